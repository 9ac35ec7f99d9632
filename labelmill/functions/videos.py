"""Video URLs and the text document made from a video."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hosts a video id is taken from.
SHORT_HOSTS = ["youtu.be"]
LONG_HOSTS = ["www.youtube.com", "youtube.com", "m.youtube.com"]

# scheme, authority, path, query; the fragment is left out.
_PARTS = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def _unquote(text: Column) -> Column:
    """Decode a query value; an incomplete escape stays as it is."""
    whole = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.try_url_decode(whole)


def _query_value(query: Column, name: str) -> Column:
    """First value of a parameter that is not blank, else ``''``."""
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike("(?s)^[^=]*=."))
    named = F.filter(pairs, lambda p: _unquote(F.substring_index(p, "=", 1)) == name)
    value = F.regexp_replace(F.get(named, F.lit(0)), "(?s)^[^=]*=", "")
    return F.coalesce(_unquote(value), F.lit(""))


def video_id(url: Column) -> Column:
    """Id of the video a URL points to, null when it points to none.

    Hosts ignore case, user and port. A short host carries the id as its path;
    a long one in ``v`` of ``/watch`` or as the part after ``/embed/`` and
    ``/v/``.
    """
    cleaned = F.regexp_replace(
        F.regexp_replace(url, r"\A[\x00-\x20]+", ""), r"[\t\r\n]", ""
    )
    authority = F.regexp_extract(cleaned, _PARTS, 1)
    host = F.lower(F.substring_index(F.substring_index(authority, "@", -1), ":", 1))
    # Parameters behind a semicolon belong to the last path segment only.
    path = F.regexp_replace(F.regexp_extract(cleaned, _PARTS, 2), ";[^/]*$", "")
    query = F.regexp_extract(cleaned, _PARTS, 3)
    long_host = host.isin(LONG_HOSTS)
    return (
        F.when(host.isin(SHORT_HOSTS), F.ltrim(path, F.lit("/")))
        .when(long_host & (path == "/watch"), _query_value(query, "v"))
        .when(
            long_host & path.rlike("^/(embed|v)/"),
            F.get(F.split(path, "/"), F.lit(2)),
        )
    )


def video_text(title: Column, channel: Column, published: Column, transcript: Column) -> Column:
    """The text of a video: head lines, a blank line, the transcript."""
    return F.concat(
        F.lit("[Video Title] "), title,
        F.lit("\n[Channel] "), channel,
        F.lit("\n[Published] "), published,
        F.lit("\n\n[Transcript]\n"), transcript,
    )


def spoken_text(transcript: Column, description: Column) -> Column:
    """The transcript, or the description where there is none."""
    return F.coalesce(
        F.nullif(transcript, F.lit("")), description, F.lit("")
    )
