"""Text anchors: index pairs into the text of the shard they came with."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelmill.functions.let import let
from labelmill.functions.text import strip


def _position(index: Column, length: Column, default: Column) -> Column:
    """Slice bound as a position in the text; absent and 0 mean the default."""
    n = F.coalesce(index.try_cast("bigint"), F.lit(0))
    from_end = F.greatest(length + n, F.lit(0))
    return F.when(n == 0, default).when(n < 0, from_end).otherwise(F.least(n, length))


def _slice(wide: Column, length: Column, segment: Column) -> Column:
    begin = _position(segment["start_index"], length, F.lit(0).cast("bigint"))
    end = _position(segment["end_index"], length, length)
    size = F.greatest(end - begin, F.lit(0))
    part = wide.substr((begin * 4 + 1).cast("int"), (size * 4).cast("int"))
    return F.decode(part, "UTF-32")


def _unreadable(segment: Column) -> Column:
    def bad(index: Column) -> Column:
        return (F.coalesce(index, F.lit("")) != "") & index.try_cast("bigint").isNull()

    return bad(segment["start_index"]) | bad(segment["end_index"])


def _anchored(wide: Column, length: Column, segments: Column) -> Column:
    pieces = F.transform(segments, lambda s: _slice(wide, length, s))
    joined = F.array_join(pieces, "")
    return F.when(F.exists(segments, _unreadable), F.lit("")).otherwise(
        F.coalesce(joined, F.lit(""))
    )


def _with_wide(text: Column, use) -> Column:
    """Evaluate ``use(wide, length)`` with the text in four bytes per character.

    Cutting a string by character position walks it from the start each time;
    on the fixed-width form a cut costs only its own length, so a shard with
    many paragraphs stays linear.
    """
    wide = F.encode(F.coalesce(text, F.lit("")), "UTF-32")
    return let(wide, lambda w: use(w, F.floor(F.octet_length(w) / 4)))


def anchor_text(text: Column, segments: Column) -> Column:
    """Concatenated slices of ``text``; ``''`` when an index is unreadable."""
    return _with_wide(text, lambda w, n: _anchored(w, n, segments))


def page_texts(text: Column, pages: Column) -> Column:
    """Pages as ``(page_number, text)``: paragraphs on lines, ends stripped."""

    def page(w: Column, n: Column, p: Column) -> Column:
        lines = F.transform(p["paragraphs"], lambda q: _anchored(w, n, q["segments"]))
        body = strip(F.array_join(lines, "\n"))
        return F.struct(
            p["page_number"].alias("page_number"),
            F.coalesce(body, F.lit("")).alias("text"),
        )

    return _with_wide(text, lambda w, n: F.transform(pages, lambda p: page(w, n, p)))
