"""Stored video answers and transcript lines to video documents."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.functions import videos as V
from labelmill.operators.assemble import PART_CHARS, cut_rows, in_parts, moved_parts
from labelmill.schema import CAPTION_ANSWER, VIDEO_ANSWER

LANGUAGES = ("ko", "en")


def video_info(answers: DataFrame) -> DataFrame:
    """Title, description and the like from ``(video_id, response)``.

    A missing field is ``''``; an answer without a video is a status row.
    """
    found = answers.withColumn("_a", F.from_json("response", VIDEO_ANSWER))
    item = F.get(F.col("_a.items"), F.lit(0))
    snippet = item["snippet"]
    fields = {
        "title": "title",
        "description": "description",
        "channel": "channelTitle",
        "published_at": "publishedAt",
        "default_language": "defaultLanguage",
        "default_audio_language": "defaultAudioLanguage",
    }
    status = (
        F.when(item.isNull(), "video_not_found")
        .when(snippet.isNull(), "no_snippet")
        .otherwise("ok")
    )
    return found.withColumn("status", status).select(
        "video_id",
        *[
            F.when(F.col("status") == "ok", F.coalesce(snippet[key], F.lit(""))).alias(name)
            for name, key in fields.items()
        ],
        "status",
    )


def caption_tracks(answers: DataFrame) -> DataFrame:
    """One row per caption track; a video without any keeps a row of nulls."""
    found = answers.withColumn("_a", F.from_json("response", CAPTION_ANSWER))
    return found.select("video_id", F.explode_outer("_a.items").alias("item")).select(
        "video_id",
        F.col("item.id").alias("track_id"),
        F.col("item.snippet.language").alias("language"),
        F.when(
            F.col("item").isNotNull(),
            F.coalesce(F.lower("item.snippet.trackKind") == "asr", F.lit(False)),
        ).alias("is_generated"),
    )


def select_tracks(tracks: DataFrame, languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """The track to read for each video, none where no language fits.

    Languages are tried in order; within one a manual track goes before a
    generated one. A minimum is enough for that, and unlike a ranking it is
    reduced before the shuffle.
    """
    rank = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("language"))
    best = F.min(F.struct(rank.alias("rank"), "is_generated", "track_id", "language"))
    return (
        tracks.filter(F.col("language").isin(*languages))
        .groupBy("video_id")
        .agg(best.alias("t"))
        .select("video_id", "t.track_id", "t.language", "t.is_generated")
    )


def transcript_texts(
    lines: DataFrame,
    keys: tuple[str, ...] = ("video_id", "track_id"),
    chars: int = PART_CHARS,
) -> DataFrame:
    """Lines ``(video_id, track_id, seq, text)`` as texts ``(keys, part, start, transcript)``.

    Lines go on lines of their own, in ``seq`` order; one without text is an
    empty line. A text of more than ``chars`` characters has several parts, see
    ``assemble``.
    """
    rows = lines.select(*keys, "seq", F.coalesce("text", F.lit("")).alias("transcript"))
    return in_parts(rows, list(keys), "seq", "transcript", separator="\n", chars=chars)


def chosen_lines(lines: DataFrame, tracks: DataFrame) -> DataFrame:
    """Lines of the selected tracks only."""
    wanted = tracks.select("video_id", "track_id")
    return lines.join(wanted, ["video_id", "track_id"], "left_semi")


def video_documents(info: DataFrame, transcripts: DataFrame, chars: int = PART_CHARS) -> DataFrame:
    """Documents ``(video_id, part, start, full_text, status)`` of videos.

    ``transcripts`` holds one text per video, maybe in parts. A video without
    transcript is read from its description. Behind the head lines the parts of
    a long transcript begin elsewhere and are cut anew.
    """
    spoken = transcripts.select("video_id", "part", "start", "transcript")
    rows = info.join(spoken, "video_id", "left")
    title = [F.col(c) for c in ("title", "channel", "published_at")]
    known, opening = F.col("status") == "ok", F.col("start") == 0
    in_one = F.coalesce(F.col("part"), F.lit("")) == ""
    words = V.spoken_text(F.col("transcript"), F.col("description"))
    short = rows.filter(in_one | (~known & opening)).select(
        "video_id", V.video_text(*title, words).alias("full_text"), "status"
    )
    head = V.video_text(*title, F.lit(""))
    long = rows.filter(~in_one & known).select(
        "video_id",
        F.when(opening, F.concat(head, "transcript")).otherwise(F.col("transcript")).alias("full_text"),
        F.when(opening, F.lit(0)).otherwise(F.col("start") + F.length(head)).alias("begin"),
        "status",
    )
    moved = moved_parts(long, ["video_id", "status"], "begin", "full_text", chars)
    whole = cut_rows(short, "full_text", chars)
    return whole.unionByName(moved).select("video_id", "part", "start", "full_text", "status")
