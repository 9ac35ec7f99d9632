"""Video URLs to metadata records."""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.functions import videos as V
from labelmill.operators.assemble import PART_CHARS
from labelmill.operators.labelling import label_documents, rule_labels
from labelmill.operators.routing import split_quarantine
from labelmill.operators.skew import join_hot
from labelmill.operators.video import (
    chosen_lines,
    select_tracks,
    transcript_texts,
    video_documents,
    video_info,
)
from labelmill.plans.batch import Outcome, finish
from labelmill.session import configure, stored
from labelmill.sinks.tables import write_text_sidecar


# Bytes of a joined row: 13 columns with a summary, a reference to a text, or a part of one.
RECORD_BYTES, REFERENCE_BYTES, PART_BYTES = 4_000, 200, PART_CHARS


def video_ids(urls: DataFrame) -> DataFrame:
    """``(uri, video_id, status)`` of URLs in column ``url``."""
    found = V.video_id(F.col("url"))
    return urls.select(F.col("url").alias("uri"), found.alias("video_id")).withColumn(
        "status", F.when(F.col("video_id").isNull(), "not_a_video").otherwise("ok")
    )


def distinct_videos(
    ids: DataFrame,
    answers: DataFrame,
    tracks: DataFrame,
    lines: DataFrame,
    chars: int = PART_CHARS,
) -> DataFrame:
    """Documents of the videos among ``ids``, each put together once.

    ``(uri, video_id, part, start, full_text, status)``; the id also serves as
    ``uri``. Ids are reduced before the shuffle, so a video behind most of the
    URLs is one key of many, and its text is not repeated for them.
    """
    wanted = ids.filter(F.col("status") == "ok").select("video_id").distinct()
    chosen = chosen_lines(lines, select_tracks(tracks))
    spoken = transcript_texts(chosen, ("video_id",), chars)
    asked = answers.join(wanted, "video_id", "left_semi")
    return video_documents(video_info(asked), spoken, chars).withColumn("uri", F.col("video_id"))


def of_urls(ids: DataFrame, rows: DataFrame, row_bytes: int = RECORD_BYTES) -> DataFrame:
    """Rows ``(video_id, status, ...)`` of videos for each URL of ``ids``.

    A URL without a video and a video without an answer keep a status row.
    """
    # Foreign URLs share one key, null; they do not take part in the join.
    foreign = ids.filter(F.col("status") != "ok")
    own = ids.filter(F.col("status") == "ok").drop("status")
    known = join_hot(own, rows.drop("uri"), "video_id", F.col("uri"), row_bytes).withColumn(
        "status", F.coalesce("status", F.lit("video_not_found"))
    )
    return known.unionByName(foreign, allowMissingColumns=True)


def references_of_urls(ids: DataFrame, documents: DataFrame) -> DataFrame:
    """``(uri, video_id, parts, chars, status)``: which document each URL leads to.

    A URL refers to the text of its video by id; the text itself stays where it
    is, once, however many URLs share it.
    """
    known = documents.groupBy("video_id").agg(
        F.count("*").alias("parts"),
        F.sum(F.length("full_text").cast("bigint")).alias("chars"),
        F.min("status").alias("status"),
    )
    return of_urls(ids, known, REFERENCE_BYTES).select("uri", "video_id", "parts", "chars", "status")


def documents_of_urls(ids: DataFrame, documents: DataFrame) -> DataFrame:
    """``(uri, video_id, part, start, full_text, status)``: the text that each URL leads to.

    A URL without a video and a video without an answer keep a status row. URLs
    get the places of the parts first, and then each part by a key of its own,
    so neither a long text nor a video behind most URLs meets in one task.
    """
    place = ["video_id", "part", "start", "status"]
    key = F.struct(*place).alias("_key")
    placed = of_urls(ids, documents.select(*place).distinct(), REFERENCE_BYTES).select("*", key)
    held = placed.filter("part IS NOT NULL")
    texts = join_hot(held, documents.select(key, "full_text"), "_key", F.col("uri"), PART_BYTES)
    without = placed.filter("part IS NULL").withColumns({"part": F.lit(""), "start": F.lit(0).cast("bigint")})
    both = texts.unionByName(without, allowMissingColumns=True)
    return both.select("uri", "video_id", "part", "start", "full_text", "status")


def video_records(
    documents: DataFrame,
    run_date: str,
    models: list[str] | DataFrame | None = None,
    labeler: Callable[[str], str] | None = None,
    store: str | None = None,
) -> DataFrame:
    """Records of video documents; their file format is ``video``."""
    if labeler is not None:
        return label_documents(documents, labeler, run_date, source_type="video", store=store)
    rules = rule_labels(documents, [] if models is None else models, run_date, source_type="video")
    return rules.withColumn("status", F.lit("ok")).withColumn("error", F.lit(None).cast("string"))


def records_of_urls(ids: DataFrame, documents: DataFrame, records: DataFrame) -> DataFrame:
    """``(uri, found, 13 columns, status, error)`` of every URL.

    ``found`` says what became of the URL, ``status`` of the labels. Only the
    narrow records are joined to the URLs, never the texts.
    """
    labels = records.withColumnsRenamed({"uri": "video_id", "status": "_labels"})
    videos = documents.groupBy("video_id").agg(F.min("status").alias("status"))
    joined = of_urls(ids, videos.join(labels, "video_id", "left"))
    return joined.withColumnsRenamed({"status": "found", "_labels": "status"})


def run_videos(
    urls: DataFrame,
    answers: DataFrame,
    tracks: DataFrame,
    lines: DataFrame,
    output_path: str,
    at: datetime,
    models: list[str] | DataFrame | None = None,
    labeler: Callable[[str], str] | None = None,
) -> Outcome:
    """Label the videos behind a table of URLs, or behind one.

    Each video is written and labelled once, under its id; its record goes to
    all its URLs. URLs without a video end in ``Outcome.quarantine``. The CSV
    of a single URL bears the id of its video.
    """
    configure(urls.sparkSession)
    ids = video_ids(urls)
    documents = stored(distinct_videos(ids, answers, tracks, lines), "videos")
    good = split_quarantine(documents)[0]
    write_text_sidecar(good, f"{output_path.rstrip('/')}/parsing", f"{at:%Y%m%d_%H%M%S}")
    labels = stored(video_records(good, f"{at:%Y-%m-%d}", models, labeler, f"{output_path.rstrip('/')}/answers"), "labels")
    records = stored(records_of_urls(ids, documents, labels), "records")
    failed = records.filter(F.col("found") != "ok").select(
        "uri", "video_id", F.col("found").alias("status")
    )
    return finish(
        records.filter(F.col("found") == "ok"),
        f"{output_path.rstrip('/')}/{_csv_name(ids, at)}",
        failed,
    )


def _csv_name(ids: DataFrame, at: datetime) -> str:
    few = ids.select("video_id").limit(2).collect()
    if len(few) == 1 and few[0]["video_id"] is not None:
        return f"video_{few[0]['video_id']}_{at:%Y%m%d_%H%M%S}_metadata.csv"
    return f"video_metadata_{at:%Y%m%d_%H%M%S}.csv"
