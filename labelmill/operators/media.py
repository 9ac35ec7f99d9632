"""Speech of media files, transcribed in time segments and put together again."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.operators.assemble import PART_CHARS, in_parts

# A service is asked for so much of a medium at a time.
SEGMENT_MS = 300_000

# What is said in a medium, from one time to another.
Transcriber = Callable[[str, int, int], str]


def time_segments(media: DataFrame, segment_ms: int = SEGMENT_MS) -> DataFrame:
    """``(uri, start_ms, end_ms)`` of media ``(uri, duration_ms)``, the last one shorter.

    A medium of no or unknown length has no segment.
    """
    known = media.filter(F.col("duration_ms") > 0)
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("duration_ms") - 1, F.lit(segment_ms).cast("bigint"))
    cut = known.select("uri", F.col("duration_ms").cast("bigint").alias("duration_ms"))
    return cut.select("uri", "duration_ms", F.explode(starts).alias("start_ms")).select(
        "uri", "start_ms", F.least(F.col("start_ms") + segment_ms, "duration_ms").alias("end_ms")
    )


def transcribe(segments: DataFrame, transcriber: Transcriber) -> DataFrame:
    """Segments with ``text`` and ``error``; a call that fails costs its own segment only."""

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, errors = [], []
            for uri, start, end in zip(batch["uri"], batch["start_ms"], batch["end_ms"]):
                try:
                    text, error = transcriber(uri, int(start), int(end)), None
                except Exception as e:  # one bad segment must not stop the others
                    text, error = None, f"{type(e).__name__}: {e}"
                texts.append(text)
                errors.append(error)
            yield batch.assign(text=texts, error=errors)

    given = segments.select("uri", "start_ms", "end_ms")
    return given.mapInPandas(call, "uri string, start_ms long, end_ms long, text string, error string")


def media_transcripts(segments: DataFrame, chars: int = PART_CHARS) -> DataFrame:
    """Transcripts ``(uri, part, start, full_text, segments, spoken_ms, status)`` of media.

    Segments ``(uri, start_ms, end_ms, text)`` follow each other by time, each on
    lines of its own, word for word. A text of more than ``chars`` characters
    has several parts, see ``assemble``. ``status`` is ``missing_text`` if a
    segment has none, ``missing_segment`` if they leave out or repeat some time.
    """
    length = F.col("end_ms") - F.col("start_ms")
    covered = (F.min("start_ms") == 0) & (F.sum(length) == F.max("end_ms"))
    silent = F.count(F.when(F.col("text").isNull(), 1)) > 0
    status = F.when(silent, "missing_text").when(covered, "ok").otherwise("missing_segment")
    rows = segments.select("uri", "start_ms", "end_ms", "text", F.coalesce("text", F.lit("")).alias("full_text"))
    return in_parts(
        rows, ["uri"], "start_ms", "full_text", separator="\n", chars=chars,
        facts={"segments": F.count("*"), "spoken_ms": F.sum(length), "status": status},
    )
