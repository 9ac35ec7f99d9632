"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition yields a run: its distinct digests in order, each with
the identifiers seen. Rounds then merge runs whose numbers differ in the lowest
binary digits, a fixed number of runs at a time, until one run is left. Each
round works on digests already reduced, so a group of copies arrives as one row
per run however large it is.

Two texts count as equal only if SHA-256, XXH64 and length agree; the latter two
verify a meeting of digests at every level.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import LOWER, UPPER
from labelmill.session import stored

# Bits of the run number that one round merges away: 16 runs become one.
ROUND_BITS = 4
KEY = ["digest", "check", "n_bytes"]


def lower_ascii(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def digests(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``(doc_id, run, digest, check, n_bytes)``, one row per input row."""
    norm = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), lower_ascii(F.col(text_column)).alias("norm")
    )
    return norm.select(
        "doc_id",
        F.spark_partition_id().alias("run"),
        F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("digest"),
        F.xxhash64("norm").alias("check"),
        F.octet_length("norm").alias("n_bytes"),
    )


def _merge(rows: DataFrame, name: str) -> DataFrame:
    """One row per run and digest; every run is written in digest order."""
    merged = rows.groupBy("run", *KEY).agg(
        F.max("keep_id").alias("keep_id"),
        F.min("first_id").alias("first_id"),
        F.sum("group_size").alias("group_size"),
    )
    return stored(merged.sortWithinPartitions("run", *KEY), name)


def merge_runs(found: DataFrame) -> DataFrame:
    """``(digest, check, n_bytes, keep_id, first_id, group_size)`` over all runs."""
    last = found.agg(F.max("run")).first()[0] or 0
    rounds = max(1, math.ceil((last + 1).bit_length() / ROUND_BITS))
    level = _merge(
        found.select(
            "run",
            *KEY,
            F.col("doc_id").alias("keep_id"),
            F.col("doc_id").alias("first_id"),
            F.lit(1).cast("long").alias("group_size"),
        ),
        "digest-runs",
    )
    for number in range(rounds):
        level = _merge(
            level.withColumn("run", F.shiftright("run", ROUND_BITS)), f"digest-round-{number}"
        )
    return level.drop("run")


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: the group of its text and whether the row stays.

    Texts are equal if identical after lower-casing A-Z; the row with the
    largest id stays, ``first_id`` is the smallest. Null texts count as empty
    and form one group with the empty ones. Null ids lose against any other; a
    group that has no other keeps them. Rows repeated with their id each count
    in ``group_size`` and share ``kept``. An empty table gives an empty result;
    columns beside id and text are not read.
    """
    found = stored(digests(docs, id_column, text_column), "digests")
    groups = merge_runs(found)
    return found.join(groups, KEY).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "first_id",
    )
