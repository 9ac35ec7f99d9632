"""Documents to training shards in five stages, each written and read again.

1. ``quality``: documents the classifier rejects go.
2. ``near_duplicates``: of documents linked by SimHash, the smallest id stays.
3. ``decontamination``: documents that overlap with a benchmark item go.
4. ``mixing``: the rest in the order of the mix; none goes.
5. ``sharding``: every document with its shard and slot; the slots of a shard
   follow the mix.

All but the last return the columns they were given. Documents are told apart by
``doc_id``; rows repeated with their id share their fate, and rows with a null
id pass the stages that look documents up. Null texts count as empty. An empty
table passes through.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.llm import decontam, mixing, quality, sharding, simhash
from labelmill.llm.common import table
from labelmill.session import stored

# Ids to drop that may be broadcast, once counted; 8 bytes each.
DROPPED_ROWS = 500_000


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Documents whose id is not in ``dropped``, a stored table of distinct ids."""
    if dropped.limit(DROPPED_ROWS + 1).count() <= DROPPED_ROWS:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, docs["doc_id"].cast("long") == dropped["dropped_id"], "left_anti")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the factorisation machine accepts, from a score of 0.3."""
    machine = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.score(docs, machine) >= quality.ACCEPTED_FROM)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    found = simhash.near_duplicates(docs)
    others = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("dropped_id"))
    return _without(docs, stored(others.distinct(), "near-duplicates"))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with the benchmark."""
    found = decontam.leaks(docs, table(spark, sf_dir, "benchmark"))
    leaked = found.select(F.col("doc_id").alias("dropped_id")).distinct()
    return _without(docs, stored(leaked, "leaked"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order in which the schedule interleaves their sources."""
    return mixing.in_mixed_order(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``shard`` and ``slot``; input columns of these names are replaced.

    Shards hold near equal bytes; inside each, documents follow each other as in
    the files they are read from, which is the order of the mix.
    """
    return sharding.with_shards(docs, keep_order=True)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_clean),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# A trained classifier and XXH64 fingerprints have no SQL; the tests hold the
# pipeline against brute force.
ORACLE_SQL = None
