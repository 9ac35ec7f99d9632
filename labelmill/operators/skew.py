"""Joins that stay spread out when one key holds a large share of the rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelmill.session import stored

SALTS = 64

# Bytes of joined rows that one task should make of a key. Keys beyond it are
# salted; there are at most (bytes / limit) of them.
TASK_BYTES = 64 * 1024 * 1024
# Keys that may be broadcast once counted.
_BROADCAST_KEYS = 10_000


def salt_of(spread_by: Column) -> Column:
    return F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int")


def few_or_all(keys: DataFrame) -> DataFrame | None:
    """Keys marked for broadcast once counted as few; None if there are none."""
    first = keys.limit(_BROADCAST_KEYS + 1).collect()
    if not first:
        return None
    if len(first) > _BROADCAST_KEYS:
        return keys
    return F.broadcast(keys.sparkSession.createDataFrame(first, keys.schema))


def join_narrow(
    rows: DataFrame, lookup: DataFrame, keys: list[str], spread_by: Column, how: str = "inner"
) -> DataFrame:
    """Join with a lookup of one short row per key, repeated for every salt.

    For lookups so much narrower than the rows that repeating them costs little.
    """
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    repeated = lookup.withColumn("_salt", F.explode(salts))
    salted = rows.withColumn("_salt", salt_of(spread_by))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def join_short(
    rows: DataFrame, lookup: DataFrame, keys: list[str], spread_by: Column, how: str = "inner"
) -> DataFrame:
    """Join with a lookup of one short row per key: broadcast once it was
    counted as few, salted beyond that."""
    counted = few_or_all(lookup)
    if counted is lookup:
        return join_narrow(rows, lookup, keys, spread_by, how)
    return rows.join(lookup if counted is None else counted, keys, how)


def join_hot(
    rows: DataFrame, lookup: DataFrame, key: str, spread_by: Column, row_bytes: int, how: str = "left"
) -> DataFrame:
    """Join with a lookup of wide rows, one per key; a joined row takes ``row_bytes``.

    Rows per key are counted at once, reduced in the map tasks. A key gets as
    many salts as its joined rows fill tasks, and its lookup row is repeated as
    often; without a key of several tasks this is the plain join.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
    salts = F.ceil(F.col("_n") * row_bytes / TASK_BYTES).cast("int").alias("_salts")
    hot = few_or_all(counts.select(key, salts).filter("_salts > 1"))
    if hot is None:
        return rows.join(lookup, key, how)
    own = F.pmod(F.xxhash64(spread_by), F.coalesce("_salts", F.lit(1))).cast("int")
    salted = rows.join(hot, key, "left").withColumn("_salt", own).drop("_salts")
    numbers = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = lookup.join(hot, key, "left").withColumn("_salt", F.explode(numbers)).drop("_salts")
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def running_before(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Narrow ``rows`` with ``_before``: the sum of ``value`` over the earlier rows of their key.

    Rows are dealt by ranges of key and order, so one key may lie in many
    tasks. Each range is summed for itself; the sums of a key's ranges, one row
    each, tell where a range begins.
    """
    ranged = stored(
        rows.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    held = ranged.groupBy("_range", *keys).agg(F.sum(value).alias("_held"))
    ranges = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    # In a struct a null key equals itself.
    key = F.struct("_range", *keys).alias("_key")
    first = held.select(key, F.coalesce(F.sum("_held").over(ranges), F.lit(0)).alias("_first"))
    inside = W.partitionBy("_range", *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    within = ranged.withColumn("_within", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        within.withColumn("_key", key)
        .join(first, "_key")
        .withColumn("_before", F.col("_first") + F.col("_within"))
        .drop("_key", "_range", "_first", "_within")
    )
