"""Shards of near equal bytes by sampled splitters."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelmill.llm.common import FILE_PLACE, as_rows, in_files, text_of
from labelmill.llm.splitters import numbers, ranked
from labelmill.session import stored

SHARDS = 40
# Bytes a row takes beside its text.
ROW_BYTES = 16
# Copies stay in one shard if together they are at most this share of one:
# one in so many.
WHOLE_GROUP = 50
LAW = "bytes"
_LOWEST = -(1 << 63)


def sized(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    place: list[Column] | None = None,
) -> DataFrame:
    """Narrow rows to place: id, size, checksum and the order of the shards.

    Ordered by a hash of the text, copies follow each other; the id and
    ``place``, or else a running number, make rows distinct.
    """
    text = text_of(text_column)
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(_LOWEST)).alias("id_key"),
        *(place or [F.monotonically_increasing_id().alias("row_key")]),
    )


def _placed(rows: DataFrame, shards: int, row_key: list[str]) -> DataFrame:
    """Stored ``sized`` rows with their ``shard`` and their ``slot`` in it.

    ``ranked`` range-partitions the rows by splitters drawn by size and tells
    how many bytes precede each; a row goes to the shard its middle byte falls
    in. Equal texts are one unit if they are small beside a shard and are cut by
    id else, so a shard is off its share by no more than one unit at either end.
    """
    found = ranked(rows, ["text_key", "id_key", *row_key], "size")
    copies = Window.partitionBy("range_no", "text_key")
    whole = F.col("copies_size") * WHOLE_GROUP * shards <= found.weight
    twice_middle = F.when(whole, 2 * F.col("copies_before") + F.col("copies_size")).otherwise(
        2 * F.col("before") + F.col("size")
    )
    units = found.rows.withColumns(
        {
            "copies_size": F.sum("size").over(copies),
            "copies_before": F.min("before").over(copies),
        }
    )
    share = F.floor(twice_middle * shards / F.lit(max(1, 2 * found.weight)))
    shard = F.least(F.lit(shards - 1), share).cast("int")
    placed = stored(
        units.select("doc_id", "size", "text_crc32", *row_key, shard.alias("shard"), "place"), "placed"
    )
    return _slotted(placed)


def _slotted(placed: DataFrame) -> DataFrame:
    """``slot`` from ``place``, a number of all rows that goes through the shards in turn."""
    starts = dict(placed.groupBy("shard").agg(F.min("place")).collect())
    first = numbers([starts.get(s, 0) for s in range(max(starts, default=0) + 1)])
    return placed.withColumn("slot", F.col("place") - F.get(first, F.col("shard").cast("int"))).drop("place")


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every row with its shard and its slot in it; shards hold near equal bytes.

    Slots count from 0 without gaps. Null texts have size 16; null ids come
    first; repeated rows are placed each; an empty table gives an empty result.
    """
    rows = stored(sized(docs, id_column, text_column), "sized")
    return _placed(rows, shards, ["row_key"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def with_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_order: bool = False,
) -> DataFrame:
    """The rows of ``docs`` with their ``shard`` and ``slot``, as ``shard_documents`` places them.

    With ``keep_order`` the rows of a shard follow each other as they do in the
    files of ``docs``; only narrow rows are sorted for that, by range. Input
    columns named ``shard`` or ``slot`` are replaced; other names do not matter.
    Rows are told apart by where they stand in their files, see ``in_files``.
    """
    docs, place = in_files(docs, "to-shard")
    rows = stored(sized(docs, id_column, text_column, place), "sized")
    placed = _placed(rows, shards, FILE_PLACE)
    if keep_order:
        wide = placed.select(*FILE_PLACE, F.col("shard").cast("long").alias("shard"), F.lit(1).cast("long").alias("one"))
        found = ranked(stored(wide, "to-order"), ["shard", *FILE_PLACE], "one").rows
        placed = _slotted(stored(found.select(*FILE_PLACE, "shard", "place"), "ordered"))
    keys = placed.select(
        F.struct(*FILE_PLACE).alias("at"), F.col("shard").cast("int").alias("shard"), "slot"
    )
    mine = docs.select(as_rows(docs, ["shard", "slot"]).alias("row"), F.struct(*place).alias("at"))
    return mine.join(keys.hint("merge"), "at").select("row.*", "shard", "slot")
