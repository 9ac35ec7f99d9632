"""Small helpers the operators of this package share."""

import string

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.session import stored

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def unsigned_unit(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def is_test_row(doc_id: str) -> Column:
    """The fixed fold that models never learn from: crc32 of the id's text mod 5."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def as_rows(docs: DataFrame, without: list[str] = []) -> Column:
    """All columns as one, so that no helper column can clash with them."""
    left_out = {n.lower() for n in without}
    kept = [c for c in docs.columns if c.lower() not in left_out]
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in kept])


# Where a row stands in its files.
FILE_PLACE = ["file_no", "split_no", "row_no"]


def _file_place(docs: DataFrame) -> list[Column]:
    meta = docs.metadataColumn("_metadata")

    def number(pattern: str) -> Column:
        found = F.regexp_extract(meta["file_name"], pattern, 1).try_cast("long")
        return F.coalesce(found, F.lit(-1).cast("long"))

    return [number("^part-([0-9]+)"), number("-c([0-9]+)[.]"), meta["row_index"]]


def in_files(docs: DataFrame, name: str) -> tuple[DataFrame, list[Column]]:
    """Documents and where each stands in its files: three longs, a key in written order.

    Meant for rows as they are read from Parquet files that Spark numbered. Rows
    that come from elsewhere, or from files whose numbers repeat, are written
    first, in the order they have.
    """
    try:
        place = _file_place(docs)
        path = docs.metadataColumn("_metadata")["file_path"].alias("path")
        files = docs.select(path, place[0].alias("file_no"), place[1].alias("split_no")).distinct()
        held, numbered = files.agg(F.count("*"), F.count_distinct("file_no", "split_no")).first()
        unique = held == numbered
    except AnalysisException:
        unique = False
    if not unique:
        docs = stored(docs, name)
        place = _file_place(docs)
    return docs, [c.alias(n) for c, n in zip(place, FILE_PLACE)]
