"""Metadata CSV and the text kept beside it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.operators.records import metadata_table

BYTE_ORDER_MARK = "\ufeff"

# Buckets of a table by URI; about one for each 128 MB it will hold.
URI_BUCKETS = 64

# A file is read back by one task, since values may hold line breaks.
ROWS_PER_FILE = 100_000


def write_metadata_csv(records: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write the 13 columns as CSV files with byte-order marks; their path.

    The mark is part of the first header name, since the writer has no option
    for it. An empty table writes nothing and returns ``''``. The path is a
    folder; every task writes files of its own, of limited length. ``append`` adds files and
    leaves the old ones alone.
    """
    table = metadata_table(records)
    if table.isEmpty():
        return ""
    first = table.columns[0]
    marked = table.withColumnRenamed(first, BYTE_ORDER_MARK + first)
    (
        marked.write.mode(mode)
        .option("header", True)
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def write_text_sidecar(documents: DataFrame, path: str, run: str) -> str:
    """Put texts into the sidecar table ``(uri, part, full_text, run)``; its path.

    Keyed by the full URI: files of one name in two folders do not replace
    each other. A run repeated under its name replaces its own rows only.
    """
    rows = documents.select("uri", "part", "full_text").withColumn("run", F.lit(run))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run")
        .parquet(path)
    )
    return path


def write_by_uri(rows: DataFrame, name: str, path: str | None = None, buckets: int = URI_BUCKETS) -> None:
    """Add rows to the table ``name``, bucketed by ``uri``; the table is made if it is not there.

    Only the new rows are dealt; those of earlier runs stay where they are. What
    is joined to such a table by ``uri`` moves, the table does not. ``path``
    puts a new table elsewhere than the warehouse.
    """
    writer = rows.repartition(buckets, "uri").write.mode("append").format("parquet")
    if path and not rows.sparkSession.catalog.tableExists(name):
        writer = writer.option("path", path)
    writer.bucketBy(buckets, "uri").sortBy("uri").saveAsTable(name)
