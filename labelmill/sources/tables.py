"""Metadata CSV."""

from pyspark.sql import DataFrame, SparkSession

from labelmill.schema import METADATA_SCHEMA


def read_metadata_csv(spark: SparkSession, path: str) -> DataFrame:
    """Metadata written as CSV, all columns as text.

    Fields may contain line breaks and a byte-order mark may open each file.
    """
    return (
        spark.read.schema(METADATA_SCHEMA)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("enforceSchema", True)
        .csv(path)
    )
