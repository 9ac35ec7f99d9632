"""Session settings the operators rely on, and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL options whose values change results.

    Repeated JSON keys keep the last value instead of failing the row, and
    timestamps are formatted in UTC.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a temporary folder; on
    a cluster that is an error, since executors could not see each other's
    files.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="labelmill-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write rows once to the scratch folder and read them back.

    For results that several steps read. What a service answered is then kept:
    neither a second use nor a lost executor asks again.
    """
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
