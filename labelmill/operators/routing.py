"""Which inputs are taken, how they are read, and which are done."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions import uri as U
from labelmill.schema import DIRECT_LIMIT_BYTES


def select_objects(listing: DataFrame, prefix: str = "", suffix: str = "") -> DataFrame:
    """Objects under a prefix with a suffix; folder markers are left out.

    Both tests respect case.
    """
    uri = F.col("uri")
    keep = ~F.endswith(uri, F.lit("/"))
    if prefix:
        keep = keep & F.startswith(uri, F.lit(prefix))
    if suffix:
        keep = keep & F.endswith(uri, F.lit(suffix))
    return listing.filter(keep).select(
        "*",
        U.file_name(uri).alias("file_name"),
        U.mime_type(uri).alias("mime_type"),
    )


def object_info(listing: DataFrame) -> DataFrame:
    """``(uri, size, content_type, created)``; 0 or ``''`` where unknown.

    ``created`` is the time as ISO 8601 in UTC, fractions only if there are any.
    """
    at = F.to_utc_timestamp("modificationTime", F.current_timezone())
    whole = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(at, ".SSSSSS")
    created = F.concat(
        whole, F.when(fraction == ".000000", "").otherwise(fraction), F.lit("+00:00")
    )
    return listing.select(
        "uri",
        F.coalesce("length", F.lit(0)).alias("size"),
        U.mime_type(F.col("uri")).alias("content_type"),
        F.coalesce(created, F.lit("")).alias("created"),
    )


def supported_files(listing: DataFrame) -> DataFrame:
    return listing.filter(U.is_supported(F.col("uri")))


def size_route(length: Column, limit: int = DIRECT_LIMIT_BYTES) -> Column:
    """``chunked`` above the limit; an unknown size counts as 0."""
    return F.when(F.coalesce(length, F.lit(0)) > limit, "chunked").otherwise("direct")


def already_processed(listing: DataFrame, done: DataFrame) -> DataFrame:
    """Inputs that already have output.

    The output side may hold many rows per input; they are reduced before they
    are shuffled.
    """
    return listing.join(done.select("uri").distinct(), "uri", "left_semi")


def pending_files(listing: DataFrame, done: DataFrame) -> DataFrame:
    return listing.join(done.select("uri").distinct(), "uri", "left_anti")


def split_quarantine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and the others, by ``status``; no row is in both or neither."""
    good = F.coalesce(F.col("status") == "ok", F.lit(False))
    return rows.filter(good), rows.filter(~good)


def status_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count("*").alias("n"))
