"""Documents to metadata records: listing, extraction, labels, CSV, report."""

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelmill.functions import uri as U
from labelmill.operators.assemble import cut_rows
from labelmill.operators.extraction import Extractor, extract_documents
from labelmill.operators.labelling import label_documents, rule_labels
from labelmill.operators.records import metadata_table
from labelmill.operators.report import distribution_report, placed_report
from labelmill.operators.routing import select_objects, size_route, split_quarantine, supported_files
from labelmill.operators.shards import (
    merge_shards,
    owned_shards,
    parse_shards,
    shards_of,
    with_missing,
)
from labelmill.schema import DIRECT_LIMIT_BYTES
from labelmill.session import configure, stored
from labelmill.sinks.tables import write_metadata_csv, write_text_sidecar
from labelmill.sources.files import Opener, below_prefix, list_objects, open_uri, read_contents


@dataclass
class Outcome:
    """What a run wrote: CSV folder (``''`` if empty), tables, report."""

    csv_path: str
    records: DataFrame
    quarantine: DataFrame
    report: DataFrame


def small_files(listing: DataFrame) -> DataFrame:
    """Files that are read in one call; one of unknown size is."""
    return listing.filter(F.coalesce("length", F.lit(0)) <= DIRECT_LIMIT_BYTES)


def direct_documents(contents: DataFrame, extractor: Extractor) -> DataFrame:
    """Documents of the files that are read in one call.

    ``contents`` holds ``(uri, length, content)``; contents are neither joined
    nor shuffled.
    """
    found = extract_documents(small_files(contents).select("uri", "length", "content"), extractor)
    return cut_rows(found, "full_text", lists=("pages", "entities"))


def chunked_documents(files: DataFrame, shards: DataFrame, at: datetime) -> DataFrame:
    """Documents of the listed large files from their stored OCR shards.

    ``shards`` carries ``(shard_uri, length, content)`` and either the ``uri``
    of the document, or else a path below its ``chunk_prefix`` of the run
    ``at``. A file without any becomes a status row.
    """
    large = files.filter(F.col("route") == "chunked").select("uri")
    if "uri" in shards.columns:
        own = shards_of(shards, large)
    else:
        # Owners are found by run and document folder, in whatever bucket.
        put = U.chunk_prefix(F.lit(""), F.col("uri"), F.lit(at).cast("timestamp"))
        own = owned_shards(shards, large.select("uri", put.alias("chunk_prefix")))
    size = F.col("length") if "length" in shards.columns else None
    merged = with_missing(large, merge_shards(parse_shards(own), size=size), own)
    return merged.withColumn("error", F.lit(None).cast("string"))


def batch_records(
    documents: DataFrame,
    run_date: str,
    models: list[str] | DataFrame | None = None,
    labeler: Callable[[str], str] | None = None,
    partitions: int | None = None,
    store: str | None = None,
) -> DataFrame:
    """Records of extracted documents ``(uri, part, full_text)``.

    With a ``labeler`` its answers are used, kept at ``store`` if that is
    given; otherwise the text rules.
    """
    if labeler is not None:
        return label_documents(documents, labeler, run_date, partitions=partitions, store=store)
    rules = rule_labels(documents, [] if models is None else models, run_date)
    return rules.withColumn("status", F.lit("ok")).withColumn("error", F.lit(None).cast("string"))


def finish(records: DataFrame, csv_path: str, failed: DataFrame) -> Outcome:
    """Write the CSV and hang the report on the same stored records.

    A run repeated under its name replaces its own output.
    """
    table = metadata_table(records)
    written = write_metadata_csv(table, csv_path, mode="overwrite")
    return Outcome(written, records, failed, placed_report(distribution_report(table)))


def _run(
    listing: DataFrame,
    contents: DataFrame,
    output_path: str,
    csv_name: str,
    extractor: Extractor,
    at: datetime,
    models: list[str] | DataFrame | None,
    labeler: Callable[[str], str] | None,
    shards: DataFrame | None,
    shards_at: datetime | None,
    partitions: int | None,
) -> Outcome:
    files = select_objects(listing).withColumn("route", size_route(F.col("length")))

    documents = direct_documents(contents, extractor)
    if shards is not None:
        documents = documents.unionByName(chunked_documents(files, shards, shards_at or at))
    else:
        unread = files.filter(F.col("route") == "chunked").select(
            "uri", F.lit("").alias("part"), F.lit(0).cast("bigint").alias("start"), "mime_type",
            F.lit("no_shards").alias("status"),
        )
        documents = documents.unionByName(unread, allowMissingColumns=True)

    good, failed = split_quarantine(stored(documents, "documents"))
    folder = output_path.rstrip("/")
    write_text_sidecar(good, f"{folder}/parsing", f"{at:%Y%m%d_%H%M%S}")
    labelled = batch_records(good, f"{at:%Y-%m-%d}", models, labeler, partitions, f"{folder}/answers")
    return finish(stored(labelled, "records"), f"{folder}/{csv_name}", failed)


def run_batch(
    spark: SparkSession,
    inputs: str | DataFrame,
    output_path: str,
    extractor: Extractor,
    at: datetime,
    models: list[str] | DataFrame | None = None,
    labeler: Callable[[str], str] | None = None,
    shards: DataFrame | None = None,
    any_extension: bool = False,
    partitions: int | None = None,
    shards_at: datetime | None = None,
    opener: Opener = open_uri,
) -> Outcome:
    """Label all files whose path begins with ``inputs``, see ``below_prefix``.

    ``inputs`` may also be a table ``(uri, length, content)``: then nothing is
    listed. ``opener`` brings another file system than those pyarrow knows. One bad file never stops the others: it ends in
    ``Outcome.quarantine``, while a document whose labelling failed keeps its
    default record. ``any_extension`` takes whatever the suffix is. ``shards``
    without a ``uri`` are those of the run ``shards_at``, this one by default.
    """
    configure(spark)
    if isinstance(inputs, DataFrame):
        contents = inputs if any_extension else supported_files(inputs)
        listing = contents.drop("content")
    else:
        listing = list_objects(spark, below_prefix(inputs), opener)
        listing = listing if any_extension else supported_files(listing)
        contents = read_contents(small_files(listing), opener)
    name = f"batch_metadata_{at:%Y%m%d_%H%M%S}.csv"
    return _run(
        listing, contents, output_path, name, extractor, at, models, labeler, shards, shards_at, partitions
    )


def run_file(
    spark: SparkSession,
    path: str,
    output_path: str,
    extractor: Extractor,
    at: datetime,
    models: list[str] | DataFrame | None = None,
    labeler: Callable[[str], str] | None = None,
    shards: DataFrame | None = None,
    shards_at: datetime | None = None,
    opener: Opener = open_uri,
) -> Outcome:
    """Label one file, whatever its extension.

    Its CSV bears its name and is replaced when the file is labelled again.
    """
    configure(spark)
    name = path.rsplit("/", 1)[-1].rsplit(".", 1)[0] + "_metadata.csv"
    listing = list_objects(spark, path, opener)
    contents = read_contents(small_files(listing), opener)
    return _run(
        listing, contents, output_path, name, extractor, at, models, labeler, shards, shards_at, None
    )


def output_names(listing: DataFrame, folder: str, at: datetime) -> DataFrame:
    """Where the outputs of each listed file go."""
    uri, stamp = F.col("uri"), F.lit(at).cast("timestamp")
    return listing.select(
        "uri",
        U.document_csv_path(F.lit(folder), uri).alias("csv_path"),
        U.sidecar_path(F.lit(folder), U.file_name(uri)).alias("sidecar_path"),
        U.chunk_prefix(U.bucket(uri), uri, stamp).alias("chunk_prefix"),
    )
