"""OCR shards to documents: parse, cut pages, merge in shard order."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.functions import uri as U
from labelmill.functions.anchors import page_texts
from labelmill.operators.assemble import PART_CHARS, in_parts
from labelmill.operators.skew import join_short, running_before
from labelmill.schema import ENTITIES, SHARD_JSON, SHARD_PAGES
from labelmill.session import stored


def owned_shards(files: DataFrame, names: DataFrame) -> DataFrame:
    """Shard files ``(shard_uri, ...)`` with the ``uri`` of their document.

    ``names`` holds ``(uri, chunk_prefix)``: where the shards of a document were
    put. They may lie in any folder below. Shards of other documents go; before
    the texts are parsed, and however many shards a document has.
    """
    owners = names.select("uri", U.chunk_folder(F.col("chunk_prefix")).alias("_folder"))
    placed = files.drop("uri").withColumn("_folder", U.chunk_folder(F.col("shard_uri")))
    return join_short(
        placed, owners.filter(F.col("_folder") != ""), ["_folder"], F.col("shard_uri")
    ).drop("_folder")


def shards_of(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Shards ``(uri, shard_uri, ...)`` of the expected documents only."""
    listed = expected.select("uri").distinct()
    return join_short(files, listed, ["uri"], F.col("shard_uri"), "left_semi")


def parse_shards(files: DataFrame, content: str = "content") -> DataFrame:
    """Shard files ``(uri, shard_uri, content)`` to their text and structure.

    Indices are read as text, which is how the JSON carries 64-bit numbers. An
    unreadable file keeps its row with ``status`` set.
    """
    body = F.from_json(F.col(content).cast("string"), SHARD_JSON)
    segments = lambda s: F.transform(
        s,
        lambda x: F.struct(
            x["startIndex"].alias("start_index"), x["endIndex"].alias("end_index")
        ),
    )
    pages = F.transform(
        F.col("_body.pages"),
        lambda p: F.struct(
            F.coalesce(p["pageNumber"], F.lit(0)).alias("page_number"),
            F.transform(
                p["paragraphs"],
                lambda q: F.struct(
                    segments(q["layout"]["textAnchor"]["textSegments"]).alias("segments")
                ),
            ).alias("paragraphs"),
        ),
    )
    entities = F.transform(
        F.col("_body.entities"),
        lambda e: F.struct(
            F.coalesce(e["type"], F.lit("")).alias("type"),
            F.coalesce(e["mentionText"], F.lit("")).alias("mention_text"),
            F.coalesce(e["confidence"], F.lit(0.0)).alias("confidence"),
        ),
    )
    # A record parser answers unreadable text with a struct of nulls.
    unreadable = F.col("_body").isNull() | (
        F.col("_body.text").isNull()
        & F.col("_body.pages").isNull()
        & F.col("_body.entities").isNull()
        & ~F.trim(F.col(content).cast("string")).rlike(r"^\{\s*\}$")
    )
    return files.withColumn("_body", body).select(
        *[c for c in files.columns if c != content],
        F.coalesce("_body.text", F.lit("")).alias("text"),
        F.coalesce(pages, F.array().cast(SHARD_PAGES)).alias("pages"),
        F.coalesce(entities, F.array().cast(ENTITIES)).alias("entities"),
        F.when(unreadable, "unreadable_shard").otherwise("ok").alias("status"),
    )


def _first_problem(status: Column) -> Column:
    return F.coalesce(F.min(F.when(status != "ok", status)), F.lit("ok"))


def merge_shards(
    shards: DataFrame, chars: int = PART_CHARS, size: Column | None = None
) -> DataFrame:
    """Documents of parsed shards: text, pages and entities in shard order.

    The order is that of the shard names as text, so ``-10`` comes before
    ``-2``; texts are joined without a separator, page numbers are kept as they
    are. Page texts are cut from their own shard before anything is merged.
    ``(uri, part, start, mime_type, full_text, pages, entities, status)``: a
    text of more than ``chars`` characters has several parts, see ``assemble``;
    the pages and entities of a shard stand in the part in which it begins.
    ``size`` may name a column with the file length, which saves reading the
    texts once more to find the long ones.
    """
    if "status" not in shards.columns:
        shards = shards.withColumn("status", F.lit("ok"))
    pages = page_texts(F.col("text"), F.col("pages"))
    rows = shards.select(
        "uri", "shard_uri", F.col("text").alias("full_text"), pages.alias("pages"), "entities", "status",
        (F.lit(None).cast("bigint") if size is None else size).alias("_bytes"),
    )
    merged = in_parts(
        rows, ["uri"], "shard_uri", "full_text", ("pages", "entities"), chars=chars,
        size=None if size is None else F.col("_bytes"),
        facts={"status": _first_problem(F.col("status"))},
    )
    return merged.select(
        "uri", "part", "start", U.mime_type(F.col("uri")).alias("mime_type"), "full_text", "pages",
        "entities", "status",
    )


def with_missing(expected: DataFrame, merged: DataFrame, shards: DataFrame) -> DataFrame:
    """Merged documents, with a status row for the expected ones without shards."""
    listed = expected.select("uri")
    missing = listed.join(shards.select("uri").distinct(), "uri", "left_anti")
    rows = missing.select(
        "uri", F.lit("").alias("part"), F.lit(0).cast("bigint").alias("start"), F.lit("no_shards").alias("status")
    )
    return merged.unionByName(rows, allowMissingColumns=True)


def page_stats(shards: DataFrame) -> DataFrame:
    """Pages and characters per document, summed over its parsed shards."""
    return shards.groupBy("uri").agg(
        F.sum(F.size("pages").cast("bigint")).alias("page_count"),
        F.sum(F.length("text").cast("bigint")).alias("text_length"),
    )


def entity_list(shards: DataFrame) -> DataFrame:
    """One row per recognised entity of parsed shards, numbered through their document.

    Numbers come from the sizes of the shards before, summed by range, so
    neither the shards of a large document nor any entity meet in one task.
    """
    tie = F.xxhash64(F.to_json("entities")).alias("_tie")
    rows = stored(
        shards.select("uri", "shard_uri", "entities", tie, F.monotonically_increasing_id().alias("_row")),
        "entities",
    )
    sizes = rows.select("_row", "uri", "shard_uri", "_tie", F.size("entities").cast("bigint").alias("_n"))
    before = running_before(sizes, ["uri"], ["shard_uri", "_tie"], "_n").select("_row", "_before")
    listed = rows.filter(F.size("entities") > 0).join(before, "_row")
    return listed.select("uri", "_before", F.posexplode("entities").alias("_at", "entity")).select(
        "uri",
        (F.col("_before") + F.col("_at")).cast("bigint").alias("position"),
        "entity.type",
        "entity.mention_text",
        "entity.confidence",
    )
