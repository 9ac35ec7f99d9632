"""Benchmark passages in documents, by spaced seeds.

A seed is the hash of six tokens picked by a fixed mask out of eight neighbours;
the tokens a mask ignores may differ. Seeds of the benchmark are joined to the
seeds of the documents. Every hit names a document, an item and how far the two
are shifted; under that shift their tokens are compared one by one, and an
overlap counts if a stretch of the item agrees but for a few substitutions.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.session import stored

# Picked positions. Any two substitutions within 13 tokens leave
# one of the two masks a place without them.
MASKS = [(0, 1, 3, 5, 6, 7), (0, 1, 2, 3, 6, 7)]
SPAN = 8
# Tokens of a stretch, and how many of them may be substituted. Items shorter
# than a stretch are compared whole, with fewer substitutions; those shorter
# than a mask are no evidence of a leak and are not searched.
STRETCH, SUBSTITUTED = 13, 2
ONE_SUBSTITUTED_FROM = 10

# Rows that may be broadcast once they are counted. A seed takes about 40 bytes
# (an item has two for nearly every token, so its tokens are bounded with them),
# a hit 60.
SEED_ROWS = 1_000_000
HIT_ROWS = 200_000


def tokens(text: Column) -> Column:
    """Hashes of the runs of letters and digits, lower-cased."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def allowed(length: Column) -> Column:
    """Substitutions that a stretch may hold, by the tokens of the item."""
    return (
        F.when(length >= STRETCH, SUBSTITUTED).when(length >= ONE_SUBSTITUTED_FROM, 1).otherwise(0)
    )


def seeds(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, at, seed)``: the seed of every mask at every token of ``hashes``."""
    places = F.size("hashes") - SPAN + 1
    windows = F.arrays_zip(
        *[F.slice("hashes", F.lit(i + 1), F.greatest(places, F.lit(0))).alias(f"t{i}") for i in range(SPAN)]
    )
    placed = rows.filter(places > 0).select(*keys, F.posexplode(windows).alias("at", "t"))
    picked = [
        F.xxhash64(F.lit(number), *[F.col(f"t.t{i}") for i in mask])
        for number, mask in enumerate(MASKS)
    ]
    return placed.select(*keys, "at", F.explode(F.array(*picked)).alias("seed"))


def _at_most(rows: DataFrame, most: int) -> bool:
    return rows.limit(most + 1).count() <= most


def _best_stretch(agree: Column, length: Column) -> Column:
    """The most agreeing tokens in any stretch of the aligned item."""
    stretch = F.least(length, F.lit(STRETCH))
    starts = F.sequence(F.lit(1), length - stretch + 1)
    return F.array_max(
        F.transform(
            starts,
            lambda s: F.aggregate(F.slice(agree, s, stretch), F.lit(0), lambda n, a: n + a),
        )
    )


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """One row per document and item that overlap: where, and how far they agree.

    ``(doc_id, item_id, first_token, item_tokens, agreeing, best_stretch)``: the
    item is laid over the document from token ``first_token`` (negative if its
    beginning is missing there), ``agreeing`` of its tokens are the same, and
    ``best_stretch`` of the best 13 neighbours (or of the item, if shorter). At
    least 11 of 13 must agree; of an item of 10 to 12 tokens all but one; of 8 or
    9 all. Of several places the best is given, then the first. Null texts and
    texts or items under 8 tokens have no rows, nor have null ids. Repeated
    documents or items give the rows of one; an empty table on either side gives
    an empty result. Other columns are not read.
    """
    items = stored(
        benchmark.select(
            F.col(item_column).cast("long").alias("item_id"),
            tokens(F.col(item_text_column)).alias("item_hashes"),
        )
        .filter(F.col("item_id").isNotNull() & (F.size("item_hashes") >= SPAN))
        .distinct(),
        "items",
    )
    wanted = stored(
        seeds(items.withColumn("hashes", F.col("item_hashes")), ["item_id", "item_hashes"]).select(
            "seed",
            "item_id",
            F.col("at").alias("item_at"),
            F.size("item_hashes").alias("item_tokens"),
            F.xxhash64("item_hashes").alias("item_version"),
        ),
        "seeds",
    )
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).filter("doc_id is not null")
    light = F.broadcast if _at_most(wanted, SEED_ROWS) else lambda rows: rows
    own = seeds(texts.select("doc_id", tokens(F.col("text")).alias("hashes")), ["doc_id"])
    hits = stored(
        own.join(light(wanted), "seed")
        .select(
            "doc_id",
            "item_id",
            "item_version",
            "item_tokens",
            (F.col("at") - F.col("item_at")).alias("first_token"),
        )
        .distinct(),
        "hits",
    )
    hit = F.struct("item_id", "item_version", "item_tokens", "first_token")
    by_document = hits.groupBy("doc_id").agg(F.collect_list(hit).alias("found"))
    if _at_most(hits, HIT_ROWS):
        by_document = F.broadcast(by_document)
    hashed = texts.join(by_document, "doc_id").select(
        "doc_id", "found", tokens(F.col("text")).alias("hashes")
    )
    laid = hashed.select(
        "doc_id",
        F.inline(
            F.transform(
                "found",
                lambda h: F.struct(
                    h.item_id.alias("item_id"),
                    h.item_version.alias("item_version"),
                    h.item_tokens.alias("item_tokens"),
                    h.first_token.alias("first_token"),
                    F.slice(
                        "hashes",
                        F.greatest(h.first_token, F.lit(0)) + 1,
                        h.item_tokens + F.least(h.first_token, F.lit(0)),
                    ).alias("there"),
                ),
            )
        ),
    )
    versions = items.withColumn("item_version", F.xxhash64("item_hashes"))
    missing = F.greatest(-F.col("first_token"), F.lit(0))
    beside = F.concat(F.array_repeat(F.lit(None).cast("long"), missing), "there")
    agree = F.zip_with("item_hashes", beside, lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0)))
    compared = (
        laid.join(light(versions), ["item_id", "item_version"])
        .withColumn("agree", agree)
        .select(
            "doc_id",
            "item_id",
            "first_token",
            "item_tokens",
            F.aggregate("agree", F.lit(0), lambda n, a: n + a).alias("agreeing"),
            _best_stretch(F.col("agree"), F.col("item_tokens")).alias("best_stretch"),
        )
    )
    needed = F.least(F.col("item_tokens"), F.lit(STRETCH)) - allowed(F.col("item_tokens"))
    best = F.max_by(
        F.struct("first_token", "item_tokens", "agreeing", "best_stretch"),
        F.struct("best_stretch", "agreeing", -F.col("first_token")),
    )
    return (
        compared.filter(F.col("best_stretch") >= needed)
        .groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select("doc_id", "item_id", "best.*")
    )
