"""Ordered pieces put together to texts, in parts of a fixed width.

A text is cut every ``PART_CHARS`` characters, wherever its pieces end, and each
part is one row: ``part`` is ``''`` if there is only one, else its number, and
``start`` counts the characters before it. The rows say the same at every size.
Nothing larger than a part meets in one task; texts that fit into one take a
shorter way to the same rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelmill.operators.skew import few_or_all, join_narrow, running_before, salt_of
from labelmill.session import stored

# Characters of a part, at most four bytes each: far below the two gigabytes of
# a cell, since grouping holds several copies of a part in one task.
PART_CHARS = 4 * 1024 * 1024
# Digits of a part's number, so that numbers sort as texts do.
PART_DIGITS = 12


def part_name(number: Column, parts: Column) -> Column:
    return F.when(parts == 1, F.lit("")).otherwise(F.lpad(number.cast("string"), PART_DIGITS, "0"))


def cut_rows(rows: DataFrame, text: str, chars: int = PART_CHARS, lists: tuple[str, ...] = ()) -> DataFrame:
    """Whole texts, one a row, in parts; no shuffle. Adds ``part`` and ``start``.

    Array columns in ``lists`` stay with the first part. A null text has one part.
    """
    parts = F.greatest(F.lit(1), F.ceil(F.length(F.col(text)) / chars)).cast("bigint")
    numbers = F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)
    cut = rows.withColumn("_parts", F.coalesce(parts, F.lit(1))).withColumn("_at", F.explode(numbers))
    start = F.col("_at") * chars
    later = {c: F.when(F.col("_at") == 0, F.col(c)).otherwise(_none(rows, c)) for c in lists}
    return cut.withColumns(
        {
            text: F.substring(F.col(text), (start + 1).cast("int"), F.lit(chars)),
            "part": part_name(F.col("_at"), F.col("_parts")),
            "start": start,
            **later,
        }
    ).drop("_parts", "_at")


def _none(rows: DataFrame, column: str) -> Column:
    return F.array().cast(rows.schema[column].dataType)


def _over(pieces: DataFrame, keys: list[str], size: Column, limit: int) -> DataFrame | None:
    """Keys whose sizes exceed the limit together, None if there are none.

    Summed at once, with map-side partial sums, so a key that holds most of the
    rows costs no more than any other.
    """
    groups = pieces.select(*keys, size.cast("bigint").alias("_size")).groupBy(*keys)
    return few_or_all(groups.agg(F.sum("_size").alias("_size")).filter(F.col("_size") > limit).drop("_size"))


def in_parts(
    pieces: DataFrame,
    keys: list[str],
    order: str,
    text: str,
    lists: tuple[str, ...] = (),
    separator: str = "",
    chars: int = PART_CHARS,
    size: Column | None = None,
    facts: dict[str, Column] | None = None,
) -> DataFrame:
    """``(keys, part, start, text, lists, facts)``: pieces joined in order, cut anew.

    Array columns in ``lists`` are joined as well; a piece's entries stay whole,
    in the part in which the piece begins. ``facts`` are aggregates over the
    pieces of a key, repeated for each of its parts. Pieces of one place go by a
    hash of their texts. ``size`` may name at least the bytes of a piece where
    they are known without reading its text.
    """
    facts, gap = facts or {}, len(separator)
    own = F.octet_length(text) + gap
    over = _over(pieces, keys, own if size is None else F.coalesce(size + gap, own), chars)
    tie = F.xxhash64(text).alias("_tie")
    if over is None:
        return _in_one(pieces, keys, order, tie, text, lists, separator, facts)
    marked = join_narrow(pieces, over.withColumn("_large", F.lit(True)), keys, F.col(order), "left")
    small = _in_one(
        marked.filter(F.col("_large").isNull()), keys, order, tie, text, lists, separator, facts
    )
    rows = stored(
        marked.filter("_large").drop("_large").withColumn("_row", F.monotonically_increasing_id()), "pieces"
    )
    narrow = rows.select("_row", *keys, order, tie, (F.length(text) + gap).cast("bigint").alias("_n"))
    placed = running_before(narrow, keys, [order, "_tie"], "_n").select("_row", "_n", "_before")
    totals = rows.groupBy(*keys).agg(
        (F.sum(F.length(text) + gap) - gap).alias("_total"), *[c.alias(n) for n, c in facts.items()]
    )
    taken = [n for n in facts if n in rows.columns]
    known = join_narrow(rows.drop(*taken).join(placed, "_row"), totals, keys, F.col("_row"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("_total") / chars)).cast("bigint")
    known = known.withColumn("_parts", parts).withColumn(
        "_first", F.least(F.floor(F.col("_before") / chars), F.col("_parts") - 1)
    )
    ends = F.floor((F.col("_before") + F.col("_n") - 1) / chars)
    last = F.greatest(F.col("_first"), F.least(ends, F.col("_parts") - 1))
    cut = known.withColumn("_at", F.explode(F.sequence(F.col("_first"), last)))
    begin = F.greatest(F.col("_at") * chars - F.col("_before"), F.lit(0))
    end = F.least((F.col("_at") + 1) * chars, F.col("_total")) - F.col("_before")
    piece = F.concat(F.col(text), F.lit(separator)) if gap else F.col(text)
    piece = F.struct(
        "_before", order, tie, "_row",
        F.substring(piece, (begin + 1).cast("int"), F.greatest(end - begin, F.lit(0)).cast("int")).alias("_text"),
        *[F.when(F.col("_at") == F.col("_first"), F.col(c)).otherwise(_none(rows, c)).alias(c) for c in lists],
    )
    slices = cut.select(*keys, "_at", "_parts", *facts, piece.alias("_piece"))
    joined = slices.groupBy(*keys, "_at", "_parts", *facts).agg(F.sort_array(F.collect_list("_piece")).alias("s"))
    large = joined.select(
        *keys,
        part_name(F.col("_at"), F.col("_parts")).alias("part"),
        (F.col("_at") * chars).alias("start"),
        F.array_join("s._text", "").alias(text),
        *[F.flatten(f"s.{c}").alias(c) for c in lists],
        *facts,
    )
    return small.unionByName(large)


def _in_one(
    pieces: DataFrame, keys: list[str], order: str, tie: Column, text: str, lists: tuple[str, ...],
    separator: str, facts: dict[str, Column],
) -> DataFrame:
    """The same for texts that are one part each."""
    piece = F.struct(F.col(order), tie, F.col(text).alias("_text"), *lists)
    joined = pieces.groupBy(*keys).agg(
        F.sort_array(F.collect_list(piece)).alias("s"), *[c.alias(n) for n, c in facts.items()]
    )
    return joined.select(
        *keys,
        F.lit("").alias("part"),
        F.lit(0).cast("bigint").alias("start"),
        F.array_join("s._text", separator).alias(text),
        *[F.flatten(f"s.{c}").alias(c) for c in lists],
        *facts,
    )


def moved_parts(
    parts: DataFrame, keys: list[str], begin: str, text: str, chars: int = PART_CHARS
) -> DataFrame:
    """Parts that now begin elsewhere, cut anew: ``(keys, part, start, text)``.

    For texts of several parts only, whose places are known.
    """
    first = F.floor(F.col(begin) / chars)
    last = F.greatest(first, F.floor((F.col(begin) + F.length(text) - 1) / chars))
    cut = parts.withColumn("_at", F.explode(F.sequence(first, last)))
    skipped = F.greatest(F.col("_at") * chars - F.col(begin), F.lit(0))
    kept = (F.col("_at") + 1) * chars - F.col(begin) - skipped
    piece = F.substring(F.col(text), (skipped + 1).cast("int"), kept.cast("int"))
    joined = cut.groupBy(*keys, "_at").agg(
        F.sort_array(F.collect_list(F.struct(begin, piece.alias("_text")))).alias("s")
    )
    return joined.select(
        *keys,
        part_name(F.col("_at"), F.lit(0)).alias("part"),
        (F.col("_at") * chars).alias("start"),
        F.array_join("s._text", "").alias(text),
    )


def told_apart(parts: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """Add ``_doc``: the key and the number of the copy a part belongs to.

    A key that occurs several times has several parts of the same place. They
    are numbered in the order of their texts, so that no copy loses a part or
    runs into another.
    """
    same_place = W.partitionBy(key, order).orderBy(text)
    copy = F.row_number().over(same_place).alias("copy")
    return parts.withColumn("_doc", F.struct(F.col(key), copy))


def whole_lines(
    parts: DataFrame, key: str, order: str, text: str, limit: int = PART_CHARS
) -> DataFrame:
    """``(key, order, text)``: the parts of each key cut anew, at line breaks.

    What follows the last line break of a part goes on in front of the next
    one, so no word and no line is spread over two parts. A part without a line
    break goes on whole. Where lines are numbered, only flags are sorted, never
    texts. A single line above the limit keeps the cuts it has.
    """
    after = F.substring_index(F.substring_index(text, "\n", -1), "\r", -1)
    breaks = F.contains(text, F.lit("\n")) | F.contains(text, F.lit("\r"))
    before = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    flags = parts.select(key, order, breaks.cast("bigint").alias("_breaks"))
    lines = flags.select(
        key, order, "_breaks", F.coalesce(F.sum("_breaks").over(before), F.lit(0)).alias("_line")
    )
    # The next place after that of a part, before that of any other.
    follows = F.concat(F.col(order), F.lit("\0"))
    head = F.substring(text, F.lit(1), F.length(text) - F.length(after))

    def piece(place: Column, line: Column, words: Column) -> Column:
        return F.struct(place.alias("place"), line.alias("line"), words.alias("words"))

    at, line = F.col(order), F.col("_line")
    cut = F.when(
        F.col("_breaks") == 1,
        F.array(piece(at, line, head), piece(follows, line + 1, after)),
    ).otherwise(F.array(piece(at, line, F.col(text))))
    pieces = (
        parts.select(key, order, text)
        .join(lines, [key, order])
        .select(key, F.explode(cut).alias("p"))
        .select(key, "p.*")
        .filter((F.col("words") != "") | ~F.endswith("place", F.lit("\0")))
    )
    sizes = pieces.groupBy(key, "line").agg(F.sum(F.octet_length("words")).alias("_size"))
    group = F.when(F.col("_size") > limit, F.col("place")).otherwise("")
    joined = (
        pieces.join(sizes, [key, "line"])
        .groupBy(key, "line", group.alias("_group"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "words"))).alias("s"))
    )
    return joined.select(
        key,
        F.get("s.place", F.lit(0)).alias(order),
        F.array_join("s.words", "").alias(text),
    )


def head_text(parts: DataFrame, key: str, order: str, text: str, chars: int) -> DataFrame:
    """``(key, head)``: the first ``chars`` characters of each key's parts.

    A part that begins within the first ``chars`` characters also does so
    within any subset of the parts. So each salted share first drops the parts
    that cannot matter, and only the few left over meet in one place. Empty
    parts add nothing; of them at most one is kept per share, for keys that
    have no text at all.
    """
    rows = parts.select(
        key,
        F.col(order).alias("_order"),
        F.substring(text, 1, chars).alias("_text"),
        salt_of(F.col(order)).alias("_salt"),
    )

    def within(df: DataFrame, *by: str) -> DataFrame:
        by_order = W.partitionBy(*by).orderBy("_order")
        before = F.sum(F.length("_text")).over(by_order.rowsBetween(W.unboundedPreceding, -1))
        return (
            df.withColumn("_before", F.coalesce(before, F.lit(0)))
            .withColumn("_place", F.row_number().over(by_order))
            .filter(F.col("_before") < chars)
            .filter((F.length("_text") > 0) | (F.col("_place") == 1))
            .drop("_before", "_place")
        )

    near = within(within(rows, key, "_salt"), key)
    pieces = F.sort_array(F.collect_list(F.struct("_order", "_text")))
    return near.groupBy(key).agg(
        F.substring(F.array_join(pieces["_text"], ""), 1, chars).alias("head")
    )
