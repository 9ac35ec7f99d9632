"""Sources mixed to target weights by Pfair scheduling.

Time is cut into slots, one block each. A source of weight ``w`` must get its
block number ``k`` (from 0) within a window: released at ``floor(k / w)``, due at
``ceil((k + 1) / w)``. In every slot the released block that is due first runs.
On one resource this keeps each source within one block of its share at all
times. Weights are taken as the decimal numbers they are given as and brought to
a common denominator, the cycle, without rounding, so nothing adds up however
long the mix is. One task walks through the blocks and holds one entry a source.
"""

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import FILE_PLACE, as_rows, in_files, text_of
from labelmill.llm.splitters import numbers, ranked, real_numbers
from labelmill.session import stored

# Bytes of a block, and of a row beside its text.
BLOCK_BYTES = 65_536
ROW_BYTES = 16
# Target weights, where none are given: the size of a source to this power.
TEMPERATURE = 0.5
# Blocks the walk hands on at a time.
WALKED = 50_000
# Later times, which only the smallest weights lead to, are given as this.
LATEST = (1 << 63) - 1


def exact(weights: list[float]) -> tuple[int, list[int]]:
    """The cycle and the whole shares of it that are the weights, none rounded."""
    parts = [Fraction(str(w)) for w in weights]
    common = math.lcm(*[p.denominator for p in parts])
    shares = [int(p * common) for p in parts]
    divisor = math.gcd(*shares) or 1
    shares = [s // divisor for s in shares]
    return sum(shares), shares


def window(k: int, share: int, cycle: int) -> tuple[int, int]:
    """Release and due time of block ``k``."""
    return k * cycle // share, -((-(k + 1) * cycle) // share)


def walk(cycle: int, shares: list[int], blocks: list[int]) -> Iterator[tuple[int, int, int]]:
    """``(slot, source, block)``: earliest due date first, among the blocks released.

    Source ``s`` has ``blocks[s]`` blocks. Where none is released, slots stay
    empty. Sources without a share come after all others, one after the other.
    """
    waiting = [(0, s, 0) for s in range(len(shares)) if blocks[s] and shares[s]]
    heapq.heapify(waiting)
    released: list[tuple[int, int, int]] = []
    slot = 0
    while waiting or released:
        if not released:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, source, k = heapq.heappop(waiting)
            heapq.heappush(released, (window(k, shares[source], cycle)[1], source, k))
        _, source, k = heapq.heappop(released)
        yield slot, source, k
        if k + 1 < blocks[source]:
            heapq.heappush(waiting, (window(k + 1, shares[source], cycle)[0], source, k + 1))
        slot += 1
    for source, share in enumerate(shares):
        for k in range(0 if share else blocks[source]):
            yield slot, source, k
            slot += 1


def _walked(docs: DataFrame, cycle: int, shares: list[int], blocks: list[int]) -> DataFrame:
    """``(source_no, block, slot, release_slot, due_slot)`` of all blocks, stored by one task."""
    names = ["slot", "source_no", "block", "release_slot", "due_slot"]

    def steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _ in batches:
            rows = []
            for slot, source, k in walk(cycle, shares, blocks):
                times = window(k, shares[source], cycle) if shares[source] else (slot, slot + 1)
                rows.append((min(slot, LATEST), source, k, *(min(t, LATEST) for t in times)))
                if len(rows) == WALKED:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)

    one = docs.sparkSession.range(0, min(1, len(shares)), 1, 1)
    return stored(one.mapInPandas(steps, ", ".join(f"{n} long" for n in names)), "walked")


def _key(source: Column) -> Column:
    """The source as text that also tells null from empty."""
    return F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source.cast("string")))


def mixed(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every row with its block and its place in the mix.

    ``(doc_id, source, block, slot, release_slot, due_slot, place, share)``: a
    source's rows, in the order of a hash of their ids, are cut into blocks of
    ``block_bytes``; a row belongs to the block its first byte falls in.
    ``place`` counts all rows in the order of the slots, from 0 without gaps.
    While all sources last, every beginning of the mix holds each source's
    share but for less than one block (and the row that ends it). A source that
    is used up leaves its slots to the others, which go on inside their windows;
    no row is dropped or repeated.

    Weights that are missing count as the smallest given above zero; a source of
    weight zero comes after all others; negative weights and those that are no
    finite number are a ``ValueError``. With none given, sources weigh as the
    square root of their size. Times beyond 64 bits are given as the largest. One row per
    source is all that comes to the driver. A null source is a source; null
    texts have size 16; null ids come first; repeated rows are placed each; an
    empty table gives an empty result.
    """
    return _mixed(docs, weights, id_column, text_column, source_column, block_bytes, None).select(
        "doc_id", "source", "block", "slot", "release_slot", "due_slot", "place", "share"
    )


def _mixed(
    docs: DataFrame,
    weights: dict[str | None, float] | None,
    id_column: str,
    text_column: str,
    source_column: str,
    block_bytes: int,
    row_place: list[Column] | None,
) -> DataFrame:
    """``mixed`` with the row's place in its files, if that is given."""
    low = -(1 << 63)
    row_key = FILE_PLACE if row_place else ["row_key"]
    source = F.col(source_column)
    sized = stored(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            source.alias("source"),
            _key(source).alias("source_key"),
            (F.octet_length(text_of(text_column)) + ROW_BYTES).cast("long").alias("size"),
            F.xxhash64(F.col(id_column).cast("long")).alias("id_hash"),
            F.coalesce(F.col(id_column).cast("long"), F.lit(low)).alias("id_key"),
            *(row_place or [F.monotonically_increasing_id().alias("row_key")]),
        ),
        "sources",
    )
    held = dict(sized.groupBy("source_key").agg(F.sum("size")).collect())
    names = sorted(held)
    if weights is None:
        given = [held[n] ** TEMPERATURE for n in names]
    else:
        asked = {"" if k is None else f"={k}": w for k, w in weights.items()}
        if not all(math.isfinite(w) and w >= 0 for w in asked.values()):
            raise ValueError("weights must be finite and not negative")
        least = min((w for w in asked.values() if w > 0), default=1.0)
        given = [asked.get(n, least) for n in names]
    cycle, shares = exact(given)
    blocks = [(held[n] - 1) // block_bytes + 1 for n in names]
    walked = _walked(docs, cycle, shares, blocks)
    number = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i)]) if names else None
    place = number[F.col("source_key")] if names else F.lit(0)
    found = ranked(
        sized.withColumn("source_no", place.cast("long")),
        ["source_no", "id_hash", "id_key", *row_key],
        "size",
    )
    starts, passed = [], 0
    for n in names:
        starts.append(passed)
        passed += held[n]
    start = F.get(numbers(starts), F.col("source_no").cast("int"))
    part = F.get(real_numbers([w / max(1, cycle) for w in shares]), F.col("source_no").cast("int"))
    rows = found.rows.withColumn("first_byte", F.col("before") - start).withColumn(
        "block", F.expr(f"first_byte div {block_bytes}")
    )
    slotted = stored(
        rows.join(walked, ["source_no", "block"]).select(
            "doc_id", "source", "block", "slot", "release_slot", "due_slot",
            F.col("place").alias("source_place"), F.lit(1).cast("long").alias("one"),
            part.alias("share"), *row_key,
        ),
        "slotted",
    )
    return ranked(slotted, ["slot", "source_place"], "one").rows


def in_mixed_order(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs``, written in the order of the mix when saved.

    Rows are dealt to partitions by their place, so the files follow each other
    as the mix does. Rows are told apart by where they stand in their files, see
    ``in_files``; the names of their columns do not matter.
    """
    docs, row_place = in_files(docs, "to-mix")
    options = (id_column, text_column, source_column, block_bytes)
    placed = _mixed(docs, weights, *options, row_place).select(F.struct(*FILE_PLACE).alias("at"), "place")
    placed = stored(placed, "mix")
    count, parts = placed.count(), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mine = docs.select(as_rows(docs).alias("row"), F.struct(*row_place).alias("at"))
    part = F.floor(F.col("place") / F.lit(max(1, count)) * parts).cast("int")
    return (
        mine.join(placed.hint("merge"), "at")
        .repartitionById(parts, part)
        .sortWithinPartitions("place")
        .select("row.*")
    )
