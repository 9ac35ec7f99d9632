"""Near duplicates by SimHash and a Gray-order hierarchical index.

A node of the index is a masked bit pattern its fingerprints share. The upper
nodes are dealt over the cluster: of three masks that cover the 64 bits, two
fingerprints that differ in at most two bits share the pattern under at least
one. A node with too many fingerprints gets children in the same way, three
masks over the bits still free, so that a node ends up small or with so few
free bits that it must be. Inside a node the fingerprints are sorted by Gray
rank, which puts those with common patterns side by side; runs of them are
summed up by the bits on which they all agree, level by level up to one root.
A search goes down from the root and drops every run whose shared pattern
already differs in more bits than allowed.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.llm.components import components
from labelmill.session import stored

SHINGLE = 3
MAX_BITS = 2
SEED = 42
BITS = 64

# Fingerprints a node may hold before it gets children.
NODE_LIMIT = 4096
# Children a node of the local tree has, and searches that go down together.
FAN_OUT = 8
SEARCHES = 512
# Shingles whose bits are counted at once.
BLOCK = 1 << 16


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed long; zero without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        parts = iter([b" ".join(words)])
        count = 1
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        count = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, SEED) for p in parts), dtype="<u8", count=count)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, count, BLOCK):
        rows = hashes[start : start + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > count, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """``(doc_id, fp)``: a SimHash of the word shingles of each whole text."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        of(F.col(text_column).cast("binary")).alias("fp"),
    )


def _thirds(free: list[int], parts: int) -> list[int]:
    """Masks (as signed longs) that cover the free bits in consecutive parts."""
    masks = []
    for i in range(parts):
        bits = free[i * len(free) // parts : (i + 1) * len(free) // parts]
        masks.append(_signed(sum(1 << b for b in bits)))
    return masks


def _signed(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def _free(mask: int) -> list[int]:
    return [b for b in range(BITS) if not (mask >> b) & 1]


def upper_nodes(codes: DataFrame, max_bits: int) -> DataFrame:
    """Fingerprints ``(fp, node)`` under every upper node ``(mask, pattern)`` with two or more.

    A mask has ``max_bits + 1`` children, so every pair within the distance
    meets under some node. Masks depend on bit places alone: five levels leave at
    most 14 free bits, and there are at most 243 masks to split, whatever the data.
    """
    parts = max_bits + 1
    level, masks, finished = codes.withColumn("mask", F.lit(0).cast("long")), [0], []
    while True:
        children = [
            (m, _signed((m | part) & (2**64 - 1))) for m in masks for part in _thirds(_free(m), parts)
        ]
        child = codes.sparkSession.createDataFrame(children, "mask long, child long")
        level = stored(
            level.join(F.broadcast(child), "mask").select(
                "fp",
                "node",
                F.col("child").alias("mask"),
                F.col("fp").bitwiseAND(F.col("child")).alias("pattern"),
            ),
            "nodes",
        )
        held = stored(
            level.groupBy("mask", "pattern").agg(F.count("*").alias("held")).filter("held > 1"),
            "held",
        )
        kept = level.join(held, ["mask", "pattern"])
        finished.append(kept.filter(F.col("held") <= NODE_LIMIT).drop("held"))
        crowded = held.filter(F.col("held") > NODE_LIMIT)
        masks = [r.mask for r in crowded.select("mask").distinct().collect()]
        if not masks:
            break
        level = kept.filter(F.col("held") > NODE_LIMIT).select("fp", "node", "mask")
    found = finished[0]
    for more in finished[1:]:
        found = found.unionByName(more)
    return found


def gray_rank(code: Column) -> Column:
    """The place of a code in Gray order, as a long whose order is unsigned."""
    rank = code
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def _levels(codes: np.ndarray, group: np.ndarray) -> list[tuple]:
    """The tree over codes sorted by group and Gray rank, leaves first.

    Each level is ``(group, first child, children, pattern, mask)``; the mask
    has the bits on which all codes below agree, the pattern their values.
    """
    every = np.uint64(2**64 - 1)
    ands, ors = codes, codes
    levels = [(group, None, None, codes, np.full(len(codes), every))]
    while True:
        group = levels[-1][0]
        starts = np.r_[0, np.flatnonzero(np.diff(group)) + 1]
        if len(starts) == len(group):
            return levels
        sizes = np.diff(np.r_[starts, len(group)])
        inside = np.arange(len(group)) - np.repeat(starts, sizes)
        first = np.flatnonzero(inside % FAN_OUT == 0)
        count = np.diff(np.r_[first, len(group)])
        ands, ors = np.bitwise_and.reduceat(ands, first), np.bitwise_or.reduceat(ors, first)
        mask = ~(ands ^ ors)
        levels.append((group[first], first, count, ands & mask, mask))


def _linked_pairs(codes, levels, queries, max_bits) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(query, code)`` of one group within the distance."""
    top = levels[-1]
    at = np.searchsorted(top[0], levels[0][0][queries])
    q = queries
    for depth in range(len(levels) - 1, 0, -1):
        _, first, count, _, _ = levels[depth]
        n = count[at]
        ends = np.cumsum(n)
        offset = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
        child = np.repeat(first[at], n) + offset
        q = np.repeat(q, n)
        _, _, _, pattern, mask = levels[depth - 1]
        near = np.bitwise_count((codes[q] ^ pattern[child]) & mask[child]) <= max_bits
        q, at = q[near], child[near]
    other = at > q
    return q[other], at[other]


def _join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the sets of a and b; a label is its set's least index."""
    ends = np.unique(np.stack([label[a], label[b]], axis=1), axis=0)
    ends = ends[ends[:, 0] != ends[:, 1]]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while x in parent:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    for x, y in ends.tolist():
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    if parent:
        moved = np.arange(len(label))
        for x in parent:
            moved[x] = root(x)
        label = moved[label]
    return label


def search_sorted(rows: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    """Links that join what is within the distance in each group of sorted rows."""
    codes = rows["fp"].to_numpy(np.int64).view(np.uint64)
    keys = rows[["mask", "pattern"]].to_numpy(np.int64)
    group = np.r_[0, np.cumsum((np.diff(keys, axis=0) != 0).any(axis=1))]
    levels = _levels(codes, group)
    label = np.arange(len(codes))
    for start in range(0, len(codes), SEARCHES):
        queries = np.arange(start, min(start + SEARCHES, len(codes)))
        label = _join_labels(label, *_linked_pairs(codes, levels, queries, max_bits))
    node = rows["node"].to_numpy(np.int64)
    linked = np.flatnonzero(label != np.arange(len(codes)))
    return pd.DataFrame({"a": node[linked], "b": node[label[linked]]})


def links(codes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``(a, b)`` that connect the nodes of codes ``(fp, node)`` within the distance.

    Not every pair of a dense group is given, but its codes stay connected.
    """

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = rows.iloc[-1]
            open_group = (rows["mask"] == last["mask"]) & (rows["pattern"] == last["pattern"])
            first = int(np.argmax(open_group.to_numpy()))
            rest = rows.iloc[first:]
            if first:
                yield search_sorted(rows.iloc[:first], max_bits)
        if rest is not None and len(rest):
            yield search_sorted(rest, max_bits)

    nodes = upper_nodes(codes, max_bits).withColumn("rank", gray_rank(F.col("fp")))
    dealt = nodes.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern", "rank")
    return dealt.select("mask", "pattern", "fp", "node").mapInPandas(search, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``fingerprint``, ``component_id``, ``fp_docs``.

    Texts are lower-cased in A-Z; fingerprints that differ in at most
    ``max_bits`` bits link, and a component is named by its smallest id.
    ``fp_docs`` counts the rows with the same fingerprint. Null texts count as
    empty; texts without words all have fingerprint zero and link like any
    other. Rows with a null id get a fingerprint, belong to the component of
    their fingerprint and never name it unless all ids there are null (then it
    is null). Repeated rows are repeated in the result. An empty table gives an
    empty result; other columns are not read.
    """
    found = stored(fingerprints(docs, id_column, text_column, shingle), "fingerprints")
    codes = stored(
        found.groupBy("fp").agg(F.min("doc_id").alias("node"), F.count("*").alias("fp_docs")),
        "codes",
    )
    joined = components(links(codes.filter("node is not null").select("fp", "node"), max_bits))
    named = stored(
        codes.join(joined, "node", "left").select(
            "fp", "fp_docs", F.coalesce("component", "node").alias("component_id")
        ),
        "named",
    )
    return found.join(named, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "fp_docs",
    )
