"""Stupid-backoff scores of documents under an n-gram model of the whole corpus.

Documents are taken in chunks. A chunk lists its distinct n-grams with their
counts, in the order of their hashes and dealt over the ranges of the hash: the
exploded n-grams, one row for all equal ones of a chunk. The lists of one range
meet in one task, which sums the counts (the count table of that range) and
joins them back to every list. The counts return to their chunk, whose words
wait for them where the first shuffle put them. There each word of each document
takes the longest n-gram that the corpus has often enough, and the logarithms
are summed per document.

However frequent an n-gram is, it is one entry per chunk, so no range is hot.
Lists are sorted, stored as differences and compressed.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.session import stored

ORDER = 3
BACKOFF = 0.4
# N-grams of two words or more count as unseen below this.
LEAST_COUNT = 2

# Words of a chunk; it ends with the document that reaches them. Bytes of text
# whose n-grams share a range of the hash.
CHUNK_WORDS = 1_500_000
RANGE_BYTES = 8 << 20

# N-grams of two words or more are told apart by the upper 56 bits of their
# hash: among 10^9 different ones, a chance of 2 in 10^8 for each to be taken for
# another. Words keep 64 bits.
GRAM_BITS = np.uint64(2**64 - 2**8)

_CODED = "place long, chunk long, kind int, number int, data binary"
_BODY = 0


def joined(*parts: bytes) -> bytes:
    """Parts behind their lengths."""
    sizes = np.array([len(parts), *map(len, parts)], np.int64).tobytes()
    return sizes + b"".join(parts)


def parted(data: bytes) -> list[bytes]:
    count = int(np.frombuffer(data, np.int64, 1)[0])
    ends = 8 * (count + 1) + np.cumsum(np.frombuffer(data, np.int64, count, 8))
    starts = [8 * (count + 1), *ends[:-1]]
    return [data[s:e] for s, e in zip(starts, ends)]


def pack(values: np.ndarray) -> bytes:
    """An integer array by byte planes, each compressed for itself."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    coder = zstandard.ZstdCompressor(level=1)
    return joined(*(coder.compress(p.tobytes()) for p in planes))


def unpack(data: bytes, kind: type) -> np.ndarray:
    coder = zstandard.ZstdDecompressor()
    planes = [np.frombuffer(coder.decompress(p), np.uint8) for p in parted(data)]
    return np.stack(planes, axis=1).view(kind).ravel()


def differences(ordered: np.ndarray) -> np.ndarray:
    return np.diff(ordered, prepend=np.uint64(0))


def mixed_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of an n-gram from that of its beginning and its last word."""
    x = context * np.uint64(0x9E3779B97F4A7C15) + word
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def grams_of(words: np.ndarray, lengths: np.ndarray, order: int) -> Iterator[tuple]:
    """For 1 to ``order`` words: where n-grams end, and their hashes there."""
    inside = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    current = words
    for n in range(1, order + 1):
        if n > 1:
            following = np.zeros_like(words)
            following[1:] = mixed_hash(current[:-1], words[1:])
            current = following
        ends = np.flatnonzero(inside >= n - 1)
        yield ends, current[ends] & GRAM_BITS if n > 1 else current[ends]


class _Numbers(dict):
    """Numbers words in the order in which they first occur."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Chunk:
    """Documents as word numbers, until they are coded."""

    def __init__(self) -> None:
        self.numbers, self.ids, self.known, self.words = _Numbers(), [], [], []
        self.size = 0

    def add(self, doc_id: str | None, text: bytes | None) -> None:
        words = (text or b"").lower().split()
        self.words.append(np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words)))
        self.known.append(doc_id is not None)
        self.ids.append(int(doc_id) if doc_id is not None else 0)
        self.size += len(words)

    def coded(self, chunk: int, ranges: int, order: int) -> pd.DataFrame:
        """The body under its chunk, and the lists of its n-grams under their ranges."""
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.numbers), np.uint64, len(self.numbers))
        sort = np.argsort(hashes)
        rank = np.empty(len(sort), np.uint32)
        rank[sort] = np.arange(len(sort), dtype=np.uint32)
        hashes = hashes[sort]
        sequence = rank[np.concatenate(self.words)] if len(sort) else np.zeros(0, np.uint32)
        lengths = np.array([len(w) for w in self.words], np.int64)
        # Frequent words get small numbers in the body; these compress better.
        frequent = np.argsort(-np.bincount(sequence), kind="stable").astype(np.uint32)
        place = np.empty_like(frequent)
        place[frequent] = np.arange(len(frequent), dtype=np.uint32)
        body = joined(
            pack(place[sequence]),
            pack(frequent),
            pack(lengths),
            pack(np.array(self.ids, np.int64)),
            pack(np.array(self.known, np.uint8)),
        )
        rows = [(place_of(chunk), chunk, _BODY, 0, body)]
        for n, (_, grams) in enumerate(grams_of(hashes[sequence], lengths, order), start=1):
            distinct, counts = np.unique(grams, return_counts=True)
            of_range = range_of(distinct, ranges)
            starts = np.r_[0, np.flatnonzero(np.diff(of_range)) + 1, len(distinct)]
            for a, b in zip(starts[:-1], starts[1:]):
                if a < b:
                    data = joined(pack(differences(distinct[a:b])), pack(counts[a:b].astype(np.uint32)))
                    rows.append((int(of_range[a]), chunk, n, int(of_range[a]), data))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _CODED.split(", ")])


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Which of the equal ranges of the hash, in its order."""
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def place_of(chunk: int) -> int:
    """Where the words of a chunk wait; ranges of the hash have places from 0."""
    return -1 - chunk


def answered(rows: pd.DataFrame) -> pd.DataFrame:
    """The lists of one range, each n-gram's count in the chunk replaced by that in the corpus.

    Words keep their hashes beside the counts; the chunk needs them. The words
    of a chunk are not answered.
    """
    rows = rows[rows["kind"] != _BODY]
    if rows.empty:
        return pd.DataFrame()
    out = rows.copy()
    for n in sorted(set(rows["kind"])):
        places = np.flatnonzero((rows["kind"] == n).to_numpy())
        lists = [[unpack(p, k) for p, k in zip(parted(bytes(d)), (np.uint64, np.uint32))] for d in rows["data"].iloc[places]]
        grams = np.concatenate([np.cumsum(d, dtype=np.uint64) for d, _ in lists])
        counts = np.concatenate([c for _, c in lists])
        _, where = np.unique(grams, return_inverse=True)
        totals = np.bincount(where, counts).astype(np.int64)[where]
        ends = np.cumsum([len(c) for _, c in lists])[:-1]
        for place, part, (hashes, _) in zip(places, np.split(totals, ends), lists):
            data = joined(pack(hashes), pack(part)) if n == 1 else pack(part)
            out.iat[place, out.columns.get_loc("data")] = data
    out["place"] = place_of(out["chunk"])
    return out


def chunk_scores(body: bytes, rows: pd.DataFrame, order: int) -> pd.DataFrame:
    """Per document the words, those by n-gram length, and the summed logarithms.

    Unigrams are still to be divided by the words of the corpus.
    """
    kinds = (np.uint32, np.uint32, np.int64, np.int64, np.uint8)
    sequence, frequent, lengths, ids, known = (
        unpack(p, k) for p, k in zip(parted(body), kinds)
    )
    lists = {
        n: [bytes(d) for d in rows[rows["kind"] == n].sort_values("number")["data"]]
        for n in range(1, order + 1)
    }
    both = [parted(d) for d in lists[1]]
    lists[1] = [counts for _, counts in both]
    none = np.zeros(0, np.uint64)
    hashes = np.concatenate([none, *(np.cumsum(unpack(h, np.uint64), dtype=np.uint64) for h, _ in both)])
    words = hashes[frequent[sequence]]
    counts = []
    for n, (ends, grams) in enumerate(grams_of(words, lengths, order), start=1):
        distinct, where = np.unique(grams, return_inverse=True)
        totals = np.concatenate([none, *(unpack(d, np.int64) for d in lists[n])])
        if len(totals) != len(distinct):
            raise ValueError("a chunk and its counts differ")
        count = np.zeros(len(words), np.int64)
        count[ends] = totals[where]
        counts.append(count)
    document = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    longest = np.minimum(inside + 1, order)
    score, used = np.log(np.maximum(counts[0], 1)), np.ones(len(words), np.int64)
    for n in range(2, order + 1):
        seen = np.flatnonzero(counts[n - 1] >= LEAST_COUNT)
        score[seen] = np.log(counts[n - 1][seen] / counts[n - 2][seen - 1])
        used[seen] = n
    score += (longest - used) * math.log(BACKOFF)
    out = {"doc_id": [str(i) if k else None for i, k in zip(ids, known)], "n_words": lengths}
    for n in range(1, order + 1):
        out[f"by_{n}"] = np.bincount(document[used == n], minlength=len(lengths))
    out["summed"] = np.bincount(document, score, len(lengths))
    return pd.DataFrame(out)


def backoff_scores(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", order: int = ORDER
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, by_1 .. by_order, log_score, mean_log_score``.

    Words are lower-cased in A-Z and parted by ASCII white space. A word scores
    the count of the longest n-gram it ends (of at most ``order`` words, inside
    the document) that occurs at least twice in the corpus, divided by the count
    of that n-gram without it; each order given up costs a factor of 0.4. Alone
    it scores its share of all words. ``by_n`` counts the words scored with n
    words, ``log_score`` sums the natural logarithms, rounded to 6 places like
    its mean per word. The corpus is the table itself, all texts whole. Null
    texts count as empty; texts without words have ``log_score`` 0 and a null
    mean. Null ids and repeated rows pass through (repeated rows count in the
    corpus as often); an empty table gives an empty result; other columns are
    not read.
    """
    given = docs.select(
        F.col(id_column).cast("long").cast("string").alias("doc_id"),
        F.col(text_column).cast("binary").alias("text"),
    )
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(16, math.ceil(size / RANGE_BYTES))

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, count = TaskContext.get().partitionId() << 32, 0
        chunk = Chunk()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                chunk.add(doc_id, text)
                if chunk.size >= CHUNK_WORDS:
                    yield chunk.coded(first + count, ranges, order)
                    chunk, count = Chunk(), count + 1
        if chunk.words:
            yield chunk.coded(first + count, ranges, order)

    def score(waiting: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        bodies = waiting.loc[waiting["kind"] == _BODY, "data"]
        if bodies.empty:
            return pd.DataFrame()
        return chunk_scores(bytes(bodies.iloc[0]), counts, order)

    # One shuffle serves both: its lists are counted, its bodies wait in it. The
    # lists are emptied after it, since a filter or fewer columns would move
    # below it and make it two.
    dealt = given.mapInPandas(code, _CODED).repartition("place")
    counted = dealt.groupBy("place").applyInPandas(answered, _CODED)
    waiting = dealt.withColumn("data", F.when(F.col("kind") == _BODY, F.col("data")))
    names = [f"by_{n}" for n in range(1, order + 1)]
    shape = ", ".join(["doc_id string", "n_words long", *[f"{n} long" for n in names], "summed double"])
    summed = stored(
        waiting.groupBy("place").cogroup(counted.groupBy("place")).applyInPandas(score, shape),
        "scores",
    )
    words = summed.agg(F.sum("n_words")).first()[0] or 0
    log_score = F.col("summed") - F.col("by_1") * F.lit(math.log(max(1, words)))
    return summed.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_words",
        *names,
        F.round(log_score, 6).alias("log_score"),
        F.when(F.col("n_words") > 0, F.round(log_score / F.col("n_words"), 6)).alias("mean_log_score"),
    )
