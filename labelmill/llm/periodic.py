"""Periodic runs of words, by Baier's grouping of suffixes.

A run is a stretch that repeats with its smallest period and cannot be longer.
For one of the two orders of the words every run holds a Lyndon word as long as
its period, which is the longest Lyndon word that starts at its place. The first
phase of Baier's suffix sorter finds these for all places at once: suffixes are
grouped by their first word, groups are taken from the highest down, and what
stands before the members of a group moves up according to how many of them
follow it. Each such root is then extended to both sides as far as the period
holds (longest common extensions).

Before that, stretches that cannot hold a run are set aside: a word of a run of
twelve words or more lies in six words that the run repeats one period away.
"""

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words of the shortest run. Every word of a run then lies in GRAM words that
# occur in the run once more: a run of length L and period q repeats L - q.
LEAST_LENGTH = 12
GRAM = 6
# Times the setting aside is repeated; it only saves work.
ROUNDS = 8
# Words handled at a time; a longer document is handled alone.
SLICE_WORDS = 300_000

SCHEMA = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, "
    "exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)

Run = tuple[int, int, int]


def lyndon_lengths(ranks: list[int], highest: int) -> list[int]:
    """The length of the longest Lyndon word that starts at each place.

    Ranks go from 0 to ``highest``. ``left`` and ``right`` link the places not
    yet taken: a place's longest Lyndon word ends before its right neighbour
    when its turn comes.
    """
    n = len(ranks)
    members: list[list[int]] = [[] for _ in range(highest + 1)]
    for place, rank in enumerate(ranks):
        members[rank].append(place)
    group = list(ranks)
    size = [len(m) for m in members]
    below = list(range(-1, highest))
    above = list(range(1, highest + 2))
    left = list(range(-1, n - 1))
    right = list(range(1, n + 1))
    lengths = [0] * n
    at = highest
    while at >= 0:
        followed: dict[int, int] = {}
        for place in members[at]:
            if group[place] != at:
                continue
            before, after = left[place], right[place]
            lengths[place] = after - place
            if after < n:
                left[after] = before
            if before >= 0:
                right[before] = after
                followed[before] = followed.get(before, 0) + 1
        parts: dict[tuple[int, int], list[int]] = {}
        for place, times in followed.items():
            parts.setdefault((-times, group[place]), []).append(place)
        # Those followed most often end up highest above what is left of their group.
        for key in sorted(parts) if len(parts) > 1 else parts:
            old, moved = key[1], parts[key]
            if len(moved) == size[old]:
                continue
            new = len(members)
            members.append(moved)
            size[old] -= len(moved)
            size.append(len(moved))
            for place in moved:
                group[place] = new
            higher = above[old]
            above[old] = below[higher] = new
            above.append(higher)
            below.append(old)
        at = below[at]
    return lengths


class Extensions:
    """How far a sequence agrees with itself from two places on, or back from them."""

    def __init__(self, words: np.ndarray):
        self.data = words.astype(np.uint32).tobytes()

    def ahead(self, i: int, j: int, most: int) -> int:
        data, n, step, growing = self.data, 0, 8, True
        while step and n < most:
            if step <= most - n and data[4 * (i + n) : 4 * (i + n + step)] == data[4 * (j + n) : 4 * (j + n + step)]:
                n += step
                step = step << 1 if growing else step >> 1
            else:
                growing, step = False, step >> 1
        return n

    def back(self, i: int, j: int, most: int) -> int:
        """Words that agree up to and with ``i`` and ``j``."""
        data, n, step, growing = self.data, 0, 8, True
        i, j = 4 * (i + 1), 4 * (j + 1)
        while step and n < most:
            far = 4 * (n + step)
            if step <= most - n and data[i - far : i - 4 * n] == data[j - far : j - 4 * n]:
                n += step
                step = step << 1 if growing else step >> 1
            else:
                growing, step = False, step >> 1
        return n


def runs_of(words: np.ndarray, least: int = LEAST_LENGTH) -> list[Run]:
    """``(start, length, period)`` of all runs of at least so many words, in order."""
    n = len(words)
    if n < 2:
        return []
    values, ranks = np.unique(words, return_inverse=True)
    highest, extend = len(values) - 1, Extensions(ranks)
    places, found = np.arange(n), set()
    for order in (ranks, highest - ranks):
        periods = np.array(lyndon_lengths(order.tolist(), highest))
        ends = places + periods
        agrees = (ends < n) & (ranks[np.minimum(ends, n - 1)] == ranks)
        agrees |= (places > 0) & (ranks[places - 1] == ranks[ends - 1])
        reached: dict[int, int] = {}  # period -> end of its last run
        roots = np.flatnonzero(agrees & (2 * periods <= n))
        for place, period in zip(roots.tolist(), periods[roots].tolist()):
            end = place + period
            if reached.get(period, 0) >= end:
                continue
            more = extend.ahead(place, end, n - end)
            less = extend.back(place - 1, end - 1, place)
            if more + less >= period:
                reached[period] = end + more
                if period + more + less >= least:
                    found.add((place - less, period + more + less, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def repeating_stretches(words: np.ndarray, document: np.ndarray) -> list[tuple[int, int]]:
    """Stretches ``[begin, end)`` that may hold runs; every run lies inside one.

    Kept are words in ``GRAM`` words that occur twice in their stretch, at first
    the document. Equal hashes of different words keep more, never less.
    """
    place = np.arange(len(words))
    stretch = document.astype(np.uint64)
    word = words.astype(np.uint64) + np.uint64(1)
    for _ in range(ROUNDS):
        n = len(word)
        if n < LEAST_LENGTH:
            return []
        last = n - GRAM + 1
        # A gram must stand in one stretch; cut places have other numbers.
        whole = np.flatnonzero(stretch[:last] == stretch[GRAM - 1 :])
        gram = stretch[:last] * np.uint64(0x9E3779B97F4A7C15)
        for k in range(GRAM):
            gram = (gram ^ word[k : last + k]) * np.uint64(0xBF58476D1CE4E5B9)
            gram ^= gram >> np.uint64(29)
        gram = gram[whole]
        order = np.argsort(gram)
        same = gram[order[1:]] == gram[order[:-1]]
        twice = np.zeros(len(gram), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, whole[twice], 1)
        np.add.at(edge, whole[twice] + GRAM, -1)
        kept = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        if not len(kept):
            return []
        # New stretches begin after a gap and where the old one ends.
        begins = np.r_[True, (np.diff(place[kept]) > 1) | (np.diff(stretch[kept]) != 0)]
        number = np.cumsum(begins)
        long = np.bincount(number)[number] >= LEAST_LENGTH
        done = len(kept) == n
        place, word, stretch = place[kept][long], word[kept][long], number[long].astype(np.uint64)
        if done:
            break
    starts = np.flatnonzero(np.r_[True, np.diff(stretch) != 0]) if len(place) else []
    ends = [*starts[1:], len(place)]
    return [(int(place[a]), int(place[b - 1]) + 1) for a, b in zip(starts, ends)]


def repeated_places(doc_id: int, n: int) -> np.ndarray:
    """Which original word each of ``n`` words becomes: some documents repeat their end."""
    number = zlib.crc32(str(doc_id).encode())
    places = np.arange(n)
    if number % 10 or not n:
        return places
    g = number // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    places[start:] = start + (places[start:] - start) % period
    return places


class _Numbers(dict):
    """Numbers words in the order in which they first occur."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def described(doc_id: int | None, words: list[bytes], runs: list[Run]) -> tuple:
    """The row of a document; kept are the words outside all repeats of runs."""
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    if runs:
        dropped = np.zeros(len(words) + 1, np.int64)
        for s, n, q in runs:
            dropped[s + q] += 1
            dropped[s + n] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(dropped[:-1]) == 0).tolist()]
    longest = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    s, n, q = longest or (None, None, None)
    return (
        doc_id, len(runs), s, n, q, 1000 * n // q if longest else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest(),
    )


def _slice_rows(ids: list[int | None], texts: list[list[bytes]], repeat: bool) -> list[tuple]:
    numbers = _Numbers()
    coded = []
    for i, (doc_id, words) in enumerate(zip(ids, texts)):
        code = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        if repeat and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0:
            places = repeated_places(doc_id, len(words))
            code, texts[i] = code[places], [words[p] for p in places.tolist()]
        coded.append(code)
    lengths = np.array([len(c) for c in coded], np.int64)
    sequence = np.concatenate(coded) if coded else np.zeros(0, np.int64)
    firsts = np.cumsum(lengths) - lengths
    document = np.repeat(np.arange(len(lengths)), lengths)
    found: dict[int, list[Run]] = {}
    for begin, end in repeating_stretches(sequence, document):
        at = int(document[begin])
        shift = begin - int(firsts[at])
        runs = [(s + shift, n, q) for s, n, q in runs_of(sequence[begin:end])]
        found.setdefault(at, []).extend(runs)
    rows = []
    for i, (doc_id, words) in enumerate(zip(ids, texts)):
        runs = sorted(found.get(i, []), key=lambda r: (r[0], r[2]))
        first, *rest = described(doc_id, words, runs)
        rows.append((first, len(words), *rest))
    return rows


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", repeat: bool = False
) -> DataFrame:
    """One row per input row: its runs of words, the longest of them, digests.

    Words are what ASCII white space parts, compared as they stand. A run is a
    stretch of consecutive words with smallest period ``period`` and at least
    twice as long, of 12 words or more, that no neighbour extends. ``start`` to
    ``exponent_milli`` describe the longest (ties: smallest start, then period)
    and are null without one. ``runs_sha256`` digests the lines
    ``start,length,period`` of all runs by start, then period;
    ``collapsed_sha256`` the words, joined by a blank, without those any run
    holds after its first period. With ``repeat`` documents are first altered as
    ``repeated_places`` says, rows with a null id never. Each text is handled
    whole, in time linear in its words. Null texts count as empty and have no
    words; null ids and repeated rows pass through; an empty table gives an
    empty result; other columns are not read.
    """
    given = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").cast("binary").alias("text"),
    )
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.string() if "sha256" in c else pa.int64() for c in names]

    def answer(ids: list, texts: list) -> pa.RecordBatch:
        rows = _slice_rows(ids, texts, repeat)
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, waiting = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = (text.as_py() or b"").split()
                ids.append(doc_id.as_py())
                texts.append(words)
                waiting += len(words) + 1
                if waiting >= SLICE_WORDS:
                    yield answer(ids, texts)
                    ids, texts, waiting = [], [], 0
        if ids:
            yield answer(ids, texts)

    return given.mapInArrow(rows, SCHEMA)
