"""Documents packed into sequences by the histogram of their lengths.

Only counts of lengths are packed: lengths go from the longest to the shortest,
each into the shortest packs it still fits, and packs of equal content are one
pattern with a count. A document finds its place by its rank among all of its
length, so nothing but ranks and the small table of patterns is needed.

Documents beyond a sequence are cut into full ones and a rest. Patterns that end
short of a length without padding are laid end to end and cut anew, so padding
does not depend on how well the lengths fit.
"""

import bisect
import heapq
import json
import os
import sys
import types
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelmill.session import stored

SEQUENCE = 2048
END_ID = 1

# Characters of a word, or of white space beside the gaps, beyond which a text is
# left to ``tokenizers``, whose work stays linear in them.
LONG_WORD = 500
# Rows of ranks that may be broadcast, once counted; 16 bytes each.
BROADCAST_ROWS = 500_000
# Tokens handed on at a time.
SLICE_TOKENS = 4_000_000

_TOKENS = "doc_id long, part long, n long, rest int, rest_no long, full_no long, ids binary"
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids array<int>"
)


# --- tokens ------------------------------------------------------------------------

# How a byte-level tokenizer parts a text into words.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Latin, Greek and Cyrillic letters end here; further on, what counts as a letter
# depends on the version of Unicode.
PLAIN_BELOW = "\u0530"


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: itself if it shows."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def merge_ranks(source: str) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """Byte strings with their ids, and special tokens, of a byte-level BPE file.

    Only if ids say the order of the merges and words are parted by ``WORDS``;
    else None.
    """
    said = json.loads(source)
    before, model = said["pre_tokenizer"] or {}, said["model"]
    usual = (
        said["normalizer"] is None
        and said["post_processor"] is None
        and (before.get("type"), before.get("use_regex"), before.get("add_prefix_space")) == ("ByteLevel", True, False)
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback", "unk_token"))
        and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix"))
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in said["added_tokens"])
    )
    if not usual:
        return None
    letters, vocabulary = byte_letters(), model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocabulary.get(a + b, -1) for a, b in pairs]
    special = {t["content"]: t["id"] for t in said["added_tokens"]}
    whole = {token: n for token, n in vocabulary.items() if token not in special}
    singles = sorted(n for token, n in whole.items() if len(token) == 1)
    if made != sorted(made) or singles != list(range(256)) or len(whole) != 256 + len(made):
        return None
    return {bytes(letters[c] for c in token): n for token, n in whole.items()}, special


class Ids:
    """The ids of whole texts, as bytes.

    They are those of ``tokenizers``. Where the file is byte-level BPE of the
    usual kind, plain texts go through the same merges in ``tiktoken``, which
    gives the same ids in less time; all other texts and files do not.
    """

    def __init__(self, source: str, kind: str):
        self.source, self.kind, self.slow, self.fast = source, kind, None, None
        ranks = merge_ranks(source)
        if ranks:
            import tiktoken

            self.fast = tiktoken.Encoding(
                "of-file", pat_str=WORDS, mergeable_ranks=ranks[0], special_tokens=ranks[1]
            )

    def whole(self, text: str) -> bytes:
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_str(self.source)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def of(self, text: str) -> bytes:
        if self.fast is None or not is_plain(text):
            return self.whole(text)
        return self.fast.encode_to_numpy(text, allowed_special="all").astype(self.kind).tobytes()


def is_plain(text: str) -> bool:
    """Whether a text has letters of old alphabets only and no word or gap of great length."""
    if not text.isascii() and max(text) >= PLAIN_BELOW:
        return False
    words = text.split()
    lengths = list(map(len, words))
    gaps = len(text) - sum(lengths) - len(words)
    return max(lengths, default=0) <= LONG_WORD and gaps <= LONG_WORD


def ids_by(name: str, source: str, kind: str) -> Ids:
    """The tokenizer of this process; a worker keeps it from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    kept = sys.modules.setdefault("_tokenizers_of_worker", types.ModuleType("_tokenizers_of_worker"))
    held = kept.__dict__.setdefault("held", {})
    if (name, kind) not in held:
        held[name, kind] = Ids(source, kind)
    return held[name, kind]


def tokenised(
    docs: DataFrame, tokenizer: str, id_column: str, text_column: str, size: int, end_id: int
) -> DataFrame:
    """Stored rows of documents with their ids and numbers within their task.

    ``rest_no`` counts the documents of the task with the same ``rest``,
    ``full_no`` its full sequences so far. The file of the tokenizer is read
    here and travels to the workers; it is as large as its vocabulary.
    """
    from tokenizers import Tokenizer

    with open(tokenizer, encoding="utf-8") as file:
        source = file.read()
    largest = max(Tokenizer.from_str(source).get_vocab_size(with_added_tokens=True), end_id + 1)
    kind = "<u2" if largest <= 1 << 16 else "<u4"
    sent = docs.sparkSession.sparkContext.broadcast(source)
    checksum = f"{zlib.crc32(source.encode())}-{len(source)}"
    end = np.array([end_id], kind).tobytes()
    names = [c.split()[0] for c in _TOKENS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    width = int(kind[2:])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_by(checksum, sent.value, kind)
        part, of_length, fulls = TaskContext.get().partitionId(), defaultdict(int), 0
        rows, waiting = [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = ids.of(text.as_py() or "") + end
                n = len(found) // width
                rest = n % size
                rows.append((doc_id.as_py(), part, n, rest, of_length[rest], fulls, found))
                of_length[rest] += 1
                fulls += n // size
                waiting += n
                if waiting >= SLICE_TOKENS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows, waiting = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    given = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    return stored(given.mapInArrow(encode, _TOKENS).withColumn("width", F.lit(width)), "tokens")


# --- patterns ----------------------------------------------------------------------


@dataclass
class Pattern:
    """So many packs that each hold these ``(length, times)``."""

    count: int
    content: tuple[tuple[int, int], ...]

    @property
    def used(self) -> int:
        return sum(length * times for length, times in self.content)


def added(content: tuple, length: int, times: int) -> tuple:
    if content and content[-1][0] == length:
        return (*content[:-1], (length, content[-1][1] + times))
    return (*content, (length, times))


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[Pattern]:
    """Patterns that hold every length as often as the histogram says.

    From the longest on, a length goes into the shortest packs if it fits there
    and opens new ones else, which the next of its kind then join.
    """
    open_packs: dict[int, list[Pattern]] = defaultdict(list)
    spaces: list[int] = []

    def keep(space: int, pattern: Pattern) -> None:
        if pattern.count:
            if not open_packs[space]:
                heapq.heappush(spaces, -space)
            open_packs[space].append(pattern)

    for length in sorted(histogram, reverse=True):
        todo = histogram[length]
        while todo and spaces and -spaces[0] >= length:
            space = -spaces[0]
            pattern = open_packs[space].pop()
            if not open_packs[space]:
                heapq.heappop(spaces)
            moved = min(todo, pattern.count)
            keep(space, Pattern(pattern.count - moved, pattern.content))
            keep(space - length, Pattern(moved, added(pattern.content, length, 1)))
            todo -= moved
        if todo:
            each = size // length
            keep(size - each * length, Pattern(todo // each, ((length, each),)))
            if todo % each:
                keep(size - todo % each * length, Pattern(1, ((length, todo % each),)))
    return [p for space in sorted(open_packs) for p in open_packs[space]]


def needs_no_padding(used: int, size: int) -> bool:
    return used == size or used & (used - 1) == 0


class Plan:
    """Where the document of a length and rank lies.

    Patterns without padding keep their packs. The others follow each other on
    one line, which is cut into full sequences; its end is cut into powers of two.
    """

    def __init__(self, patterns: list[Pattern], size: int):
        self.size = size
        whole = [p for p in patterns if needs_no_padding(p.used, size)]
        rows, taken, self.sequences = [], defaultdict(int), 0
        line = 0
        for pattern in [*whole, *[p for p in patterns if not needs_no_padding(p.used, size)]]:
            on_line = not needs_no_padding(pattern.used, size)
            offset = 0
            for length, times in pattern.content:
                first = line if on_line else self.sequences
                rows.append((length, taken[length], times, offset, first, pattern.used if on_line else 0))
                taken[length] += pattern.count * times
                offset += length * times
            if on_line:
                line += pattern.count * pattern.used
            else:
                self.sequences += pattern.count
        rows.sort()
        table = np.array(rows or [(0,) * 6], np.int64).T
        self.lengths, self.ranks, self.times, self.offsets, self.firsts, self.used = table
        self.keys = self.lengths << 48 | self.ranks
        self.line_full = line // size * size
        self.tail = [self.line_full]
        while self.tail[-1] < line:
            self.tail.append(self.tail[-1] + (1 << (line - self.tail[-1]).bit_length() - 1))

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each its sequence and its offset there, or -1 and its place on the line; if on it."""
        at = np.searchsorted(self.keys, lengths << 48 | ranks, side="right") - 1
        number = ranks - self.ranks[at]
        pack, copy = number // self.times[at], number % self.times[at]
        offset = self.offsets[at] + copy * lengths
        on_line = self.used[at] > 0
        sequence = np.where(on_line, -1, self.firsts[at] + pack)
        return sequence, np.where(on_line, self.firsts[at] + pack * self.used[at] + offset, offset), on_line

    def cuts(self, place: int, length: int) -> Iterator[tuple[int, int, int]]:
        """``(sequence, offset, length)`` of what lies at a place of the line."""
        while length:
            if place < self.line_full:
                number, offset = divmod(place, self.size)
                room = self.size - offset
            else:
                i = bisect.bisect_right(self.tail, place) - 1
                number, offset = self.line_full // self.size + i, place - self.tail[i]
                room = self.tail[i + 1] - place
            here = min(room, length)
            yield self.sequences + number, offset, here
            place, length = place + here, length - here


# --- documents ---------------------------------------------------------------------


def _looked_up(rows: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of ``ranks``, a stored table, broadcast if it is small."""
    if ranks.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        ranks = F.broadcast(ranks)
    return rows.join(ranks, keys, "left")


def packed(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = SEQUENCE,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is the ids of its text by the ``tokenizers`` file at
    ``tokenizer``, and ``end_id``. Sequences hold at most ``size`` ids and are
    full or hold a power of two, so none is padded. ``start`` counts the ids of
    the document before the piece, ``offset`` those of the sequence;
    ``ids_crc32`` is the checksum of the ids as unsigned 32-bit numbers, low
    byte first; with ``with_ids`` the ids themselves follow. Whole texts are
    read. Null texts count as empty and are ``end_id`` alone; null ids and
    repeated rows pass through, each packed for itself; an empty table gives an
    empty result; other columns are not read. The driver holds a count per
    length up to ``size`` and the patterns made of them.
    """
    tokens = tokenised(docs, tokenizer, id_column, text_column, size, end_id)
    counted = tokens.groupBy("part", F.col("rest").alias("length")).agg(F.count("*").alias("held"))
    counted = counted.filter("length > 0").unionByName(
        tokens.groupBy("part")
        .agg(F.sum(F.expr(f"n div {size}")).alias("held"))
        .select("part", F.lit(size).alias("length"), "held")
        .filter("held > 0")
    )
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("held").over(earlier), F.lit(0)).cast("long")
    ranks = stored(counted.select("part", "length", "held", before.alias("before")), "ranks")
    histogram = dict(ranks.groupBy("length").agg(F.sum("held")).collect())
    plan = Plan(shortest_pack_first(histogram, size), size)
    rests = ranks.select("part", F.col("length").alias("rest"), F.col("before").alias("rest_before"))
    fulls = ranks.filter(F.col("length") == size).select("part", F.col("before").alias("full_before"))
    found = _looked_up(_looked_up(tokens, rests, ["part", "rest"]), fulls, ["part"]).select(
        "doc_id", "n", "rest", "width", "ids",
        (F.col("rest_no") + F.coalesce("rest_before", F.lit(0))).alias("rest_rank"),
        (F.col("full_no") + F.coalesce("full_before", F.lit(0))).alias("full_rank"),
    )
    names = [c.split()[0] for c in _PIECES.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())]

    def answer(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, waiting = [], 0
        for batch in batches:
            columns = {n: batch[n].to_numpy(zero_copy_only=False) for n in ("n", "rest", "rest_rank", "full_rank")}
            full_lengths = np.full(batch.num_rows, size, np.int64)
            rest_at = [c.tolist() for c in plan.find(columns["rest"].astype(np.int64), columns["rest_rank"])]
            full_at = plan.find(full_lengths, columns["full_rank"])[0].tolist() if size in histogram else []
            for row in range(batch.num_rows):
                doc_id, n, rest = batch["doc_id"][row].as_py(), int(columns["n"][row]), int(columns["rest"][row])
                data = batch["ids"][row].as_py()
                ids = np.frombuffer(data, f"<u{batch['width'][row].as_py()}").astype("<u4")
                pieces = [(full_at[row] + k, 0, size) for k in range(n // size)]
                sequence, at, on_line = (c[row] for c in rest_at)
                if rest:
                    pieces += plan.cuts(at, rest) if on_line else [(sequence, at, rest)]
                start = 0
                for sequence, offset, length in pieces:
                    part = ids[start : start + length]
                    out.append(
                        (doc_id, start, length, zlib.crc32(part.tobytes()), n, sequence, offset,
                         part.astype(np.int32) if with_ids else None)
                    )
                    start += length
                waiting += n if with_ids else 100 * len(pieces)
                if waiting >= SLICE_TOKENS:
                    yield answer(out)
                    out, waiting = [], 0
        if out:
            yield answer(out)

    placed = found.mapInArrow(place, _PIECES)
    return placed if with_ids else placed.drop("ids")
