"""Packing: ids of whole texts, patterns against single packs, sequences without gaps."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from labelmill.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
TEXT = "doc_id long, text string"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


PARTS = [
    "$5.", "a&&", "&.", "#1%",    "word", "Word,", "it's", "'s", "12,5", "a.b", "...", "end.\n", "é", "日本語", "x" * 60, "<|endoftext|>",
    "(&)", "$$$", "½,", "_", "don't.", "\x1c", "​", "😀",
]
GAPS = [" ", "  ", "   ", "\n", " \n", "\n ", "\n\n  ", "\t ", " \xa0", "\xa0 ", "　", "", "\r\n", " \x1c", "\x85 "]


def source():
    with open(PATH, encoding="utf-8") as file:
        return file.read()


def same_ids(ids, tokenizer, text):
    return np.frombuffer(ids.of(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_tokenizer(tokenizer):
    ids = packing.Ids(source(), "<u2")
    rng = random.Random(1)
    plain = 0
    for k in range(3000):
        gaps = GAPS if k % 3 else [" "]
        text = "".join(rng.choice(PARTS) + rng.choice(gaps) for _ in range(rng.randint(0, 25)))
        text = text.strip() if k % 2 else rng.choice(GAPS) + text
        plain += packing.is_plain(text)
        assert same_ids(ids, tokenizer, text), repr(text)
    assert 500 < plain < 2900


def test_every_plain_character(tokenizer):
    """Each beside letters, digits, marks and blanks, so that all its kinds of words occur."""
    ids = packing.Ids(source(), "<u2")
    for code in range(ord(packing.PLAIN_BELOW)):
        c = chr(code)
        text = f"a{c} {c}b{c}{c} 1{c}2 .{c}, {c} '{c}s\n{c}"
        assert packing.is_plain(text) and same_ids(ids, tokenizer, text), hex(code)


def test_texts_of_the_table(spark, sf_dir, tokenizer):
    ids = packing.Ids(source(), "<u2")
    texts = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert all(same_ids(ids, tokenizer, text) for text in texts)
    assert sum(map(packing.is_plain, texts)) > 0.9 * len(texts)


@pytest.mark.parametrize("text", ["x" * 200_000, " " * 200_000 + "x", "\n" * 3000 + "a" * 501, "ab" * 251])
def test_long_words_and_gaps(tokenizer, text):
    assert not packing.is_plain(text) and same_ids(packing.Ids(source(), "<u2"), tokenizer, text)


def test_other_tokenizers(spark):
    """A file with another rule for words: lower case, white space dropped."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    other = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        ids = packing.Ids(file.read(), "<u2")
    assert ids.fast is None
    for text in ("Some  Words, and more.\n", "", "it's ÄÖ 123"):
        assert same_ids(ids, other, text)


def single_packs(histogram, size):
    """Spaces left when every length goes into the shortest pack it fits, one after the other."""
    spaces = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            space = max(spaces, default=-1)
            if space >= length:
                spaces.remove(space)
            else:
                space = size
            spaces.append(space - length)
    return sorted(spaces)


def test_patterns_are_those_of_single_packs():
    rng = random.Random(2)
    for _ in range(200):
        size = rng.choice([8, 16, 64])
        histogram = {rng.randint(1, size): rng.randint(1, 40) for _ in range(rng.randint(0, 9))}
        patterns = packing.shortest_pack_first(histogram, size)
        held = Counter()
        for p in patterns:
            assert 0 < p.used <= size
            for length, times in p.content:
                held[length] += times * p.count
        assert held == Counter(histogram)
        assert sorted(size - p.used for p in patterns for _ in range(p.count)) == single_packs(histogram, size)


def test_every_rank_has_its_own_place():
    rng = random.Random(3)
    for _ in range(100):
        size = rng.choice([8, 16, 64])
        histogram = {rng.randint(1, size): rng.randint(1, 30) for _ in range(rng.randint(1, 9))}
        plan = packing.Plan(packing.shortest_pack_first(histogram, size), size)
        filled = defaultdict(list)
        for length, count in histogram.items():
            found = plan.find(np.full(count, length), np.arange(count))
            for sequence, at, on_line in zip(*(f.tolist() for f in found)):
                for s, o, n in plan.cuts(at, length) if on_line else [(sequence, at, length)]:
                    filled[s] += range(o, o + n)
        check_full(filled, size)


def check_full(filled, size):
    """No place of a sequence is free or taken twice, and no sequence is padded."""
    assert sorted(filled) == list(range(len(filled)))
    for places in filled.values():
        assert sorted(places) == list(range(len(places)))
        assert len(places) == size or len(places).bit_count() == 1


@pytest.mark.parametrize("size", [16, 64])
def test_pieces_of_documents(spark, tokenizer, size):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))) for i in range(200)]
    rows += [(1000 + i, "same text of many rows") for i in range(150)]
    rows += [(None, None), (None, "x"), (3, None), (4, "long " * 3000), (5, rows[5][1])]
    docs = spark.createDataFrame(rows, TEXT).repartition(6)
    got = packing.packed(docs, PATH, size=size, with_ids=True).collect()
    want = Counter()
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        want[doc_id, tuple(ids)] += 1
    filled, documents = defaultdict(list), defaultdict(list)
    for r in got:
        filled[r.sequence_id] += range(r.offset, r.offset + r.length)
        assert len(r.ids) == r.length and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        documents[r.doc_id].append(r)
    check_full(filled, size)
    for doc_id in {d for d, _ in want}:
        mine = Counter((r.start, tuple(r.ids), r.doc_tokens) for r in documents[doc_id])
        total = Counter()
        for (d, ids), times in want.items():
            if d == doc_id:
                total[len(ids)] += times
        assert sum(len(ids) * k for (_, ids, _), k in mine.items()) == sum(n * k for n, k in total.items())
        if sum(total.values()) == 1:
            whole = [i for _, ids, _ in sorted(mine) for i in ids]
            assert want[doc_id, tuple(whole)] == 1 and {n for _, _, n in mine} == set(total)


def test_edges(spark):
    docs = spark.createDataFrame([(1, "a b", 7, "s")], TEXT + ", part int, ids string")
    assert packing.packed(docs.limit(0), PATH).count() == 0
    (row,) = packing.packed(docs, PATH).filter("start = 0").collect()
    assert row.doc_tokens == 3 and "ids" not in row
    alone = packing.packed(spark.createDataFrame([(1, None)], TEXT), PATH).collect()
    assert [tuple(r) for r in alone] == [(1, 0, 1, zlib.crc32(b"\x01\0\0\0"), 1, 0, 0)]
    multiple = spark.createDataFrame([(1, "a" + " a" * 14)], TEXT)
    (row,) = packing.packed(multiple, PATH, size=16).collect()
    assert (row.start, row.length, row.offset, row.doc_tokens) == (0, 16, 0, 16)
