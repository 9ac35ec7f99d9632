"""Exact and near duplicates against brute force, and their edge cases."""

import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from labelmill.llm import components, exactdedup, simhash

TEXT = "doc_id long, text string"


def lower_az(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- exact ---------------------------------------------------------------------


def test_exact_groups(spark):
    rows = [(1, "Ab"), (2, "aB"), (3, None), (4, ""), (5, "Äb"), (6, "äb"), (2, "aB"), (None, "ab")]
    got = exactdedup.exact_duplicates(spark.createDataFrame(rows, TEXT).repartition(3)).collect()
    seen = sorted((r.doc_id or -1, r.keep_id, r.group_size, r.kept, r.first_id) for r in got)
    assert seen == [
        (-1, 2, 4, False, 1), (1, 2, 4, False, 1), (2, 2, 4, True, 1), (2, 2, 4, True, 1),
        (3, 4, 2, False, 3), (4, 4, 2, True, 3), (5, 5, 1, True, 5), (6, 6, 1, True, 6),
    ]
    digest = {r.doc_id: r.text_sha256 for r in got}
    assert digest[1] == hashlib.sha256(b"ab").hexdigest()
    assert digest[3] == hashlib.sha256(b"").hexdigest()


def test_exact_null_ids_and_other_columns(spark):
    rows = [(None, "x", 9, "a"), (None, "x", 8, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, run int, digest string")
    got = exactdedup.exact_duplicates(docs).collect()
    assert [(r.keep_id, r.group_size, r.kept) for r in got] == [(None, 2, True)] * 2


def test_exact_empty_table(spark):
    got = exactdedup.exact_duplicates(spark.createDataFrame([], TEXT))
    assert got.count() == 0 and got.columns[:2] == ["doc_id", "keep_id"]


def test_runs_of_many_partitions_merge(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), (F.col("id") % 7).cast("string").alias("text")
    )
    got = exactdedup.exact_duplicates(docs.repartition(70)).collect()
    assert {r.keep_id for r in got} == set(range(393, 400))
    assert sum(r.kept for r in got) == 7


# --- SimHash ---------------------------------------------------------------------


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower_az(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes):
    """Least id reachable over codes at most 2 bits apart."""
    label = dict(codes)
    ids = sorted(label)
    group = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            near = [j for j in ids if (label[i] ^ label[j]).bit_count() <= 2]
            least = min(group[j] for j in near)
            for j in near:
                if group[j] > least:
                    group[j], changed = least, True
    return group


@pytest.mark.parametrize(
    "text",
    ["", None, " \t\n", "one", "Two words", "a b c d", "É\x1cx   y\x85z", "x " * 70_000, "😀 ß A\x0bB\x0c"],
)
def test_fingerprint(text):
    got = simhash.simhash(None if text is None else text.encode()) & (2**64 - 1)
    assert got == fingerprint(text)


def test_near_duplicates_match_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 50, 40)) for _ in range(30)]
    texts += [t.replace("w7 ", "w8 ", 1) for t in texts] + [None, "", " ", "w1", "W1"]
    rows = list(enumerate(texts))
    got = simhash.near_duplicates(spark.createDataFrame(rows, TEXT).repartition(4)).collect()
    codes = {i: fingerprint(t) for i, t in rows}
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == codes
    assert {r.doc_id: r.component_id for r in got} == brute_components(codes)


@pytest.mark.parametrize("limit", [24, 4096])
def test_links_of_dense_groups(spark, monkeypatch, limit):
    """Chains and balls of codes, with nodes small enough to be split again and again."""
    monkeypatch.setattr(simhash, "NODE_LIMIT", limit)
    rng = np.random.default_rng(5)
    codes = set()
    for center in rng.integers(0, 2**63, 4):
        code = int(center)
        for _ in range(40):
            flips = rng.choice(64, rng.integers(1, 4), replace=False)
            near = code
            for b in flips:
                near ^= 1 << int(b)
            codes.add(near)
            if rng.random() < 0.3:
                code = near
    codes |= {int(x) for x in rng.integers(0, 2**63, 40)} | {0, 1, 2**64 - 1, 2**63}
    named = dict(enumerate(sorted(codes)))
    frame = spark.createDataFrame([(c - 2**64 if c >= 2**63 else c, i) for i, c in named.items()], "fp long, node long")
    found = components.components(simhash.links(frame)).collect()
    got = dict.fromkeys(named) | {r.node: r.component for r in found}
    want = brute_components(named)
    assert {i: c if c is not None else i for i, c in got.items()} == want
    assert len(set(want.values())) < len(named)


def test_gray_rank(spark):
    codes = [i ^ (i >> 1) for i in range(64)]
    frame = spark.createDataFrame([(c,) for c in codes], "c long")
    ranks = {r.c: r.r for r in frame.select("c", simhash.gray_rank(F.col("c")).alias("r")).collect()}
    assert [ranks[c] + 2**63 for c in codes] == list(range(64))


def test_near_duplicates_edges(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], TEXT)).count() == 0
    rows = [(None, "a b c", 1), (7, "a b c", 2), (7, "a b c", 2), (None, "alone here now", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.fp_docs) for r in got) == [
        (-1, -1, 1), (-1, 7, 3), (7, 7, 3), (7, 7, 3),
    ]


# --- components -------------------------------------------------------------------


def test_components_match_brute_force(spark):
    rng = np.random.default_rng(2)
    links = [tuple(map(int, x)) for x in rng.integers(0, 60, (45, 2))] + [(7, 7), (7, 7)]
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    group = {n: n for link in links for n in link if link[0] != link[1]}
    for _ in group:
        for a, b in links:
            if a != b:
                group[a] = group[b] = min(group[a], group[b])
    assert {r.node: r.component for r in got} == group
    assert len(got) == len(group)


def test_long_chain(spark):
    chain = [(i, i + 1) for i in range(24)]
    got = components.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.component for r in got} == {0} and len(got) == 25
