"""Periodic runs against definitions written out plainly."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from labelmill.llm import periodic

TEXT = "doc_id long, text string"


def plain_lyndon(w):
    """Up to the next smaller suffix."""
    return [next((j for j in range(i + 1, len(w)) if w[j:] < w[i:]), len(w)) - i for i in range(len(w))]


def has_period(w, q):
    return all(a == b for a, b in zip(w, w[q:]))


def plain_runs(w, least):
    found = []
    for q in range(1, len(w) // 2 + 1):
        start = 0
        while start + q < len(w):
            end = start + q
            while end < len(w) and w[end] == w[end - q]:
                end += 1
            part = w[start:end]
            if len(part) >= max(least, 2 * q) and not any(has_period(part, r) for r in range(1, q)):
                found.append((start, end - start, q))
            start = end - q + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def sequences(seed, count, most):
    rng = random.Random(seed)
    for _ in range(count):
        n = rng.randint(1, most)
        w = [rng.randrange(rng.randint(1, 4)) for _ in range(n)]
        if rng.random() < 0.5:
            a, p = rng.randrange(n), rng.randint(1, max(1, n // 3))
            for i in range(a, n):
                w[i] = w[a + (i - a) % p]
        yield w


def test_lyndon_lengths_under_both_orders():
    for w in sequences(1, 400, 40):
        values = sorted(set(w))
        ranks = [values.index(x) for x in w]
        highest = len(values) - 1
        assert periodic.lyndon_lengths(ranks, highest) == plain_lyndon(ranks)
        turned = [highest - r for r in ranks]
        assert periodic.lyndon_lengths(turned, highest) == plain_lyndon(turned)


@pytest.mark.parametrize("least", [2, 12])
def test_runs_by_definition(least):
    for w in sequences(2, 400, 60):
        assert periodic.runs_of(np.array(w), least) == plain_runs(w, least)
    fibonacci = [0, 1]
    a, b = [0], [0, 1]
    for _ in range(9):
        a, b = b, b + a
    fibonacci = b
    assert periodic.runs_of(np.array(fibonacci), least) == plain_runs(fibonacci, least)


def test_extensions():
    w = np.array([5, 1, 2, 3] * 100 + [9])
    extend = periodic.Extensions(w)
    for i, j in ((0, 4), (3, 399), (8, 16), (2, 3)):
        ahead = next((k for k in range(len(w) - j) if w[i + k] != w[j + k]), len(w) - j)
        assert extend.ahead(i, j, len(w) - j) == ahead
        back = next((k for k in range(i + 1) if w[i - k] != w[j - k]), i + 1)
        assert extend.back(i, j, i + 1) == back


def test_every_run_lies_inside_a_stretch():
    rng = random.Random(3)
    for _ in range(60):
        docs = [w for w in sequences(rng.random(), 6, 120)]
        words = np.array([x for w in docs for x in w])
        document = np.repeat(np.arange(len(docs)), [len(w) for w in docs])
        kept = periodic.repeating_stretches(words, document)
        first = 0
        for w in docs:
            for s, n, _ in plain_runs(w, periodic.LEAST_LENGTH):
                assert any(a <= first + s and first + s + n <= b for a, b in kept)
            first += len(w)
        assert all(document[a] == document[b - 1] for a, b in kept)


def plain_row(doc_id, text, repeat):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    n = len(words)
    if repeat and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words, 12)
    drop = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[0] if runs else None
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    return (
        doc_id, n, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


@pytest.mark.parametrize("repeat", [False, True])
def test_rows_match_brute_force(spark, repeat):
    rng = random.Random(4)
    rows = [(i, " ".join("äbc"[x % 3] + "\n" * (x == 0) for x in w)) for i, w in enumerate(sequences(5, 150, 90))]
    rows += [(200, "one two\tthree " * 900 + "end"), (201, " ".join(str(rng.random()) for _ in range(300)))]
    rows += [(None, "a " * 30), (None, None), (7, ""), (8, " \x0b\f "), (9, "a b " * 12), (200, "x")]
    got = periodic.periodic_runs(spark.createDataFrame(rows, TEXT).repartition(4), repeat=repeat).collect()
    want = [plain_row(d, t, repeat) for d, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_other_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b " * 9, 5, "x")], TEXT + ", n_runs int, start string")
    (row,) = periodic.periodic_runs(docs).collect()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (1, 0, 18, 2, 9000)
    assert row.collapsed_sha256 == hashlib.sha256(b"a b").hexdigest()
    assert periodic.periodic_runs(docs.limit(0)).count() == 0
    nothing = spark.createDataFrame([(None, None)], "doc_id string, text string")
    assert periodic.periodic_runs(nothing).first()[:4] == (None, 0, 0, None)
