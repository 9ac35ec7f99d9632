"""Classifiers, the pipeline, and the registered queries against their SQL."""

import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from labelmill.llm import quality, toxicity
from labelmill.llm import queries as llm

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TEXT = "doc_id long, text string, n_chars long, score double"
LABELS = "doc_id long, quality int, toxic int"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


# --- quality -----------------------------------------------------------------------


def test_pairs_by_the_sum_of_squares():
    rng = np.random.default_rng(0)
    n = len(quality.STATISTICS)
    size = quality.WORD_BUCKETS + n
    machine = quality.Machine(
        0.3, rng.normal(size=size), rng.normal(size=(size, 3)), rng.normal(size=n), np.ones(n)
    )
    buckets, dense = np.array([2, 5, 9], np.int32), rng.normal(size=n)
    places, x = machine.values(buckets, dense)
    z = machine.bias + sum(machine.weights[p] * v for p, v in zip(places, x))
    for i in range(len(x)):
        for j in range(i):
            z += machine.factors[places[i]] @ machine.factors[places[j]] * x[i] * x[j]
    assert machine.score(buckets, dense) == pytest.approx(1 / (1 + np.exp(-z)))


@pytest.mark.parametrize("text", [b"", None, b"\n\n", b"\xff\xfe", b"one", b"a " * 100_000])
def test_statistics_are_finite(text):
    _, dense = quality.inputs_of(text, [float("nan")])
    assert len(dense) == len(quality.STATISTICS) + 1 and np.isfinite(dense).all()


def accuracy(rows, labels, column):
    known = {r["doc_id"]: r[column] for r in labels.collect() if r[column] is not None}
    judged = [(r.predicted, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    return sum(a == b for a, b in judged) / len(judged)


@pytest.mark.parametrize("name,column,least", [("op8_quality_classifier", "quality", 0.93), ("op9_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, column, least):
    sf_dir = "/root/testdata/sf0.01"
    rows = llm.QUERIES[name](spark, sf_dir).collect()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert accuracy(rows, labels, column) >= least


@pytest.mark.parametrize("score", [quality.quality, toxicity.toxicity])
def test_labels_of_the_test_fold_are_not_learned(spark, score):
    rows = [(i, "fine words here" if i % 3 else "bad ### idiot", 3, 0.0) for i in range(120)]
    docs = spark.createDataFrame(rows, TEXT)
    right = [(i, int(i % 3 > 0), int(i % 3 == 0)) for i in range(120)]
    wrong = [(i, 1 - q, 1 - t) if held_out(i) else (i, q, t) for i, q, t in right]
    a, b = (score(docs, spark.createDataFrame(rows, LABELS)).collect() for rows in (right, wrong))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


@pytest.mark.parametrize("score", [quality.quality, toxicity.toxicity])
def test_classifier_edges(spark, score):
    rows = [(1, None, None, 1.0), (2, "", 0, 1.0), (2, "", 0, 1.0), (None, "some text.", 5, 1.0)]
    docs = spark.createDataFrame(rows, TEXT)
    for labels in ([], [(1, 1, 1), (2, None, None), (None, 0, 0)], [(1, 1, 1), (2, 0, 0)]):
        got = score(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
        assert sum(r.doc_id is None and not r.held_out for r in got) == 1
    assert score(docs.limit(0), spark.createDataFrame([(1, 1, 1)], LABELS)).count() == 0
    bare = docs.select("doc_id", "text")
    assert score(bare, spark.createDataFrame([(1, 1, 1)], LABELS)).count() == 4


# --- toxicity -----------------------------------------------------------------------


def test_metadata_that_is_no_number(spark):
    rows = [(i, "some plain words here " * (i % 5), "many") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    assert quality.quality(docs, labels).count() == 30


def test_noisy_or():
    scores = [-1.0, 0.5, -8.0]
    chances = [1 / (1 + np.exp(-z)) for z in scores]
    assert toxicity.noisy_or(scores) == pytest.approx(1 - np.prod([1 - p for p in chances]))
    assert toxicity.noisy_or([]) == 0.0


def test_offending_sentences_are_found(spark):
    calm = "Nothing to see here. All is well and calm today"
    rows = [(i, calm + f". Number {i}" if i % 4 else f"{calm}! You grumblefoot{i % 3}, go. {calm}", 0, 0.0) for i in range(400)]
    docs = spark.createDataFrame(rows, TEXT)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], LABELS)
    for r in toxicity.toxicity(docs, labels).collect():
        text = rows[r.doc_id][1]
        assert r.predicted == int(r.doc_id % 4 == 0)
        spans = [tuple(map(int, s.split(":"))) for s in r.offending.split(",") if s]
        assert all("grumblefoot" in text[a:b] for a, b in spans)
        assert len(spans) == r.predicted


# --- queries and pipeline ------------------------------------------------------------


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    df = llm.QUERIES[name](spark, sf_dir)
    want = con.sql(llm.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    places = [want.columns.index(c) for c in columns]
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == Counter(tuple(plain(r[i]) for i in places) for r in want.fetchall())


def test_every_operator_has_a_query():
    assert {int(n.split("_")[0][2:]) for n in llm.QUERIES} == set(range(1, 14))


def test_pipeline_stages(spark, sf_dir):
    """Each stage against its operator's rows, on its own input."""
    from labelmill.llm import decontam, mixing, sharding, simhash
    from labelmill.session import stored

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, before, sf_dir), name)
        ids = {r.doc_id for r in before.select("doc_id").collect()}
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert kept[name] <= ids and docs.count() == len(kept[name])
        assert docs.columns == columns if name != "sharding" else docs.columns == [*columns, "shard", "slot"]
        if name == "quality":
            machine = quality.fit(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            rows = before.collect()
            want = {r.doc_id for r in rows if machine.score(*quality.inputs_of(r.text.encode(), [r.n_chars])) >= 0.3}
            assert kept[name] == want and len(want) < len(rows)
        if name == "near_duplicates":
            found = simhash.near_duplicates(before).collect()
            assert kept[name] == {r.component_id for r in found}
        if name == "decontamination":
            bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
            assert kept[name] == ids - {r.doc_id for r in decontam.leaks(before, bench).collect()}
        if name in ("mixing", "sharding"):
            assert kept[name] == ids
    assert mixing.mixed(docs).count() == sharding.shard_documents(docs).count() == len(kept["sharding"])


def test_pipeline_runs_whole(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    held = got.groupBy("shard").count().collect()
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    assert len(held) > 30 and sum(r["count"] for r in held) == got.select("doc_id").distinct().count()


def test_stages_with_odd_rows(spark, sf_dir):
    """Null and repeated rows, extra columns of clashing names, no rows."""
    text = "Some quiet words that make a sentence of fair length, and then another one follows."
    rows = [(None, None, None, None, None, 1, "x"), (1, text, "en", "s", 80, 2, "y"), (1, text, "en", "s", 80, 2, "y")]
    rows += [(2, "", "en", None, 0, 3, "z"), (3, "y" * 300_000, "en", "", 9, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, slot int, dropped_id string"
    docs = spark.createDataFrame(rows, schema)
    for given in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, given, sf_dir)
            assert out.count() <= given.count()
            if name != "sharding":
                assert out.columns == given.columns
            if name in ("mixing", "sharding"):
                assert out.count() == given.count()
