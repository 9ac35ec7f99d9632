"""Names of a dictionary against the pattern that says the same."""

import random
import re
import time

import pytest
import regex
from pyspark.sql import functions as F

from labelmill.functions import rules
from labelmill.operators import recognition as R

NAMES = ["Nimbus", "Nimbus GT", "Cirrus", "CIRRUS", "GT", "#5 Ray", "#5", "é-Tron 2", "X+", "Aurora  B", "한 글", "nimbus gt max"]


def table(spark, names):
    return R.dictionary(spark.createDataFrame([(n,) for n in names], "name string"))


def plain(text, names):
    """The first name by the rule: leftmost, then longest; whole words, any case."""
    lowered = text.lower()
    best = None
    for name in sorted(names, key=lambda n: (n.lower(), n)):
        if not regex.search(r"[\p{L}\p{N}]", name):
            continue
        found = regex.search(rf"(?<![\p{{L}}\p{{N}}]){re.escape(name.lower())}(?![\p{{L}}\p{{N}}])", lowered)
        if found and (best is None or (found.start(), -len(name)) < best[0]):
            best = (found.start(), -len(name)), min(n for n in names if n.lower() == name.lower())
    return best[1] if best else "UNKNOWN"


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_names_by_the_rule(spark, monkeypatch, broadcast):
    monkeypatch.setattr(R, "BROADCAST_NAMES", broadcast)
    rng = random.Random(1)
    pieces = ["nimbus", "GT", "Cirrus", "max", "#5", " ray", "é-tron", "2", "x+", "aurora", "b", "한", "글", "word", "!", "#"]
    texts = ["".join(rng.choice(pieces) + rng.choice([" ", "  ", "", ", ", "\n"]) for _ in range(rng.randint(0, 9))) for _ in range(300)]
    texts += ["", "#5", "x#5 ray", "##5 ray", "a #5 rays", "X+", "x+y", "nimbus gt ma", "aurora  b", "aurora b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = {r.i: r.model for r in R.recognise(docs, "i", "t", table(spark, NAMES)).collect()}
    assert got == {i: plain(t, NAMES) for i, t in enumerate(texts)}


def test_same_as_the_pattern(spark):
    names = ["Nimbus", "Nimbus GT", "Cirrus"]
    texts = ["the NIMBUS gt and Cirrus", "nimbus gtx", "cirrusX Cirrus", "", "cirrus한 nimbus", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    want = {r.i: r.m or "UNKNOWN" for r in docs.select("i", rules.model_name(F.col("t"), names).alias("m")).collect()}
    assert {r.i: r.model for r in R.recognise(docs, "i", "t", table(spark, names)).collect()} == want


def test_odd_names(spark):
    docs = spark.createDataFrame([(1, "a -- b"), (2, "ab")], "i long, t string")
    for names, want in (([], {"UNKNOWN"}), ([None, "", "--"], {"UNKNOWN"}), (["B", "b"], {"B", "UNKNOWN"})):
        assert {r.model for r in R.recognise(docs, "i", "t", table(spark, names)).collect()} == want
    assert R.recognise(docs.limit(0), "i", "t", table(spark, ["a"])).count() == 0


def test_long_text_in_linear_time(spark):
    text = "word " * 200_000 + "nimbus gt"
    docs = spark.createDataFrame([(1, text)], "i long, t string")
    begin = time.perf_counter()
    assert R.recognise(docs, "i", "t", table(spark, NAMES)).first().model == "Nimbus GT"
    assert time.perf_counter() - begin < 60


def test_many_names_cost_no_more_than_few(spark):
    """A hundred thousand names: found by their words, no pattern holds them."""
    many = [f"name{i} of {i % 7}" for i in range(100_000)]
    texts = [f"{'word ' * (i % 50)}name{i * 31} of {i * 31 % 7} and name{i} of {i % 7}" for i in range(2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "i long, t string").repartition(8)
    took = {}
    for names in (many[:10], many):
        known = table(spark, names).cache()
        known.count()
        found = R.recognise(docs, "i", "t", known)
        begin = time.perf_counter()
        got = {r.i: r.model for r in found.collect()}
        took[len(names)] = time.perf_counter() - begin
        known.unpersist()
    assert got == {i: f"name{i * 31} of {i * 31 % 7}" for i in range(2000)}
    assert took[100_000] < 5 * took[10] + 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "name99" not in plan and "NestedLoop" not in plan
