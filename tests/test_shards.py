"""Anchors, shard parsing and merging, against plain Python."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from labelmill.functions import anchors
from labelmill.operators import assemble, shards, skew


def test_anchor_text(spark):
    text = "a😀é한국 text\nwith lines"
    cases = [
        ([], ''),
        ([(None, None)], 'a😀é한국 text\nwith lines'),
        ([('0', '0')], 'a😀é한국 text\nwith lines'),
        ([(None, '3')], 'a😀é'),
        ([('1', None)], '😀é한국 text\nwith lines'),
        ([('1', '2'), ('3', '5')], '😀한국'),
        ([('5', '2')], ''),
        ([('2', '900')], 'é한국 text\nwith lines'),
        ([('100', '200')], ''),
        ([('x', '2')], ''),
        ([('1', '2'), ('1', 'y')], ''),
        ([('', '4')], 'a😀é한'),
        ([('-3', None)], 'nes'),
        ([('2', '-2')], 'é한국 text\nwith lin'),
        ([('+2', '4')], 'é한'),
        ([('0', '1'), (None, None)], 'aa😀é한국 text\nwith lines'),
    ]
    rows = [(i, text, [{"start_index": a, "end_index": b} for a, b in c]) for i, (c, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, t string, s array<struct<start_index:string,end_index:string>>")
    got = [r.x for r in df.select("i", anchors.anchor_text(F.col("t"), F.col("s")).alias("x")).orderBy("i").collect()]
    assert got == [wanted for _, wanted in cases]
    missing = df.select(anchors.anchor_text(F.lit(None).cast("string"), F.col("s")).alias("x"), anchors.anchor_text(F.col("t"), F.lit(None).cast("array<struct<start_index:string,end_index:string>>")).alias("y")).collect()
    assert {tuple(r) for r in missing} == {("", "")}


def shard_json(text, page_numbers, cuts, entities=()):
    segments = [{"startIndex": str(a), "endIndex": str(b)} for a, b in cuts]
    paragraphs = [{"layout": {"textAnchor": {"textSegments": [s]}}} for s in segments]
    return json.dumps({
        "text": text,
        "pages": [{"pageNumber": n, "paragraphs": paragraphs} for n in page_numbers],
        "entities": [{"type": t, "mentionText": m, "confidence": c} for t, m, c in entities],
    })


FILES = [
    ("gs://b/a.docx", "s/a-0.json", shard_json(" zero\n", [1], [(0, 6)], [("k", "m0", 0.5)])),
    ("gs://b/a.docx", "s/a-2.json", shard_json("two", [1, 2], [(0, 1), (1, 3)])),
    ("gs://b/a.docx", "s/a-10.json", shard_json("ten", [3], [(0, 3)], [("k", "m10", 0.25), ("k", "m10", 0.25)])),
    ("gs://b/b.pdf", "s/b-0.json", "{}"),
    ("gs://b/c.pdf", "s/c-0.json", "no json"),
    ("gs://b/c.pdf", "s/c-1.json", shard_json("rest", [1], [])),
]


def test_merge_order_and_status(spark):
    files = spark.createDataFrame(FILES, "uri string, shard_uri string, content string")
    expected = spark.createDataFrame([(u,) for u in ("gs://b/a.docx", "gs://b/b.pdf", "gs://b/c.pdf", "gs://b/none.pdf")], "uri string")
    unlisted = spark.createDataFrame([("gs://b/other.pdf", "s/o-0.json", "{}")], files.schema)
    files = files.union(unlisted)
    own = shards.shards_of(files, expected)
    parsed = shards.parse_shards(own)
    merged = shards.with_missing(expected, shards.merge_shards(parsed), own)
    got = {r.uri: r for r in merged.collect()}
    a = got["gs://b/a.docx"]
    assert a.full_text == " zero\ntentwo" and a.part == "" and a.mime_type.endswith("wordprocessingml.document")
    assert [(p.page_number, p.text) for p in a.pages] == [(1, "zero"), (3, "ten"), (1, "t\nwo"), (2, "t\nwo")]
    assert [e.mention_text for e in a.entities] == ["m0", "m10", "m10"]
    assert (got["gs://b/b.pdf"].full_text, got["gs://b/b.pdf"].pages, got["gs://b/b.pdf"].status) == ("", [], "ok")
    assert (got["gs://b/c.pdf"].full_text, got["gs://b/c.pdf"].status) == ("rest", "unreadable_shard")
    assert got["gs://b/none.pdf"].status == "no_shards" and len(got) == 4
    listed = shards.entity_list(parsed).orderBy("position").collect()
    assert [(r.position, r.mention_text, r.confidence) for r in listed] == [(0, "m0", 0.5), (1, "m10", 0.25), (2, "m10", 0.25)]


@pytest.mark.parametrize("broadcast_keys", [10_000, 0])
def test_owners_of_shards(spark, monkeypatch, broadcast_keys):
    monkeypatch.setattr(skew, "_BROADCAST_KEYS", broadcast_keys)
    names = [("gs://b/x/a.pdf", "gs://b/temp_async_output/t/a.pdf/"), ("gs://b/y/a.pdf", "gs://b/temp_async_output/t/a.pdf/"), ("gs://b/c.pdf", "gs://b/temp_async_output/t/c.pdf/"), ("gs://b/o/", "gs://b/temp_async_output/t//"), ("n", None)]
    files = [("gs://b/temp_async_output/t/a.pdf/1/0/s.json",), ("gs://b/temp_async_output/t/c.pdf.json",), ("gs://b/elsewhere/s.json",), ("gs://b/temp_async_output/u/c.pdf/s.json",), (None,)]
    got = shards.owned_shards(spark.createDataFrame(files, "shard_uri string"), spark.createDataFrame(names, "uri string, chunk_prefix string")).collect()
    assert sorted((r.uri, r.shard_uri) for r in got) == [("gs://b/x/a.pdf", files[0][0]), ("gs://b/y/a.pdf", files[0][0])]


def test_counts_and_entities_shuffle_no_text(spark, sf_dir):
    for name in ("page_stats", "entity_list"):
        df = entry.queries()[name](spark, sf_dir)
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plan = df._jdf.queryExecution().explainString(mode)
        moved = re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\(uri#", plan)
        assert len(moved) == 1, name
        assert not re.search("text|body|content|shard#", moved[0]), moved


def many_shards(spark, counts):
    rng = random.Random(3)
    rows = []
    for uri, n in counts.items():
        for i in range(n):
            text = "".join(rng.choice("ab é😀\n") for _ in range(rng.randrange(0, 30)))
            rows.append((uri, f"{uri}-{i}", text))
    return rows, spark.createDataFrame(rows, "uri string, shard_uri string, text string").withColumn(
        "pages", F.array().cast("array<struct<page_number:int,paragraphs:array<struct<segments:array<struct<start_index:string,end_index:string>>>>>>")
    ).withColumn("entities", F.array().cast("array<struct<type:string,mention_text:string,confidence:double>>"))


@pytest.mark.parametrize("broadcast_keys", [10_000, 0])
@pytest.mark.parametrize("chars", [1, 13, 500])
def test_one_document_with_most_shards_is_cut(spark, monkeypatch, broadcast_keys, chars):
    monkeypatch.setattr(skew, "_BROADCAST_KEYS", broadcast_keys)
    rows, df = many_shards(spark, {"hot": 400, "x": 3, "y": 2})
    rows += [("none", "n-0", ""), ("none", "n-1", ""), ("twice", "t-0", "ab" * 40), ("twice", "t-0", "ab" * 40)]
    more = spark.createDataFrame(rows[-4:], "uri string, shard_uri string, text string")
    df = df.unionByName(more.withColumns({c: F.array().cast(df.schema[c].dataType) for c in ("pages", "entities")}))
    # Every shard has one entity, named like its place.
    entity = F.struct(F.lit("k").alias("type"), F.col("shard_uri").alias("mention_text"), F.lit(0.5).alias("confidence"))
    df = df.withColumn("entities", F.array(entity))
    got = shards.merge_shards(df.repartition(5), chars=chars).orderBy("uri", "part").collect()
    for uri in ("hot", "x", "y", "none", "twice"):
        own = sorted((s, t) for u, s, t in rows if u == uri)
        text = "".join(t for _, t in own)
        parts = [m for m in got if m.uri == uri]
        assert [m.full_text for m in parts] == [text[i : i + chars] for i in range(0, max(1, len(text)), chars)]
        assert [m.start for m in parts] == list(range(0, max(1, len(text)), chars))
        names = [""] if len(parts) == 1 else [f"{k:012}" for k in range(len(parts))]
        assert [m.part for m in parts] == names
        assert [e.mention_text for m in parts for e in m.entities] == [s for s, _ in own]
        ahead = 0
        for shard, t in own:
            home = parts[min(ahead // chars, len(parts) - 1)]
            assert shard in {e.mention_text for e in home.entities}
            ahead += len(t)
    stats = {r.uri: r.text_length for r in shards.page_stats(df).collect()}
    assert stats["hot"] == sum(len(t) for u, _, t in rows if u == "hot")


def test_parts_of_a_large_document_meet_in_no_task(spark):
    """Every group is one part; places come from narrow rows, summed by range."""
    _, df = many_shards(spark, {"hot": 50})
    merged = shards.merge_shards(df, chars=10)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    grouped = [g for g in re.findall(r"ObjectHashAggregate\(keys=\[([^\]]*)\]", plan) if "_at" in g]
    assert grouped and "Window" not in plan.split("collect_list")[0]


@pytest.mark.parametrize("ranges", [1, 7])
def test_running_sums_over_ranges(spark, monkeypatch, ranges):
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        rng = random.Random(5)
        rows = [(i, "hot" if i % 3 else f"k{i % 5}" if i % 2 else None, rng.randrange(50), rng.randrange(9)) for i in range(400)]
        frame = spark.createDataFrame(rows, "i long, k string, o long, n long").repartition(4)
        got = {r.i: r._before for r in skew.running_before(frame, ["k"], ["o", "i"], "n").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    for i, k, o, _ in rows:
        assert got[i] == sum(n for j, l, p, n in rows if l == k and (p, j) < (o, i))


@pytest.mark.parametrize("text", ["", "abc", "abcdefg", "é😀한" * 5])
def test_cut_rows(spark, text):
    df = spark.createDataFrame([(1, text, [1, 2]), (2, None, [3])], "i long, t string, l array<int>")
    got = assemble.cut_rows(df, "t", 3, ("l",)).orderBy("i", "part").collect()
    mine = [r for r in got if r.i == 1]
    assert [r.t for r in mine] == [text[i : i + 3] for i in range(0, max(1, len(text)), 3)]
    assert [r.l for r in mine] == [[1, 2]] + [[]] * (len(mine) - 1) and [r.start for r in mine] == [3 * k for k in range(len(mine))]
    assert tuple(got[-1]) == (2, None, [3], "", 0)


@pytest.mark.parametrize("chars", [1, 7, 200, 10**5])
def test_head_text(spark, chars):
    rows, df = many_shards(spark, {"hot": 700, "x": 3})
    rows += [("empty", f"e{i}", "") for i in range(50)]
    df = df.select("uri", "shard_uri", "text").union(spark.createDataFrame(rows[-50:], "uri string, shard_uri string, text string"))
    got = {r.uri: r["head"] for r in assemble.head_text(df, "uri", "shard_uri", "text", chars).collect()}
    assert got == {u: "".join(t for v, _, t in sorted(rows) if v == u)[:chars] for u in ("hot", "x", "empty")}
