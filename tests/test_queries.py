"""Every registered query against its SQL, row for row."""

import math
from collections import Counter
from datetime import datetime
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalog import queries as catalog
from catalog import sql as catalog_sql
from labelmill.operators import assemble
from labelmill.sources import files

# Queries of the text preparation package are tested beside it.
QUERIES = {name: entry.queries()[name] for name in catalog.QUERIES}
ORACLES = catalog_sql.ORACLES

TABLES = """region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations""".split()

KINDS = {
    "string": "text", "varchar": "text", "bigint": "whole", "int": "whole", "integer": "whole",
    "double": "real", "boolean": "flag",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime):
        return value.isoformat()
    return value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    assert len(set(columns)) == len(columns)
    want = duck.sql(ORACLES[name])
    assert columns == sorted(want.columns)
    ours = {c: KINDS[t] for c, t in df.dtypes}
    theirs = {c: KINDS.get(str(t).lower(), str(t)) for c, t in zip(want.columns, want.types)}
    rows = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    places = [want.columns.index(c) for c in columns]
    expected = Counter(tuple(plain(r[i]) for i in places) for r in want.fetchall())
    extra, missing = rows - expected, expected - rows
    assert not extra and not missing, (
        f"{sum(extra.values())} extra, {sum(missing.values())} missing of {sum(expected.values())};"
        f" {columns}; extra {str(list(extra)[:2])[:1500]}; missing {str(list(missing)[:2])[:1500]}"
    )
    assert ours == theirs
    assert rows


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_listed_files(spark, sf_dir):
    found = files.list_files(spark, sf_dir, suffix=".parquet").collect()
    assert {r.file_name: r.length for r in found} == {p.name: p.stat().st_size for p in Path(sf_dir).glob("*.parquet")}


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["dimension", "value", "label", "n"]
    assert df.count() > 0


IN_PARTS = ["shard_merge", "transcript_text", "media_transcript", "video_document", "video_reference"]


@pytest.mark.parametrize("chars", [97, 2000])
@pytest.mark.parametrize("name", IN_PARTS)
def test_query_matches_sql_in_short_parts(spark, sf_dir, duck, monkeypatch, name, chars):
    """The same rows when nearly every text has several parts."""
    monkeypatch.setattr(catalog, "PART_CHARS", chars)
    monkeypatch.setitem(ORACLES, name, catalog_sql.texts_in_parts(chars)[name])
    test_query_matches_sql(spark, sf_dir, duck, name)


def test_every_url_has_its_document(spark, sf_dir, monkeypatch):
    """Pages that are no video and videos without an answer too."""
    monkeypatch.setattr(catalog, "PART_CHARS", 97)
    urls = sorted(r.url for r in catalog.I.video_urls(spark, sf_dir).collect())
    rows = QUERIES["video_document"](spark, sf_dir).collect()
    assert sorted(r.uri for r in rows if r.start == 0) == urls
    assert {r.status for r in rows} == {"ok", "not_a_video", "video_not_found"}
    assert all((r.full_text is None) == (r.status != "ok") for r in rows) and len(rows) > len(urls)


def test_large_transcript_in_parts(spark, sf_dir, monkeypatch):
    """One track of 18 MiB; no task holds more than one part of it."""
    n = 180
    lines = spark.range(n).select(
        F.lit("vid1").alias("video_id"),
        F.lit("system").alias("track_id"),
        (n - F.col("id")).alias("seq"),
        F.concat(F.lpad((n - F.col("id")).cast("string"), 4, "0"), F.repeat(F.lit("x"), 100_000)).alias("text"),
    )
    track = [("vid1", "system", "ko", False)]
    tracks = spark.createDataFrame(track, "video_id string, track_id string, language string, is_generated boolean")
    monkeypatch.setattr(catalog.I, "spoken_lines", lambda *_: lines.repartition(7))
    monkeypatch.setattr(catalog.I, "spoken_tracks", lambda *_: tracks)
    want = "\n".join(f"{i:04}" + "x" * 100_000 for i in range(1, n + 1))
    for name, text in (("transcript_text", "transcript"), ("video_document", "full_text")):
        got = QUERIES[name](spark, sf_dir).filter("video_id = 'vid1'").orderBy("part").collect()
        whole = "".join(r[text] for r in got)
        assert whole.endswith(want) and (len(whole) == len(want)) == (name == "transcript_text")
        assert [(r.part, r.start) for r in got] == [(f"{k:012}", k * assemble.PART_CHARS) for k in range(len(got))]
        assert {len(r[text]) for r in got[:-1]} == {assemble.PART_CHARS} and len(got) == 5
