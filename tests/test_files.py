"""Files in and out: listings, CSV, sidecars, whole runs."""

import json
import os
import re
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from labelmill.operators import extraction, records, report, routing, shards
from labelmill.plans import batch
from labelmill.schema import METADATA_COLUMNS, METADATA_SCHEMA
from labelmill.session import scratch_path
from labelmill.sinks.tables import write_by_uri, write_metadata_csv, write_text_sidecar
from labelmill.sources import files as sources
from labelmill.sources.files import below_prefix, list_files, list_objects, read_contents, read_shards
from labelmill.sources.tables import read_metadata_csv

AT = datetime(2024, 1, 29, 14, 30)


@pytest.fixture
def tree(tmp_path):
    folder = tmp_path / "in"
    for name, text in {
        "a.pdf": "The Aurora of 2020 is a hybrid", "sub/b.PPTX": "x" * 30, "sub/a.pdf": "other text, other folder",
        "c.txt": "not supported", "sub/deep/d.Docx": "Cirrus", "noext": "n",
    }.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    (folder / "bad.pdf").write_bytes(b"\xff\xfe\xff")
    return folder


def names(df):
    return sorted(r[0].rsplit("/in/", 1)[1] for r in df.select("uri").collect())


def test_listing(spark, tree):
    everything = ["a.pdf", "bad.pdf", "c.txt", "noext", "sub/a.pdf", "sub/b.PPTX", "sub/deep/d.Docx"]
    assert names(list_files(spark, str(tree))) == everything
    assert names(list_files(spark, str(tree), suffix=".PPTX")) == ["sub/b.PPTX"]
    assert names(routing.supported_files(list_files(spark, str(tree)))) == ["a.pdf", "bad.pdf", "sub/a.pdf", "sub/b.PPTX", "sub/deep/d.Docx"]
    contents = read_contents(list_objects(spark, str(tree)))
    assert names(contents) == everything
    assert all(bytes(r.content) == Path(r.uri.removeprefix("file:")).read_bytes() and r.length == len(r.content) for r in contents.collect())
    sizes = {r.file_name: r.length for r in list_files(spark, str(tree)).collect()}
    assert sizes["b.PPTX"] == 30
    times = {r.file_name: r.modificationTime for r in list_files(spark, str(tree)).collect()}
    assert abs(times["noext"].timestamp() - (tree / "noext").stat().st_mtime) < 1


HIDDEN = ["_x", ".x", "_old/b.pdf", ".git/c.pdf", "_old/.deep/_er/d.pdf", "sub/_SUCCESS", "a b.pdf", "x%20y.pdf", "한 글.pdf"]


def test_every_name_is_listed_and_read(spark, tree):
    """Names that file sources of Spark leave out, odd ones, folders without files."""
    for name in HIDDEN:
        path = tree / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(name)
    (tree / "empty" / "emptier").mkdir(parents=True)
    listed = list_objects(spark, str(tree))
    assert set(HIDDEN) <= set(names(listed)) and len(names(listed)) == len(HIDDEN) + 7
    read = {r.uri.rsplit("/in/", 1)[1]: bytes(r.content).decode("utf-8", "replace") for r in read_contents(listed).collect()}
    assert all(read[name] == name for name in HIDDEN)
    assert names(list_objects(spark, f"{tree}/_*")) == ["_old/.deep/_er/d.pdf", "_old/b.pdf", "_x"]
    assert names(list_objects(spark, f"{tree}/_x")) == ["_x"]
    assert names(list_objects(spark, f"file://{tree}/_old/")) == ["_old/.deep/_er/d.pdf", "_old/b.pdf"]
    for nothing in (f"{tree}/empty", f"{tree}/none", f"{tree}/none/", f"{tree}/zz*"):
        assert list_objects(spark, nothing).count() == 0
    manifest = routing.select_objects(listed, suffix=".pdf").select("uri", "length", "file_name", "mime_type")
    got = {r.file_name: (r.length, r.mime_type) for r in manifest.collect()}
    assert got["d.pdf"] == (len("_old/.deep/_er/d.pdf"), "application/pdf") and ".x" not in got


def test_folders_are_listed_by_tasks(spark, tree, monkeypatch):
    """Each round is a job over the folders of the last; the driver opens nothing."""
    rounds = []
    keep = sources.stored
    monkeypatch.setattr(sources, "stored", lambda rows, name: rounds.append(rows.rdd.getNumPartitions()) or keep(rows, name))
    for i in range(9):
        (tree / f"f{i}").mkdir()
        (tree / f"f{i}" / "x").write_text("x")
    monkeypatch.setattr(sources, "LISTING_TASKS", 5)
    driver, open_uri = os.getpid(), sources.open_uri

    def opener(uri):
        assert os.getpid() != driver
        return open_uri(uri)

    assert len(names(list_objects(spark, str(tree), opener))) == 16
    assert len(rounds) == 3 and rounds[1] == 5


def test_files_that_are_gone(spark, tree):
    listed = list_objects(spark, str(tree / "sub") + "/")
    rows = listed.collect()
    gone = spark.createDataFrame([(r.uri + "x", r.length, r.modificationTime) for r in rows], listed.schema)
    got = read_contents(listed.unionByName(gone)).collect()
    assert sum(r.content is None for r in got) == len(rows) == 3
    found = extraction.extract_documents(read_contents(gone), extraction.plain_text).collect()
    assert {r.status for r in found} == {"extractor_error"}


def test_run_takes_hidden_names(spark, tree, tmp_path):
    (tree / "_draft").mkdir()
    (tree / "_draft" / ".a.pdf").write_text("An Aurora")
    done = batch.run_batch(spark, f"{tree}/_", str(tmp_path / "out"), extraction.plain_text, AT, models=["Aurora"])
    assert [(r.uri[-6:], r.model) for r in done.records.collect()] == [(".a.pdf", "Aurora")]


def test_object_info(spark):
    times = ["2024-01-29 14:30:00+00:00", "2024-01-29 14:30:00.25+00:00", None]
    df = spark.createDataFrame([(f"{i}.pdf", i or None, t) for i, t in enumerate(times)], "uri string, length bigint, t string")
    df = df.withColumn("modificationTime", F.col("t").cast("timestamp"))
    want = [("0.pdf", 0, "2024-01-29T14:30:00+00:00"), ("1.pdf", 1, "2024-01-29T14:30:00.250000+00:00"), ("2.pdf", 2, "")]
    for zone in ("UTC", "Asia/Seoul"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = [(r.uri, r.size, r.created) for r in routing.object_info(df).orderBy("uri").collect()]
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == want


def test_routing(spark):
    df = spark.createDataFrame([(None,), (0,), (20 * 1024 * 1024,), (20 * 1024 * 1024 + 1,)], "length bigint")
    assert [r[0] for r in df.select(routing.size_route(F.col("length"))).collect()] == ["direct", "direct", "direct", "chunked"]


def test_done_and_pending(spark):
    listing = spark.createDataFrame([("a",), ("b",), ("c",)], "uri string")
    done = spark.createDataFrame([("b",)] * 50 + [("z",), (None,)], "uri string")
    assert [r.uri for r in routing.already_processed(listing, done).collect()] == ["b"]
    assert sorted(r.uri for r in routing.pending_files(listing, done).collect()) == ["a", "c"]


def test_csv_keeps_every_character(spark, tmp_path):
    values = ['say "hi"', "a,b", "line\nbreak", "cr\r\nlf", " leading", "trailing ", "\ttab", "NULL", "NA", "2024", "back\\slash", '\\"', "한글 😀", "'", '""']
    rows = [tuple([v] * len(METADATA_COLUMNS)) for v in values] + [tuple([None] * 6 + [""] * 6 + ["s"])]
    df = spark.createDataFrame(rows, METADATA_SCHEMA)
    path = str(tmp_path / "csv")
    assert write_metadata_csv(df, path) == path
    files = [p for p in Path(path).iterdir() if p.suffix == ".csv"]
    assert files and all(p.read_bytes().startswith(b"\xef\xbb\xbftype,source,") for p in files)
    back = sorted((tuple(r) for r in read_metadata_csv(spark, path).collect()), key=str)
    assert back == sorted(rows[:-1] + [tuple([None] * 12 + ["s"])], key=str)
    write_metadata_csv(df, path, mode="append")
    assert read_metadata_csv(spark, path).count() == 2 * len(rows)


def test_empty_table_writes_nothing(spark, tmp_path):
    path = tmp_path / "none"
    assert write_metadata_csv(spark.createDataFrame([], METADATA_SCHEMA), str(path)) == ""
    assert not path.exists()


def test_sidecars_of_equal_names(spark, tmp_path):
    docs = spark.createDataFrame([("gs://b/x/a.pdf", "", "one"), ("gs://b/y/a.pdf", "", "two")], "uri string, part string, full_text string")
    path = write_text_sidecar(docs, str(tmp_path / "side"), "run1")
    write_text_sidecar(docs, path, "run1")
    stored = spark.read.parquet(path)
    assert stored.count() == 2
    assert {r.uri: r.full_text for r in stored.collect()} == {"gs://b/x/a.pdf": "one", "gs://b/y/a.pdf": "two"}
    assert routing.pending_files(docs.select("uri"), stored).count() == 0


def test_shard_files(spark, tmp_path):
    (tmp_path / "out").mkdir()
    for n, text in (("0", "zero "), ("10", "ten "), ("2", "two")):
        (tmp_path / "out" / f"a-{n}.json").write_text(json.dumps({"text": text}))
    (tmp_path / "out" / "a.log").write_text("no shard")
    found = read_shards(spark, str(tmp_path / "out")).withColumn("uri", F.lit("gs://b/a.pdf"))
    merged = shards.merge_shards(shards.parse_shards(found), size=F.col("length")).collect()
    assert [r.full_text for r in merged] == ["zero ten two"]


def test_scratch_is_shared_folder(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert one.startswith(base.rstrip("/"))


def test_run_by_rules(spark, tree, tmp_path):
    done = batch.run_batch(spark, str(tree), str(tmp_path / "out"), extraction.plain_text, AT, models=["Aurora", "Cirrus"])
    got = {r.uri.rsplit("/in/", 1)[1]: r for r in done.records.collect()}
    assert sorted(got) == ["a.pdf", "sub/a.pdf", "sub/b.PPTX", "sub/deep/d.Docx"]
    first = got["a.pdf"]
    assert (first.model, first.year1, first.xev, first.file_format, first.updated_at) == ("Aurora", "2020", "Hybrid", "pdf", "2024-01-29")
    assert [(r.status, r.uri[-7:]) for r in done.quarantine.collect()] == [("extractor_error", "bad.pdf")]
    assert done.csv_path.endswith("out/batch_metadata_20240129_143000.csv")
    assert read_metadata_csv(spark, done.csv_path).count() == 4
    assert spark.read.parquet(str(tmp_path / "out" / "parsing")).count() == 4
    assert "Total Documents Processed: 4" in "\n".join(report.report_lines(done.report, "now"))


def test_run_with_labeler_and_shards(spark, tree, tmp_path, monkeypatch):
    monkeypatch.setattr(batch, "DIRECT_LIMIT_BYTES", 25)
    monkeypatch.setattr(batch, "size_route", lambda c: routing.size_route(c, 25))
    large = next(r.uri for r in list_files(spark, str(tree)).collect() if r.file_name == "b.PPTX")
    shard_rows = [(large, "s-0", json.dumps({"text": "shard "})), (large, "s-1", json.dumps({"text": "text"}))]
    shards_df = spark.createDataFrame(shard_rows, "uri string, shard_uri string, content string").withColumn("length", F.length("content"))

    def labeler(request):
        if "other" in request:
            raise ValueError("no")
        return json.dumps({"metadata": {"type": "T"}, "content_summary": "shard" if "shard text" in request else "direct"})

    done = batch.run_batch(spark, str(tree), str(tmp_path / "out"), extraction.plain_text, AT, labeler=labeler, shards=shards_df, partitions=2)
    got = {r.uri.rsplit("/in/", 1)[1]: (r.type, r.content_summary, r.status) for r in done.records.collect()}
    assert got == {"sub/b.PPTX": ("T", "shard", "ok"), "sub/a.pdf": ("UNKNOWN", "", "labeler_error"), "sub/deep/d.Docx": ("T", "direct", "ok")}
    assert {(r.uri[-7:], r.status) for r in done.quarantine.collect()} == {("bad.pdf", "extractor_error"), ("n/a.pdf", "no_shards")}


def test_run_of_one_file(spark, tree, tmp_path):
    (tree / "c.txt.bak").write_text("an older one")
    for _ in range(2):
        done = batch.run_file(spark, str(tree / "c.txt"), str(tmp_path / "out"), extraction.plain_text, AT)
        assert [(r.file_format, r.content_summary) for r in done.records.collect()] == [("string_link", "not supported")]
        assert done.csv_path.endswith("out/c_metadata.csv")
        assert read_metadata_csv(spark, done.csv_path).count() == 1


def test_prefixes_and_stars(spark, tree):
    for path, want in {
        "su": ["sub/a.pdf", "sub/b.PPTX", "sub/deep/d.Docx"], "sub/": ["sub/a.pdf", "sub/b.PPTX", "sub/deep/d.Docx"],
        "sub/a*.docx": ["sub/a.pdf"], "b": ["bad.pdf"], "*.pdf": names(list_files(spark, str(tree))),
    }.items():
        assert names(list_files(spark, below_prefix(f"{tree}/{path}"))) == want, path
    odd = tree / "od{d}[1]?"
    odd.mkdir()
    (odd / "x.pdf").write_text("x")
    assert names(list_files(spark, below_prefix(str(odd)))) == ["od{d}[1]?/x.pdf"]


def test_run_over_a_table_of_contents(spark, tmp_path):
    rows = [("gs://b/_draft.pdf", 9, b"An Aurora"), ("gs://b/.h.pdf", 1, b"h"), ("gs://b/n.txt", 1, b"n"), ("gs://b/o/", 0, b""), ("gs://b/nil.pdf", None, b"nil")]
    table = spark.createDataFrame(rows, "uri string, length bigint, content binary")
    done = batch.run_batch(spark, table, str(tmp_path / "out"), extraction.plain_text, AT, models=["Aurora"])
    assert {r.uri: r.model for r in done.records.collect()} == {"gs://b/_draft.pdf": "Aurora", "gs://b/.h.pdf": "UNKNOWN", "gs://b/nil.pdf": "UNKNOWN"}


def test_run_with_shard_files(spark, tree, tmp_path, monkeypatch):
    monkeypatch.setattr(batch, "DIRECT_LIMIT_BYTES", 25)
    monkeypatch.setattr(batch, "size_route", lambda c: routing.size_route(c, 25))
    for folder, pieces in {"b.PPTX/9/0": ["An Au", "rora"], "other.pdf/9/0": ["other"], "b.PPTX2/1": ["no"]}.items():
        place = tmp_path / "temp_async_output" / "20240129_143000" / folder
        place.mkdir(parents=True)
        for i, piece in enumerate(pieces):
            (place / f"doc-{i}.json").write_text(json.dumps({"text": piece}))
    found = read_shards(spark, str(tmp_path / "temp_async_output"))
    done = batch.run_batch(spark, f"{tree}/sub/b", str(tmp_path / "out"), extraction.plain_text, AT, models=["Aurora"], shards=found)
    assert [(r.uri[-6:], r.model) for r in done.records.collect()] == [("b.PPTX", "Aurora")]
    later = batch.run_batch(spark, f"{tree}/sub/b", str(tmp_path / "late"), extraction.plain_text, datetime(2025, 1, 1), shards=found, shards_at=AT)
    assert later.records.count() == 1 and later.quarantine.isEmpty()
    none = batch.run_batch(spark, f"{tree}/sub/b", str(tmp_path / "none"), extraction.plain_text, datetime(2025, 1, 1), shards=found)
    assert [r.status for r in none.quarantine.collect()] == ["no_shards"]


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())


def test_the_past_is_not_shuffled(spark, tmp_path):
    """A table by URI: what is added is dealt, what is looked up moves, the table stays."""
    name = "by_uri_" + tmp_path.name.replace("-", "_")
    first = spark.range(500).select(F.concat(F.lit("gs://b/"), "id").alias("uri"), F.lit("T").alias("type"))
    write_by_uri(first, name, str(tmp_path / "table"), buckets=4)
    write_by_uri(first.select(F.concat("uri", F.lit("x")).alias("uri"), "type"), name, buckets=4)
    done = spark.table(name)
    assert done.count() == 1000 and len(list((tmp_path / "table").glob("*.parquet"))) == 8
    listing = spark.range(1000).select(F.concat(F.lit("gs://b/"), "id").alias("uri")).repartition(3)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for split, n in ((routing.pending_files, 500), (routing.already_processed, 500)):
            rows = split(listing, done)
            assert len(exchanges(rows)) == 1 and rows.count() == n
        appended = records.append_records(done, first)
        assert appended.count() == 1500 and not exchanges(appended)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql(f"DROP TABLE {name}")
