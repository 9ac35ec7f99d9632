"""Media in time segments."""

from labelmill.operators import media


def test_segments_cover_the_time(spark):
    rows = [("a", 0), ("b", None), ("c", 1), ("d", 1000), ("e", 2500)]
    got = media.time_segments(spark.createDataFrame(rows, "uri string, duration_ms long"), 1000).collect()
    assert sorted(tuple(r) for r in got) == [
        ("c", 0, 1), ("d", 0, 1000), ("e", 0, 1000), ("e", 1000, 2000), ("e", 2000, 2500),
    ]


def test_a_failed_call_costs_its_segment(spark):
    def transcriber(uri, start, end):
        if start == 1000:
            raise RuntimeError("no sound")
        return f"{uri} {start}-{end}"

    cut = media.time_segments(spark.createDataFrame([("e", 2500), ("d", 900)], "uri string, duration_ms long"), 1000)
    heard = media.transcribe(cut.repartition(3), transcriber)
    assert [r.error for r in heard.collect() if r.error] == ["RuntimeError: no sound"]
    got = {r.uri: r for r in media.media_transcripts(heard).collect()}
    assert (got["e"].full_text, got["e"].status) == ("e 0-1000\n\ne 2000-2500", "missing_text")
    assert tuple(got["d"]) == ("d", "", 0, "d 0-900", 1, 900, "ok")


def test_time_left_out_or_repeated(spark):
    rows = [("a", 0, 10, "x"), ("a", 20, 30, "y"), ("b", 5, 9, "x"), ("c", 0, 10, "x"), ("c", 0, 10, "x")]
    got = media.media_transcripts(spark.createDataFrame(rows, "uri string, start_ms long, end_ms long, text string"), 2).collect()
    assert {r.uri: r.status for r in got} == dict.fromkeys("abc", "missing_segment")
    assert ["".join(r.full_text for r in sorted(got) if r.uri == u) for u in "abc"] == ["x\ny", "x", "x\nx"]
