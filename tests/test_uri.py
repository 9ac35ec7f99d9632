from datetime import datetime

from pyspark.sql import functions as F

from labelmill.functions import uri as U


def table(spark, rows, schema):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}").orderBy("i")


def results(df, *columns):
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_split(spark):
    df = table(spark, [("gs://b",), ("gs://b/",), ("gs://b/a/c.pdf",), ("gs://b//x",), ("http://x",), ("",), (None,), ("GS://b/c",)], "u string")
    u = F.col("u")
    assert results(df, U.bucket(u), U.key(u), U.uri_status(u)) == [
        ("b", "", "ok"), ("b", "", "ok"), ("b", "a/c.pdf", "ok"), ("b", "/x", "ok"),
        (None, None, "invalid_uri"), (None, None, "invalid_uri"), (None, None, "invalid_uri"), (None, None, "invalid_uri"),
    ]


def test_names_and_types(spark):
    df = table(spark, [("gs://b/a.PPTX",), ("gs://b/a.pptx",), ("gs://b/a.tar.gz",), ("gs://b/noext",), ("gs://b/a.",), ("gs://b/x.docx",), ("",), (None,), ("gs://b/d/",), ("gs://b/A.Htm",), ("gs://b.pdf/noext",)], "u string")
    name = U.file_name(F.col("u"))
    office = "application/vnd.openxmlformats-officedocument"
    assert results(df, name, U.file_format(name), U.file_format(name, F.lit("video")), U.is_supported(F.col("u"))) == [
        ("a.PPTX", "ppt", "video", True), ("a.pptx", "ppt", "video", True), ("a.tar.gz", "unknown", "video", False),
        ("noext", "unknown", "video", False), ("a.", "unknown", "video", False), ("x.docx", "doc", "video", True),
        ("unknown", "unknown", "video", False), ("unknown", "unknown", "video", None), ("", "unknown", "video", False),
        ("A.Htm", "html", "video", False), ("noext", "unknown", "video", False),
    ]
    kinds = [r[0] for r in results(df, U.mime_type(F.col("u")))]
    assert kinds[0] == "application/pdf" and kinds[1] == f"{office}.presentationml.presentation"
    assert kinds[5] == f"{office}.wordprocessingml.document" and set(kinds[6:]) == {"application/pdf"}


def test_document_id(spark):
    df = table(spark, [("My Doc.v2.pdf",), ("가나-é_1!?.x",), (".hidden",), ("áb",), ("①½",)], "n string")
    at = F.lit("2024-01-29 14:30:05").cast("timestamp_ntz")
    assert [r[0] for r in results(df, U.document_id(F.col("n"), at))] == [
        "My_Doc_20240129143005", "가나-é_1___20240129143005", "_20240129143005", "a_b_20240129143005", "①½_20240129143005",
    ]


def test_resolve_input(spark):
    df = table(spark, [
        ("b", "p/", "gs://f/x", "gs://c/*"), ("b", None, None, None), ("", "p", "gs://f/x", "gs://c/*"),
        (None, None, "", "gs://c/d/*.pdf"), (None, None, None, "gs://c/d.pdf"), (None, None, None, None), (None, None, None, "gs://c/a*b*c"),
    ], "b string, p string, f string, x string")
    assert [r[0] for r in results(df, U.resolve_input(*map(F.col, "bpfx")))] == [
        "gs://b/p/", "gs://b/", "gs://f/x", "gs://c/d/", None, None, "gs://c/a",
    ]


def test_output_names(spark):
    df = table(spark, [("gs://b/d/a.v1.pdf",), ("gs://b/noext",), ("gs://b/.pdf",)], "u string")
    u, at = F.col("u"), F.lit(datetime(2024, 1, 29, 14, 30)).cast("timestamp")
    assert results(df, U.document_csv_path(F.lit("out//"), u), U.sidecar_path(F.lit("out"), U.file_name(u))) == [
        ("out/a.v1_metadata.csv", "out/parsing/a.v1.pdf.txt"),
        ("out/noext_metadata.csv", "out/parsing/noext.txt"),
        ("out/_metadata.csv", "out/parsing/.pdf.txt"),
    ]
    one = df.limit(1)
    assert results(one, U.csv_path(F.lit("o/"), F.lit("x.csv")), U.csv_path(F.lit("o"), F.lit("x")), U.batch_csv_path(F.lit("o"), at), U.video_csv_path(F.lit("o"), F.lit("v1"), at), U.chunk_prefix(F.lit("ob"), u, at)) == [
        ("o/x.csv", "o/x.csv", "o/batch_metadata_20240129_143000.csv", "o/video_v1_20240129_143000_metadata.csv", "gs://ob/temp_async_output/20240129_143000/a.v1.pdf/"),
    ]
