from collections import Counter

import pytest

from labelmill.operators import quality, report, skew
from labelmill.schema import METADATA_COLUMNS, METADATA_SCHEMA


def records(spark, rows):
    full = [{**dict.fromkeys(METADATA_COLUMNS, "x"), **r} for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in METADATA_COLUMNS) for r in full], METADATA_SCHEMA)


ROWS = (
    [{"model": f"m{i:02d}", "type": None, "xev": None} for i in range(15)]
    + [{"model": "m03", "type": "", "xev": ""}, {"model": "m14", "type": "a", "xev": "Hybrid"}]
    + [{"model": None, "type": "a", "xev": None}]
)


def test_counts(spark):
    df = records(spark, ROWS)
    got = report.distribution_report(df).collect()
    by = lambda d: {(r.value, r.label): r.n for r in got if r.dimension == d}
    assert by("total") == {(None, None): 18}
    assert by("type") == {("", ""): 1, ("a", "a"): 2}
    no = "NULL (Non-Hybrid)"
    assert by("xev") == {(None, no): 16, ("", no): 1, ("Hybrid", "Hybrid"): 1}
    models = [f"m{i:02d}" for i in (3, 14, 0, 1, 2, 4, 5, 6, 7, 8)]
    assert list(by("model")) and {v for v, _ in by("model")} == set(models)
    assert [r.model for r in report.top_models(df).collect()] == models
    assert [(r.xev, r.n) for r in report.xev_distribution(df).collect()] == [(None, 16), ("", 1), ("Hybrid", 1)]
    for d in ("source", "region", "language", "file_format"):
        assert by(d) == {("x", "x"): 18}
    kinds = Counter(r["type"] for r in ROWS)
    assert sum(by("type").values()) + kinds[None] == report.report_totals(df).head().n


def test_lines(spark):
    df = records(spark, ROWS)
    text = "\n".join(report.report_lines(report.distribution_report(df), "2024-01-29 14:30:00"))
    rule = "=" * 60
    assert text.startswith(f"{rule}\nMETADATA GENERATION REPORT\n{rule}\n\nTotal Documents Processed: 18\nGeneration Date: 2024-01-29 14:30:00\n\n\nDocument Type Distribution:\n  - a: 2\n  - : 1\n\n\nSource Distribution:\n  - x: 18\n")
    assert "Car Model Distribution:\n  - m03: 2\n  - m14: 2\n  - m00: 1\n" in text
    assert "XEV Type Distribution:\n  - NULL (Non-Hybrid): 16\n  - NULL (Non-Hybrid): 1\n  - Hybrid: 1\n" in text
    assert text.endswith(f"  - x: 18\n\n{rule}")
    empty = report.distribution_report(df.limit(0))
    assert list(report.report_lines(empty, "now")) == ["No data available for report"]


def test_missing_sections_are_left_out(spark):
    got = report.distribution_report(records(spark, ROWS).select("type", "model")).collect()
    assert {r.dimension for r in got} == {"total", "type", "model"}


def test_earlier_report(spark):
    df = spark.createDataFrame([("EX", "document", 20), ("EX", "video", None), (None, "document", 25)], "car_model string, source_type string, page_count bigint")
    got = {(r.dimension, r.value): (r.n, r.mean_pages) for r in report.earlier_report(df).collect()}
    assert got == {("total", None): (3, 22.5), ("car_model", "EX"): (2, None), ("source_type", "document"): (2, None), ("source_type", "video"): (1, None)}


    lines = list(report.report_lines(report.earlier_report(df), "now"))
    assert lines[1:] == [
        "METADATA GENERATION REPORT", "=" * 60, "\nTotal Documents Processed: 3", "Generation Date: now",
        "\n\nCar Model Distribution:", "  - EX: 2", "\n\nSource Type Distribution:", "  - document: 2", "  - video: 1",
        "\n\nAverage Page Count: 22.50", "\n" + "=" * 60,
    ]


@pytest.mark.parametrize("broadcast_keys", [10_000, 0])
def test_countries_when_nearly_all_are_unknown(spark, monkeypatch, broadcast_keys):
    monkeypatch.setattr(skew, "_BROADCAST_KEYS", broadcast_keys)
    rows = [{**GOOD, "country": "UNKNOWN", "updated_at": "2024-01-01"}] * 990 + [{**GOOD, "country": c} for c in ("Korea", "Atlantis", None)]
    countries = spark.createDataFrame([("Korea", "A1(KOREA)"), ("Korea", "again"), (None, "x")], "country string, region string")
    got = quality.domain_violations(records(spark, rows), "updated_at", countries).collect()
    assert sorted((r["column"], str(r.value)) for r in got) == [("country", "Atlantis"), ("country", "None")]


GOOD = {
    "type": "기술정보", "source": "FAQ", "region": "A1(KOREA)", "country": "Korea", "model": "QX7 PE (The Name)", "xev": None,
    "year1": "2024", "year2": None, "language": "ko-KR", "version": "v1.2.3", "updated_at": "2024-02-29", "file_format": "pdf", "content_summary": "s",
}


def test_violations(spark):
    bad = {
        "type": "x", "source": None, "region": "A9", "country": "Atlantis", "model": "qx7", "xev": "Diesel", "year1": "24", "year2": "20244",
        "language": "korean", "version": "1.0.0", "updated_at": "2023-02-29", "file_format": "PDF", "content_summary": "s" * 1001,
    }
    placeholders = {**GOOD, **dict.fromkeys(["type", "source", "region", "country", "model", "language"], "UNKNOWN"), "country": "COMMON"}
    df = records(spark, [GOOD, bad, placeholders])
    countries = spark.createDataFrame([("Korea", "A1(KOREA)"), ("US", "B1(NORTH AMERICA)")], "country string, region string")
    got = quality.domain_violations(df, "updated_at", countries).collect()
    assert {r["column"]: r.value for r in got} == bad and len(got) == len(bad)
    assert all(r.updated_at == "2023-02-29" for r in got)
    assert not any(r["column"] == "country" for r in quality.domain_violations(df, "updated_at").collect())


def test_regions_and_countries(spark):
    pairs = [("A1(KOREA)", "Korea"), ("A1(KOREA)", "US"), ("UNKNOWN", "US"), ("A3(CHINA)", "COMMON"), ("A3(CHINA)", "Atlantis"), (None, "US"), ("A3(CHINA)", None)]
    df = records(spark, [{"region": r, "country": c, "type": str(i)} for i, (r, c) in enumerate(pairs)])
    countries = spark.createDataFrame([("Korea", "A1(KOREA)"), ("US", "B1(NORTH AMERICA)")], "country string, region string")
    got = quality.region_country_check(df, countries, "type").orderBy("type").collect()
    assert [(r.type, r.expected_region) for r in got] == [("1", "B1(NORTH AMERICA)"), ("4", None)]


def test_accuracy(spark):
    made = spark.createDataFrame([(i, "a" if i else "b", None) for i in range(10)], "uri int, type string, xev string")
    seen = spark.createDataFrame([(i, "a", None if i < 5 else "Hybrid") for i in range(12)], "uri int, type string, xev string")
    got = {r["column"]: tuple(r)[1:] for r in quality.label_accuracy(made, seen, ["type", "xev"]).collect()}
    assert got == {"type": (10, 9, 0.9, True), "xev": (10, 5, 0.5, False)}
    none = quality.label_accuracy(made.limit(0), seen, ["type"]).collect()
    assert [tuple(r) for r in none] == [("type", 0, 0, None, False)]
