"""Answers and stored records against the json module."""

import json

from labelmill.operators import labelling, records, routing
from labelmill.schema import LABEL_FIELDS, METADATA_COLUMNS

DEFAULTS = dict.fromkeys(["type", "source", "region", "country", "model", "language"], "UNKNOWN")
DEFAULTS |= dict.fromkeys(["xev", "year1", "year2"])
DEFAULTS |= {"version": "v1.0.0", "updated_at": "2024-01-29"}

ANSWERS = [
    '{"metadata":{"type":"T","xev":null,"year1":2024},"content_summary":"S"}',
    '```json\n{"metadata":{"type":"T"}}\n```',
    '```{"metadata":{}}```',
    '{"metadata":{"type":"T"}} and more',
    '{"metadata":{"type":"a","type":"b"},"metadata":{"source":"c"}}',
    '{"type":"flat","content_summary":"S"}',
    '{"metadata":null,"content_summary":"S"}',
    '{"metadata":[],"content_summary":"S"}',
    '{"metadata":"text"}',
    '[{"metadata":{}}]',
    '"text"',
    "12",
    "null",
    "true",
    "",
    "   ",
    None,
    "{",
    '{"metadata":{"type":"T"}',
    "{'metadata':{}}",
    '{"metadata":{},}',
    '{"a":1}{"b":2}',
    '{"a":1},{"b":2}',
    '{"metadata":{"type":"T"}}],[{}',
    '{"metadata":{"file_format":null,"version":"","content_summary":"inner"},"content_summary":null}',
    '{"metadata":{"content_summary":"inner"}}',
    '{"metadata":{"type":"줄\\n바꿈 \\ud83d\\ude00 \\"q\\""}}',
    '{"metadata":{"type":"T\nU"}}',
    ' {"metadata" : {"type" : "T"} } ',
    '{"metadata":{"TYPE":"T","Type":"U"}}',
    '{"metadata":{"type":"T"}, // note\n"content_summary":"S"}',
    '{"metadata":{"updated_at":"x","file_format":"web","language":"ko-KR"}}',
]


# The fenced answers without their fences.
INSIDE = {
    '```json\n{"metadata":{"type":"T"}}\n```': '{"metadata":{"type":"T"}}',
    '```{"metadata":{}}```': '{"metadata":{}}',
}


def as_text(value):
    return value if value is None or isinstance(value, str) else json.dumps(value)


def expected_record(answer, file_format):
    rejected = {**DEFAULTS, "file_format": "UNKNOWN", "content_summary": ""}
    if answer is None:
        return rejected
    try:
        body = json.loads(INSIDE.get(answer, answer))
    except ValueError:
        return rejected
    labels = body.get("metadata", {}) if isinstance(body, dict) else None
    if not isinstance(labels, dict):
        return rejected
    absent = {**DEFAULTS, "file_format": file_format}
    record = {c: as_text(labels.get(c, absent[c])) for c in LABEL_FIELDS}
    return {**record, "content_summary": as_text(body.get("content_summary", ""))}


def test_answers_follow_json(spark):
    rows = [(str(i), "pdf", a) for i, a in enumerate(ANSWERS)]
    df = spark.createDataFrame(rows, "uri string, file_format string, response string")
    parsed = labelling.parse_responses(df, "2024-01-29")
    got = {int(r.uri): r for r in parsed.collect()}
    for i, answer in enumerate(ANSWERS):
        assert {c: got[i][c] for c in METADATA_COLUMNS} == expected_record(answer, "pdf"), answer
    good, bad = routing.split_quarantine(parsed)
    assert good.count() + bad.count() == len(ANSWERS)
    counts = {r.status: r.n for r in routing.status_counts(parsed).collect()}
    assert sum(counts.values()) == len(ANSWERS)
    assert counts["metadata_not_an_object"] == 3 and counts["not_an_object"] == 5


def test_records_nested_or_flat(spark):
    stored = [
        '{"metadata":{"type":"T","xev":null},"content_summary":"S","source":"not used"}',
        '{"type":"T","year1":"2020","content_summary":null}',
        '{"metadata":{}}',
        "{}",
        '{"metadata":null,"type":"T"}',
        "no json",
    ]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stored)], "i int, record string")
    got = {r.i: r for r in records.flatten_records(df).collect()}
    for i, s in enumerate(stored[:4]):
        item = json.loads(s)
        source = item.get("metadata", item)
        want = {c: source.get(c, "") for c in LABEL_FIELDS} | {"content_summary": item.get("content_summary", "")}
        assert {c: got[i][c] for c in METADATA_COLUMNS} == want and got[i].status == "ok"
    assert [got[i].status for i in (4, 5)] == ["metadata_not_an_object", "not_a_record"]
    assert all(got[i][c] is None for i in (4, 5) for c in METADATA_COLUMNS)


def test_append(spark):
    old = spark.createDataFrame([("a", "NULL"), ("b", "2024")], "type string, year1 string")
    new = spark.createDataFrame([("FAQ", "c")], "source string, type string")
    got = records.append_records(old, new)
    assert sorted(tuple(r) for r in got.select("type", "year1", "source").collect()) == [("a", "NULL", None), ("b", "2024", None), ("c", None, "FAQ")]
    assert records.append_records(None, new) is new
