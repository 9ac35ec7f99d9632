import json
from collections import Counter

import pytest

from labelmill.functions import rules as R
from labelmill.operators import assemble, extraction, labelling, recognition, records
from labelmill.schema import METADATA_COLUMNS
from pyspark.sql import functions as F

DOC = "uri string, part string, full_text string"


def test_labeler_errors_stay_in_their_row(spark):
    docs = spark.createDataFrame([("gs://b/a.pdf", "", "fine"), ("gs://b/b.pdf", "", "boom"), ("gs://b/c.html", "", "none"), ("gs://b/d", "", None)], DOC)

    def labeler(request):
        if "boom" in request:
            raise RuntimeError("service down")
        if "none" in request:
            return None
        return json.dumps({"metadata": {"type": "T"}, "content_summary": request[:3]})

    for partitions in (None, 4):
        got = {r.uri: r for r in labelling.label_documents(docs, labeler, "2024-01-29", partitions=partitions).collect()}
        assert got["gs://b/a.pdf"].type == "T" and got["gs://b/a.pdf"].file_format == "pdf"
        assert got["gs://b/b.pdf"].error == "RuntimeError: service down"
        assert (got["gs://b/b.pdf"].status, got["gs://b/b.pdf"].file_format) == ("labeler_error", "UNKNOWN")
        assert got["gs://b/c.html"].error == "TypeError: labeler returned NoneType"
        assert got["gs://b/d"].status == "ok" and got["gs://b/d"].file_format == "unknown"


def test_a_request_is_sent_once_whatever_is_asked_of_its_answer(spark):
    docs = spark.createDataFrame([(f"gs://b/{i}.pdf", "", f"text {i}") for i in range(300)], DOC).repartition(3)
    calls = spark.sparkContext.accumulator(0)

    class Answer(str):
        pass

    def labeler(request):
        calls.add(1)
        if "text 7" in request:
            raise RuntimeError("down")
        return Answer(json.dumps({"metadata": {"type": "T"}, "content_summary": request[-9:]}))

    got = labelling.label_documents(docs, labeler, "2024-01-29").filter("status = 'ok' AND type = 'T'")
    assert got.select("uri", "content_summary", "error").distinct().count() == 289 and calls.value == 300


def test_answers_are_kept(spark, tmp_path):
    """A labeler is called once for equal requests, not at all on a rerun, again where it failed."""
    rows = [(f"gs://b/{i}.pdf", "", f"text {i % 4}") for i in range(40)] + [("gs://b/x.pdf", "", "boom"), ("gs://b/y.pdf", "", None)]
    docs = spark.createDataFrame(rows, DOC).repartition(5)
    calls = spark.sparkContext.accumulator(0)

    def labeler(request, broken=True):
        calls.add(1)
        if broken and "boom" in request:
            raise RuntimeError("down")
        return json.dumps({"metadata": {"type": "T"}, "content_summary": request[-40:]})

    store, found = str(tmp_path / "answers"), []
    for run, ask in enumerate([labeler, labeler, lambda r: labeler(r, False)]):
        found.append(sorted(map(tuple, labelling.label_documents(docs, ask, "2024-01-29", store=store).collect()), key=str))
        assert calls.value == [6, 7, 8][run]
    plain = labelling.label_documents(docs, lambda r: labeler(r, False), "2024-01-29")
    assert found[2] == sorted(map(tuple, plain.collect()), key=str)
    assert found[0] == found[1] and sum(r[-1] is not None for r in found[0]) == 1
    calls.value = 0
    new = docs.union(spark.createDataFrame([("gs://b/new.pdf", "", "new")], DOC))
    assert labelling.label_documents(new, labeler, "2024-01-29", store=store).count() == 43 and calls.value == 1
    assert spark.read.parquet(store).count() == spark.read.parquet(store).select("digest").distinct().count() == 7


def test_request_of_a_document_in_parts(spark):
    parts = [f"{i:04d} " * 3 for i in range(2000)]
    rows = [("gs://b/hot.pdf", f"p{i:05d}", t) for i, t in enumerate(parts)]
    rows += [("gs://b/x.pdf", "", "whole"), ("gs://b/e.pdf", "p1", ""), ("gs://b/e.pdf", "p2", None)]
    got = {r.uri: r.request for r in labelling.label_requests(spark.createDataFrame(rows, DOC)).collect()}
    assert "".join(parts)[:10_000] in got["gs://b/hot.pdf"]
    assert len(got) == 3 and "whole" in got["gs://b/x.pdf"]
    assert len(got["gs://b/hot.pdf"]) - 10_000 == len(got["gs://b/e.pdf"])


def test_rule_labels_of_parts_equal_those_of_the_whole(spark):
    para = "A paragraph that is long enough to be taken for a summary."
    texts = {
        "gs://b/1.pdf": ["nothing here 2020\n", f"{para}\nThe Cirrus hybrid\n", "Aurora 1999 plug-in hybrid 2031\n"],
        "gs://b/2.pptx": [" \n", "  short\n", "\n", "lines \n", " "],
        "gs://b/3.pdf": ["w " * 20 + "\n"] * 30,
    }
    whole = spark.createDataFrame([(u, "", "".join(p)) for u, p in texts.items()], DOC)
    parted = spark.createDataFrame([(u, f"p{i}", t) for u, p in texts.items() for i, t in enumerate(p)], DOC)
    one = {r.uri: r for r in labelling.rule_labels(whole, ["Aurora", "Cirrus"], "2024-01-29").collect()}
    many = {r.uri: r for r in labelling.rule_labels(parted, ["Aurora", "Cirrus"], "2024-01-29").collect()}
    first = one["gs://b/1.pdf"]
    assert first == many["gs://b/1.pdf"]
    assert (first.model, first.xev, first.year1, first.year2, first.content_summary) == ("Cirrus", "Plugin-Hybrid", "1999", "2031", para)
    assert (first.type, first.version, first.file_format) == ("UNKNOWN", "v1.0.0", "pdf")
    second = many["gs://b/2.pptx"]
    assert second == one["gs://b/2.pptx"]
    assert (second.model, second.year1, second.content_summary) == ("UNKNOWN", None, "short\n\nlines")
    assert many["gs://b/3.pdf"] == one["gs://b/3.pdf"]
    assert whole.columns == ["uri", "part", "full_text"] and list(first.asDict()) == ["uri", *METADATA_COLUMNS]


def cut(text, size):
    return [text[i : i + size] for i in range(0, len(text), size)]


@pytest.mark.parametrize("size", [3, 7, 41])
def test_words_and_lines_run_across_parts(spark, size):
    para = "A paragraph that is long enough to be taken for a summary of it."
    texts = {
        "gs://b/1.pdf": f"x\n\r\nAuro rapid, Cirrus1\r\nThe Aurora plug-in hybrid of 2024.\n{para}\n19991\n1987",
        "gs://b/2.pdf": "Cirrus",
        "gs://b/3.pdf": "\n\nhybrids 20245\r" + "short\n" * 50,
    }
    whole = spark.createDataFrame([(u, "", t) for u, t in texts.items()], DOC)
    pieces = [(u, f"p{i:03d}", t) for u, text in texts.items() for i, t in enumerate(cut(text, size))]
    parted = spark.createDataFrame(pieces, DOC)
    want = sorted(labelling.rule_labels(whole, ["Aurora", "Cirrus"], "2024-01-29").collect())
    assert sorted(labelling.rule_labels(parted, ["Aurora", "Cirrus"], "2024-01-29").collect()) == want
    first = want[0]
    assert (first.model, first.xev, first.year1, first.year2, first.content_summary) == ("Aurora", "Plugin-Hybrid", "1987", "2024", para)


def test_rule_labels_by_a_dictionary(spark):
    """A table of names gives the labels that the list gives, in one part and in several."""
    names = ["Aurora", "Aurora GT", "Cirrus"]
    table = recognition.dictionary(spark.createDataFrame([(n,) for n in names], "name string"))
    texts = {"gs://b/1.pdf": "the aurora\ngt and Cirrus 2024", "gs://b/2.pdf": "AURORA gt", "gs://b/3.pdf": "none", "gs://b/4.pdf": ""}
    whole = spark.createDataFrame([*[(u, "", t) for u, t in texts.items()], ("gs://b/1.pdf", "", "Cirrus")], DOC)
    parted = spark.createDataFrame([(u, f"p{i:03d}", t) for u, text in texts.items() for i, t in enumerate(cut(text, 4) or [""])], DOC)
    for docs in (whole, parted):
        want = sorted(labelling.rule_labels(docs, names, "2024-01-29").collect(), key=str)
        assert sorted(labelling.rule_labels(docs, table, "2024-01-29").collect(), key=str) == want


@pytest.mark.parametrize("chars", [5, 37, 400])
def test_earlier_projection_of_parts(spark, chars):
    """What pieces say is merged to what the whole text would say."""
    para = "A paragraph that is long enough to be the summary of a document."
    texts = {
        "gs://b/1.v2.pdf": f"the cat cat dog\nA sedan\n  hybrid SUV costs 3,000만원 or $5\n{para}\nAurora GT Cirrus electric dog dog\n" + "w1 w2 w3\n" * 40,
        "gs://b/2.pptx": " \n short\nlines only \n\n$ 7.5 and Cirrus", "gs://b/3.pdf": "", "gs://b/4.pdf": "one " * 30, "gs://b/5.pdf": "\n\n \n",
    }
    rows = [(u, t, i, f"2024-01-{i + 1:02}") for i, (u, t) in enumerate(texts.items())]
    whole = spark.createDataFrame(rows, "uri string, full_text string, page_count int, day string")
    parted = assemble.cut_rows(whole, "full_text", chars)
    names, at = ["Aurora", "Aurora GT", "Cirrus"], F.to_timestamp("day")
    want = records.earlier_projection(whole, names, at).orderBy("gcs_uri").collect()
    assert parted.count() > whole.count()
    assert records.earlier_projection(parted, names, at).orderBy("gcs_uri").collect() == want
    assert (want[0].car_model, want[0].car_type, want[0].engine_type, want[0].price, want[0].summary) == ("Aurora GT", "SUV", "Electric", "3,000만원", para)


def test_whole_lines_keep_every_character(spark):
    texts = {"a": ["on", "e\ntw", "o\r", "\nthree", "", " four"], "b": ["", ""], "c": ["\n", "\n"], "d": ["x" * 9, "y" * 9]}
    rows = [(u, f"p{i}", t) for u, parts in texts.items() for i, t in enumerate(parts)]
    df = spark.createDataFrame(rows, DOC)
    for limit in (1, 10, 1000):
        got = {}
        for r in assemble.whole_lines(df, "uri", "part", "full_text", limit).orderBy("uri", "part").collect():
            got.setdefault(r.uri, []).append(r.full_text)
        assert {u: "".join(t) for u, t in got.items()} == {u: "".join(t) for u, t in texts.items()}
        if limit == 1000:
            assert got["a"] == ["one\n", "two\r", "\n", "three four"] and got["d"] == ["x" * 9 + "y" * 9]
        if limit == 10:
            assert got["d"] == texts["d"]


def test_repeated_documents_in_parts_stay_apart(spark):
    rows = [("u", "p0", "ab 20"), ("u", "p1", "24 cd"), ("u", "p0", "ab 20"), ("u", "p1", "24 cd"), ("v", "", "whole")]
    df = spark.createDataFrame(rows, DOC)
    asked = [r.request for r in labelling.label_requests(df).collect() if r.uri == "u"]
    assert len(asked) == 2 and all("\nab 2024 cd\n" in r for r in asked)
    labels = [r for r in labelling.rule_labels(df, ["X"], "2024-01-29").collect() if r.uri == "u"]
    assert [(r.year1, r.content_summary) for r in labels] == [("2024", "ab 2024 cd")] * 2


def test_extractor_errors_stay_in_their_row(spark):
    files = spark.createDataFrame([("a.txt", "page one\fpage é".encode()), ("b.txt", b"\xff\xfe"), ("c.txt", b"")], "uri string, content binary")
    got = {r.uri: r for r in extraction.extract_documents(files, extraction.plain_text).collect()}
    assert [(p.page_number, p.text) for p in got["a.txt"].pages] == [(1, "page one"), (2, "page é")]
    assert got["b.txt"].status == "extractor_error" and "UnicodeDecodeError" in got["b.txt"].error
    assert (got["b.txt"].full_text, got["c.txt"].full_text, got["c.txt"].status) == (None, "", "ok")


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[1] for r in df.select("i", expression(F.col("t"))).orderBy("i").collect()]


def test_prices_are_decimal_and_linear(spark):
    texts = ["2,999.99만원", "1" * 1_000_000 + " 만 " + "2" * 1_000_000, ",5만원 1.2.3만원 1,,5만원", "9" * 40 + "만원"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: [p.amount for p in r.p] for r in df.select("i", R.prices(F.col("t")).alias("p")).collect()}
    assert got == {0: [29_999_900.0], 1: [], 2: [50_000.0, 23_000.0, 150_000.0], 3: [pytest.approx(1e44)]}


def test_long_paragraph_of_a_later_part_wins(spark):
    parts = [("u", "0", "short line\n" * 40), ("u", "1", "A real paragraph that is long enough to be the summary of it.")]
    df = spark.createDataFrame(parts, "uri string, part string, full_text string")
    (row,) = labelling.rule_labels(df, ["X"], "2024-01-29").collect()
    assert row.content_summary.startswith("A real paragraph")


def test_prices(spark):
    texts = ["3,000만원", "1,200만 원 or $30,000", "$5.50, $ 7 and 2.5만원", "$", "만원", "30,000원"]
    got = column(spark, texts, R.prices)
    assert [[(p.currency, p.amount) for p in ps] for ps in got] == [
        [("KRW", 30_000_000.0)], [("KRW", 12_000_000.0), ("USD", 30_000.0)],
        [("KRW", 25_000.0), ("USD", 5.5), ("USD", 7.0)], [], [], [],
    ]
    assert column(spark, texts, R.price_text) == ["3,000만원", "1,200만 원", "$5.50", None, None, None]


def test_models_and_types(spark):
    texts = ["the NIMBUS gt and Cirrus", "nimbus gtx", "cirrusX Cirrus", "", "cirrus한 nimbus"]
    assert column(spark, texts, lambda t: R.model_name(t, ["Nimbus", "Nimbus GT", "Cirrus"])) == ["Nimbus GT", "Nimbus", "Cirrus", "UNKNOWN", "Nimbus"]
    assert column(spark, texts[:1], lambda t: R.model_name(t, [])) == ["UNKNOWN"]
    kinds = ["sedan, then suv", "Sedan", "SUVs", "hybrid or electric", "Hybrid"]
    assert column(spark, kinds, R.car_type) == ["SUV", "Sedan", "UNKNOWN", "UNKNOWN", "UNKNOWN"]
    assert column(spark, kinds, R.engine_type) == ["UNKNOWN"] * 3 + ["Electric", "Hybrid"]


def test_years(spark):
    texts = ["1999-2004, 20245, 1899 2099", "a2010b", "", "12020"]
    assert column(spark, texts, R.model_years) == [["1999", "2004", "2099"], ["2010"], [], []]


def test_keywords_follow_a_counter(spark):
    texts = ["the Cat, the cat; a DOG dog dog é é éé", "", "the of", "b a c bb bb aa aa cc x1 x1 x1", "한국 한국 자동차", " ".join(f"w{i % 37}" for i in range(900))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    import regex

    want = {}
    for i, t in enumerate(texts):
        words = [w for w in regex.split(r"[^\p{L}\p{N}]+", t.lower()) if len(w) >= 2 and w not in R.STOP_WORDS]
        ranked = sorted(Counter(words).items(), key=lambda p: (-p[1], p[0]))[:10]
        want |= {(i, k): p for k, p in enumerate(ranked, start=1)}
    for fn in (records.keyword_topk, records.keyword_topk_of_parts):
        assert {(r.i, r["rank"]): (r.word, r.n) for r in fn(df, "i", "t").collect()} == want
    halves = spark.createDataFrame([(0, "cat cat dog"), (0, "dog dog"), (1, "x1")], "i int, t string")
    got = records.keyword_topk_of_parts(halves, "i", "t", 1).orderBy("i").collect()
    assert [(r.i, r.word, r.n) for r in got] == [(0, "dog", 3), (1, "x1", 1)]
