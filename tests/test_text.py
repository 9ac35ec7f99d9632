"""Text functions against plain Python."""

import random
import re

from pyspark.sql import functions as F

from labelmill.functions import text as X

BLANKS = [" ", "\t", "\n", "\r", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", " ", " ", " ", " ", "　"]


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    rows = df.select("i", expression(F.col("t")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


def random_texts(n=300):
    rng = random.Random(7)
    letters = BLANKS + list("abc é한😀​﻿")
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 12))) for _ in range(n)]


def test_strip_and_clean_follow_python(spark):
    texts = random_texts() + ["", " ", "a", "".join(BLANKS) + "x y" + "".join(BLANKS)]
    assert column(spark, texts, X.strip) == [t.strip() for t in texts]
    assert column(spark, texts, X.clean_text) == [re.sub(r"\s+", " ", t).strip() for t in texts]


def test_strip_fences_step_by_step(spark):
    wanted = {
        '{}': '{}',
        '```json\n{}\n```': '{}',
        '```\n{}```': '{}',
        '  ```json{}``` \n': '{}',
        '```json```{}```': '{}',
        '``````json{}': '```json{}',
        '```': '',
        '``````': '',
        '```json': '',
        '': '',
        '{}\n```\n': '{}',
        '\u3000```json {} ```\x1c': '{}',
        '```JSON\n{}```': 'JSON\n{}',
        'a```b```': 'a```b',
        '```json\n```json\n{}\n``````': '```json\n{}\n```',
    }
    assert column(spark, list(wanted), X.strip_fences) == list(wanted.values())


def test_request_keeps_whole_characters(spark):
    texts = ["é" * 10_001, "😀" * 10_000 + "x", "short", ""]
    assert column(spark, texts, X.request_text) == [t[:10_000] for t in texts]
    (request,) = column(spark, ["T" * 10_005], lambda t: X.label_request(F.lit("pdf"), t))
    assert request == (
        "다음 문서를 분석하여 메타데이터를 추출해주세요.\n\n파일 형식: pdf\n\n문서 내용:\n"
        + "T" * 10_000
        + "\n\n위 문서를 분석하여 JSON 형식으로 메타데이터를 반환해주세요."
    )


def test_summary(spark):
    long = "x" * 49 + "y"
    texts = [f"head\n\n  {long}  \r\n{long}z", "a" * 60 + "\n" + "b" * 70, "short\nlines", "ab" * 10 + "\n" + "c" * 40 + "\n", "z" * 1500, "", "k\n" * 300]
    want = [long, "a" * 60, "short\nlines", "ab" * 10 + "\n" + "c" * 40, "z" * 1000, "", ("k\n" * 300)[:200]]
    assert column(spark, texts, X.summary_paragraph) == want
