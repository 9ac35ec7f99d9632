"""The registered queries of this package and the SQL that says the same."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from labelmill.llm import (
    decontam,
    exactdedup,
    lm,
    mixing,
    packing,
    periodic,
    pii,
    quality,
    sharding,
    simhash,
    toxicity,
    warc,
    whitening,
)
from labelmill.llm.common import LOWER, UPPER, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    """A file of a public tokenizer, where it is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_pii(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


@query
def op3_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query
def op4_decontamination(spark, sf_dir):
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_lm_scoring(spark, sf_dir):
    return lm.backoff_scores(table(spark, sf_dir, "documents"))


@query
def op6_source_mixing(spark, sf_dir):
    return mixing.mixed(table(spark, sf_dir, "documents"))


@query
def op7_warc(spark, sf_dir):
    return warc.archived_pages(table(spark, sf_dir, "pages"))


@query
def op8_quality_classifier(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_exact_dedup(spark, sf_dir):
    return exactdedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_embedding_whitening(spark, sf_dir):
    return whitening.whitened_vectors(table(spark, sf_dir, "embeddings"))


@query
def op12_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query
def op13_periodic_runs(spark, sf_dir):
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), repeat=True)


ORACLES["op10_exact_dedup"] = f"""
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(norm) AS text_sha256,
       min(doc_id) OVER same AS first_id
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents)
WINDOW same AS (PARTITION BY norm)
"""


ORACLES["op5_lm_scoring"] = f"""
WITH spoken AS (
    SELECT doc_id, string_split_regex(
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[ \\t\\n\\x0B\\f\\r]+') AS words
    FROM documents
),
part AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS j FROM spoken),
token AS (
    SELECT doc_id, w, row_number() OVER (PARTITION BY doc_id ORDER BY j) AS i
    FROM part WHERE w <> ''
),
gram AS (
    SELECT doc_id, i, w, lag(w) OVER inside AS v, lag(w, 2) OVER inside AS u
    FROM token WINDOW inside AS (PARTITION BY doc_id ORDER BY i)
),
one AS (SELECT w, count(*) AS n FROM gram GROUP BY w),
two AS (SELECT v, w, count(*) AS n FROM gram WHERE v IS NOT NULL GROUP BY v, w),
three AS (SELECT u, v, w, count(*) AS n FROM gram WHERE u IS NOT NULL GROUP BY u, v, w),
total AS (SELECT count(*) AS n FROM token),
scored AS (
    SELECT gram.doc_id,
           CASE WHEN three.n >= 2 THEN 3 WHEN two.n >= 2 THEN 2 ELSE 1 END AS used,
           CASE WHEN three.n >= 2 THEN ln(three.n / before.n)
                WHEN two.n >= 2 THEN ln(two.n / context.n) + CASE WHEN i > 2 THEN ln(0.4) ELSE 0 END
                ELSE ln(one.n / total.n) + least(i - 1, 2) * ln(0.4) END AS score
    FROM gram JOIN one ON gram.w = one.w CROSS JOIN total
    LEFT JOIN two ON gram.v = two.v AND gram.w = two.w
    LEFT JOIN three ON gram.u = three.u AND gram.v = three.v AND gram.w = three.w
    LEFT JOIN one AS context ON context.w = gram.v
    LEFT JOIN two AS before ON before.v = gram.u AND before.w = gram.v
),
summed AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (used = 1) AS by_1,
           count(*) FILTER (used = 2) AS by_2, count(*) FILTER (used = 3) AS by_3, sum(score) AS s
    FROM scored GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(by_1, 0) AS by_1,
       coalesce(by_2, 0) AS by_2, coalesce(by_3, 0) AS by_3,
       coalesce(round(s, 6), 0) AS log_score, round(s / n_words, 6) AS mean_log_score
FROM documents LEFT JOIN summed USING (doc_id)
"""
