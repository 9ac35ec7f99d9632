"""What the plans may and may not contain."""

import re

import pytest

import __spark_entry__ as entry
from catalog import queries as catalog

QUERIES = {name: entry.queries()[name] for name in catalog.QUERIES}


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_product_of_tables(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in {"label_documents", "extract_documents"}:
        assert "MapInPandas" not in text and "Python" not in text


def shuffles(text):
    """Shuffles but for the one that spreads a table of a single small file."""
    return len(re.findall(r"Exchange (?:hash|range)partitioning\((?!doc_id#\d+L, \d+\), REPARTITION_BY_NUM)", text))


@pytest.mark.parametrize(
    "name, most",
    [
        ("keyword_topk", 0), ("batch_records", 0), ("metadata_defaults", 0), ("prompt_text", 0),
        ("earlier_projection", 0), ("page_text", 0), ("shard_merge", 1), ("page_stats", 1),
        ("distribution_report", 2), ("batch_report", 2), ("top_models", 1), ("transcript_select", 1),
        ("transcript_text", 1), ("label_accuracy", 0), ("append_records", 0),
    ],
)
def test_shuffles(spark, sf_dir, name, most):
    assert shuffles(plan(spark, sf_dir, name)) <= most


def test_reports_do_not_read_texts(spark, sf_dir):
    for name in ("distribution_report", "xev_distribution", "top_models", "report_totals"):
        schemas = re.findall(r"FileScan parquet \[([^\]]*)\]", plan(spark, sf_dir, name))
        assert schemas and not any("text" in s for s in schemas), name


def test_models_are_cut_before_they_are_shuffled(spark, sf_dir):
    assert plan(spark, sf_dir, "distribution_report").count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(spark, sf_dir, "top_models")
