"""Distribution reports as tables, and their text."""

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labelmill.operators.skew import running_before
from labelmill.schema import TOP_MODELS
from labelmill.session import stored

# Sections of the report, in print order.
SECTIONS = {
    "type": "Document Type Distribution",
    "source": "Source Distribution",
    "region": "Region Distribution",
    "model": "Car Model Distribution",
    "xev": "XEV Type Distribution",
    "language": "Language Distribution",
    "file_format": "File Format Distribution",
}
EARLIER_SECTIONS = {
    "car_model": "Car Model Distribution",
    "source_type": "Source Type Distribution",
}
NOT_HYBRID = "NULL (Non-Hybrid)"
EMPTY_REPORT = "No data available for report"


def xev_label(xev: Column) -> Column:
    return F.when(xev.isNull() | (xev == ""), NOT_HYBRID).otherwise(xev)


def _counted(records: DataFrame, dimensions: list[str], *more: Column) -> DataFrame:
    """Rows per value of each dimension and in total, in one pass.

    Each dimension is a grouping set of its own, so counts are reduced in the
    map tasks and a frequent value costs one row per task.
    """
    sets = [[]] + [[F.col(d)] for d in dimensions]
    grouped = records.groupingSets(sets, *[F.col(d) for d in dimensions]).agg(
        F.count("*").alias("n"),
        *[F.grouping(d).alias(f"_not_{d}") for d in dimensions],
        *more,
    )
    dimension = F.lit("total")
    value = F.lit(None).cast("string")
    for d in dimensions:
        here = F.col(f"_not_{d}") == 0
        dimension = F.when(here, d).otherwise(dimension)
        value = F.when(here, F.col(d)).otherwise(value)
    extra = [c for c in grouped.columns if c not in {*dimensions, "n"} and not c.startswith("_not_")]
    return grouped.select(
        dimension.alias("dimension"), value.alias("value"), "n", *extra
    )


def distribution_report(records: DataFrame, top_models: int = TOP_MODELS) -> DataFrame:
    """``(dimension, value, label, n)`` of every section and the total.

    Nulls are left out except for ``xev``; empty texts count. Of the models
    only the most frequent are kept, ties in value order.
    """
    dimensions = [d for d in SECTIONS if d in records.columns]
    counts = _counted(records, dimensions)
    kept = counts.filter(
        F.col("value").isNotNull() | F.col("dimension").isin("xev", "total")
    )
    # Only models compete with each other; any other value is alone in its
    # window. One rank filter for all lets Spark cut the models down before
    # they are shuffled.
    alone = F.when(F.col("dimension") != "model", F.col("value"))
    best = W.partitionBy("dimension", alone).orderBy(F.desc("n"), "value")
    ranked = kept.withColumn("_rank", F.row_number().over(best))
    label = F.when(F.col("dimension") == "xev", xev_label(F.col("value"))).otherwise(
        F.col("value")
    )
    return ranked.filter(F.col("_rank") <= top_models).select(
        "dimension", "value", label.alias("label"), "n"
    )


def xev_distribution(records: DataFrame) -> DataFrame:
    """Counts with nulls kept; null and ``''`` are two rows with one label."""
    counts = records.groupBy("xev").agg(F.count("*").alias("n"))
    return counts.select("xev", xev_label(F.col("xev")).alias("label"), "n").orderBy(
        F.desc("n"), F.asc_nulls_first("xev")
    )


def top_models(records: DataFrame, k: int = TOP_MODELS) -> DataFrame:
    counts = records.filter(F.col("model").isNotNull()).groupBy("model")
    return counts.agg(F.count("*").alias("n")).orderBy(F.desc("n"), "model").limit(k)


def report_totals(records: DataFrame) -> DataFrame:
    return records.agg(F.count("*").alias("n"))


def earlier_report(records: DataFrame) -> DataFrame:
    """Counts and mean page number of the earlier record layout."""
    pages = F.round(F.avg("page_count"), 2).alias("mean_pages")
    counts = _counted(records, list(EARLIER_SECTIONS), pages)
    return counts.filter(
        F.col("value").isNotNull() | (F.col("dimension") == "total")
    ).select(
        "dimension",
        "value",
        "n",
        F.when(F.col("dimension") == "total", F.col("mean_pages")).alias("mean_pages"),
    )


def placed_report(report: DataFrame) -> DataFrame:
    """A report, stored once, with ``place``: its rows in print order, from 0.

    The total, then the sections; in each values by falling count, ties by value.
    Places are counted by ranges, so a section may have any number of values.
    """
    titles = ["total", *SECTIONS, *EARLIER_SECTIONS]
    sections = F.create_map(*[F.lit(x) for i, d in enumerate(titles) for x in (d, i)])
    rows = report.withColumns(
        {
            "_section": F.try_element_at(sections, F.col("dimension")),
            "_falling": -F.col("n"),
            "_one": F.lit(1).cast("bigint"),
        }
    )
    placed = running_before(rows, [], ["_section", "_falling", "value"], "_one")
    return stored(placed.select(*report.columns, F.col("_before").alias("place")), "report")


def report_lines(
    report: DataFrame, generated_at: str, title: str = "METADATA GENERATION REPORT"
) -> Iterator[str]:
    """The report's text line by line, values by falling count.

    Takes the present report and the earlier one, whose mean page number goes
    last, placed or not. Lines are handed on as partitions of the ordered report arrive; the
    driver holds no more than one of them.
    """
    titles = {**SECTIONS, **EARLIER_SECTIONS}
    placed = report if "place" in report.columns else placed_report(report)
    ordered = placed.orderBy("place").toLocalIterator()
    total = next(ordered, None)
    if total is None or total["dimension"] != "total" or total["n"] == 0:
        yield EMPTY_REPORT
        return
    rule = "=" * 60
    yield from (rule, title, rule)
    yield f"\nTotal Documents Processed: {total['n']}"
    yield f"Generation Date: {generated_at}"
    shown = "label" if "label" in report.columns else "value"
    section = None
    for row in ordered:
        if row["dimension"] != section:
            section = row["dimension"]
            yield f"\n\n{titles[section]}:"
        yield f"  - {row[shown]}: {row['n']}"
    if "mean_pages" in report.columns and total["mean_pages"] is not None:
        yield f"\n\nAverage Page Count: {total['mean_pages']:.2f}"
    yield "\n" + rule
