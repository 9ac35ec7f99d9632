"""Conformance with the vocabularies, and accuracy against human review."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.operators.skew import join_short
from labelmill.schema import ACCURACY_TARGET, DOMAINS, PLACEHOLDERS, SUMMARY_CHARS

# Formats of the columns that have no closed list.
MODEL_FORMAT = r"^[A-Z0-9]+( PE)? \(.+\)$"
YEAR_FORMAT = r"^[0-9]{4}$"
LANGUAGE_FORMAT = r"^[a-z]{2,3}(-[A-Z][a-z]{3})?(-([A-Z]{2}|[0-9]{3}))?$"
VERSION_FORMAT = r"^v[0-9]+[.][0-9]+[.][0-9]+(-[0-9A-Za-z.-]+)?([+][0-9A-Za-z.-]+)?$"
DATE_FORMAT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"

_NULLABLE = ["xev", "year1", "year2"]


def _rules() -> dict[str, tuple[str, Column]]:
    """Per column: the name of its rule and whether a value obeys it."""
    col = F.col
    rules = {c: ("domain", col(c).isin(values)) for c, values in DOMAINS.items()}
    # Extensions also yield ``doc``, and a format can be undetermined.
    rules["file_format"] = (
        "domain",
        col("file_format").isin([*DOMAINS["file_format"], "doc", "unknown", "UNKNOWN"]),
    )
    for c in ("type", "source"):
        rules[c] = ("domain", col(c).isin([*DOMAINS[c], "UNKNOWN"]))
    rules["model"] = ("format", col("model").isin(PLACEHOLDERS) | col("model").rlike(MODEL_FORMAT))
    for c in ("year1", "year2"):
        rules[c] = ("format", col(c).rlike(YEAR_FORMAT))
    rules["language"] = (
        "format",
        (col("language") == "UNKNOWN") | col("language").rlike(LANGUAGE_FORMAT),
    )
    rules["version"] = ("format", col("version").rlike(VERSION_FORMAT))
    rules["updated_at"] = (
        "format",
        col("updated_at").rlike(DATE_FORMAT)
        & F.try_to_date("updated_at", "yyyy-MM-dd").isNotNull(),
    )
    rules["content_summary"] = ("length", F.length("content_summary") <= SUMMARY_CHARS)
    return rules


def domain_violations(
    records: DataFrame, key: str = "uri", countries: DataFrame | None = None
) -> DataFrame:
    """``(key, column, value, rule)`` of every value that breaks its rule.

    One pass over the records without a shuffle: the closed lists are short
    constants. ``countries(country, region)`` is joined when given: broadcast
    if it was counted as few, else salted, since most records may say the same.
    """
    rules = _rules()
    if countries is not None:
        known = countries.filter(F.col("country").isNotNull()).select("country").distinct()
        known = known.withColumn("_listed", F.lit(True))
        records = join_short(records, known, ["country"], F.col(key), "left")
        listed = F.col("country").isin(PLACEHOLDERS) | F.col("_listed")
        rules["country"] = ("domain", listed)
    checks = []
    for column, (rule, obeys) in rules.items():
        value = F.col(column)
        missing_ok = value.isNull() if column in _NULLABLE else F.lit(False)
        bad = ~(missing_ok | F.coalesce(obeys, F.lit(False)))
        entry = F.struct(
            F.lit(column).alias("column"), value.alias("value"), F.lit(rule).alias("rule")
        )
        checks.append(F.when(bad, entry))
    return records.select(
        key, F.explode(F.array_compact(F.array(*checks))).alias("v")
    ).select(key, "v.column", "v.value", "v.rule")


def region_country_check(records: DataFrame, countries: DataFrame, key: str = "uri") -> DataFrame:
    """Records whose country belongs to another region, or to none known.

    A placeholder on either side agrees with everything.
    """
    stated = records.filter(
        ~F.coalesce(F.col("region").isin(PLACEHOLDERS), F.lit(True))
        & ~F.coalesce(F.col("country").isin(PLACEHOLDERS), F.lit(True))
    ).select(key, "region", "country")
    home = countries.select("country", F.col("region").alias("expected_region"))
    return stated.join(home, "country", "left").filter(
        ~F.col("region").eqNullSafe(F.col("expected_region"))
    ).select(key, "region", "country", "expected_region")


def label_accuracy(
    generated: DataFrame,
    reviewed: DataFrame,
    columns: list[str],
    key: str = "uri",
    target: float = ACCURACY_TARGET,
) -> DataFrame:
    """Share of equal labels per column among the reviewed documents.

    Two nulls are equal. The shares are sums over one row per document; only
    the single result row is turned into one row per column.
    """
    theirs = reviewed.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    both = generated.select(key, *columns).join(theirs, key)
    hits = [
        F.sum(F.col(c).eqNullSafe(F.col(f"_{c}")).cast("bigint")).alias(c) for c in columns
    ]
    totals = both.agg(F.count("*").alias("reviewed"), *hits)
    rows = F.array(
        *[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit(0)).alias("correct")) for c in columns]
    )
    share = F.try_divide(F.col("r.correct"), F.col("reviewed"))
    return totals.select("reviewed", F.explode(rows).alias("r")).select(
        "r.column",
        "reviewed",
        "r.correct",
        share.alias("accuracy"),
        F.coalesce(share >= target, F.lit(False)).alias("passed"),
    )
