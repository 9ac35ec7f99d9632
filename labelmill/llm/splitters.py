"""Global order without one global sort: sampled splitters and exact sums.

Rows get a place in the order of their keys, and the sum of the weights before
them, although no task ever holds more than one range of the keys.
"""

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelmill.llm.common import unsigned_unit

# Ranges the keys are cut into: one for so many rows, within these bounds. The
# sample holds about SAMPLES keys per range, so it is bounded as well.
ROWS_PER_RANGE = 250_000
FEWEST_RANGES, MOST_RANGES = 512, 2048
SAMPLES = 32


@dataclass
class Ranked:
    """Rows with ``range_no``, ``place`` and ``before``; the sums over all rows."""

    rows: DataFrame
    count: int
    weight: int


def _literal(values: list, kind: str) -> Column:
    """A constant array; Spark folds it while it plans."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def numbers(values: list[int]) -> Column:
    return _literal(values, "bigint")


def real_numbers(values: list[float]) -> Column:
    return _literal(values, "double")


def _range_of(points: list[tuple], keys: list[str]) -> Column:
    """How many splitters are at or below the key, by halving steps."""
    if not points:
        return F.lit(0)
    kind = "struct<" + ",".join(f"{k}:bigint" for k in keys) + ">"
    bounds = _literal([dict(zip(keys, p)) for p in points], kind)
    steps = [1 << i for i in reversed(range(len(points).bit_length()))]
    key = F.struct(*keys)
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(points)) & (F.get(bounds, at + step - 1) <= key), at + step
        ).otherwise(at),
    )


def _sample(rows: DataFrame, keys: list[str], weight: str, each: float) -> list[tuple]:
    """Keys drawn in proportion to weight, one for every ``each`` of it.

    Comes with the weight a key stands for. The draw depends on the key alone,
    so a task that is run again draws the same.
    """
    chance = unsigned_unit(F.lit(7), *[F.col(k) for k in keys])
    drawn = rows.filter(chance * F.lit(each) < F.col(weight)).select(*keys, weight)
    return sorted((*r[:-1], max(float(r[-1]), each)) for r in drawn.collect())


def _quantiles(drawn: list[tuple], each: float) -> list[tuple]:
    """Keys that start a new range each time so much weight has passed."""
    points, passed = [], 0.0
    for *key, stands_for in drawn:
        passed += stands_for
        if passed >= each:
            points.append(tuple(key))
            passed = 0.0
    return points


def _whole_groups(points: set[tuple]) -> list[tuple]:
    """Splitters moved to the start of their first key's group.

    Only a group that several splitters fall into is cut inside: it is too
    large for one range.
    """
    lowest = -(1 << 63)
    firsts: dict[int, int] = {}
    for p in points:
        firsts[p[0]] = firsts.get(p[0], 0) + 1
    moved = {(p[0], *[lowest] * (len(p) - 1)) for p in points}
    return sorted(moved | {p for p in points if firsts[p[0]] > 1})


def ranked(rows: DataFrame, keys: list[str], weight: str) -> Ranked:
    """Rows in the order of their keys, with exact places and sums.

    ``rows`` must be stored and narrow; keys are non-null longs, weights are
    positive. Keys are drawn by weight, quantiles of the draw become splitters,
    and rows are measured by range. A range of more than twice its share is
    drawn again more densely and subdivided, until that splits nothing more (a
    single row or equal keys). Splitters, counts and sums per range are all the
    driver holds.
    """
    count, total = rows.agg(F.count("*"), F.sum(weight)).first()
    if not count:
        places = rows.select("*", F.lit(0).alias("range_no"))
        for name in ("place", "before"):
            places = places.withColumn(name, F.lit(0).cast("long"))
        return Ranked(places, 0, 0)
    ranges = min(MOST_RANGES, max(FEWEST_RANGES, count // ROWS_PER_RANGE))
    share = total / ranges
    points = set(_quantiles(_sample(rows, keys, weight, share / SAMPLES), share))
    dense = SAMPLES
    while True:
        bounds = _whole_groups(points)
        placed = rows.withColumn("range_no", _range_of(bounds, keys))
        held = placed.groupBy("range_no").agg(F.count("*").alias("n"), F.sum(weight).alias("w"))
        held = {r.range_no: (r.n, r.w) for r in held.collect()}
        overfull = [k for k, (n, w) in held.items() if n > 1 and w > 2 * share]
        if not overfull or dense > SAMPLES << 8:
            break
        dense *= 8
        inside = placed.filter(F.col("range_no").isin(overfull))
        finer = _quantiles(_sample(inside, keys, weight, share / dense), share / 2)
        if points.issuperset(finer):
            break
        points.update(finer)
    rows_before, weight_before, n, w = [], [], 0, 0
    for number in range(len(bounds) + 1):
        rows_before.append(n)
        weight_before.append(w)
        more = held.get(number, (0, 0))
        n, w = n + more[0], w + more[1]
    inside = Window.partitionBy("range_no").orderBy(*keys)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = placed.withColumns(
        {
            "place": F.row_number().over(inside) - 1 + F.get(numbers(rows_before), "range_no"),
            "before": F.sum(weight).over(running)
            - F.col(weight)
            + F.get(numbers(weight_before), "range_no"),
        }
    )
    return Ranked(out, n, w)
