"""Bounded training sets for the models of this package."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import is_test_row

# Labelled rows of either label that a model is fitted on at most. Which ones
# depends on their ids alone.
MOST_PER_LABEL = 3000


def sample_labels(labels: DataFrame, id_column: str, label_column: str, most: int) -> DataFrame:
    """``(doc_id, label, weight)``: at most so many rows of either label, never of the test fold.

    An id with several labels counts with its largest. A weight says how many
    rows of its label a drawn row stands for.
    """
    known = (
        labels.select(
            F.col(id_column).cast("long").alias("doc_id"), F.col(label_column).cast("int").alias("label")
        )
        .dropna()
        .filter(~is_test_row("doc_id"))
        .groupBy("doc_id")
        .agg((F.max("label") > 0).cast("int").alias("label"))
    )
    held = dict(known.groupBy("label").count().collect())
    drawn = None
    for label, n in sorted(held.items()):
        rows = (
            known.filter(F.col("label") == label)
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(most)
            .withColumn("weight", F.lit(n / min(n, most)))
        )
        drawn = rows if drawn is None else drawn.union(rows)
    return known.limit(0).withColumn("weight", F.lit(1.0)) if drawn is None else drawn


def training_rows(
    docs: DataFrame,
    drawn: DataFrame,
    id_column: str,
    inputs: list,
    features: Callable[[pd.DataFrame], list[bytes]],
) -> list[tuple[int, float, bytes]]:
    """``(label, weight, features)`` of the drawn documents, in the order of their ids.

    Features are made where the texts are; only they come to the driver.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "label": batch["label"],
                    "weight": batch["weight"],
                    "features": features(batch),
                }
            )

    rows = (
        docs.select(F.col(id_column).cast("long").alias("doc_id"), *inputs)
        .join(F.broadcast(drawn), "doc_id")
        .mapInPandas(encode, "doc_id long, label int, weight double, features binary")
    )
    found = sorted((r.doc_id, bytes(r.features), r.label, r.weight) for r in rows.collect())
    return [(label, weight, data) for _, data, label, weight in found]
