"""Quality by a factorisation machine.

Inputs are the hashed distinct words of a text, statistics of its structure and
numeric metadata. Beside a weight each input has a short vector; the interaction
of two inputs is the product of their vectors, and the sum over all pairs comes
from the square of the sum less the sum of the squares, linear in the inputs.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import is_test_row
from labelmill.llm.training import MOST_PER_LABEL, sample_labels, training_rows

WORD_BUCKETS = 1 << 13
FACTORS = 4
ACCEPTED_FROM = 0.3
METADATA = ["n_chars"]
# Statistics of the structure, in the order in which they are made.
STATISTICS = [
    "log_words", "log_bytes", "word_length", "upper", "digits", "symbols", "closing", "commas",
    "not_ascii", "lines_per_word", "distinct_words", "repeated_next", "distinct_lines", "short",
]

EPOCHS, BATCH, RATE = 10, 32, 0.1
WORD_DECAY, FACTOR_DECAY = 1e-3, 1e-3

_CLASSES = np.zeros((256, 5), dtype=np.float64)
_CLASSES[65:91, 0] = 1
_CLASSES[48:58, 1] = 1
_CLASSES[[*b"#$%&*+/<=>@[\\]^_`{|}~"], 2] = 1
_CLASSES[[*b".!?"], 3] = 1
_CLASSES[[*b",;:"], 4] = 1


def statistics(data: bytes, words: list[bytes]) -> list[float]:
    size, n = max(1, len(data)), len(words)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, digits, symbols, closing, commas = (counts @ _CLASSES / size).tolist()
    lines = [x for x in data.split(b"\n") if x]
    return [
        np.log1p(n),
        np.log1p(len(data)),
        (len(data) - max(0, n - 1)) / max(1, n),
        upper,
        digits,
        symbols,
        closing,
        commas,
        float(counts[128:].sum()) / size,
        len(lines) / max(1, n),
        len(set(words)) / max(1, n),
        sum(map(eq, words, words[1:])) / max(1, n - 1),
        len(set(lines)) / max(1, len(lines)),
        float(n < 5),
    ]


def inputs_of(data: bytes | None, metadata: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the distinct words, and the dense inputs."""
    data = data or b""
    words = data.split()
    hashed = {zlib.crc32(w) % WORD_BUCKETS for w in set(data.lower().split())}
    dense = statistics(data, words)
    dense += [dense[1] if m != m else float(np.log1p(max(0.0, m))) for m in metadata]
    return np.fromiter(sorted(hashed), np.int32, len(hashed)), np.array(dense)


@dataclass
class Machine:
    """``bias``, a weight and a vector per input, and the scale of the dense inputs."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def values(self, buckets: np.ndarray, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the inputs that are not zero, and their values."""
        scaled = np.clip((dense - self.mean) / self.spread, -4, 4)
        places = np.r_[buckets, WORD_BUCKETS + np.arange(len(dense))]
        return places, np.r_[np.full(len(buckets), max(1, len(buckets)) ** -0.5), scaled]

    def score(self, buckets: np.ndarray, dense: np.ndarray) -> float:
        places, x = self.values(buckets, dense)
        v = self.factors[places] * x[:, None]
        pairs = 0.5 * (v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum()
        z = self.bias + self.weights[places] @ x + pairs
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(rows: list[tuple[int, float, bytes]], metadata: int) -> Machine:
    """Fit by AdaGrad on the log loss; the same rows give the same machine."""
    n_dense = len(STATISTICS) + metadata
    size = WORD_BUCKETS + n_dense
    rng = np.random.default_rng(1)
    dense = np.array([np.frombuffer(d, np.float64, n_dense) for *_, d in rows]).reshape(-1, n_dense)
    total = sum(w for _, w, _ in rows)
    positive = sum(w for y, w, _ in rows if y)
    prior = (positive + 1) / (total + 2)
    machine = Machine(
        float(np.log(prior / (1 - prior))),
        np.zeros(size),
        rng.normal(0, 0.02, (size, FACTORS)),
        dense.mean(axis=0) if rows else np.zeros(n_dense),
        dense.std(axis=0) + 1e-3 if rows else np.ones(n_dense),
    )
    if not 0 < positive < total:
        machine.factors[:] = 0
        return machine
    given = []
    for (label, weight, data), d in zip(rows, dense):
        buckets = np.frombuffer(data, np.int32, offset=8 * n_dense)
        given.append((label, weight, *machine.values(buckets, d)))
    mean_weight = total / len(rows)
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, FACTORS), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(given))
        for start in range(0, len(order), BATCH):
            batch = [given[i] for i in order[start : start + BATCH]]
            places = np.concatenate([b[2] for b in batch])
            x = np.concatenate([b[3] for b in batch])
            lengths = np.array([len(b[2]) for b in batch])
            starts = np.r_[0, np.cumsum(lengths)[:-1]]
            row = np.repeat(np.arange(len(batch)), lengths)
            w, v = machine.weights[places], machine.factors[places]
            vx = v * x[:, None]
            sums = np.add.reduceat(vx, starts)
            pairs = 0.5 * (sums**2 - np.add.reduceat(vx**2, starts)).sum(axis=1)
            z = machine.bias + np.add.reduceat(w * x, starts) + pairs
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            error = (p - [b[0] for b in batch]) * [b[1] / mean_weight for b in batch] / len(batch)
            grad_w = np.bincount(places, error[row] * x, size)
            used = np.unique(places)
            grad_w = grad_w[used] + WORD_DECAY * machine.weights[used]
            each = (error[row] * x)[:, None] * (sums[row] - vx)
            grad_v = np.stack([np.bincount(places, each[:, f], size)[used] for f in range(FACTORS)], 1)
            grad_v += FACTOR_DECAY * machine.factors[used]
            seen_w[used] += grad_w**2
            seen_v[used] += grad_v**2
            seen_b += error.sum() ** 2
            machine.weights[used] -= RATE * grad_w / np.sqrt(seen_w[used])
            machine.factors[used] -= RATE / 4 * grad_v / np.sqrt(seen_v[used])
            machine.bias -= RATE * error.sum() / np.sqrt(seen_b)
    return machine


_NUMBERS = {"tinyint", "smallint", "int", "bigint", "float", "double"}


def _metadata_of(docs: DataFrame, names: list[str]) -> list[Column]:
    """The metadata columns as doubles; a missing one is null, and so is what is no number."""
    kinds = dict(docs.dtypes)

    def number(name: str) -> Column:
        if name not in kinds:
            return F.lit(None).cast("double")
        if kinds[name] in _NUMBERS or kinds[name].startswith("decimal"):
            return F.col(name).cast("double")
        return F.col(name).cast("string").try_cast("double")

    return [number(n).alias(f"metadata_{i}") for i, n in enumerate(names)]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    metadata: list[str] = METADATA,
    most_per_label: int = MOST_PER_LABEL,
) -> Machine:
    """The machine of a bounded sample of the labelled documents, test fold left out."""

    def features(batch: pd.DataFrame) -> list[bytes]:
        out = []
        given = batch[[c for c in batch.columns if c.startswith("metadata_")]].to_numpy(float)
        for text, numbers in zip(batch["bytes"], given):
            buckets, dense = inputs_of(text, numbers.tolist())
            out.append(dense.tobytes() + buckets.tobytes())
        return out

    drawn = sample_labels(labels, id_column, label_column, most_per_label)
    inputs = [F.col(text_column).cast("binary").alias("bytes"), *_metadata_of(docs, metadata)]
    return train(training_rows(docs, drawn, id_column, inputs, features), len(metadata))


def score(
    docs: DataFrame, machine: Machine, text_column: str = "text", metadata: list[str] = METADATA
) -> Column:
    """The probability of label 1, from 0 to 1. Null texts count as empty."""

    @F.pandas_udf("double")
    def of(columns: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for texts, *numbers in columns:
            rows = zip(*[n.to_list() for n in numbers]) if numbers else iter(lambda: (), None)
            yield pd.Series(
                [machine.score(*inputs_of(t, list(r))) for t, r in zip(texts, rows)], dtype=float
            )

    given = [c.cast("double") for c in _metadata_of(docs, metadata)]
    return of(F.col(text_column).cast("binary"), *given)


def quality(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per input row.

    Null texts count as empty and are scored; null metadata falls back on the
    length of the text. Null ids are scored and are not held out; repeated rows
    are repeated. Without labels of both kinds every score is the share of
    label 1, one half if there are no labels. An empty table gives an empty
    result.
    """
    machine = fit(docs, labels, id_column, text_column)
    scored = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        score(docs, machine, text_column).alias("score"),
    )
    return scored.select(
        "doc_id",
        F.coalesce(is_test_row("doc_id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPTED_FROM).cast("int").alias("predicted"),
    )
