"""Toxicity by multiple-instance learning.

Labels are known for documents, the offence sits in sentences. A sentence has a
probability by logistic regression over its words and their beginnings; a
document is toxic unless all of its sentences are harmless (noisy-or). The
weights are trained through that combination, so sentences need no labels, and
the fitted model tells which sentences offend.
"""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import is_test_row
from labelmill.llm.training import MOST_PER_LABEL, sample_labels, training_rows

BUCKETS = 1 << 18
# Beginnings of a word that are inputs beside the whole word.
BEGINNINGS = (4, 5)
TOXIC_FROM = 0.5
SENTENCE = re.compile(r"[^.!?\n]+")
EDGES = ".,;:!?\"'()[]{}<>*#%&$|-_"

# Inputs must occur in so many documents labelled toxic to get a weight.
LEAST_DOCUMENTS = 2
STEPS, RATE, L1 = 150, 0.2, 1e-4
# Words whose weight a task remembers.
REMEMBERED = 500_000


def inputs_of(word: str) -> list[int]:
    """Buckets of a word: itself and its beginnings."""
    word = word.strip(EDGES).lower()
    if not word:
        return []
    parts = [word, *[f"{word[:n]}\n" for n in BEGINNINGS if len(word) >= n]]
    return [zlib.crc32(p.encode("utf-8", "replace")) % BUCKETS for p in parts]


@dataclass
class Model:
    bias: float
    places: np.ndarray
    weights: np.ndarray

    def words(self) -> "Weights":
        return Weights(dict(zip(self.places.tolist(), self.weights.tolist())))


class Weights(dict):
    """The weight of a word as it stands in the text; forgets all when it is full."""

    def __init__(self, by_bucket: dict[int, float]):
        super().__init__()
        self.by_bucket = by_bucket

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        weight = sum(self.by_bucket.get(b, 0.0) for b in set(inputs_of(word)))
        self[word] = weight
        return weight


def sentence_scores(text: str, bias: float, weights: Weights) -> list[float]:
    of = weights.__getitem__
    return [bias + sum(map(of, set(s.split()))) for s in SENTENCE.findall(text)]


def noisy_or(scores: list[float]) -> float:
    """1 less the chance that no sentence offends."""
    if not scores:
        return 0.0
    return float(-np.expm1(-np.logaddexp(0, scores).sum()))


def encode(text: str) -> bytes:
    """Sentences as bucket lists, each behind its length."""
    out = []
    for sentence in SENTENCE.findall(text):
        found = {b for w in set(sentence.split()) for b in inputs_of(w)}
        out += [len(found), *found]
    return np.array(out, np.int32).tobytes()


def train(rows: list[tuple[int, float, bytes]]) -> Model:
    """Weights that maximise the likelihood of the documents' labels."""
    sentence_doc, lengths, parts = [], [], []
    for number, (_, _, data) in enumerate(rows):
        coded = np.frombuffer(data, np.int32)
        at = 0
        while at < len(coded):
            n = int(coded[at])
            sentence_doc.append(number)
            lengths.append(n)
            parts.append(coded[at + 1 : at + 1 + n])
            at += n + 1
    label = np.array([r[0] for r in rows])
    weight = np.array([r[1] for r in rows])
    total = weight.sum() if rows else 0.0
    prior = ((weight * label).sum() + 1) / (total + 2) if rows else 0.5
    doc = np.array(sentence_doc, int)
    per_doc = len(doc) / max(1, len(rows))
    bias = float(np.log(prior / (1 - prior)) - np.log(max(1.0, per_doc)))
    nothing = Model(bias, np.zeros(0, int), np.zeros(0))
    if not parts or not 0 < label.sum() < len(rows):
        return nothing
    buckets = np.concatenate(parts)
    sentence = np.repeat(np.arange(len(doc)), lengths)
    toxic = label[doc[sentence]] == 1
    pairs = np.unique(np.stack([buckets[toxic], doc[sentence[toxic]]], 1), axis=0)
    places, documents = np.unique(pairs[:, 0], return_counts=True)
    places = places[documents >= LEAST_DOCUMENTS]
    if not len(places):
        return nothing
    known = np.isin(buckets, places)
    sentence, place = sentence[known], np.searchsorted(places, buckets[known])
    weight = weight / total
    w, m, s = np.zeros(len(places)), np.zeros(len(places)), np.zeros(len(places))
    b, mb, sb = bias, 0.0, 0.0
    for step in range(1, STEPS + 1):
        z = b + np.bincount(sentence, w[place], len(doc))
        harmless = np.bincount(doc, np.logaddexp(0, z), len(rows))
        p = 1 / (1 + np.exp(-z))
        # The slope of a document's log likelihood by the score of a sentence.
        odds = np.exp(-harmless) / np.maximum(-np.expm1(-harmless), 1e-12)
        slope = weight[doc] * p * np.where(label[doc] == 1, odds[doc], -1.0)
        grad, grad_b = -np.bincount(place, slope[sentence], len(places)), -slope.sum()
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad**2
        mb, sb = 0.9 * mb + 0.1 * grad_b, 0.99 * sb + 0.01 * grad_b**2
        up, down = 1 - 0.9**step, 1 - 0.99**step
        scale = RATE / (np.sqrt(s / down) + 1e-4)
        w = w - scale * m / up
        w = np.sign(w) * np.maximum(np.abs(w) - scale * L1, 0)
        b -= RATE * (mb / up) / (np.sqrt(sb / down) + 1e-4)
    kept = w != 0
    return Model(float(b), places[kept], w[kept])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    most_per_label: int = MOST_PER_LABEL,
) -> Model:
    """The model of a bounded sample of the labelled documents, test fold left out."""
    drawn = sample_labels(labels, id_column, label_column, most_per_label)
    inputs = [F.coalesce(F.col(text_column), F.lit("")).alias("text")]
    rows = training_rows(docs, drawn, id_column, inputs, lambda b: [encode(t) for t in b["text"]])
    return train(rows)


def toxicity(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(doc_id, held_out, score, predicted, offending)``, one row per input row.

    ``offending`` lists the sentences with a probability of one half or more as
    ``start:end`` in code points, comma-joined. Null and empty texts have score
    0. Null ids are scored and are not held out; repeated rows are repeated.
    Without labels of both kinds no word has a weight. An empty table gives an
    empty result; columns beside id and text are not read.
    """
    model = fit(docs, labels, id_column, text_column)

    @F.pandas_udf("score double, offending string")
    def of(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights = model.words()
        for texts in columns:
            scores, spans = [], []
            for text in texts:
                each = sentence_scores(text, model.bias, weights)
                scores.append(noisy_or(each))
                bad = {i for i, z in enumerate(each) if z >= 0}
                found = enumerate(SENTENCE.finditer(text)) if bad else ()
                spans.append(",".join(f"{m.start()}:{m.end()}" for i, m in found if i in bad))
            yield pd.DataFrame({"score": scores, "offending": spans})

    scored = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        of(F.coalesce(F.col(text_column), F.lit(""))).alias("found"),
    )
    return scored.select(
        "doc_id",
        F.coalesce(is_test_row("doc_id"), F.lit(False)).alias("held_out"),
        "found.score",
        (F.col("found.score") >= TOXIC_FROM).cast("int").alias("predicted"),
        "found.offending",
    )
