"""Toxicity: severity grades by cumulative-link ordinal regression on sparse text features.

One weight per feature is shared by all grades: ``P(grade >= k) = sigmoid(w . x - threshold_k)`` with
rising thresholds.  The expected severity is the sum of those probabilities.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Container, Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import column, in_tasks, plain_words, raw_texts, slices

#: Weights that features are hashed to; lengths of word beginnings that are features too.
BUCKETS, BEGINNINGS = 1 << 18, (3, 4, 5, 6, 7)
#: Labelled documents that a model is fitted on, of either label at most.
SAMPLE = 3000
#: A feature takes part if it stands in this many sampled documents and in this share of those of a label, in a larger
#: share of the toxic ones than of the others, and if a G-test of its link with the label exceeds the value.
LEAST_DOCUMENTS, LEAST_SHARE, LEAST_G = 3, 0.01, 3.0
STEPS, L2, RATE = 600, 1e-4, 0.5
#: A toxic document counts as so many others: missing one is worse than a false alarm.
TOXIC_WEIGHT = 3.0
#: Words a task remembers the features of.
REMEMBERED = 500_000


def buckets(word: bytes) -> tuple[int, ...]:
    """The features of a word: the word and its beginnings."""
    text = word.decode()
    parts = [text, *[f"{text[:n]}-" for n in BEGINNINGS if len(text) > n]]
    return tuple(xxhash.xxh32_intdigest(p.encode(), 7) % BUCKETS for p in parts)


class Features(dict):
    """The features of words, looked up by word; ``only`` these, if given."""

    def __init__(self, only: Container[int] | None = None) -> None:
        super().__init__()
        self.only = only

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = buckets(word)
        self[word] = found = found if self.only is None else tuple(b for b in found if b in self.only)
        return found

    def counts(self, text: bytes | None) -> Counter:
        """How often each feature stands in a text."""
        found: Counter = Counter()
        for at in filter(None, map(self.__getitem__, plain_words(text))):
            for b in at:
                found[b] += 1
        return found


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """Weights by bucket (others are zero) and rising thresholds."""

    weights: dict[int, float]
    thresholds: np.ndarray

    def at_least(self, found: Counter) -> np.ndarray:
        """The probabilities of grade 1 or more, 2 or more, and so on."""
        score = sum(self.weights[b] * math.log1p(n) for b, n in found.items() if b in self.weights)
        return sigmoid(score - self.thresholds)


def grades(features: list[Counter], toxic: np.ndarray, totals: np.ndarray | None = None) -> np.ndarray:
    """Severity grades from toxic and other documents: 0 if not toxic, else 1, or 2 if more than half of
    the toxic documents hold a smaller share of telling features.

    A feature tells if it stands in 3 toxic documents or more, and in ten times as large a
    share of the toxic documents as of the others.  ``totals`` are the numbers of features of the
    documents, where ``features`` lacks some that can't tell.
    """
    totals = [sum(f.values()) for f in features] if totals is None else totals
    seen = [Counter(), Counter()]
    for f, t in zip(features, toxic, strict=True):
        seen[int(t)].update(f.keys())
    n = [max(1, int((toxic == k).sum())) for k in (0, 1)]
    telling = {b for b, k in seen[1].items() if k >= 3 and k / n[1] >= 10 * (seen[0][b] + 0.1) / n[0]}
    dose = np.array([sum(k for b, k in f.items() if b in telling) / max(1, n) for f, n in zip(features, totals, strict=True)])
    middle = np.median(dose[toxic == 1]) if (toxic == 1).any() else 0.0
    return np.where(toxic == 1, 1 + (dose > middle), 0)


def chosen(features: list[Counter], toxic: np.ndarray) -> list[int]:
    """The features whose presence goes with the toxic label, by a G-test.

    Words that go with harmless documents say nothing against an insult beside them, so they are left out.
    """
    seen = [Counter(), Counter()]
    for f, t in zip(features, toxic, strict=True):
        seen[int(t)].update(f.keys())
    n = np.array([(toxic == 0).sum(), (toxic == 1).sum()], float)
    often = sorted(b for b in seen[0] | seen[1] if seen[0][b] + seen[1][b] >= LEAST_DOCUMENTS)
    have = np.array([[seen[0][b], seen[1][b]] for b in often], float).reshape(-1, 2)
    expected = have.sum(axis=1, keepdims=True) * n / n.sum()
    g = np.zeros(len(often))
    for seen_, due in ((have, expected), (n - have, n - expected)):
        with np.errstate(divide="ignore", invalid="ignore"):
            g += 2 * np.where(seen_ > 0, seen_ * np.log(seen_ / due), 0).sum(axis=1)
    share = have / np.maximum(n, 1)
    common = (share.max(axis=1) >= LEAST_SHARE) & (share[:, 1] > share[:, 0])
    return [b for b, x, fine in zip(often, g, common, strict=True) if fine and x >= LEAST_G]


def fit(features: list[Counter], grade: np.ndarray, weight: np.ndarray) -> Model:
    """Fit weights and thresholds by gradient steps over all rows."""
    top = int(grade.max(initial=0))
    used = chosen(features, grade > 0) if top else []
    if not used:
        return Model({}, np.full(max(1, top), 30.0))
    place = {b: k for k, b in enumerate(used)}
    inside = [[(place[b], n) for b, n in f.items() if b in place] for f in features]
    row = np.repeat(np.arange(len(features)), [len(f) for f in inside])
    at = np.array([k for f in inside for k, _ in f], np.int64)
    value = np.log1p(np.array([n for f in inside for _, n in f], float))
    weight = weight / weight.sum()
    # Thresholds rise: after the first one come the logarithms of the distances between them.
    w, rising = np.zeros(len(used)), np.concatenate(([2.0], np.zeros(top - 1)))
    sum_w, sum_t = np.full(len(used), 1e-8), np.full(top, 1e-8)
    for _ in range(STEPS):
        gaps = np.exp(rising[1:])
        theta = rising[0] + np.concatenate(([0.0], np.cumsum(gaps)))
        score = np.bincount(row, w[at] * value, len(features))
        reach = np.column_stack([np.ones(len(score)), sigmoid(score[:, None] - theta), np.zeros(len(score))])
        upper = reach[np.arange(len(score)), grade]
        lower = reach[np.arange(len(score)), grade + 1]
        slope = -weight * (1 - upper - lower)  # of the negative log likelihood, by the score
        p = np.maximum(upper - lower, 1e-9)
        by_w = np.bincount(at, slope[row] * value, len(used)) + L2 * w
        by_t = np.zeros(top)
        for k in range(top):
            f = reach[:, k + 1] * (1 - reach[:, k + 1])
            by_t[k] = (weight * f / p)[grade == k + 1].sum() - (weight * f / p)[grade == k].sum()
        above = np.cumsum(by_t[::-1])[::-1]  # a step in a threshold moves all above it
        by_t = above * np.concatenate(([1.0], gaps))
        sum_w += by_w**2
        sum_t += by_t**2
        w = w - RATE / np.sqrt(sum_w) * by_w
        rising = rising - RATE / np.sqrt(sum_t) * by_t
    return Model(dict(zip(used, w.tolist(), strict=True)), theta)


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from at most about ``sample`` toxic and ``sample`` other labelled documents, drawn by a hash of the id.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``toxic`` (0 or 1; null teaches nothing).
    Of documents with one id, the smallest text counts.  Only counts of hashed features of the sampled documents reach
    the driver.
    """
    rated = labels.select(column("doc_id").alias("doc_id"), column("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    n = {r["toxic"]: r["n"] for r in rated.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return fit([], np.zeros(0, int), np.zeros(0))
    chance = F.when(F.col("toxic") == 1, min(1.0, sample / n[1])).otherwise(min(1.0, sample / n[0]))
    drawn = rated.where(F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 30)) < chance * (1 << 30))
    drawn = drawn.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # At most about 2 * sample rows of two numbers: small by construction.
    texts = docs.select(column("doc_id").alias("doc_id"), column("text").alias("text")).join(F.broadcast(drawn), "doc_id")
    # One row, the smallest text's, for an id that many documents have.
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in slices(batches):
            every = Features()
            found = [every.counts(t) for t in raw_texts(batch)]
            at = pa.array([list(f.keys()) for f in found], pa.list_(pa.int32()))
            times = pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("toxic"), at, times], ["doc_id", "toxic", "at", "times"])

    table = in_tasks(texts, run, "doc_id string, toxic int, at array<int>, times array<int>").toArrow().sort_by("doc_id")
    toxic = table["toxic"].to_numpy()
    features, totals = _leaning(table, toxic)
    shares = {k: n[k] / max(1, int((toxic == k).sum())) for k in (0, 1)}
    weight = np.where(toxic == 1, TOXIC_WEIGHT * shares[1], shares[0])
    return fit(features, grades(features, toxic, totals), weight)


def _leaning(table: pa.Table, toxic: np.ndarray) -> tuple[list[Counter], np.ndarray]:
    """The features that can tell or be chosen, by document, and the number of all features of each document.

    The others, most of them, stay out of the driver's objects.
    """
    at, times = (table[c].combine_chunks() for c in ("at", "times"))
    row = np.repeat(np.arange(len(toxic)), pc.list_value_length(at).to_numpy(zero_copy_only=False))
    at, times = at.flatten().to_numpy(), times.flatten().to_numpy()
    totals = np.bincount(row, times, len(toxic))
    seen = np.stack([np.bincount(at[toxic[row] == k], minlength=BUCKETS) for k in (0, 1)])
    share = seen / np.maximum([[(toxic == 0).sum()], [(toxic == 1).sum()]], 1)
    kept = ((seen.sum(axis=0) >= LEAST_DOCUMENTS) & (share[1] > share[0]))[at]
    row, at, times = row[kept], at[kept], times[kept]
    ends = np.searchsorted(row, np.arange(len(toxic) + 1))
    return [Counter(dict(zip(at[a:b].tolist(), times[a:b].tolist(), strict=True))) for a, b in pairwise(ends)], totals


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``expected_severity`` (0 to the highest grade), ``grade`` (the highest that is
    as likely as not) and ``toxic`` (grade 1 or more).  A null or empty text has no features.  Nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        model = shared.value
        weighted = Features(model.weights)
        for batch in slices(batches):
            reach = [model.at_least(weighted.counts(t)) for t in raw_texts(batch)]
            grade = [int((r >= 0.5).sum()) for r in reach]
            columns = [
                batch.column("doc_id"),
                pa.array([float(r.sum()) for r in reach], pa.float64()),
                pa.array(grade, pa.int32()),
                pa.array([g > 0 for g in grade], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "expected_severity", "grade", "toxic"])

    rows = docs.select(column(id_column).alias("doc_id"), column(text_column).alias("text"))
    return in_tasks(rows, run, f"doc_id {kind}, expected_severity double, grade int, toxic boolean")
