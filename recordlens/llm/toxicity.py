"""Toxicity: a cumulative-link ordinal regression that gives each document an expected severity.

One weight vector scores the sparse features of a text; ordered thresholds cut the score into grades,
``P(grade > k) = sigmoid(score - threshold_k)``. All thresholds share the weights. The expected severity is the sum of
these probabilities over the thresholds.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.llm.common import parts, texts
from recordlens.sources.scratch import materialize

#: Labelled documents that the model is fitted on at most: those with the least hashes of their ids.
MAX_LABELLED = 12_000
#: Features of the model at most, those of the greatest chi-square.
MAX_FEATURES = 4_000
#: Documents of the sample that a feature has to be in.
MIN_DOCS = 3
#: Chi-square between a feature and being graded above 0 at least; below it a small sample shows chance only.
MIN_CHI = 10.0
#: Starts of words that are features beside the whole words.
PREFIXES = (4, 5, 6, 7, 8)
PENALTY = 1e-4
STEPS = 400
REJECT_FROM = 0.5
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str) -> dict[str, int]:
    """The words of a text in lower case and their starts (marked by ``^``), with their counts."""
    words: dict[str, int] = {}
    for w in _WORD.findall(text.lower()):
        words[w] = words.get(w, 0) + 1
    out = dict(words)
    for w, n in words.items():
        for k in PREFIXES:
            if len(w) > k:
                start = f"^{w[:k]}"
                out[start] = out.get(start, 0) + n
    return out


@dataclass
class Severity:
    """A fitted model: weights of named features, and ascending thresholds."""

    weights: dict[str, float]
    thresholds: list[float]

    def expected(self, text: str) -> float:
        """Expected severity, from 0 to the number of thresholds.

        A feature counts 1 + log of its count, and the score is the sum over the features present, so what else a text holds
        does not dilute it.
        """
        words: dict[str, int] = {}
        for w in _WORD.findall(text.lower()):
            words[w] = words.get(w, 0) + 1
        get, score, starts = self.weights.get, 0.0, {}
        for w, n in words.items():
            if (x := get(w)) is not None:
                score += x * (1 + math.log(n))
            for k in PREFIXES:
                if len(w) > k and (s := f"^{w[:k]}") in self.weights:
                    starts[s] = starts.get(s, 0) + n
        score += sum(get(s) * (1 + math.log(n)) for s, n in starts.items())
        return sum(_sigmoid(score - t) for t in self.thresholds)


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int, n_grades: int, penalty: float = PENALTY, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of greatest penalised likelihood, by gradient steps (Adam) from zero.

    The entries of the sparse matrix are ``values`` at (``rows``, ``columns``). Thresholds are a first one and positive
    gaps, so they stay in order.
    """
    n, k = len(grades), n_grades - 1
    share = np.array([(grades > t).mean() for t in range(k)]).clip(1e-3, 1 - 1e-3)
    cuts = -np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(cuts), 1e-2))
    x = np.concatenate([np.zeros(n_features), cuts[:1], gaps])
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        w, first, g = x[:n_features], x[n_features], np.exp(x[n_features + 1 :])
        cuts = first + np.concatenate([[0.0], np.cumsum(g)])
        score = np.bincount(rows, values * w[columns], n)
        above = 1 / (1 + np.exp(-np.clip(score[:, None] - cuts[None, :], -40, 40)))
        full = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], 1)
        at = np.arange(n)
        likely = np.maximum(full[at, grades] - full[at, grades + 1], 1e-12)
        slope = np.concatenate([np.zeros((n, 1)), above * (1 - above), np.zeros((n, 1))], 1)
        by_score = -(slope[at, grades] - slope[at, grades + 1]) / likely / n
        by_cut = np.zeros((n, n_grades + 1))
        by_cut[at, grades] += slope[at, grades] / likely / n
        by_cut[at, grades + 1] -= slope[at, grades + 1] / likely / n
        cut_sums = by_cut[:, 1:-1].sum(0)
        tail = np.cumsum(cut_sums[::-1])[::-1]
        gradient = np.concatenate([np.bincount(columns, values * by_score[rows], n_features) + penalty * w, tail[:1], tail[1:] * g])
        m = 0.9 * m + 0.1 * gradient
        v = 0.999 * v + 0.001 * gradient**2
        x = x - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return x[:n_features], x[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(x[n_features + 1 :]))])


def graded_sample(docs: DataFrame, labels: DataFrame, grade: str = "grade", most: int = MAX_LABELLED, text: str = "text") -> DataFrame:
    """``doc_id, text, grade`` of at most ``most`` labelled ids; of several labels of an id the highest counts, of several texts the least (null is empty). Runs jobs."""
    one = labels.where(f"doc_id is not null and {grade} is not null").groupBy("doc_id").agg(F.max(grade).cast("int").alias("grade"))
    chosen = materialize(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), "graded")
    known = F.broadcast(chosen.withColumnRenamed("doc_id", "_id"))  # at most `most` rows
    rows = docs.select("doc_id", F.col(text).alias("text")).join(known, F.col("doc_id") == F.col("_id"))
    one_text = rows.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("grade").alias("grade"))
    return materialize(one_text, "graded-texts")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, int] = {}  # documents that are clean, and 2**32 for each toxic one
        for part in parts(batch):
            for text, grade in zip(texts(part.column(0)), part.column(1).to_pylist(), strict=True):
                one = 1 << 32 if grade > 0 else 1
                for f in features(text):
                    counts[f] = counts.get(f, 0) + one
        both = np.fromiter(counts.values(), np.int64, len(counts))
        yield pa.RecordBatch.from_arrays([pa.array(counts, pa.string()), pa.array(both & 0xFFFFFFFF), pa.array(both >> 32)], names=["feature", "clean", "toxic"])


def fit(docs: DataFrame, labels: DataFrame, grade: str = "grade", *, max_labelled: int = MAX_LABELLED, max_features: int = MAX_FEATURES, text: str = "text") -> Severity:
    """Fit to ``labels (doc_id, grade)`` with grades 0, 1, …; at most ``max_labelled`` whole texts. Runs jobs.

    Features are counted over all tasks; ``max_features`` of them, and the sample's entries of these, reach the driver.
    Without labels of two grades every document has the severity 0.
    """
    return fit_sample(graded_sample(docs, labels, grade, max_labelled, text), max_features=max_features)


def fit_sample(sample: DataFrame, *, max_features: int = MAX_FEATURES) -> Severity:
    """Fit to a sample ``doc_id, text, grade`` of bounded size. Runs jobs."""
    sizes = {r["grade"]: r["n"] for r in sample.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2 or min(sizes) < 0:
        return Severity({}, [math.inf])
    n_clean = sum(n for g, n in sizes.items() if g == 0)
    n_toxic = sum(sizes.values()) - n_clean
    counts = sample.select("text", "grade").mapInArrow(_counted, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    n = float(n_clean + n_toxic)
    held = F.col("clean") + F.col("toxic")
    apart = F.col("toxic") * F.lit(float(n_clean)) - F.col("clean") * F.lit(float(n_toxic))
    spread = held * (n - held) * F.lit(float(n_clean) * float(n_toxic))
    counts = counts.where(held >= MIN_DOCS).withColumn("chi", F.when(spread > 0, n * apart * apart / spread).otherwise(0.0))
    best = counts.where(F.col("chi") >= MIN_CHI).orderBy(F.desc("chi"), "feature").limit(max_features)
    names = [r["feature"] for r in best.select("feature").collect()]
    number = {f: i for i, f in enumerate(names)}

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[list[int], list[float], int]] = []
            for part in parts(batch):
                for text_, g in zip(texts(part.column(0)), part.column(1).to_pylist(), strict=True):
                    found = [(number[f], 1 + math.log(n)) for f, n in features(text_).items() if f in number]
                    out.append(([i for i, _ in found], [x for _, x in found], g))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _, _ in out], pa.list_(pa.int32())), pa.array([b for _, b, _ in out], pa.list_(pa.float32())), pa.array([g for _, _, g in out], pa.int32())], names=["at", "value", "grade"])

    # In the order of the ids, so that the sums and the model are the same each time.
    rows = sample.orderBy("doc_id").select("text", "grade").mapInArrow(entries, "at array<int>, value array<float>, grade int").toPandas()
    lengths = rows["at"].map(len).to_numpy()
    flat = lambda c, t: np.concatenate([*rows[c], np.empty(0)]).astype(t)
    weights, thresholds = fit_ordinal(np.repeat(np.arange(len(rows)), lengths), flat("at", np.int64), flat("value", float), rows["grade"].to_numpy(np.int64), len(names), max(sizes) + 1)
    return Severity(dict(zip(names, weights.tolist(), strict=True)), thresholds.tolist())


def score(docs: DataFrame, model: Severity, name: str = "severity", text: str = "text") -> DataFrame:
    """Add the expected severity to each row; one pass, no shuffle. Null texts are empty.

    A column of ``docs`` called ``name`` is replaced; all others are kept, repeated rows too.
    """
    base = docs.select(*[c for c in docs.columns if c.lower() != name.lower()])
    at = base.columns.index(text)
    schema = T.StructType([*base.schema.fields, T.StructField(name, T.DoubleType())])
    sent = base.sparkSession.sparkContext.broadcast(model)  # at most MAX_FEATURES weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expected = sent.value.expected
        for batch in batches:
            values = [expected(x) for part in parts(batch) for x in texts(part.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=[*batch.schema.names, name])

    return base.mapInArrow(run, schema)


def graded_by_density(sample: DataFrame, *, max_features: int = MAX_FEATURES) -> DataFrame:
    """Turn the grades 0 and 1 of a sample into 0, 1 and 2, where only flags are known. Runs jobs.

    Markers are features that ``MIN_DOCS`` flagged documents have and no other one. Flagged documents with a larger share of
    marker words than half of them are graded 2.
    """
    counts = sample.select("text", "grade").mapInArrow(_counted, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    only = counts.where((F.col("clean") == 0) & (F.col("toxic") >= MIN_DOCS)).orderBy(F.desc("toxic"), "feature").limit(max_features)
    markers = {r["feature"] for r in only.select("feature").collect()}

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in (x for part in parts(batch) for x in texts(part.column(1))):
                words = _WORD.findall(text.lower())
                marked = sum(w in markers or any(f"^{w[:k]}" in markers for k in PREFIXES if len(w) > k) for w in words)
                out.append(marked / max(len(words), 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=["doc_id", "text", "grade", "_share"])

    shared = materialize(sample.select("doc_id", "text", "grade").mapInArrow(shares, "doc_id long, text string, grade int, _share double"), "shares")
    half = shared.where("grade > 0").agg(F.percentile("_share", 0.5)).first()[0]
    grade = F.when(F.col("grade") == 0, 0).when(F.col("_share") > F.lit(half).cast("double"), 2).otherwise(1)
    return shared.select("doc_id", "text", grade.alias("grade"))


def model_of_flags(docs: DataFrame, labels: DataFrame, flag: str = "toxic") -> Severity:
    """Fit to labels that are a flag (0 or 1) only, graded by density."""
    return fit_sample(graded_by_density(graded_sample(docs, labels.select("doc_id", F.col(flag).cast("int").alias("grade")))))
