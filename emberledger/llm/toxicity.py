"""Toxicity by cumulative-link ordinal regression.

P(grade <= k) = sigmoid(threshold_k - w . x): one weight per text feature,
shared by all grades, and ordered thresholds. A document's output is its
expected grade. Features are words and word beginnings (invented or compound
words share a beginning), counted over the whole text; only those that tell
the grades apart in the training sample get a weight.

The labels say only toxic or not. Grades are made from them: 0 for clean
documents; toxic ones are graded 1 to ``GRADES - 1`` by how much of what sets
toxic documents apart they hold, in equal parts.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberledger.llm.common import Scope, arrow_rows, cut, let_go

#: Labelled documents of each class that the model is fitted on, at most.
TRAIN_ROWS = 3000
GRADES = 3
#: Features with a weight, at most; documents that must hold one; its least z-score.
MAX_FEATURES, MIN_DOCS, MIN_Z = 20_000, 5, 4.0
#: Lengths of word beginnings.
HEADS = (4, 5, 6)
#: Expected grade from which on a document is rejected.
REJECT = 0.4
#: Documents per batch between the JVM and Python where whole documents go both ways.
BATCH_ROWS = 1000
_EDGE = string.punctuation + "«»„“”’…–—"


def counts(text: str | None, known: dict[str, int] | None = None) -> dict[str, int]:
    """How often each feature (of the known ones) occurs in a text."""
    out: Counter[str] = Counter()
    for raw, n in Counter((text or "").lower().split()).items():
        w = raw.strip(_EDGE)
        if not w:
            continue
        for f in (w, *(f"{w[:k]}*" for k in HEADS if len(w) > k)):
            if known is None or f in known:
                out[f] += n
    return out


@dataclass
class Model:
    names: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def plain(self) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
        """What a broadcast carries (at most ``MAX_FEATURES`` weights): a
        class would be unpickled by name, and executors need no copy of the package."""
        return self.names, self.weights, self.thresholds

    def expected(self, found: dict[str, int]) -> float:
        score = sum(self.weights[self.names[f]] * (1 + np.log(n)) for f, n in found.items())
        return float((1 - _sigmoid(self.thresholds - score)).sum())


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_cumulative(
    rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int,
    n_grades: int = GRADES, l2: float = 1.0, rounds: int = 400, rate: float = 0.1,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by gradient steps (Adam) on the
    likelihood of the grades; entries (row, column, value) are sparse."""
    n, k = len(grades), n_grades - 1
    share = np.array([(grades <= g).mean() for g in range(k)])
    start = np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
    # thresholds: the first, then logs of the steps between them, so that they stay ordered
    params = np.concatenate([np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    below, above = grades - 1, grades
    for t in range(1, rounds + 1):
        w, cuts = params[:n_features], np.cumsum(np.concatenate([params[n_features : n_features + 1], np.exp(params[n_features + 1 :])]))
        score = np.bincount(rows, weights=values * w[cols], minlength=n) if len(rows) else np.zeros(n)
        hi = np.where(above < k, _sigmoid(cuts[np.minimum(above, k - 1)] - score), 1.0)
        lo = np.where(below >= 0, _sigmoid(cuts[np.maximum(below, 0)] - score), 0.0)
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
        g_score = d_hi - d_lo
        g_cut = np.array([d_lo[below == g].sum() - d_hi[above == g].sum() for g in range(k)])
        g_w = np.bincount(cols, weights=values * g_score[rows], minlength=n_features) if len(rows) else np.zeros(n_features)
        tail = np.cumsum(g_cut[::-1])[::-1]
        steps = np.exp(params[n_features + 1 :])
        grad = np.concatenate([g_w + l2 * w, tail[:1], tail[1:] * steps]) / n
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        params = params - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    w = params[:n_features]
    return w, np.cumsum(np.concatenate([params[n_features : n_features + 1], np.exp(params[n_features + 1 :])]))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id``, ``text``, ``toxic`` of at most ``rows`` labelled documents
    of each class, chosen by the hash of their id. Rows without label, id or
    text are not used. Only ids and hashes of texts are sorted and sent."""
    marked = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_toxic")).dropna().distinct()
    parts = [marked.filter(F.col("_toxic") == k).orderBy(F.xxhash64("_id"), "_id").limit(rows) for k in (0, 1)]
    # 2 * rows ids at most
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    joined = docs.select("doc_id", "text").dropna().join(chosen, F.col("doc_id") == F.col("_id"))
    joined = joined.select("doc_id", "text", F.col("_toxic").alias("toxic"), F.xxhash64("text").alias("key"))
    # where ids repeat there may be more rows than ids
    first = joined.select("doc_id", "toxic", "key").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "toxic", "key").limit(2 * rows)
    return joined.join(F.broadcast(first), ["doc_id", "toxic", "key"]).dropDuplicates(["doc_id", "toxic", "key"]).select("doc_id", "text", "toxic", "key")


def telling_features(sample: DataFrame) -> list[tuple[str, float]]:
    """Features that mark toxic documents, with their log odds ratio: counted
    in the tasks, chosen by an aggregation, at most ``MAX_FEATURES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()  # in a chain of operators, workers may hold the tables of others
        held: tuple[Counter, Counter] = (Counter(), Counter())
        size = [0, 0]
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[label].update(counts(text).keys())
                size[label] += 1
        names = [None, *(held[0].keys() | held[1].keys())]
        held[0][None], held[1][None] = size  # the documents themselves
        for lo in range(0, len(names) if sum(size) else 0, 50_000):
            part = names[lo : lo + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), *(pa.array([h[n] for n in part], pa.int64()) for h in held)], names=["feature", "clean", "toxic"]
            )

    found = sample.select("text", "toxic").mapInArrow(run, "feature string, clean long, toxic long")
    found = found.groupBy("feature").agg(F.sum("clean").alias("b"), F.sum("toxic").alias("a"))
    found = cut(found.filter(f"feature is null or (a > 0 and a + b >= {MIN_DOCS})"))
    size = found.filter("feature is null").select("b", "a").first()
    n0, n1 = (max(1, n) for n in (size or (0, 0)))
    a, b, half = F.col("a"), F.col("b"), F.lit(0.5)
    odds = F.log((a + half) / (F.lit(n1) - a + half)) - F.log((b + half) / (F.lit(n0) - b + half))
    z = odds / F.sqrt(1 / (a + half) + 1 / (b + half))
    best = found.filter("feature is not null").select("feature", odds.alias("odds"), z.alias("z")).filter(F.col("z") >= MIN_Z)
    return [(r.feature, r.odds) for r in best.orderBy(F.col("z").desc(), "feature").limit(MAX_FEATURES).collect()]


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, grades: int = GRADES) -> Model:
    """Fit the model on a bounded sample of labelled documents; without toxic
    or clean ones, a model that finds nothing toxic. The driver gets, per
    sampled document, its counts of the chosen features, never its text."""
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return _fit(cut(training_rows(docs, labels, rows)), grades)


def _fit(sample: DataFrame, grades: int) -> Model:
    chosen = telling_features(sample)
    names, weight = {f: i for i, (f, _) in enumerate(chosen)}, np.array([o for _, o in chosen])
    if not names:
        return Model({}, np.zeros(0), np.full(grades - 1, 35.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            found = [{names[f]: n for f, n in counts(t, names).items()} for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([list(f) for f in found], pa.list_(pa.int32())), pa.array([list(f.values()) for f in found], pa.list_(pa.int64()))],
                names=["doc_id", "toxic", "key", "at", "n"],
            )

    kind = sample.select("doc_id").schema[0].dataType.simpleString()
    sparse = sample.select("text", "doc_id", "toxic", "key").mapInArrow(run, f"doc_id {kind}, toxic int, key long, at array<int>, n array<long>")
    got = sorted(sparse.collect(), key=lambda r: (r.key, r.doc_id, r.toxic))  # 2 * rows documents at most
    y = np.array([r.toxic for r in got])
    n = [len(r.at) for r in got]
    r = np.repeat(np.arange(len(got)), n)
    c, times = (np.array([v for row in got for v in row[f]], "i8") for f in ("at", "n"))
    mass = np.bincount(r, weights=weight[c] * times, minlength=len(got))
    edges = np.quantile(mass[y == 1], np.linspace(0, 1, grades)[1:-1])
    grade = np.where(y == 1, 1 + np.searchsorted(edges, mass, side="left"), 0)
    weights, thresholds = fit_cumulative(r, c, 1 + np.log(times), grade, len(names), grades)
    return Model(names, weights, thresholds)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``expected_severity``, ``grade`` (the nearest) and ``toxic``."""
    sent = docs.sparkSession.sparkContext.broadcast(model.plain())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        m = Model(*sent.value)
        for batch in batches:
            e = np.array([m.expected(counts(t.as_py(), m.names)) for t in batch.column(1)], "f8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(e), pa.array(np.rint(e).astype("i4")), pa.array(e >= REJECT)],
                names=["doc_id", "expected_severity", "grade", "toxic"],
            )

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, expected_severity double, grade int, toxic boolean"
    )


def grade_documents(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Fit on a bounded sample of the labelled documents, score all. A null
    or empty text has no features and scores as such; rows that repeat are
    scored alike; other columns are left out; no documents, no rows."""
    return score(docs, fit(docs, labels, rows))


def drop_toxic(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` without the documents that the model rejects, all columns
    kept. Written at once, so that the batches are small: the JVM keeps what
    large ones took beside its heap."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows).plain())
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        m = Model(*sent.value)
        for batch in batches:
            keep = [m.expected(counts(t.as_py(), m.names)) < REJECT for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        return Scope(docs.sparkSession).cut(docs.mapInArrow(run, docs.schema))
