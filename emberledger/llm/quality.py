"""Quality rules with robust multivariate outliers.

Every document gets base statistics and fixed rules. The documents that pass
them are judged by a transformed vector of the statistics: regularised minimum-
covariance-determinant estimates of its centre and scatter per language and
source. Concentration steps run from several starts (the medians, and small
hashed subsets), the start with the least determinant goes on, and the result
is reweighted once; a document is rejected if its Mahalanobis distance is
beyond a chi-square quantile.

Three of the statistics are 0 in most documents, so the documents that an
estimate is concentrated on need not vary in them at all. A count is not known
better than to one occurrence; the mean square, over these documents, of what
one more occurrence changes is therefore added to the variance of each
statistic. It comes from the lengths of the documents of the cell.

A concentration step is two aggregations over all documents, so a cell
(language and source) of any size is worked on by all tasks. Cells of fewer
than ``MIN_ROWS`` documents are taken together per language, and if these are
still few, over all languages.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberledger.llm.common import cut, lookup, null_last

SYMBOLS = "#*$%&|<>"
GRAM = 8
#: Share of a cell that the estimates are concentrated on; steps from every start, and from the best.
KEEP, ROUGH, STEPS = 0.75, 2, 3
#: Starts: the medians, and hashed subsets of about so many documents.
STARTS, SUBSET = 4, 40
#: Chi-square quantiles (4 degrees of freedom) of the reweighting and of rejection.
REWEIGHT, REJECT = 0.975, 0.999
MIN_ROWS = 100
#: Words from which on the mean word length of a document varies no less with its length.
LONG = 3000
DIMS = 4


# -- base statistics ------------------------------------------------------


def repeated_words(words: list[bytes], gram: int = GRAM) -> int:
    """Words that lie in a window of ``gram`` words found twice or more."""
    n = len(words)
    seen: dict[bytes, int] = {}
    if n <= gram:
        return 0
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), "u8", n)
    if len(seen) == n:
        return 0
    with np.errstate(over="ignore"):
        spread = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        spread ^= spread >> np.uint64(31)
        h = np.zeros(n - gram + 1, "u8")
        for j in range(gram):
            h = h * np.uint64(0xBF58476D1CE4E5B9) + spread[j : n - gram + 1 + j]
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    if not len(at):
        return 0
    # windows of equal hash are compared word by word
    exact = Counter(tuple(ids[i : i + gram].tolist()) for i in at)
    covered = np.zeros(n + 1, "i8")
    for i in at:
        if exact[tuple(ids[i : i + gram].tolist())] > 1:
            covered[i] += 1
            covered[i + gram] -= 1
    return int((np.cumsum(covered[:-1]) > 0).sum())


def text_statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """(words, characters in words, symbols, repeated lines, words in repeated windows)."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = Counter(text.split("\n"))
    dup = sum(c - 1 for line, c in lines.items() if c > 1 and line.strip(" \t\x0b\x0c\r"))
    return len(words), chars, sum(map(text.count, SYMBOLS)), dup, repeated_words(words)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``source`` and the base statistics of whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_statistics(t.as_py()) for t in batch.column(3)]
            cols = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(BASE)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *cols], names=["doc_id", "lang", "source", *BASE])

    d = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), "text")
    kind = d.schema[0].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {kind}, lang string, source string, " + ", ".join(f"{c} long" for c in BASE))


# -- estimates ------------------------------------------------------------


def chi2_cdf(x: float, dof: int) -> float:
    """For even degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dof // 2))


def chi2_quantile(p: float, dof: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, dof) < p else (lo, mid)
    return lo


def consistency(share: float, dof: int = DIMS) -> float:
    """What the scatter of the inner ``share`` of a normal sample falls short by."""
    return share / chi2_cdf(chi2_quantile(share, dof), dof + 2)


BY = ["cell", "start"]
MODEL = "cell string, start int, mean array<double>, inverse array<double>, logdet double"


def _models(sums: DataFrame, factor: float) -> DataFrame:
    """Centre, inverse scatter and its log determinant per cell and start from
    (``n``, ``s`` sums, ``ss`` sums of products, ``rs`` sums of squared resolutions)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for cell, start, n, s, ss, rs in pdf[[*BY, "n", "s", "ss", "rs"]].itertuples(index=False):
                mean = np.array(s) / n
                cov = factor * (np.array(ss).reshape(DIMS, DIMS) / n - np.outer(mean, mean))
                cov += np.diag(np.array(rs) / n)
                out.append((cell, start, mean.tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])))
            yield pd.DataFrame(out, columns=[*BY, "mean", "inverse", "logdet"])

    return cut(sums.mapInPandas(run, MODEL))


def _sums(rows: DataFrame) -> DataFrame:
    v = [F.element_at("v", i + 1) for i in range(DIMS)]
    return rows.groupBy(*BY).agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(x) for x in v]).alias("s"),
        F.array(*[F.sum(x * y) for x in v for y in v]).alias("ss"),
        F.array(*[F.sum(F.element_at("r", i + 1)) for i in range(DIMS)]).alias("rs"),
    )


def distance() -> Column:
    """Squared Mahalanobis distance of ``v`` under the joined model."""
    d = [F.element_at("v", i + 1) - F.element_at("mean", i + 1) for i in range(DIMS)]
    out = F.lit(0.0)
    for i in range(DIMS):
        for j in range(DIMS):
            out = out + d[i] * d[j] * F.element_at("inverse", i * DIMS + j + 1)
    return out


def with_cells(rows: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """``cell``: language and source, or the language's small sources, or all small languages."""
    rows = rows.withColumn("_l", null_last("lang")).withColumn("_s", null_last("source"))
    counts = rows.groupBy("_l", "_s").agg(F.count("*").alias("_n"))
    small = F.when(F.col("_n") < min_rows, F.col("_n"))
    by_lang = F.coalesce(F.sum(small).over(Window.partitionBy("_l")), F.lit(0))
    names = counts.select(
        "_l", "_s",
        F.when(F.col("_n") >= min_rows, F.concat_ws("/", F.lit("s"), F.length("_l").cast("string"), "_l", "_s"))
        .when(by_lang >= min_rows, F.concat_ws("/", F.lit("l"), "_l"))
        .otherwise(F.lit("all")).alias("cell"),
    )
    return lookup(rows, cut(names), ["_l", "_s"]).drop("_l", "_s")


def with_vectors(rows: DataFrame) -> DataFrame:
    """``v``: the transformed statistics (word length, symbols, repeated lines,
    repetitions of a window), each of about equal variance at every length;
    ``r``: the squares of what one more occurrence (a character, a symbol, a
    line, a window said again) changes."""
    n = F.col("n_words")
    rows = rows.withColumn("_len", F.col("word_chars") / n)
    middle = cut(rows.groupBy("cell").agg(F.percentile_approx("_len", 0.5, 10000).alias("_mid")))
    rows = lookup(rows, middle, "cell")
    v = F.array(
        (F.col("_len") - F.col("_mid")) * F.sqrt(n / (1 + n / LONG)),
        F.sqrt(100 * F.col("n_symbols") / n),
        F.sqrt(100 * F.col("n_dup_lines") / n),
        F.col("n_repeat_words") / (2 * GRAM) * F.sqrt(100 / n),
    )
    r = F.array(1 / (n * (1 + n / LONG)), 100 / n, 100 / n, 100 / n)
    return rows.withColumn("v", v).withColumn("r", r).drop("_len", "_mid")


def first_models(rows: DataFrame, starts: int) -> DataFrame:
    """Start 0 of every cell from medians and their absolute deviations; the
    others from hashed subsets (a cell in which a subset is empty has no such start)."""
    v = [F.element_at("v", i + 1) for i in range(DIMS)]
    middles = cut(rows.groupBy("cell").agg(F.count("*").alias("size"), F.array(*[F.percentile_approx(x, 0.5, 10000) for x in v]).alias("mean")))
    rows = lookup(rows, middles, "cell")
    off = [F.abs(x - F.element_at("mean", i + 1)) for i, x in enumerate(v)]
    spread = rows.groupBy("cell", "mean").agg(
        F.array(*[F.percentile_approx(x, 0.5, 10000) for x in off]).alias("mad"),
        F.array(*[F.avg(F.element_at("r", i + 1)) for i in range(DIMS)]).alias("res"),
    )
    scale = [F.pow(1.4826 * F.element_at("mad", i + 1), 2) + F.element_at("res", i + 1) for i in range(DIMS)]
    flat = [1 / scale[i] if i == j else F.lit(0.0) for i in range(DIMS) for j in range(DIMS)]
    medians = spread.select("cell", F.lit(0).alias("start"), "mean", F.array(*flat).alias("inverse"))
    drawn = F.filter(
        F.sequence(F.lit(1), F.lit(starts - 1)), lambda s: F.pmod(F.xxhash64(s, "v"), F.col("size")) < SUBSET
    )
    if starts < 2:
        return cut(medians)
    subsets = _models(_sums(rows.withColumn("start", F.explode(drawn))), 1.0)
    return cut(medians.unionByName(subsets.drop("logdet")))


def concentrate(rows: DataFrame, model: DataFrame, keep: float) -> DataFrame:
    """The models of the nearest ``keep`` of the rows under ``model``."""
    far = lookup(rows, model.select(*BY, "mean", "inverse"), BY).withColumn("d", distance()).drop("mean", "inverse")
    edge = cut(far.groupBy(*BY).agg(F.percentile_approx("d", keep, 10000).alias("edge")))
    return _models(_sums(lookup(far, edge, BY, "inner").filter("d <= edge")), consistency(keep))


def mcd(rows: DataFrame, keep: float = KEEP, steps: int = STEPS, starts: int = STARTS, rough: int = ROUGH) -> DataFrame:
    """The model of every cell of ``rows`` (``cell``, ``v``; without ``r`` nothing is added to the scatter)."""
    if "r" not in rows.columns:
        rows = rows.withColumn("r", F.array(*[F.lit(0.0)] * DIMS))
    rows = rows.select("cell", "v", "r")
    model = first_models(rows, starts)
    every = rows.withColumn("start", F.explode(F.sequence(F.lit(0), F.lit(starts - 1))))
    for _ in range(rough):
        model = concentrate(every, model, keep)
    if rough:
        best = model.groupBy("cell").agg(F.min(F.struct("logdet", "start")).alias("least"))
        model = cut(model.join(best, "cell").filter("start = least.start").drop("least"))
    rows = lookup(rows, cut(model.select(*BY)), "cell", "inner")
    for _ in range(steps):
        model = concentrate(rows, model, keep)
    near = lookup(rows, model, BY).filter(distance() <= chi2_quantile(REWEIGHT, DIMS))
    return _models(_sums(near), consistency(REWEIGHT))


def judge(docs: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Base statistics, ``base_failed`` and ``kept`` of every document.

    A null text has no words and fails. Ties at a quantile count as inside.
    Very long texts are counted whole. A cell that ends up without a model
    (none of its documents near any centre) keeps its documents.
    Equal rows are judged alike; null languages and sources are values of
    their own; an empty table gives no rows; other columns are left out.
    """
    n = F.col("n_words")
    base = cut(base_statistics(docs)).withColumn("base_failed", (n < 20) | (100 * F.col("n_repeat_words") > 30 * n))
    rows = cut(with_vectors(with_cells(base.filter(~F.col("base_failed")), min_rows)))
    model = mcd(rows)
    d = lookup(rows, model, "cell").withColumn("distance", distance())
    out = ["doc_id", *BASE, "base_failed", "kept", "distance"]
    passed = d.withColumn("kept", F.coalesce(F.col("distance") <= chi2_quantile(REJECT, DIMS), F.lit(True)))
    failed = base.filter("base_failed").withColumn("kept", F.lit(False)).withColumn("distance", F.lit(None).cast("double"))
    return passed.select(out).unionByName(failed.select(out))
