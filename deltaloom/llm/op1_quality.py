"""Quality classifier: Bradley-Terry ranking from preference pairs, thresholded by a score quantile.

A document of label 1 is preferred over one of label 0. Scores are linear in features of the text alone; their
weights minimise the logistic loss on feature differences of pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SEPARATOR, slices, text_or_empty, tidy, utf8

#: Labelled rows of each label that the fit takes: the bound of the training sample, drawn by a hash of doc_id.
SAMPLE = 3000
#: Preference pairs, gradient steps and ridge penalty of the fit.
PAIRS, STEPS, RIDGE = 20_000, 400, 1e-3

UPPER, LOWER, DIGIT = (np.zeros(256, bool) for _ in range(3))
UPPER[65:91], LOWER[97:123], DIGIT[48:58] = True, True, True
WIDE = np.arange(256) >= 128
MARK = ~(UPPER | LOWER | DIGIT | WIDE | SEPARATOR)


def features(data: np.ndarray) -> np.ndarray:
    """Features of one text's UTF-8 bytes: shares of each byte, and shape of words, marks and lines."""
    n = len(data)
    count = np.bincount(data, minlength=256).astype(np.float64)
    inside = ~SEPARATOR[data]
    words = int(np.count_nonzero(inside[1:] & ~inside[:-1]) + (n > 0 and inside[0]))
    mark, upper = MARK[data], UPPER[data]
    runs = int(np.count_nonzero(mark[1:] & mark[:-1]))
    wrap = int(np.count_nonzero(upper[1:] & upper[:-1]))
    after = int(np.count_nonzero(mark[:-1] & ~inside[1:])) if n else 0
    lines = count[10] + 1
    some = max(n, 1)
    shape = [np.log1p(n) / 10, np.log1p(words) / 10, inside.sum() / max(words, 1) / 20, runs / some, wrap / some, after / max(words, 1), upper.sum() / some, mark.sum() / some, DIGIT[data].sum() / some, WIDE[data].sum() / some, np.log1p(n / lines) / 10, n == 0]
    return np.concatenate([np.sqrt(count / some), np.array(shape, np.float64)])


WIDTH = len(features(np.zeros(0, np.uint8)))


def _features(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            data, at = utf8(part.column("text"))
            rows = [features(data[at[i] : at[i + 1]]).astype(np.float32) for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([part.column("quality"), pa.array(rows, pa.list_(pa.float32()))], names=["quality", "x"])


def held_out(doc_id: Column) -> Column:
    """Rows that the fit never sees: crc32 of the doc_id as text leaves 1 modulo 3; false for a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Model:
    """score = logistic((x . w - cut) / scale) on standardised features; cut is a quantile of training scores."""

    def __init__(self, mean, spread, weights, cut, scale):
        self.mean, self.spread, self.weights, self.cut, self.scale = mean, spread, weights, cut, scale

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (((x - self.mean) / self.spread) @ self.weights - self.cut) / self.scale
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_pairs(x: np.ndarray, y: np.ndarray, share: float, seed: int = 5) -> Model:
    """Bradley-Terry weights of features x with labels y; share is that of label 0 among all labelled rows."""
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Model(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1]), 0.0, 1.0)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - mean) / spread
    i, j = rng.choice(good, PAIRS), rng.choice(bad, PAIRS)
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, STEPS + 1):
        take = rng.integers(0, PAIRS, 2048)
        d = z[i[take]] - z[j[take]]
        g = -(d * (1 / (1 + np.exp(np.clip(d @ w, -500, 500))))[:, None]).mean(axis=0) + RIDGE * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    s = z @ w
    order = np.argsort(s, kind="stable")
    weight = np.where(y == 1, (1 - share) / len(good), share / len(bad))[order]
    k = int(np.searchsorted(np.cumsum(weight), share - 1e-9)) + 1
    ranked = s[order]
    cut = (ranked[min(k, len(s)) - 1] + ranked[min(k, len(s) - 1)]) / 2
    return Model(mean, spread, w, cut, max(float(s.std()) / 4, 1e-6))


def drawn(known: DataFrame, sample: int) -> DataFrame:
    """The sample rows of each label of lowest hash; every task keeps its lowest, so that none sorts a whole label."""
    lowest = lambda q: known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return lowest(0).unionAll(lowest(1))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most sample rows of each label; rows that held_out() names are left out, as are null labels."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id"))).distinct()
    counts = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    few = drawn(known, sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).join(F.broadcast(few), "doc_id")  # 2 * sample rows at most
    one = texts.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = one.select("text", "quality").mapInArrow(tidy(_features), "quality int, x array<float>").collect()
    rows.sort(key=lambda r: (r["quality"], list(r["x"])))
    x = np.array([r["x"] for r in rows], np.float64).reshape(len(rows), WIDTH)
    return fit_pairs(x, np.array([r["quality"] for r in rows], np.int64), counts.get(0, 0) / max(sum(counts.values()), 1))


def _score(model: Model, keep_only: bool):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                data, at = utf8(part.column("text"))
                x = np.stack([features(data[at[i] : at[i + 1]]) for i in range(part.num_rows)])
                s = model.score(x)
                if keep_only:
                    yield part.filter(pa.array(s >= 0.5))
                else:
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (score >= 0.5) of every row of docs.

    Null texts count as empty; empty texts get a score like others. Without labels of both kinds every score is 0.5.
    Texts are read whole, however long. Repeated rows are scored each; other columns, whatever their names, are ignored.
    An empty table gives no rows. A repeated document with both labels is learned under both. labels, lang, source and doc_id are no inputs of a score.
    """
    model = fit(docs, labels, sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")).mapInArrow(tidy(_score(model, False)), "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs, with all columns, whose score is 0.5 or more."""
    model = fit(docs, labels, sample)
    return docs.mapInArrow(tidy(_score(model, True)), docs.schema)
