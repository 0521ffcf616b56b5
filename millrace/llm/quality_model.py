"""Quality classifier: quadratic discriminant over transformed document statistics with shrunk class covariances.

Class means and covariances are sums over all labelled training rows, added up by the executors. A class's covariance is
shrunk towards the diagonal of the pooled one; its Cholesky factor is computed once and reused for every row, so a score
is a difference of two Mahalanobis log-densities (per statistic), mapped to 0..1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SHRINK = 0.2
FLOOR = 1e-4
THRESHOLD = 0.7
#: Margins are clipped to +-RANGE; BINS of them place the threshold.
RANGE, BINS = 30.0, 4096

_KIND = np.full(256, 6, np.int64)  # 6: any other ASCII
for _k, _set in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\n\r\x0b\x0c", b".,;:'-", b"#*$%&<>")):
    _KIND[list(_set)] = _k
_KIND[0x80:] = 7
_KIND[ord("!")] = 8
_KIND[ord("|")] = 9
STATISTICS = ("words", "word_length", "upper", "digits", "space", "points", "symbols", "other", "high", "exclamation", "pipes", "same_as_last", "distinct", "dup_lines", "entropy")
D = len(STATISTICS)


def statistics(text: bytes) -> list[float]:
    """STATISTICS of one text; shares go through a square root and counts through a logarithm. Empty: all zero."""
    if not text:
        return [0.0] * D
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = len(text)
    kinds = np.bincount(_KIND, weights=hist, minlength=10)
    letters = max(1.0, kinds[0] + kinds[1] + kinds[7])
    words = text.split()
    n = len(words)
    lines = [x for x in text.split(b"\n") if x]
    p = hist[hist > 0] / size
    root = lambda x: float(x) ** 0.5
    return [
        float(np.log1p(n)), min(50.0, (size - float(kinds[3])) / max(1, n)), root(kinds[0] / letters), root(kinds[2] / size), root(kinds[3] / size), root(kinds[4] / size),
        root(kinds[5] / size), root(kinds[6] / size), root(kinds[7] / size), root(kinds[8] / size), root(kinds[9] / size),
        root(sum(map(bytes.__eq__, words, words[1:])) / n) if n else 0.0, len(set(words)) / (n + 8.0), root(1 - len(set(lines)) / len(lines)) if lines else 0.0, float(-(p * np.log2(p)).sum()),
    ]


def _features(batches):
    for batch in common.small(batches):
        rows = np.array([statistics(x) for x in common.texts_of(batch.column(1))], np.float64).reshape(-1, D)
        values = pa.ListArray.from_arrays(pa.array(np.arange(0, D * len(rows) + 1, D, dtype=np.int32)), pa.array(rows.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column(0), values], ["doc_id", "x"])


def features(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_features, "doc_id long, x array<double>")


def _sums(batches):
    out = np.zeros((2, 1 + D + D * D))
    for batch in batches:
        y = batch.column(0).to_numpy(zero_copy_only=False)
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, D)
        for c in (0, 1):
            own = x[y == c]
            out[c] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
    k = out.shape[1]
    yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], k)), pa.array(np.tile(np.arange(k), 2)), pa.array(out.ravel())], ["y", "k", "v"])


class Discriminant:
    """Two Gaussian classes. A class without rows takes the pooled mean; without any rows every score is 0.5."""

    def __init__(self, sums: np.ndarray, shrink: float = SHRINK):
        n = sums[:, 0]
        self.known = bool((n > 0).all())
        self.shift = 0.0
        total = max(1.0, n.sum())
        pooled_mean = sums[:, 1 : 1 + D].sum(0) / total
        pooled = np.diag(sums[:, 1 + D :].sum(0).reshape(D, D) / total - np.outer(pooled_mean, pooled_mean)).clip(0)
        self.prior = float(np.log((n[1] + 1) / (n[0] + 1)))
        self.parts = []
        for c in (0, 1):
            m = sums[c, 1 : 1 + D] / n[c] if n[c] else pooled_mean
            s = sums[c, 1 + D :].reshape(D, D) / n[c] - np.outer(m, m) if n[c] else np.diag(pooled)
            s = (1 - shrink) * s + np.diag(shrink * pooled + FLOOR)
            low = np.linalg.cholesky((s + s.T) / 2)
            self.parts.append((m, np.linalg.inv(low), float(np.log(np.diag(low)).sum())))

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log-density difference plus log prior ratio, per statistic, within RANGE."""
        if not self.known:
            return np.zeros(len(x))
        log = [-0.5 * (((x - m) @ inverse.T) ** 2).sum(1) - det for m, inverse, det in self.parts]
        return np.clip((log[1] - log[0] + self.prior) / D, -RANGE, RANGE)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.margins(x) + self.shift)))


def fit(x: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, shrink: float = SHRINK) -> Discriminant:
    """Sums over all rows of labels (doc_id, quality 0 or 1) that x has; the narrow statistics are joined, not texts.

    Then scores are shifted so that `threshold` lies where the training rows' classes part best, by a histogram of their
    margins (BINS bins a class reach the driver).
    """
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.min("y").alias("y"))
    known = x.join(y, "doc_id").select("y", "x")
    rows = known.mapInArrow(_sums, "y long, k long, v double").groupBy("y", "k").agg(F.sum("v").alias("v")).collect()
    sums = np.zeros((2, 1 + D + D * D))
    for r in rows:
        sums[r.y, r.k] = r.v
    model = Discriminant(sums, shrink)
    if not model.known:
        return model

    def bins(batches):
        for batch in batches:
            m = model.margins(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, D))
            at = np.minimum(((m + RANGE) * (BINS / (2 * RANGE))).astype(np.int64), BINS - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(at)], ["y", "bin"])

    hist = np.zeros((2, BINS))
    for r in known.mapInArrow(bins, "y long, bin long").groupBy("y", "bin").count().collect():
        hist[r.y, r.bin] = r["count"]
    share = np.cumsum(hist, 1) / hist.sum(1, keepdims=True)
    cost = share[1] + (1 - share[0])  # good rows at or below a bin, bad rows above it
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    runs = np.split(best, np.flatnonzero(np.diff(best) > 1) + 1)
    widest = max(runs, key=len)
    cut = (widest[0] + widest[-1] + 2) / 2 * (2 * RANGE / BINS) - RANGE
    model.shift = float(np.log(threshold / (1 - threshold)) - cut)
    return model


def quality_scores(docs: DataFrame, train: DataFrame, threshold: float = THRESHOLD, shrink: float = SHRINK) -> DataFrame:
    """(doc_id, score, predicted) for every row of docs (doc_id, text), learned from train (doc_id, quality).

    A null or empty text has zero statistics and is scored by them. Repeated rows get equal scores; a repeated label
    counts once, of several the worst; labels other than 0 and 1 and labels without a document are left out. Very long texts count whole.
    Without rows of both classes every score is 0.5. An empty table gives no rows.
    """
    common.prepare(docs.sparkSession)
    x = common.written(features(docs), "statistics")
    model = fit(x, train, threshold, shrink)

    def score(batches):
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, D)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(values))], ["doc_id", "score"])

    return x.mapInArrow(score, "doc_id long, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op9_quality_model(spark, sf_dir):
    """Every document's score, learned from labels of three quarters of the ids. Null, empty, repeated, long and missing
    rows: see quality_scores. A null doc_id isn't held out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    labels = common.table(spark, sf_dir, "labels").filter(~held_out)
    rows = quality_scores(common.table(spark, sf_dir, "documents"), labels)
    return rows.select("doc_id", held_out.alias("held_out"), "score", "predicted")
