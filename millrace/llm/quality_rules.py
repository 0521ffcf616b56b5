"""Quality rules: base counts, then a hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Two multinomials over 2**16 hashed byte 4-grams: the raw one counts every 4-gram of every document; the trusted one
counts those of the labelled rows with quality 1 that are not toxic. A document's score is the mean over its 4-grams of
log p_target - log p_raw, so it is normalised by length, and it stays if the score reaches the threshold.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BUCKETS = 1 << 16
#: Labelled rows (the first by hash of the id) that op4's classifier is fitted on.
MAX_LABELLED = 20_000
#: Pseudo-4-grams that the trusted multinomial takes from the raw one.
PRIOR = 4096.0
#: Weights are whole multiples of 1 / UNIT, so their sums are exact: a score depends on nothing but its text.
UNIT = 1 << 24
#: Pieces of a unit of the score by which the labelled rows are counted for the threshold.
STEPS = 1 << 14
SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all 4-grams, which of them lie within one text, and the texts' offsets."""
    data, offsets = common.joined(texts)
    if len(data) < 4:
        return np.zeros(0, np.uint16), np.zeros(0, bool), offsets
    d = data.astype(np.uint32)
    code = d[:-3] | d[1:-2] << np.uint32(8) | d[2:-1] << np.uint32(16) | d[3:] << np.uint32(24)
    code *= np.uint32(0x9E3779B1)
    inside = np.ones(len(code), bool)
    ends = offsets[1:]
    for back in (1, 2, 3):
        at = ends - back
        inside[at[(at >= 0) & (at < len(code))]] = False
    return (code >> np.uint32(16)).astype(np.uint16), inside, offsets


def _count(batches):
    counts = np.zeros(BUCKETS, np.int64)
    for batch in common.small(batches):
        texts = common.texts_of(batch.column(0))
        for a, b in common.pieces(texts):
            code, inside, _ = grams(texts[a:b])
            counts += np.bincount(code[inside], minlength=BUCKETS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["bucket", "n"])


def counts(docs: DataFrame) -> np.ndarray:
    """4-grams by bucket over all of docs: summed by map task, then by bucket; 2**16 numbers reach the driver."""
    rows = docs.select("text").mapInArrow(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.float64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def weights(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log p_target - log p_raw by bucket, in units of 1 / UNIT. Without target or raw counts: zero."""
    if not target.sum() or not raw.sum():
        return np.zeros(BUCKETS, np.int64)
    p_raw = (raw + 0.5) / (raw.sum() + 0.5 * BUCKETS)
    p_target = (target + PRIOR * p_raw) / (target.sum() + PRIOR)
    return np.rint(np.log(p_target / p_raw) * UNIT).astype(np.int64)


def scores(texts: list[bytes], weight: np.ndarray) -> np.ndarray:
    """Mean weight of each text's 4-grams; 0 for a text without any. The same whatever texts stand beside it."""
    code, inside, offsets = grams(texts)
    if not len(code):
        return np.zeros(len(texts))
    w = np.where(inside, weight[code], 0)
    total = np.concatenate([[0], np.cumsum(w)])
    end = np.minimum(offsets, len(w))
    n = np.maximum(np.diff(offsets) - 3, 0)
    return np.where(n > 0, (total[end[1:]] - total[end[:-1]]) / np.maximum(n * UNIT, 1), 0.0)


def base(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()  # of bytes: at 0x20 and 0x09 to 0x0D, no other
    n = len(words)
    chars = sum(map(len, words)) - (len(text) - len(text.translate(None, CONTINUATION)) if not text.isascii() else 0)
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    dup = len(lines) - len(set(lines))
    repeat = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        seen = set(windows)
        if len(seen) < len(windows):
            often = Counter(windows)
            last = 0
            for i, w in enumerate(windows):
                if often[w] > 1:
                    repeat += i + 3 - max(i, last)
                    last = i + 3
    return n, chars, symbols, dup, repeat


def _rows(weight: np.ndarray):
    def run(batches):
        for batch in common.small(batches):
            texts = common.texts_of(batch.column(1))
            stats = np.array([base(x) for x in texts], np.int64).reshape(-1, 5)
            score = np.concatenate([scores(texts[a:b], weight) for a, b in common.pieces(texts)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(stats[:, k]) for k in range(5)), pa.array(score)], names)

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"]
    return run


def threshold(low: np.ndarray, high: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """Of steps of the score in order (the lowest and highest score, and the labelled rows of each kind): the middle of
    the widest of the gaps between steps that leave fewest labelled rows on the wrong side, each side weighed by its
    number and a wrongly dropped good row ten times as much. Without good or bad rows: everything stays."""
    if not good.sum() or not bad.sum():
        return float("-inf")
    lost = (np.cumsum(good) - good) / good.sum()
    passed = 1 - (np.cumsum(bad) - bad) / bad.sum()
    cost = 10 * lost + passed
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    below = np.where(best > 0, high[np.maximum(best - 1, 0)], low[best])
    k = int(np.argmax(low[best] - below))
    return float((low[best[k]] + below[k]) / 2)


def marks(labels: DataFrame) -> DataFrame:
    """(doc_id, quality, toxic), a row for each doc_id: of several labels the worst counts, a null toxic being 0. Labels
    without a doc_id or a quality are left out."""
    rows = labels.selectExpr("cast(doc_id as long) doc_id", "quality", "coalesce(toxic, 0) toxic").filter("doc_id is not null and quality is not null")
    return rows.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))


def known(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(quality, toxic, text) of all labelled documents."""
    rows = marks(labels)
    docs = docs.selectExpr("cast(doc_id as long) doc_id", "text").filter("doc_id is not null")
    return common.join_lookup(docs, rows, "doc_id", "labels").filter("quality is not null").select("quality", "toxic", "text")


def labelled(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_LABELLED) -> DataFrame:
    """(quality, toxic, text) of at most max_rows labelled documents, the same ones on every run. That bound makes the
    label side fit for a broadcast, so texts aren't shuffled."""
    rows = common.first_by_hash(marks(labels), max_rows, "doc_id")
    return common.written(docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").select("quality", "toxic", "text"), "labelled")


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, counts, score, base_failed and kept for each row of docs (doc_id, text).

    Null and empty texts have no words, so base_failed. Repeated rows and ids are judged one by one, each giving a row;
    a null doc_id stays null. An empty table gives no rows. Of a document's labels the worst counts. Without usable labels the method's verdict is to keep.
    """
    weight, least = fit(docs, labels)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(_rows(weight), SCHEMA)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= F.lit(least)))


def kept_documents(docs: DataFrame, labels: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """The rows of docs that quality_rules keeps: (doc_id, text, *carry), decided beside the texts, without a shuffle.

    Null, empty and other texts of under 50 words go, so no rows may be left; null ids and repeated rows are judged one
    by one; columns that carry doesn't name are left out.
    """
    weight, least = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)

    def run(batches):
        for batch in common.small(batches):
            texts = common.texts_of(batch.column(1))
            score = np.concatenate([scores(texts[a:b], weight) for a, b in common.pieces(texts)] or [np.zeros(0)])
            stays = [s >= least and (n := base(x))[0] >= 50 and 100 * n[4] <= 50 * n[0] for x, s in zip(texts, score.tolist())]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return rows.mapInArrow(run, rows.schema)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """The weights of 4-grams and the least score to keep."""
    common.prepare(docs.sparkSession)
    with common.scratch():
        judged = known(docs, labels)
        trusted = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
        weight = weights(counts(judged.filter(trusted)), counts(docs))

        def score_of(batches):
            for batch in common.small(batches):
                texts = common.texts_of(batch.column(1))
                score = np.concatenate([scores(texts[a:b], weight) for a, b in common.pieces(texts)] or [np.zeros(0)])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["quality", "score"])

        rows = judged.selectExpr("cast(quality as long) quality", "text").mapInArrow(score_of, "quality long, score double")
        ones = [F.sum((F.col("quality") == q).cast("long")).alias(name) for name, q in (("good", 1), ("bad", 0))]
        steps = rows.filter("quality in (0, 1)").groupBy(F.floor(F.col("score") * STEPS).alias("step")).agg(F.min("score").alias("low"), F.max("score").alias("high"), *ones)
        steps = steps.toPandas().sort_values("step")  # STEPS a unit of the score at most
    return weight, threshold(*(steps[c].to_numpy() for c in ("low", "high", "good", "bad")))


def op3_quality_rules(spark, sf_dir):
    """Every document's counts, score and verdict. Null, empty, repeated, long and missing rows: see quality_rules."""
    return quality_rules(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
