"""Mixing sources to target weights with soft membership.

A classifier fitted on the labelled table gives each document a posterior over domains. Non-negative document rates are
then fitted by least squares: they stay as near to 1 as they can (weighed by tokens) while the expected tokens of every
domain, the sum of rate * tokens * posterior, meet the targets. Each step is a projected gradient scaled by the K x K
Gauss-Newton matrix; as every iterate has the form clip(1 + posterior . step), only K numbers go to the executors, and
the sums come back from one aggregation.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .quality_model import D, statistics
from .quality_rules import MAX_LABELLED, labelled

#: Domains by the labelled table: good, low quality, toxic.
DOMAINS = ("good", "low", "toxic")
TARGETS = {"good": 0.97, "low": 0.02, "toxic": 0.01}
#: The rate that no document exceeds, and so the most tokens that a domain can be asked for.
MAX_RATE = 4.0
#: Words of the classifier, the fewest labelled texts that one is in, and what makes a weight count as strong.
VOCABULARY, MIN_WORD_DOCS, STRONG = 8192, 5, 1.0
RIDGE = 1e-3
MAX_STEPS = 60
TOLERANCE = 1e-7
_WORD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b"abcdefghijklmnopqrstuvwxyz" + b" " * 32)
K = len(DOMAINS)
X = D + 3 * (K - 1) + 1


def domain_of(quality: int | None, toxic: int | None) -> int:
    return 2 if toxic == 1 else 0 if quality == 1 else 1


def words_of(text: bytes) -> set[bytes]:
    """The text's different words, punctuation and case aside."""
    return set(text.translate(_WORD).split())


def _half(text: bytes) -> bool:
    """Labelled texts of one half give the word counts, those of the other fit the regression."""
    return bool(zlib.crc32(text) & 1)


def _word_counts(batches):
    n: list[Counter] = [Counter() for _ in range(K)]
    for batch in common.small(batches):
        for quality, toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), common.texts_of(batch.column(2))):
            if _half(text):
                n[domain_of(quality, toxic)].update([b"", *words_of(text)])  # the empty word counts documents
    words = list(set().union(*n))
    yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), *(pa.array([c[w] for w in words], pa.int64()) for c in n)], ["word", *(f"n{k}" for k in range(K))])


def word_weights(sample: DataFrame) -> dict[bytes, tuple[float, ...]]:
    """The VOCABULARY words that tell most, of those in MIN_WORD_DOCS texts or more. A weight is the log of a word's
    documents in a domain over those expected if it were as usual there as overall."""
    counts = sample.select("quality", "toxic", "text").mapInArrow(_word_counts, "word binary, " + ", ".join(f"n{k} long" for k in range(K)))
    counts = counts.groupBy("word").agg(*(F.sum(f"n{k}").alias(f"n{k}") for k in range(K)))
    counts = common.written(counts.withColumn("n", sum((F.col(f"n{k}") for k in range(1, K)), F.col("n0"))).filter(f"n >= {MIN_WORD_DOCS} or length(word) = 0"), "words")
    docs = counts.filter("length(word) = 0").first()
    if docs is None:
        return {}
    weight = [F.log((F.col(f"n{k}") + 1) / (F.col("n") * (docs[f"n{k}"] / docs.n) + 1)) for k in range(1, K)]
    tells = F.greatest(*(F.abs(w) for w in weight)) * F.sqrt("n")
    rows = counts.filter("length(word) > 0").orderBy(tells.desc(), "word").limit(VOCABULARY).select("word", *(w.alias(f"w{k}") for k, w in enumerate(weight)))
    return {bytes(r.word): tuple(r[1:]) for r in rows.collect()}


def vector(text: bytes, weight: dict[bytes, tuple[float, ...]]) -> list[float]:
    """A constant, the text's statistics, and for each domain but the first the sum of its words' weights, the largest
    weight, and how many are above STRONG."""
    words = words_of(text)
    own = np.array([weight[w] for w in words & weight.keys()], np.float64).reshape(-1, K - 1)
    sums = own.sum(0) / np.sqrt(len(words) + 1.0)
    top = own.max(0) if len(own) else np.zeros(K - 1)
    return [1.0, *statistics(text), *sums.tolist(), *top.tolist(), *np.log1p((own > STRONG).sum(0)).tolist()]


def _vectors(weight: dict):
    def run(batches):
        for batch in common.small(batches):
            texts = common.texts_of(batch.column(batch.num_columns - 1))
            rows = [(domain_of(q, t), vector(x, weight)) for q, t, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts) if not _half(x)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.float64()))], ["y", "x"])

    return run


class Posterior:
    """Multinomial logistic regression on standardised vectors, fitted by damped Newton steps with a ridge."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.mean, self.scale = x.mean(0), x.std(0)
        self.mean[0], self.scale[0] = 0, 1
        self.scale[self.scale < 1e-9] = 1
        z = self._z(x)
        self.w = np.zeros((K, X))
        want = np.eye(K)[y]
        reg = np.full(X, ridge)
        reg[0] = 1e-3
        for _ in range(30):
            p = self._p(z)
            grad = ((p - want).T @ z + reg * self.w).ravel()
            hess = np.zeros((K, X, K, X))
            for a in range(K):
                for b in range(K):
                    hess[a, :, b, :] = (z * (p[:, a] * ((a == b) - p[:, b]))[:, None]).T @ z
            step = np.linalg.solve(hess.reshape(K * X, K * X) + np.diag(np.tile(reg, K)), grad).reshape(K, X)
            self.w -= step / max(1.0, np.abs(step).max())
            if np.abs(step).max() < 1e-6:
                break

    def _z(self, x):
        return np.clip((x - self.mean) / self.scale, -10, 10)

    def _p(self, z):
        s = z @ self.w.T
        e = np.exp(s - s.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self._p(self._z(x))


def fit_posterior(sample: DataFrame) -> tuple[dict, Posterior | None]:
    """Word weights and the regression; None without labelled rows of two domains, when every document is the first's."""
    weight = word_weights(sample)
    rows = sample.select("quality", "toxic", "text").mapInArrow(_vectors(weight), "y long, x array<double>").collect()  # a bounded sample
    y = np.array([r.y for r in rows], np.int64)
    if len(np.unique(y)) < 2:
        return weight, None
    return weight, Posterior(np.array([r.x for r in rows]), y)


#: The golden ratio's part: its multiples fill 0 to 1 evenly.
_GOLDEN = 0.6180339887498949


class Uniform:
    """A number from 0 to 1 for each row of a task, by hash of its id and text; rows that repeat one move on by the golden
    ratio, so they aren't all rounded alike."""

    def __init__(self):
        self.seen: Counter = Counter()

    def __call__(self, doc: int | None, text: bytes) -> float:
        h = xxhash.xxh64_intdigest(text, seed=xxhash.xxh64_intdigest(b"" if doc is None else b"%d" % doc))
        k = self.seen[h]
        self.seen[h] += 1
        return ((h >> 11) / (1 << 53) + k * _GOLDEN) % 1.0


def posteriors(docs: DataFrame, weight: dict, model: Posterior | None, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_tokens, p_<domain>..., uniform), with carry also text and those, of docs; tokens are words between
    white space."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    more = ["text", *carry] if carry else []
    names = ["doc_id", "n_tokens", *(f"p_{k}" for k in DOMAINS), "uniform"]
    schema = ", ".join(["doc_id long, n_tokens long", *(f"p_{k} double" for k in DOMAINS), "uniform double", *(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in more)])

    def run(batches):
        uniform = Uniform()
        for batch in common.small(batches):
            texts = common.texts_of(batch.column(1))
            if model is None:
                p = np.tile(np.eye(K)[0], (len(texts), 1))
            else:
                p = model(np.array([vector(x, weight) for x in texts]).reshape(-1, X))
            own = [uniform(i, x) for i, x in zip(batch.column(0).to_pylist(), texts)]
            columns = [batch.column(0), pa.array([len(x.split()) for x in texts], pa.int64()), *(pa.array(p[:, k]) for k in range(K)), pa.array(own, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns + batch.columns[1:] if more else columns, names + more)

    return rows.mapInArrow(run, schema)


def _rate(step: np.ndarray):
    r = F.lit(1.0)
    for k, v in zip(DOMAINS, step):
        r = r + F.col(f"p_{k}") * F.lit(float(v))
    return F.least(F.greatest(r, F.lit(0.0)), F.lit(MAX_RATE))


def _sums(rows: DataFrame, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens by domain, and their derivative by step."""
    rate = _rate(step)
    free = ((rate > 0) & (rate < MAX_RATE)).cast("double") * F.col("n_tokens")
    first = [F.sum(rate * F.col("n_tokens") * F.col(f"p_{k}")) for k in DOMAINS]
    second = [F.sum(free * F.col(f"p_{a}") * F.col(f"p_{b}")) for a in DOMAINS for b in DOMAINS]
    got = np.array([float(v or 0) for v in rows.agg(*(c.alias(f"c{i}") for i, c in enumerate(first + second))).first()])
    return got[:K], got[K:].reshape(K, K)


def reachable(natural: np.ndarray, targets: dict[str, float]) -> np.ndarray:
    """Tokens asked of each domain: its share of all tokens, of a domain with too few the most that MAX_RATE / 2 allows,
    the rest shared out among the others; all are scaled up if the first domain would else lose tokens."""
    share = np.array([targets.get(k, 0.0) for k in DOMAINS])
    share = share / share.sum()
    total, most = natural.sum(), natural * (MAX_RATE / 2)
    want = share * total
    for _ in range(K):
        over = want > most
        if not over.any() or not (share[~over].sum() > 0):
            break
        want[over] = most[over]
        want[~over] = share[~over] / share[~over].sum() * (total - want[over].sum())
    want = np.minimum(want, most)
    return want * max(1.0, natural[0] / want[0]) if want[0] > 0 else want


def fit_rates(rows: DataFrame, targets: dict[str, float]) -> np.ndarray:
    """The step whose rates meet the reachable targets, or come as near as least squares can; zeros without tokens."""
    step = np.zeros(K)
    got, slope = _sums(rows, step)
    total = got.sum()
    if not total:
        return step
    want = reachable(got, targets)
    loss = lambda got, step: float((((got - want) / total) ** 2).sum() + RIDGE * TOLERANCE * (step**2).sum())
    now = loss(got, step)
    for _ in range(MAX_STEPS):
        if np.abs(got - want).max() <= TOLERANCE * total:
            break
        h = slope / total
        move = np.linalg.solve(h.T @ h + RIDGE * TOLERANCE * np.eye(K), h.T @ ((want - got) / total) - RIDGE * TOLERANCE * step)
        size = 1.0
        while size > 1e-3:
            new = step + size * move
            got_new, slope_new = _sums(rows, new)
            if (after := loss(got_new, new)) < now:
                break
            size /= 4
        else:
            break
        gain = now - after
        step, got, slope, now = new, got_new, slope_new, after
        if gain <= 1e-3 * now and now < 1e-9 or gain < 1e-15:
            break
    return step


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, max_rows: int = MAX_LABELLED, carry: tuple[str, ...] = ()) -> DataFrame:
    """posteriors of docs with the rate of each. Posteriors are written once; the steps read their columns alone."""
    common.prepare(docs.sparkSession)
    with common.scratch():
        weight, model = fit_posterior(labelled(docs, labels, max_rows))
    rows = common.written(posteriors(docs, weight, model, carry), "posteriors")
    return rows.withColumn("rate", _rate(fit_rates(rows, targets or TARGETS)))


def copies(rate):
    """Whole copies with the rate as their mean, the same on every run over the same files."""
    return F.floor(rate + F.col("uniform")).cast("long")


def totals(rates: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """(domain, natural, asked, aimed, expected, drawn) of document_rates' rows: a domain's tokens as they are, as the
    targets ask of all tokens, as they can be had (see reachable), as the rates make them, and as the whole copies do.
    Where aimed differs from asked, the target is out of reach. No rows: zeros."""
    t = [[F.sum(x * F.col("n_tokens") * F.col(f"p_{k}")) for k in DOMAINS] for x in (F.lit(1.0), F.col("rate"), F.col("copies"))]
    got = np.array([float(v or 0) for v in rates.agg(*(c.alias(f"c{i}") for i, c in enumerate(sum(t, [])))).first()]).reshape(3, K)
    share = np.array([(targets or TARGETS).get(k, 0.0) for k in DOMAINS])
    aimed = reachable(got[0], targets or TARGETS)
    rows = [(k, *map(float, (got[0, i], share[i] / share.sum() * got[0].sum(), aimed[i], got[1, i], got[2, i]))) for i, k in enumerate(DOMAINS)]
    return rates.sparkSession.createDataFrame(rows, "domain string, natural double, asked double, aimed double, expected double, drawn double")


def document_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, max_rows: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, n_tokens, p_<domain>..., rate, copies) for every row of docs (doc_id, text).

    Null and empty texts have no tokens: they take a rate but move no total. Repeated rows count each. A null doc_id is
    kept as null. Repeated rows are rounded one by one. Labels need doc_id, quality and toxic; a null toxic is 0, rows with a null quality are left out, and of
    a document's labels the worst counts.
    Without labels of two domains every document is of the first one. An empty table gives no rows.
    """
    return mixed(docs, labels, targets, max_rows).withColumn("copies", copies(F.col("rate"))).drop("uniform")


def remix(docs: DataFrame, labels: DataFrame, carry: tuple[str, ...], targets: dict[str, float] | None = None, max_rows: int = MAX_LABELLED) -> DataFrame:
    """docs (doc_id, text, *carry), each row as often as its copies say. Texts lie beside their posteriors, so they aren't
    shuffled.

    Null and empty texts take a rate like others; null ids and repeated rows are rounded one by one; texts count whole;
    columns that carry doesn't name are left out. No rows: none.
    """
    rows = mixed(docs, labels, targets, max_rows, carry).withColumn("_copies", copies(F.col("rate"))).filter("_copies > 0")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("doc_id", "text", *carry)


def op4_mixing(spark, sf_dir):
    """Every document's posterior, rate and copies. Null, empty, repeated, long and missing rows: see document_rates."""
    return document_rates(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
