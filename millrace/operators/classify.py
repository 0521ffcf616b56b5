"""A text classifier of MLlib stages, its probabilities and decisions; and a stop-word language guess."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import IDF, HashingTF, IndexToString, NGram, RegexTokenizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STOP_WORDS = {
    "deu": "der die das und ist nicht ein eine mit für auf dem den von zu im in".split(),
    "eng": "the of and to in is that for it with as was on are by this from".split(),
    "fra": "le la les de des et en un une que est pour dans du au sur qui".split(),
    "por": "o a os as de do da e em um uma que para com não por no na".split(),
    "spa": "el la los las de y en un una que es por con para del no se".split(),
}


def training_rows(rows: DataFrame, least: int = 30, least_per_class: int = 10) -> DataFrame:
    """Rows labelled 0 or 1; too few of them are an error."""
    rows = rows.withColumn("label", F.col("label").try_cast("double")).filter("label in (0, 1) and text is not null")
    n = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if sum(n.values()) < least or min(n.get(0.0, 0), n.get(1.0, 0)) < least_per_class:
        raise ValueError(f"too few labelled rows: {n}")
    return rows


def fit(rows: DataFrame, features: int = 1 << 16) -> PipelineModel:
    """Words and pairs of words, weighted by rarity, into a logistic regression."""
    stages = [
        RegexTokenizer(inputCol="text", outputCol="_words", pattern="\\s+"), NGram(n=2, inputCol="_words", outputCol="_pairs"),
        HashingTF(numFeatures=features, inputCol="_words", outputCol="_tf1"), HashingTF(numFeatures=features, inputCol="_pairs", outputCol="_tf2"),
        VectorAssembler(inputCols=["_tf1", "_tf2"], outputCol="_tf"), IDF(inputCol="_tf", outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol="label", maxIter=30, regParam=0.01),
    ]
    return Pipeline(stages=stages).fit(rows)


def predict(model: PipelineModel, rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """model_prob and model_positive; rows without text get null and false."""
    blank = F.length(F.coalesce("text", F.lit(""))) == 0
    out = model.transform(rows.withColumn("text", F.coalesce("text", F.lit(""))))
    out = out.withColumn("model_prob", F.when(~blank, vector_to_array("probability")[1].cast("float")))
    return out.withColumn("model_positive", F.coalesce(F.col("model_prob") >= threshold, F.lit(False))).drop("_words", "_pairs", "_tf1", "_tf2", "_tf", "_features", "rawPrediction", "probability", "prediction")


def guess_language(c, head: int = 3000, least: int = 50):
    """The language with the most stop words among the first characters; short texts are unknown, ties go by name."""
    words = F.split(F.lower(F.left(F.coalesce(c, F.lit("")), F.lit(head))), r"[^\p{L}]+")
    known = F.filter(words, lambda w: w.isin(sorted(set().union(*STOP_WORDS.values()))))
    count = lambda ws, lang: F.size(F.filter(ws, lambda w: w.isin(STOP_WORDS[lang])))
    # an array of one: what a lambda takes is made once, however often its body names it
    best = F.transform(F.array(known), lambda ws: F.array_max(F.array(*(F.struct(count(ws, k).alias("n"), F.lit(-i).alias("i"), F.lit(k).alias("k")) for i, k in enumerate(sorted(STOP_WORDS))))))
    told = F.transform(best, lambda b: F.when(b["n"] > 0, b["k"]).otherwise("unknown"))
    return F.when(F.length(F.coalesce(c, F.lit(""))) < least, "unknown").otherwise(told[0])


#: Characters that a language is told by, and texts that are too short for it.
HEAD, LEAST = 3000, 50
#: Labelled texts that the language model is fitted on: the first by hash.
MAX_TEXTS = 50_000


def _letters(c):
    """Lower-case letters and single spaces, of the first HEAD characters."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(F.left(F.coalesce(c, F.lit("")), F.lit(HEAD))), r"[^\p{L}]+", " "), F.lit(" "))


def fit_languages(rows: DataFrame, features: int = 1 << 16, n: int = 3, most: int = MAX_TEXTS) -> PipelineModel:
    """A multinomial naive Bayes model over hashed n-grams of letters, of rows (text, lang). Texts under LEAST characters
    and rows without a language are left out. It is fitted on `most` texts at most; it is applied to any number."""
    rows = rows.filter(f"lang is not null and length(text) >= {LEAST}")
    total = rows.count()
    if total > most:
        rows = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 40)) < int((1 << 40) * most / total))
    labels = StringIndexer(inputCol="lang", outputCol="_y", stringOrderType="alphabetAsc").fit(rows)
    stages = [
        RegexTokenizer(inputCol="_letters", outputCol="_chars", pattern="", toLowercase=False, minTokenLength=0), NGram(n=n, inputCol="_chars", outputCol="_grams"),
        HashingTF(numFeatures=features, inputCol="_grams", outputCol="_x"), NaiveBayes(featuresCol="_x", labelCol="_y", predictionCol="_p", rawPredictionCol="_r", probabilityCol="_q"),
    ]
    model = Pipeline(stages=stages).fit(labels.transform(rows.withColumn("_letters", _letters(F.col("text")))))
    return PipelineModel([*model.stages, IndexToString(inputCol="_p", outputCol="language", labels=labels.labels)])


def languages_of(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """rows (text, ...) with language; null and short texts are unknown."""
    out = model.transform(rows.withColumn("_letters", _letters(F.col("text"))))
    short = F.length(F.coalesce("text", F.lit(""))) < LEAST
    return out.withColumn("language", F.when(short, "unknown").otherwise(F.col("language"))).drop("_letters", "_chars", "_grams", "_x", "_p", "_r", "_q")


def squash(score):
    return F.round(1 / (1 + F.exp(-score / 50)), 3)
