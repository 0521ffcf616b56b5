"""Counts, rates and scores by event, reason and model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ordinal

def reason_counts(rejects: DataFrame) -> DataFrame:
    """How often each single reason occurs; joined ones are taken apart."""
    one = rejects.filter("reject_reason <> ''").select(F.explode(F.split("reject_reason", ", ")).alias("reason"))
    return one.groupBy("reason").agg(F.count("*").alias("n"))


def reason_shares(rejects: DataFrame) -> DataFrame:
    counts = rejects.groupBy("reject_reason").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 4))


def rates(rows: DataFrame, by: str, flags: list[str]) -> DataFrame:
    """Rows and the share of each flag, nulls as false."""
    return rows.groupBy(by).agg(F.count("*").alias("n"), *(F.round(F.avg(F.coalesce(F.col(f), F.lit(False)).cast("int")), 4).alias(f"{f}_rate") for f in flags))


def duplicate_rates(rows: DataFrame, by: str, alarm: float = 0.7) -> DataFrame:
    out = rates(rows, by, ["is_content_duplicate"])
    return out.withColumn("above_alarm", F.col("is_content_duplicate_rate") > alarm)


def classification(rows: DataFrame, label: str, predicted: str) -> DataFrame:
    """One row: tp, fp, fn, tn, precision, recall, f1, accuracy."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    c = rows.filter(F.col(label).isin(0, 1)).agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    div = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    c = c.withColumn("precision", div(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", div(F.col("tp"), F.col("tp") + F.col("fn")))
    c = c.withColumn("f1", div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).withColumn("accuracy", div(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")))
    return c.select("tp", "fp", "fn", "tn", *(F.round(x, 6).alias(x) for x in ("precision", "recall", "f1", "accuracy")))


def roc_auc(rows: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the curve by ranks, ties halved: scores are counted first, so only distinct ones are ordered."""
    counts = rows.filter(F.col(label).isin(0, 1)).groupBy(score).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    at = ordinal.sums_before(counts, [F.col(score)], ["n"])
    return at.agg(F.round(F.try_divide(F.sum(F.col("p") * (F.col("before_n") + F.col("n") / 2)), F.sum("p") * F.sum("n")), 6).alias("auc"))


def agreement(rows: DataFrame, a: str, b: str, by: str) -> DataFrame:
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.round(F.avg((F.col(a) == F.col(b)).cast("int")), 4).alias("agreement"))


def progress(events: DataFrame, found: DataFrame, fetched: DataFrame, extracted: DataFrame) -> DataFrame:
    """event_id with its counts and the stages that are complete; a later stage implies the earlier ones."""
    n = lambda df, name: df.groupBy("event_id").agg(F.count("*").alias(name))
    rows = events.select("event_id").join(n(found, "pointers"), "event_id", "left").join(n(fetched, "fetched"), "event_id", "left").join(n(extracted, "extracted"), "event_id", "left")
    rows = rows.select("event_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("pointers", "fetched", "extracted")))
    reached = F.when(F.col("extracted") > 0, 3).when(F.col("fetched") > 0, 2).when(F.col("pointers") > 0, 1).otherwise(0)
    return rows.withColumn("stages", reached).withColumn("fetch_rate", F.round(F.coalesce(F.try_divide("fetched", "pointers"), F.lit(0.0)), 4))


def readable_bytes(c):
    unit = F.when(c < 1024, F.struct(F.lit(1.0).alias("d"), F.lit("B").alias("u"))).when(c < 1 << 20, F.struct(F.lit(1024.0).alias("d"), F.lit("KB").alias("u"))).when(c < 1 << 30, F.struct(F.lit(float(1 << 20)).alias("d"), F.lit("MB").alias("u"))).otherwise(F.struct(F.lit(float(1 << 30)).alias("d"), F.lit("GB").alias("u")))
    return F.concat(F.format_string("%.1f", c / unit["d"]), F.lit(" "), unit["u"])


def dropout(events: DataFrame, hits: DataFrame, clean: DataFrame, accepted: DataFrame) -> DataFrame:
    """(event_id, dropped_at): where an event leaves the funnel; keys are made distinct first, so no join fans out."""
    rows = events.select("event_id").distinct()
    for name, df in (("hits", hits), ("clean", clean), ("accepted", accepted)):
        rows = rows.join(df.select("event_id").distinct().withColumn(name, F.lit(True)), "event_id", "left")
    at = F.when(F.col("hits").isNull(), "no_hits").when(F.col("clean").isNull(), "no_text").when(F.col("accepted").isNull(), "all_rejected").otherwise("passed")
    return rows.select("event_id", at.alias("dropped_at"))


def stage_counts(progress_rows: DataFrame) -> DataFrame:
    """One row of how many events are complete, fetched, begun and not begun."""
    s = F.col("stages")
    return progress_rows.agg(F.count_if(s == 3).alias("complete"), F.count_if(s == 2).alias("fetched"), F.count_if(s == 1).alias("begun"), F.count_if(s == 0).alias("not_begun"))


def chi_square(rows: DataFrame, a: str, b: str) -> DataFrame:
    """One row: the statistic and the degrees of freedom of two categories' independence; nulls are left out."""
    cells = rows.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("o"))
    ra, rb = (cells.groupBy(c).agg(F.sum("o").alias(f"n_{k}")) for k, c in (("a", a), ("b", b)))
    total = cells.agg(F.sum("o")).first()[0] or 0
    # empty cells add their expectation, so the sum needs the filled ones and the total alone
    filled = cells.join(ra, a).join(rb, b).withColumn("e", F.col("n_a") * F.col("n_b") / F.lit(total))
    return filled.agg(F.round(F.sum((F.col("o") - F.col("e")) ** 2 / F.col("e") - F.col("e")) + F.lit(total), 6).alias("statistic"), ((F.count_distinct(a) - 1) * (F.count_distinct(b) - 1)).alias("dof"))


def rank_sum(rows: DataFrame, flag: str, value: str) -> DataFrame:
    """One row: Mann-Whitney's U of the rows with flag 1 against those with 0, ties halved."""
    counts = rows.filter(F.col(flag).isin(0, 1) & F.col(value).isNotNull()).groupBy(value).agg(F.count_if(F.col(flag) == 1).alias("p"), F.count_if(F.col(flag) == 0).alias("n"))
    return ordinal.sums_before(counts, [F.col(value)], ["n"]).agg(F.sum(F.col("p") * (F.col("before_n") + F.col("n") / 2)).alias("u"))


def value_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(field, value, n): how often each value of the columns occurs; nulls are left out."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns)))
    return rows.select(pairs.alias("x")).filter("x.value is not null").groupBy("x.field", "x.value").agg(F.count("*").alias("n"))


def distinct_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row of the number of different values of each column."""
    return rows.agg(*(F.count_distinct(c).alias(f"n_{c}") for c in columns))


def flag_sums(rows: DataFrame, by: str, flag: str) -> DataFrame:
    """(by, n, n_true): rows and those with the flag, null as false."""
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col(flag).cast("boolean"), F.lit(False))).alias("n_true"))


def prefix_counts(rows: DataFrame, column: str, prefixes: list[str]) -> DataFrame:
    """(prefix, n): rows whose value begins with each prefix, in one pass; a prefix without rows counts 0."""
    counts = rows.agg(*(F.count_if(F.coalesce(F.col(column), F.lit("")).startswith(p)).alias(str(i)) for i, p in enumerate(prefixes)))
    each = F.explode(F.array(*(F.struct(F.lit(p).alias("prefix"), F.col(str(i)).alias("n")) for i, p in enumerate(prefixes))))
    return counts.select(each.alias("x")).select("x.prefix", "x.n")


def counts_by(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def alarms(rows: DataFrame, limits: dict[str, tuple[str, float]]) -> DataFrame:
    """rows with alarm_<column> for each of limits, {column: ("above" or "below", bound)}; an unknown rate is no alarm."""
    test = lambda c, side, x: F.coalesce(F.col(c) > x if side == "above" else F.col(c) < x, F.lit(False))
    return rows.withColumns({f"alarm_{c}": test(c, side, x) for c, (side, x) in limits.items()})


def classification_by(rows: DataFrame, by: str, label: str, predicted: str, least: int = 3) -> DataFrame:
    """(by, n, tp, fp, fn, precision, recall, f1) of each group with `least` labelled rows or more."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    c = rows.filter(F.col(label).isin(0, 1)).groupBy(by).agg(F.count("*").alias("n"), F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn")).filter(F.col("n") >= least)
    div = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    c = c.withColumns({"precision": div(F.col("tp"), F.col("tp") + F.col("fp")), "recall": div(F.col("tp"), F.col("tp") + F.col("fn")), "f1": div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))})
    return c.select(by, "n", "tp", "fp", "fn", *(F.round(x, 6).alias(x) for x in ("precision", "recall", "f1")))


def compared(rows: DataFrame, label: str, first: str, second: str) -> DataFrame:
    """Two predictions against the label: (label, first, second, n), nulls as 0; and who is right."""
    bit = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(0))
    got = rows.filter(F.col(label).isin(0, 1)).groupBy(bit(label).alias("label"), bit(first).alias("first"), bit(second).alias("second")).agg(F.count("*").alias("n"))
    a, b = F.col("first") == F.col("label"), F.col("second") == F.col("label")
    return got.withColumn("right", F.when(a & b, "both").when(a, "first").when(b, "second").otherwise("none"))


def errors(rows: DataFrame, label: str, predicted: str, prob: str, key: str, n: int = 10) -> DataFrame:
    """The n wrong rows of each kind (false_positive, false_negative) that the model was surest of: a report's limit."""
    wrong = F.when((F.col(label) == 0) & (F.col(predicted) == 1), "false_positive").when((F.col(label) == 1) & (F.col(predicted) == 0), "false_negative")
    rows = rows.withColumn("kind", wrong).filter("kind is not null").withColumn("_sure", F.round(F.abs(F.col(prob) - 0.5), 6))
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("_sure"), key))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank", "_sure")


def likelihood_ratio(rows: DataFrame, label: str, features: list[str]) -> DataFrame:
    """One row (statistic, dof): does a logistic regression on the features tell the label better than its mean? Nulls
    are left out. Without rows of both labels: 0."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    rows = rows.select(F.col(label).cast("double").alias("y"), *(F.col(c).cast("double").alias(c) for c in features)).na.drop().filter("y in (0, 1)")
    if rows.select("y").distinct().count() < 2:
        return rows.sparkSession.createDataFrame([(0.0, len(features))], "statistic double, dof long")
    data = VectorAssembler(inputCols=features, outputCol="x").transform(rows)
    fitted = GeneralizedLinearRegression(family="binomial", link="logit", labelCol="y", featuresCol="x", maxIter=50, tol=1e-10).fit(data).summary
    return rows.sparkSession.createDataFrame([(float(fitted.nullDeviance - fitted.deviance), len(features))], "statistic double, dof long")
