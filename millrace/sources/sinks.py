"""Writes: overwrite, upsert by partition, additive merge, logs, CSV for people, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialised

def overwrite(df: DataFrame, path: str, schema=None) -> None:
    (df.to(schema) if schema else df).write.mode("overwrite").parquet(path)


def upsert_partitions(df: DataFrame, path: str, key: str = "event_id") -> None:
    """Replaces the partitions that df has rows of and leaves the others; a rerun leaves the same table."""
    df.repartition(key, F.pmod(F.xxhash64(*[c for c in df.columns if c != key]), F.lit(8))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def upserted(existing: DataFrame, new: DataFrame, key: str = "event_id") -> DataFrame:
    """The same as a plan: existing rows of other keys, and new."""
    return existing.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def merged(existing: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Existing rows stay; of new ones those with another key come in, the first by `order` of each."""
    w = Window.partitionBy(*keys).orderBy(*(order or keys))
    fresh = new.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
    e, n = existing.select(*keys).distinct().alias("e"), fresh.alias("n")
    same = [F.col(f"n.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keys]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return existing.unionByName(n.join(e, on, "left_anti").select("n.*"), allowMissingColumns=True)


def latest_of_batches(batches: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of rows of equal keys in several batches, that of the last."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return batches.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def append(df: DataFrame, path: str, form: str = "parquet") -> None:
    df.write.mode("append").format(form).save(path)


def csv(df: DataFrame, path: str, by: str | None = None, quote_all: bool = True) -> None:
    """Quoted cells; with `by` a folder for each of its values."""
    w = df.write.mode("overwrite").option("header", True).option("quoteAll", quote_all).option("escape", '"')
    (w.partitionBy(by) if by else w).csv(path)


def csv_by_group(df: DataFrame, path: str, group: str, order: tuple[str, ...]) -> DataFrame:
    """A folder of quoted CSV for each group, its rows numbered from 1 by `order`; returns (group, n)."""
    from ..operators import report

    rows = materialised(report.numbered(df, order, within=group))
    csv(rows, path, by=group)
    return rows.groupBy(group).agg(F.count("*").alias("n"))


def manifests(df: DataFrame, path: str, key: str = "event_id") -> None:
    """A line of JSON for each row, in a folder for each key."""
    df.select(key, F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").partitionBy(key).text(path)


def summary(df: DataFrame, path: str, title: str, order: list[str]) -> None:
    """All rows of df as lines of text under a title, in order, in part files that read in that order."""
    line = F.concat_ws("  ", *(F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("None"))) for c in df.columns))
    ruled = [(0, title), (1, "=" * len(title))]
    head = df.sparkSession.createDataFrame(ruled, "_head int, value string")
    rows = df.select(F.lit(2).alias("_head"), line.alias("value"), *(F.col(c).alias(f"_k{i}") for i, c in enumerate(order)))
    rows = head.unionByName(rows, allowMissingColumns=True)
    rows.orderBy("_head", *(f"_k{i}" for i in range(len(order)))).select("value").write.mode("overwrite").text(path)


def progress_document(progress: DataFrame, path: str, at: str) -> None:
    """Events' progress as lines of JSON, and before them one line of the totals."""
    from ..operators import metrics

    totals = metrics.stage_counts(progress).select(F.lit(0).alias("_head"), F.lit(None).cast("long").alias("_k"), F.to_json(F.struct(F.lit(at).alias("generated_at"), (F.col("complete") + F.col("fetched") + F.col("begun") + F.col("not_begun")).alias("total_events"), "*")).alias("value"))
    events = progress.select(F.lit(1).alias("_head"), F.col("event_id").cast("long").alias("_k"), F.to_json(F.struct(*progress.columns)).alias("value"))
    totals.unionByName(events).orderBy("_head", "_k").select("value").write.mode("overwrite").text(path)
