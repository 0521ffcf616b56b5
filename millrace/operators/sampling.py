"""Samples in hash order: the same rows on every run and cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ordinal

def _order(seed: int, key: str):
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")), 256)


def per_group(rows: DataFrame, group: str, n: int, key: str, seed: int = 42) -> DataFrame:
    w = Window.partitionBy(group).orderBy(_order(seed, key), key)
    return rows.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def stratified(rows: DataFrame, stratum: str, sizes: dict[str, int], key: str, seed: int = 42) -> DataFrame:
    """sizes[s] rows of each stratum s, or all it has."""
    want = F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])
    w = Window.partitionBy(stratum).orderBy(_order(seed, key), key)
    ranked = rows.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= max(sizes.values()))  # a plain bound drops rows before the shuffle
    return ranked.filter(F.col("_rank") <= F.coalesce(F.element_at(want, F.col(stratum)), F.lit(0))).drop("_rank")


def negatives(rows: DataFrame, group: str, positive, key: str, seed: int = 42, ratio: int = 2, least: int = 30) -> DataFrame:
    """All positives, and of each group min(pool, max(ratio * positives, least)) negatives."""
    flagged = rows.withColumn("_pos", positive.cast("int"))
    counts = flagged.groupBy(group).agg(F.sum("_pos").alias("_n"))
    ranked = ordinal.within(flagged.withColumn("_key", _order(seed, key)), [group, "_pos"], [F.col("_key"), F.col(key)], "_rank").drop("_key").join(counts, group)
    return ranked.filter((F.col("_pos") == 1) | (F.col("_rank") <= F.greatest(F.lit(ratio) * F.col("_n"), F.lit(least)))).drop("_pos", "_n", "_rank")


def split(rows: DataFrame, label: str, key: str, share: float = 0.8, seed: int = 42) -> DataFrame:
    """is_train: `share` of each label's rows, exactly. A label may have any share of the rows."""
    n = rows.groupBy(label).agg(F.count("*").alias("_n"))
    ranked = ordinal.within(rows.withColumn("_key", _order(seed, key)), [label], [F.col("_key"), F.col(key)], "_rank")
    return ranked.join(n, label).withColumn("is_train", F.col("_rank") <= F.floor(F.col("_n") * share)).drop("_n", "_rank", "_key")
