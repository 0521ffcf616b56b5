"""Shapes of plans that the optimizer would else undo."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialised

#: Rows of a lookup that is sent to every executor; a larger one is joined by a shuffle.
BROADCAST_ROWS = 100_000


def filter_here(df: DataFrame, condition) -> DataFrame:
    """df.filter(condition) that stays where it is. Pushed below the columns that it names, a filter on costly ones would
    compute them (and all that they are made of) once more for every place where they occur."""
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return df.withColumn("_here", F.monotonically_increasing_id()).filter(condition & (F.col("_here") >= 0)).drop("_here")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where its files make fewer splits than that; unchanged on tables of many files."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def lookup(df: DataFrame) -> DataFrame:
    """df, written and counted, as the other side of a join: broadcast if it has few rows, else shuffled. The optimizer goes
    by the bytes of files, which say little of rows: it would send millions of them through the driver."""
    df = materialised(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df.hint("merge")
