"""Order without a task that sees every row: range partitions that are written once, and prefix sums over their totals.

A row's partition and its place there are written with it, so they are the same wherever the plan reads them. Partitions
that a plan makes anew each time have no such numbers: adaptive plans cut them in other ways.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.plan import lookup
from ..session import materialised

_BITS = 33  # of the place within a partition


def with_row(df: DataFrame) -> DataFrame:
    """df, written, with a number for each row (_row)."""
    return materialised(df.withColumn("_row", F.monotonically_increasing_id()))


def _ordered(df: DataFrame, order) -> DataFrame:
    df = with_row(df.repartitionByRange(*order).sortWithinPartitions(*order))
    return df.withColumns({"_part": F.shiftright("_row", _BITS), "_at": F.col("_row").bitwiseAND((1 << _BITS) - 1)}).drop("_row")


def _ahead(df: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """By partition, the sums over all partitions before it. One row a partition goes through one task."""
    totals = df.groupBy("_part").agg(*(c.alias(k) for k, c in sums.items()))
    w = Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_part", *(F.coalesce(F.sum(k).over(w), F.lit(0)).alias(k) for k in sums))


def _sure(c: str) -> Column:
    return F.coalesce(F.col(c), F.raise_error(F.lit("a partition without a total")).cast("long"))


def numbered(df: DataFrame, order, name: str = "_n") -> DataFrame:
    """df with the number of each row, from 1, in the order of `order` (columns, the last of them unique)."""
    rows = _ordered(df, order)
    rows = rows.join(F.broadcast(_ahead(rows, {"_before": F.count("*")})), "_part", "left")
    return rows.withColumn(name, _sure("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")


def within(df: DataFrame, groups: list[str], order, name: str = "_n") -> DataFrame:
    """df with the number of each row within its group, null being a group: a group may be any share of the rows."""
    rows = numbered(df, [F.col(g) for g in groups] + list(order), "_all")
    first = rows.groupBy(*(F.col(g).alias(f"_g{i}") for i, g in enumerate(groups))).agg(F.min("_all").alias("_least"))
    on = None
    for i, g in enumerate(groups):
        same = F.col(g).eqNullSafe(F.col(f"_g{i}"))
        on = same if on is None else on & same
    return rows.join(lookup(first), on).withColumn(name, F.col("_all") - F.col("_least") + 1).drop("_all", "_least", *(f"_g{i}" for i in range(len(groups))))


def sums_before(df: DataFrame, order, columns: list[str]) -> DataFrame:
    """df with before_<column> for each of the columns: its sum over all earlier rows."""
    rows = _ordered(df, order)
    rows = rows.join(F.broadcast(_ahead(rows, {f"_sum_{c}": F.sum(c) for c in columns})), "_part", "left")
    w = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumns({f"before_{c}": _sure(f"_sum_{c}") + F.coalesce(F.sum(c).over(w), F.lit(0)) for c in columns}).drop("_part", "_at", *(f"_sum_{c}" for c in columns))


def first_rows(rows: DataFrame, keys: list, order) -> DataFrame:
    """(_row) of the first row of each key of rows (with _row): all but the first of a map task's rows go before the
    shuffle, so a key that a third of the rows has gathers nowhere."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, "_row"))
    return rows.withColumn("_rank", rank).filter("_rank = 1").select("_row")


def marked(rows: DataFrame, chosen: DataFrame, name: str) -> DataFrame:
    """rows with a flag: is the row among the chosen (_row)?"""
    return rows.join(chosen.withColumn(name, F.lit(True)), "_row", "left").withColumn(name, F.coalesce(name, F.lit(False)))
