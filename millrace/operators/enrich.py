"""Lookups into tables whose keys may repeat: the right side is made unique first, so no left row is multiplied."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.plan import lookup as lookup_rows


def unique(rows: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """The first row of each key by `order` (else by all other columns); rows with a null in the key go."""
    rows = rows.na.drop(subset=keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*(order or [c for c in rows.columns if c not in keys] or keys)))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def lookup(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str], fill: str | None = None, order: list[str] | None = None) -> DataFrame:
    """left with `columns` of right by equal keys; null, or fill, where right has none. Columns of left by these names are
    replaced. Every left row stays, once; a null key finds nothing."""
    own = unique(right.select(*keys, *columns, *[c for c in order or [] if c not in keys + columns]), keys, order).select(*keys, *columns)
    out = left.drop(*columns).join(own, keys, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(fill)) for c in columns}) if fill is not None else out


def among(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key others has."""
    return rows.join(lookup_rows(others.select(*keys).distinct()), keys, "left_semi")


def not_among(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key others lacks: what is still to be done."""
    return rows.join(lookup_rows(others.select(*keys).distinct()), keys, "left_anti")
