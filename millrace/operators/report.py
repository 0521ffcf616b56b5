"""Rows for reviewers and for the language-processing hand-off."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..session import materialised
from . import ordinal


def _true(rows: DataFrame, name: str):
    """A flag with null as false; false where rows lack it."""
    return F.coalesce(F.col(name), F.lit(False)) if name in rows.columns else F.lit(False)


def event_only(rows: DataFrame) -> DataFrame:
    """Articles on an event; where that flag is absent, relevant ones."""
    return rows.filter(_true(rows, "is_event_article" if "is_event_article" in rows.columns else "is_relevant"))


def relevant(rows: DataFrame) -> DataFrame:
    """Strictly relevant, or softly and published in the window (null: not)."""
    return rows.filter(_true(rows, "is_relevant") | (_true(rows, "is_soft_relevant") & _true(rows, "pub_in_window")))


def in_frames(rows: DataFrame, frames: tuple[str, ...] = ("impact", "response")) -> DataFrame:
    return rows.filter(F.coalesce("dominant_frame", F.lit("")).isin(list(frames)))


def in_pub_window(rows: DataFrame) -> DataFrame:
    return rows.filter(_true(rows, "pub_in_window"))


def nlp_rows(rows: DataFrame, mode: str = "strict") -> DataFrame:
    """What goes to language processing. event: as event_only; soft: strict or soft; strict: relevant alone."""
    if mode == "event":
        return event_only(rows)
    return rows.filter(_true(rows, "is_relevant") | _true(rows, "is_soft_relevant") if mode == "soft" else _true(rows, "is_relevant"))


def with_text(rows: DataFrame, column: str = "clean_text", least: int = 50) -> DataFrame:
    """Rows whose text is longer than `least` characters."""
    return rows.filter(F.length(F.coalesce(column, F.lit(""))) > least)


def per_domain(rows: DataFrame, cap: int) -> DataFrame:
    """At most `cap` rows of an event and domain, those with the most hits: a report's limit."""
    w = Window.partitionBy("event_id", "domain").orderBy(F.col("flood_term_hits").desc(), "doc_id")
    return rows.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= cap).drop("_rank")


def title_has_place(title, terms):
    """Any of the terms within the title; events without terms pass."""
    t = F.lower(F.coalesce(title, F.lit("")))
    return (F.size(F.coalesce(terms, F.array().cast("array<string>"))) == 0) | F.exists(F.coalesce(terms, F.array().cast("array<string>")), lambda x: t.contains(F.lower(x)))


def with_text_cell(rows: DataFrame) -> DataFrame:
    shown = (F.col("flood_term_hits") >= 2) & (F.col("location_term_hits") >= 1)
    return rows.withColumn("clean_text_relevant", F.when(shown, text.flatten(F.col("clean_text"))).otherwise(""))


REPORT_ORDER = ("event_id", "is_event_article desc", "is_relevant desc", "flood_term_hits desc", "doc_id")


def _order(spec):
    return [F.col(x.split()[0]).cast("int").desc() if x.endswith(" desc") else F.col(x) for x in spec]


def sorted_rows(rows: DataFrame, order=REPORT_ORDER) -> DataFrame:
    """rows in order. They are written first: an order takes a sample of its rows, and would make each of them twice."""
    return materialised(rows).orderBy(*_order(order))


def numbered(rows: DataFrame, order=REPORT_ORDER, within: str | None = None) -> DataFrame:
    """doc_num from 1 on, over all rows or within a column. Rows are written, range-partitioned once and written in order; a
    row's number is its place in its partition and the sizes of those before, so no task sees every row of the table or of
    a group. Bring only the columns that are wanted."""
    rows, keys = materialised(rows), _order(order)
    out = ordinal.within(rows, [within], keys, "doc_num") if within else ordinal.numbered(rows, keys, "doc_num")
    return out.withColumn("doc_num", F.col("doc_num").cast("int"))


def best_by_url(rows: DataFrame) -> DataFrame:
    """Of an event's rows of one URL, that with the highest probability."""
    w = Window.partitionBy("event_id", "url").orderBy(F.col("model_prob").desc_nulls_last(), "doc_id")
    return rows.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
