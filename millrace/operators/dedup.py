"""Duplicates of articles: by URL and text within an event, and texts shared across events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text, urls
from ..profile import DEFAULT, Profile
from . import ordinal

def _order():
    return F.col("timestamp").asc_nulls_last(), F.col("doc_id")


def _group(where):
    return F.when(where, F.sha2(F.concat_ws("|", "event_id", "text_hash"), 256)).otherwise("")


def flag_duplicates(articles: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """articles (doc_id, event_id, url, timestamp, clean_text or its text_hash) with text_hash, is_content_duplicate,
    duplicate_group_id and cross_event_shared.

    The earliest row of a normalised URL stays; among what stays, the earliest of a text. A text belongs to the event
    with the least id that has it, and its copies elsewhere are marked as shared. Rows without a URL or text are no
    duplicates by it; of rows that repeat one in all of this, one stays. Articles are written once, with all columns that
    they have here; only their keys go through the comparisons, and the flags come back by row number.
    """
    if "text_hash" not in articles.columns:
        articles = articles.withColumn("text_hash", text.text_hash(F.col("clean_text")))
    rows = ordinal.with_row(articles.withColumn("_url", urls.normalise(F.col("url"), profile)))
    keys = rows.select("_row", "event_id", "doc_id", "timestamp", "text_hash", "_url")
    by_url = ordinal.first_rows(keys.filter("_url <> ''"), ["event_id", "_url"], _order())
    rows = ordinal.marked(rows, by_url, "_first_url").withColumn("_by_url", (F.col("_url") != "") & ~F.col("_first_url"))
    left = ordinal.marked(keys, by_url, "_first_url").filter("text_hash <> '' and (_first_url or _url = '')")
    # one row a text and event is left; its owner is the least event
    first = left.join(ordinal.first_rows(left, ["event_id", "text_hash"], _order()), "_row")
    owner = keys.filter("text_hash <> ''").groupBy("text_hash").agg(F.min("event_id").alias("_owner"))
    first = first.join(owner, "text_hash").select("_row", F.lit(True).alias("_first_text"), (F.col("event_id") > F.col("_owner")).alias("_shared"))
    rows = rows.join(first, "_row", "left")
    by_text = ~F.col("_by_url") & (F.col("text_hash") != "") & F.col("_first_text").isNull()
    rows = rows.withColumn("is_content_duplicate", F.col("_by_url") | by_text)
    rows = rows.withColumn("duplicate_group_id", _group(~F.col("_by_url") & (F.col("text_hash") != "")))
    return rows.withColumn("cross_event_shared", F.coalesce("_shared", F.lit(False))).drop("_row", "_url", "_first_url", "_by_url", "_first_text", "_shared")


def flag_duplicates_by_text(articles: DataFrame) -> DataFrame:
    """The older rule: by text alone, and every row with a text has a group."""
    rows = ordinal.with_row(articles.withColumn("text_hash", text.text_hash(F.col("clean_text"))))
    has = F.col("text_hash") != ""
    keys = rows.filter(has).select("_row", "event_id", "doc_id", "timestamp", "text_hash")
    rows = ordinal.marked(rows, ordinal.first_rows(keys, ["event_id", "text_hash"], _order()), "_first")
    return rows.withColumns({"is_content_duplicate": has & ~F.col("_first"), "duplicate_group_id": _group(has)}).drop("_row", "_first")
