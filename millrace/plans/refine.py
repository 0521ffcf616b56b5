"""The refinery as one lazy plan: articles to kept and rejected rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, languages
from ..functions.plan import filter_here
from ..operators import classify, dedup, gates, relevance
from ..profile import DEFAULT, Profile


def gated(articles: DataFrame, terms: DataFrame, wanted: DataFrame, windows: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """refine()'s rows before they part: reject_reason is the first gate that a row fails, empty if it passes all."""
    rows = gates.with_clean_text(articles, profile)
    rows = rows.withColumn("_early", gates.first_reason(gates.listing(profile), gates.usability(F.col("page_title"), profile)))
    rows = rows.withColumn("language_detected", classify.guess_language(F.col("clean_text")))
    rows = rows.join(wanted, "event_id", "left").join(windows, "event_id", "left")  # dimensions: broadcast if they are small
    rows = rows.withColumn("language_match", languages.matches(F.col("language_detected"), F.col("query_codes"), F.col("skipped"), profile))
    rows = relevance.score(rows, terms, profile)
    rows = rows.withColumn("pub_in_window", dates.in_window(F.col("pub_date"), F.col("window_start"), F.col("window_end")))
    return rows.withColumn("reject_reason", gates.first_reason(F.nullif("_early", F.lit("")), gates.language_mismatch(), gates.no_terms())).drop("_early", "query_codes", "skipped")


def rejected(rows: DataFrame) -> DataFrame:
    return filter_here(rows, "reject_reason <> ''")


def refine(articles: DataFrame, terms: DataFrame, wanted: DataFrame, windows: DataFrame, profile: Profile = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) of articles (doc_id, event_id, raw_text, page_title, url, timestamp, pub_date). terms: see
    relevance.event_terms; wanted: (event_id, query_codes, skipped); windows: (event_id, window_start, window_end).

    One reject_reason is the first gate that a row fails; duplicates are sought among the rows that pass all. Kept rows are
    written here, for their duplicates; who wants only the others takes rejected(gated()).
    """
    rows = gated(articles, terms, wanted, windows, profile)
    return dedup.flag_duplicates(filter_here(rows, "reject_reason = ''").drop("reject_reason"), profile), rejected(rows)
