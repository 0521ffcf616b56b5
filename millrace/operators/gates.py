"""Document gates. A row keeps its place; reject_reason says what it failed, empty if nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, urls
from ..profile import DEFAULT, Profile


def with_clean_text(docs: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    docs = docs.withColumn("clean_text", text.clean_text(F.col("raw_text"), profile))
    c = F.col("clean_text")
    return docs.withColumns({"char_count": text.char_count(c), "word_count": text.word_count(c), "non_ascii_ratio": text.non_ascii_ratio(c)})


def usability(title: Column, profile: Profile = DEFAULT, first_match: bool = False) -> Column:
    """Null if usable. The last of the reasons counts, or with first_match the first."""
    n, ratio = F.col("char_count"), F.col("non_ascii_ratio")
    error = F.lower(F.coalesce(title, F.lit(""))).rlike("|".join(x.lower().replace(".", "\\.") for x in profile.error_titles))
    checks = [(n == 0, "empty text"), ((n > 0) & (n < profile.min_chars), "char_count_too_short"), ((n > 0) & (ratio > profile.max_non_ascii), "non_ascii_ratio_too_high"), (error, "error_page_title")]
    return F.coalesce(*(F.when(c, r) for c, r in (checks if first_match else reversed(checks))))


def listing(profile: Profile = DEFAULT) -> Column:
    return F.when(urls.is_listing(F.col("url"), F.col("page_title"), profile), "tag_or_index_page")


def language_mismatch() -> Column:
    return F.when(~F.col("language_match") & (F.col("language_detected") != "unknown"), "language_mismatch")


def out_of_window() -> Column:
    """The older hard gate: a publication date that is known to lie outside; an unknown one passes."""
    return F.when(F.col("pub_in_window") == F.lit(False), "pub_date_out_of_window")


def no_terms() -> Column:
    return F.coalesce(F.when((F.col("n_locations") > 0) & (F.col("location_term_hits") == 0), "no_location_match"), F.when(F.col("flood_term_hits") == 0, "no_flood_term_match"))


def first_reason(*reasons: Column) -> Column:
    return F.coalesce(*reasons, F.lit(""))
