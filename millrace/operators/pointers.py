"""Byte-range pointers: validity, size class, rank and three levels of duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..profile import DEFAULT, Profile
from . import ordinal

KEY = ("offset", "length", "filename", "crawl_id", "event_id")


def invalid_reason(profile: Profile = DEFAULT):
    """All that is wrong, joined by ', '; empty if nothing is."""
    offset, length = F.col("offset").try_cast("double"), F.col("length").try_cast("double")
    name = F.col("filename")
    return F.concat_ws(
        ", ",
        F.when(F.col("offset").isNull(), "null offset").when(offset.isNull(), "non-numeric offset").when(offset < 0, "negative offset"),
        F.when(F.col("length").isNull(), "null length").when(length.isNull(), "non-numeric length").when(length <= 0, "non-positive length"),
        F.when(F.coalesce(name, F.lit("")) == "", "missing filename").when(~name.rlike(profile.filename), "malformed filename"),
    )


def validate(pointers: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    return pointers.withColumn("reject_reason", invalid_reason(profile))


def size_class(length, profile: Profile = DEFAULT):
    n = length.try_cast("double")
    return F.when(n < profile.min_bytes, "TOO_SMALL").when(n > profile.max_bytes, "TOO_LARGE").otherwise("VALID")


def with_rank(pointers: DataFrame) -> DataFrame:
    """retrieval_rank: newest first within event and query, however many rows a query has."""
    order = [F.col("timestamp").desc_nulls_last(), F.col("pointer_id")]
    return ordinal.within(pointers, ["event_id", "query_id"], order, "retrieval_rank").withColumn("retrieval_rank", F.col("retrieval_rank").cast("int"))


def flag_duplicates(pointers: DataFrame) -> DataFrame:
    """is_pointer_duplicate by natural key, then is_digest_duplicate among the rest with a digest, and
    is_cross_event_url, which drops nothing. The lowest rank stays. Null is a value of a key; of rows that are alike in
    all of this one stays."""
    order = (F.col("retrieval_rank").asc_nulls_last(), F.col("pointer_id"))
    rows = ordinal.with_row(pointers)
    keys = rows.select("_row", *KEY, "digest", "url", "retrieval_rank", "pointer_id")
    first = ordinal.first_rows(keys, list(KEY), order)
    counted = ordinal.marked(keys, first, "_first").filter("_first and trim(coalesce(digest, '')) <> ''")
    digest = ordinal.first_rows(counted, ["event_id", "crawl_id", "digest"], order)
    rows = ordinal.marked(ordinal.marked(rows, first, "_first"), digest, "_digest")
    has = F.trim(F.coalesce("digest", F.lit(""))) != ""
    rows = rows.withColumns({"is_pointer_duplicate": ~F.col("_first"), "is_digest_duplicate": F.col("_first") & has & ~F.col("_digest")})
    shared = keys.filter("coalesce(url, '') <> ''").groupBy("url").agg((F.min("event_id") != F.max("event_id")).alias("_shared")).filter("_shared")
    # rows without an address meet no shared one, so they needn't be shuffled to one place: they get one of their own
    own = F.when(F.coalesce("url", F.lit("")) != "", F.concat(F.lit("u"), "url")).otherwise(F.concat(F.lit("r"), F.col("_row").cast("string")))
    rows = rows.withColumn("_key", own).join(shared.select(F.concat(F.lit("u"), "url").alias("_key"), "_shared"), "_key", "left")
    return rows.withColumn("is_cross_event_url", F.coalesce("_shared", F.lit(False))).drop("_shared", "_key", "_row", "_first", "_digest")


def latest_by_url(pointers: DataFrame) -> DataFrame:
    """is_url_duplicate: all but the newest row of a URL within an event; rows without a URL bypass it."""
    rows = ordinal.with_row(pointers)
    has = F.trim(F.coalesce("url", F.lit(""))) != ""
    keys = rows.filter(has).select("_row", "event_id", "url", "timestamp", "pointer_id")
    newest = ordinal.first_rows(keys, ["event_id", "url"], (F.col("timestamp").desc_nulls_last(), F.col("pointer_id")))
    return ordinal.marked(rows, newest, "_newest").withColumn("is_url_duplicate", has & ~F.col("_newest")).drop("_row", "_newest")


def fetched(log: DataFrame) -> DataFrame:
    """The rows of a fetch log that brought something (download_success, null as false)."""
    return log.filter(F.coalesce("download_success", F.lit(False)))


def eligible(pointers: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    return pointers.filter((F.col("reject_reason") == "") & ~F.col("is_pointer_duplicate") & (size_class(F.col("length"), profile) == "VALID"))


def not_cached(pointers: DataFrame, files: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """Without those whose file (pointer_id, bytes) has nearly the length expected."""
    got = pointers.join(files, "pointer_id").filter(F.col("bytes") >= profile.cached_share * F.col("length").try_cast("double"))
    return pointers.join(got.select("pointer_id"), "pointer_id", "left_anti")


def fetch_result(expected, received, http_status):
    """(download_success, error_type): a short body counts, as PARTIAL."""
    ok = http_status.isin(200, 206) & (received > 0)
    error = F.when(ok & (received != expected), "PARTIAL").when(ok, "").when(http_status == 404, "NOT_FOUND").when(http_status.isin(403, 503), "RATE_LIMITED").otherwise("FAILED")
    return ok, error
