"""Which crawls cover each event's window: interval overlap, then the nearest later crawl."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.plan import lookup
from ..profile import DEFAULT, Profile


def crawl_windows(crawls: DataFrame) -> DataFrame:
    """(crawl_id, crawl_from, crawl_to) of (id or name, from, to) in ISO form; what can't be read goes."""
    name = F.coalesce(*(F.col(c) for c in ("id", "name") if c in crawls.columns))
    at = lambda c: F.try_to_timestamp(F.regexp_replace(c, "Z$", "+00:00"))
    return crawls.select(name.alias("crawl_id"), at(F.col("from")).alias("crawl_from"), at(F.col("to")).alias("crawl_to")).filter("crawl_from is not null and crawl_to is not null")


def event_windows(events: DataFrame, late: bool = False, profile: Profile = DEFAULT) -> DataFrame:
    first, last = dates.window(F.col("start_date"), F.col("end_date"), F.col("duration"), late, profile)
    return events.withColumns({"window_start": first.cast("timestamp"), "window_end": last.cast("timestamp")})


#: Days of a bin by which windows and crawls meet.
BIN = 32


def coverage(events: DataFrame, crawls: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """(event_id, window_start, window_end, coverage_status, matching_crawls).

    events: (event_id, window_start, window_end); crawls as crawl_windows gives them. A window, prolonged by the gap, and
    a crawl meet in bins of BIN days by an equi-join, and count in the first bin that they share. Two overlaps or one
    that spans the window: COVERED; one that doesn't: PARTIAL; none: the earliest later crawl within the gap is NEAREST
    and extends the window to its end; else NO_CRAWL. An event without a window has no crawl. Rows that repeat an event
    are rows of their own. Events are never the side that is sent to every executor.
    """
    day = lambda c: F.floor(F.unix_timestamp(c) / (86400 * BIN))
    key = ("event_id", "window_start", "window_end")
    e = events.select(*key)
    reach = F.col("window_end") + F.expr(f"interval {profile.nearest_gap_days + 1} days")
    bins = e.withColumn("_first", day(F.col("window_start"))).filter("window_start <= window_end").withColumn("_bin", F.explode(F.sequence(F.col("_first"), day(reach))))
    c = crawls.withColumn("_from", day(F.col("crawl_from"))).filter("crawl_from <= crawl_to").withColumn("_bin", F.explode(F.sequence(F.col("_from"), day(F.col("crawl_to")))))
    hit = (F.col("crawl_from") <= F.col("window_end")) & (F.col("crawl_to") >= F.col("window_start"))
    later = (F.col("crawl_from") > F.col("window_end")) & (F.floor((F.col("crawl_from").cast("long") - F.col("window_end").cast("long")) / 86400) <= profile.nearest_gap_days)
    near = bins.join(lookup(c), "_bin").filter(F.col("_bin") == F.greatest("_first", "_from")).filter(hit | later).withColumn("hit", hit)
    near = near.select(*key, "hit", "crawl_id", "crawl_from", "crawl_to")
    # each event once more, without a crawl: so those that have none stay, and copies of one are known
    none = e.select(*key, *(F.lit(None).cast(t).alias(k) for k, t in near.dtypes[len(key) :]))
    whole = F.col("hit") & (F.col("crawl_from") <= F.col("window_start")) & (F.col("crawl_to") >= F.col("window_end"))
    got = near.unionByName(none).groupBy(*key).agg(
        F.count_if(F.col("hit").isNull()).alias("_copies"), F.count_if("hit").alias("_hits"), F.bool_or(whole).alias("whole"), F.array_sort(F.collect_set(F.when(F.col("hit"), F.col("crawl_id")))).alias("hits"),
        F.min(F.when(~F.col("hit"), F.struct("crawl_from", "crawl_id", "crawl_to"))).alias("next"),
    )
    got = got.withColumn("n", F.expr("_hits div _copies")).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    status = F.when((F.col("n") >= 2) | F.col("whole"), "COVERED").when(F.col("n") == 1, "PARTIAL").when(F.col("next").isNotNull(), "NEAREST").otherwise("NO_CRAWL")
    nearest = (F.col("n") == 0) & F.col("next").isNotNull()
    return got.select(
        "event_id", "window_start", F.when(nearest, F.col("next.crawl_to")).otherwise(F.col("window_end")).alias("window_end"), status.alias("coverage_status"),
        F.when(nearest, F.array("next.crawl_id")).otherwise(F.col("hits")).alias("matching_crawls"),
    )


def covered(rows: DataFrame) -> DataFrame:
    """What coverage() gives of events that some crawl serves."""
    return rows.filter(F.col("coverage_status").isin("COVERED", "PARTIAL", "NEAREST"))
