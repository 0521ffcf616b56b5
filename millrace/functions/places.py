"""Place names out of free-text location fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip

_SUFFIX = r"(?i)\s+(capital city|city area|commune|county|department|district|governorate|isl\.|island|municipality|oblast|prefecture|province|regency|region|state)s?$"
_DIRECTION = r"(?i)^(central|northern|southern|eastern|western|northeast|northwest|southeast|southwest)\s+"
_FILLER = ["and", "in", "isl", "island", "of", "or", "the", "with"]


#: Names with aliases that are sent to every executor.
BROADCAST_NAMES = 100_000


def normalise(c: Column) -> Column:
    return F.btrim(F.regexp_replace(strip(F.lower(c)), r"\s+", " "), F.lit(".,;:()"))


def _token(c: Column) -> Column:
    c = strip(F.regexp_replace(strip(c), r"(?i)^(and|or|the)\s+", ""))
    c = strip(F.regexp_replace(c, _SUFFIX, ""))
    return normalise(strip(F.regexp_replace(c, _DIRECTION, "")))


def parse(raw: Column) -> Column:
    """Names in order, each once: what is in parentheses follows the text around it; long parts split at 'and'."""
    c = F.coalesce(raw, F.lit(""))
    chunks = F.concat(F.array(F.regexp_replace(c, r"\([^)]*\)", "")), F.regexp_extract_all(c, F.lit(r"\(([^)]+)\)"), 1))
    parts = F.flatten(F.transform(chunks, lambda x: F.transform(F.split(x, "[,;]"), strip)))
    parts = F.flatten(F.transform(parts, lambda x: F.when((F.length(x) > 40) & F.lower(x).contains(" and "), F.split(x, r"(?i)\s+and\s+")).otherwise(F.array(x))))
    names = F.transform(parts, _token)
    return F.array_distinct(F.filter(names, lambda x: (F.length(x) >= 3) & ~x.isin(_FILLER)))


def dictionary(events: DataFrame, aliases: DataFrame, countries: list[str], ambiguous: list[str]) -> DataFrame:
    """(event_id, location_normalised, aliases, level, ambiguous) for each place of events (event_id, country, location,
    river_basin): the country, its aliases, then places and basins, each once. aliases: (name, alias); up to
    BROADCAST_NAMES names' are broadcast, more are joined by a shuffle."""
    known = aliases.select(normalise(F.col("name")).alias("name"), "alias").groupBy("name").agg(F.array_sort(F.collect_set("alias")).alias("aliases"))
    known = F.broadcast(known) if known.count() <= BROADCAST_NAMES else known
    none = F.array().cast("array<string>")
    rows = events.withColumn("country", normalise(F.coalesce("country", F.lit("")))).join(known.select(F.col("name").alias("country"), F.col("aliases").alias("_other")), "country", "left")
    other = F.transform(F.coalesce("_other", none), normalise)
    basin = F.when(~F.lower(F.coalesce("river_basin", F.lit(""))).isin("", "n/a", "nan", "none"), parse(F.col("river_basin"))).otherwise(none)
    names = F.array_distinct(F.filter(F.concat(F.array("country"), other, parse(F.col("location")), basin), lambda x: x != ""))
    rows = rows.withColumn("_national", F.array_union(other, F.array("country"))).select("event_id", "_national", F.explode(names).alias("name"))
    national = F.array_contains("_national", F.col("name")) | F.col("name").isin(countries)
    rows = rows.join(known, "name", "left")
    return rows.select("event_id", F.col("name").alias("location_normalised"), F.coalesce("aliases", none).alias("aliases"), F.when(national, "country").otherwise("subnational").alias("level"), F.col("name").isin(ambiguous).alias("ambiguous"))
