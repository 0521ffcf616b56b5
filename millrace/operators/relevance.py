"""How often an article names its event's terms and places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..profile import DEFAULT, Profile

TERM = "array<struct<term:string,pattern:string>>"
ENTRY = f"array<struct<level:string,words:array<string>,terms:{TERM}>>"
#: One word is looked up among the text's words; only other terms need a pattern.
_WORD = "^[a-z0-9_]+$"
#: Events whose terms are sent to every executor; more are joined by a shuffle.
BROADCAST_EVENTS = 100_000


def _plain(c: Column) -> Column:
    return text.strip_accents(F.lower(c))


def _split(terms: Column) -> tuple[Column, Column]:
    """(single words, other terms with their patterns)."""
    other = F.filter(terms, lambda t: ~t.rlike(_WORD))
    return F.filter(terms, lambda t: t.rlike(_WORD)), F.transform(other, lambda t: F.struct(t.alias("term"), text.pattern_of(t).alias("pattern")))


def terms_of(languages: DataFrame, lexicon: DataFrame, places: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """A row for each event of languages (event_id, codes: array) with its distinct terms and its place entries.

    lexicon: (language, category, term), as readers.lexicon gives it; places: (event_id, location_normalised, aliases,
    level), as places.dictionary gives it. Terms are lower-cased and lose their accents; empty ones and those of other
    categories go. An event without either has none.
    """
    kinds = {"flood": profile.flood_categories, "impact": profile.impact_categories}
    lex = lexicon.select("language", "category", _plain(F.col("term")).alias("term")).filter("term <> ''")
    own = languages.select("event_id", F.explode(F.array_distinct("codes")).alias("language")).join(lex, "language")
    own = own.groupBy("event_id").agg(*(F.array_sort(F.collect_set(F.when(F.col("category").isin(list(v)), F.col("term")))).alias(k) for k, v in kinds.items()))
    names = F.filter(F.array_distinct(F.transform(F.concat(F.array("location_normalised"), F.coalesce("aliases", F.array().cast("array<string>"))), _plain)), lambda x: x != "")
    words, other = _split(F.col("names"))
    spots = places.select("event_id", "level", names.alias("names")).select("event_id", F.struct("level", words.alias("words"), other.alias("terms")).alias("entry"))
    spots = spots.groupBy("event_id").agg(F.collect_list("entry").cast(ENTRY).alias("places"))
    out = languages.select("event_id").distinct().join(own, "event_id", "left").join(spots, "event_id", "left")
    columns = []
    for k in kinds:
        words, other = _split(F.coalesce(k, F.array().cast("array<string>")))
        columns += [words.alias(f"{k}_words"), other.cast(TERM).alias(f"{k}_terms")]
    return out.select("event_id", *columns, F.coalesce("places", F.array().cast(ENTRY)).alias("places"))


def event_terms(spark, languages: dict[int, list[str]], lexicon: dict[str, dict[str, list[str]]], places: dict[int, list[tuple[str, str, list[str]]]], profile: Profile = DEFAULT) -> DataFrame:
    """terms_of() of Python values: codes by event, terms by language and category, (name, level, aliases) by event."""
    lex = [(code, kind, t) for code, kinds in lexicon.items() for kind, ts in kinds.items() for t in ts]
    spots = [(e, name, aliases, level) for e, entries in places.items() for name, level, aliases in entries]
    return terms_of(
        spark.createDataFrame(list(languages.items()), "event_id int, codes array<string>"), spark.createDataFrame(lex, "language string, category string, term string"),
        spark.createDataFrame(spots, "event_id int, location_normalised string, aliases array<string>, level string"), profile,
    )


def _hits(t: Column, words: Column, kind: str) -> Column:
    other = F.filter(f"{kind}_terms", lambda x: text.has_term(t, x["term"], x["pattern"]))
    return F.coalesce(F.size(F.array_intersect(words, f"{kind}_words")) + F.size(other), F.lit(0))


def score(articles: DataFrame, terms: DataFrame, profile: Profile = DEFAULT, legacy: bool = False) -> DataFrame:
    """articles (event_id, clean_text, page_title) with hits and flags; terms: see terms_of.

    Terms come as arrays and are matched within the row, so articles aren't multiplied; up to BROADCAST_EVENTS events'
    they are broadcast, so articles aren't shuffled either. Null texts and titles are empty; an event without terms has
    no hits. legacy: the older score, of the text alone, where each of an entry's names counts, and any place will do.
    """
    none, entries = F.array().cast("array<string>"), F.coalesce("places", F.array().cast(ENTRY))
    rows = articles.join(F.broadcast(terms) if terms.count() <= BROADCAST_EVENTS else terms, "event_id", "left")
    whole = F.coalesce("clean_text", F.lit("")) if legacy else F.concat_ws(" ", F.coalesce("page_title", F.lit("")), F.coalesce("clean_text", F.lit("")))
    rows = rows.withColumn("_t", _plain(whole)).withColumn("_w", F.array_distinct(F.split("_t", r"(?U)\W+")))
    rows = rows.withColumn("_spots", F.array_intersect("_w", F.coalesce(F.flatten(F.transform("places", lambda e: e["words"])), none)))
    t, w = F.col("_t"), F.col("_w")
    named = lambda e: F.filter(e["terms"], lambda x: text.has_term(t, x["term"], x["pattern"]))
    hit = F.filter(entries, lambda e: F.arrays_overlap(e["words"], F.col("_spots")) | F.exists(e["terms"], lambda x: text.has_term(t, x["term"], x["pattern"])))
    rows = rows.withColumns({"flood_term_hits": _hits(t, w, "flood"), "impact_term_hits": _hits(t, w, "impact"), "_hit": hit})
    found = F.size("_hit")
    if legacy:
        names = F.array_distinct(F.flatten(F.transform("_hit", lambda e: F.concat(F.array_intersect(e["words"], F.col("_spots")), F.transform(named(e), lambda x: x["term"])))))
        found = F.size(names)
    rows = rows.withColumns({"location_term_hits": found, "subnational_hits": F.size(F.filter("_hit", lambda e: e["level"] != "country")), "n_locations": F.size(entries)})
    f, loc, sub = F.col("flood_term_hits"), F.col("location_term_hits"), F.col("subnational_hits")
    local = F.exists(entries, lambda e: e["level"] != "country")
    enough = f >= profile.min_hits
    any_place = F.when(F.col("n_locations") == 0, True).otherwise(loc >= 1)
    relevant = enough & (any_place if legacy else F.when(F.col("n_locations") == 0, True).when(local, sub >= 1).otherwise(loc >= 1))
    rows = rows.withColumns(
        {
            "is_relevant": relevant, "is_soft_relevant": enough & (loc >= 1), "is_event_article": relevant & (F.col("impact_term_hits") >= 1), "flood_mentioned": f >= 1,
            "location_specificity_score": F.when(loc > 0, F.round(sub / loc, 3)).otherwise(F.lit(0.0)), "low_specificity": (loc > 0) & (sub == 0),
        }
    )
    return rows.drop("_t", "_w", "_spots", "_hit", "flood_words", "flood_terms", "impact_words", "impact_terms", "places")
