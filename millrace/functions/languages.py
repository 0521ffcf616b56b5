"""Query languages of events, and the texts of queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..profile import DEFAULT, Profile

TWO_TO_THREE = {"ar": "arb", "de": "deu", "en": "eng", "es": "spa", "fr": "fra", "hi": "hin", "id": "ind", "it": "ita", "ja": "jpn", "ko": "kor", "ms": "zlm", "ne": "npi", "pt": "por", "ru": "rus", "th": "tha", "uk": "ukr", "ur": "urd", "vi": "vie", "zh": "cmn"}


def codes(field: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(field, F.lit(""))), r"[,\s]+"), lambda x: x != "")


def query_codes(field: Column, profile: Profile = DEFAULT) -> Column:
    """Tier 1 and 2 stay, tier 3 asks for the fallbacks, others go; some are always there. Sorted, each once."""
    own = F.filter(codes(field), lambda x: x.isin(sorted(profile.tier1 | profile.tier2)))
    low = F.exists(codes(field), lambda x: x.isin(sorted(profile.tier3)))
    back = F.when(low, F.array(*map(F.lit, profile.fallback_languages))).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.concat(own, back, F.array(*map(F.lit, profile.always_languages)))))


def spec_codes(field: Column, profile: Profile = DEFAULT) -> Column:
    """An event's codes as they are written, and those that every spec has; each once, sorted."""
    return F.array_sort(F.array_union(codes(field), F.array(*map(F.lit, profile.spec_languages))))


def skipped(field: Column, profile: Profile = DEFAULT) -> Column:
    """Map of a left-out code to the reason."""
    out = F.array_distinct(F.filter(codes(field), lambda x: ~x.isin(sorted(profile.tier1 | profile.tier2))))
    reason = lambda x: F.when(x.isin(sorted(profile.tier3)), F.lit("tier3_low_coverage")).otherwise(F.lit("unknown_code"))
    return F.map_from_arrays(out, F.transform(out, reason))


def three_letters(code: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in sorted(TWO_TO_THREE.items()) for x in kv])
    return F.coalesce(F.element_at(table, F.lower(code)), F.lower(code))


def matches(detected: Column, wanted: Column, left_out: Column, profile: Profile = DEFAULT) -> Column:
    """Detected language is asked for, or is a fallback of a language that was left out for its tier."""
    low = F.exists(F.map_values(left_out), lambda r: r == "tier3_low_coverage")
    return F.coalesce(F.array_contains(wanted, detected), F.lit(False)) | (F.coalesce(low, F.lit(False)) & detected.isin(list(profile.fallback_languages)))


def any_of(terms: Column, quote: bool = False) -> Column:
    t = F.array_sort(F.array_distinct(F.coalesce(terms, F.array().cast("array<string>"))))
    if quote:
        t = F.array_sort(F.transform(t, lambda x: F.when(x.contains(" "), F.concat(F.lit('"'), x, F.lit('"'))).otherwise(x)))
    return F.array_join(t, " OR ")


def query_text(words: Column, places: Column, words_needed: bool = False) -> Column:
    """(words) AND (places); one of them alone if the other is empty. words_needed: empty without words."""
    a, b = any_of(words), any_of(places, quote=True)
    both = F.when((a != "") & (b != ""), F.concat(F.lit("("), a, F.lit(") AND ("), b, F.lit(")"))).otherwise(F.concat(a, b))
    return F.when(a == "", "").otherwise(both) if words_needed else both
