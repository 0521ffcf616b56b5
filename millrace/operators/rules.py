"""Rules after a model: ordered checks, the first that fits gives the reason."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..profile import DEFAULT, Profile


def post_filter_reason(title: Column, url: Column, domain: Column, body: Column, flood_hits: Column, location_hits: Column, profile: Profile = DEFAULT) -> Column:
    """Empty if the row passes."""
    t, u, d = (F.coalesce(c, F.lit("")) for c in (title, url, domain))
    head = F.concat_ws(" ", t, F.left(F.coalesce(body, F.lit("")), F.lit(profile.head_chars)))
    of = {"title": t, "url": u, "head": head, "cemaden": F.when(F.lower(d).contains("cemaden"), t).otherwise("")}
    event = {k: v.rlike(profile.event_words) for k, v in of.items()}
    checks = [F.when(of[where].rlike(pattern) & (~event[where] if saved else F.lit(True)), reason) for reason, where, pattern, saved in profile.title_rules]
    strict = F.lit(False)
    for x in profile.strict_domains:
        strict = strict | F.lower(d).contains(x) | F.lower(u).contains(x)
    checks += [F.when(strict & ~event["title"], "strict_domain_no_flood_title"), F.when((F.coalesce(flood_hits, F.lit(0)) == 0) & (F.coalesce(location_hits, F.lit(0)) == 0), "zero_keyword_hits")]
    return F.coalesce(*checks, F.lit(""))


def combined_gate(model: Column, enriched: Column, srl_complete: Column, frame: Column) -> Column:
    """The model's word, and where there is an enrichment also its roles or frame."""
    told = (F.coalesce(srl_complete, F.lit(0)) == 1) | F.coalesce(frame, F.lit("")).isin("impact", "response")
    return F.coalesce(model, F.lit(False)) & (~enriched | told)


def titled(title: Column, good: str, bad: str) -> Column:
    t = F.coalesce(title, F.lit(""))
    return ~t.rlike(bad) & t.rlike(good)


def broad_keyword(title: Column, body: Column, pattern: str) -> Column:
    return F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(body, F.lit(""))).rlike(pattern)
