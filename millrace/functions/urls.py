"""URL scalars as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..profile import DEFAULT, Profile


def host(url: Column) -> Column:
    """Authority as written, with port and user; empty if there is none."""
    return F.coalesce(F.regexp_extract(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)", 1), F.lit(""))


def domain(url: Column, faithful: bool = False, lower: bool = True) -> Column:
    """Host without a leading 'www.'. faithful: without any leading run of 'w' and '.', as older outputs have it."""
    h = F.lower(host(url)) if lower else host(url)
    return F.regexp_replace(h, "^[w.]+" if faithful else "^www\\.", "")


def _part(url: Column, pattern: str) -> Column:
    return F.regexp_extract(url, pattern, 1)


def normalise(url: Column, profile: Profile = DEFAULT) -> Column:
    """Lower case, without fragment, trailing slashes of the path, tracking and empty parameters; a repeated parameter
    stands where it first did. Null is empty. Escapes stay as they are written."""
    u = F.coalesce(url, F.lit(""))
    head = F.rtrim(_part(u, "^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*[^?#]*)"), F.lit("/"))
    pairs = F.filter(F.split(_part(u, "^[^?#]*\\?([^#]*)"), "&"), lambda p: F.length(F.substring_index(p, "=", 1)) < F.length(p) - 1)
    name = lambda p: F.substring_index(p, "=", 1)
    kept = F.filter(pairs, lambda p: ~F.lower(name(p)).isin(sorted(profile.tracking)))
    names = F.array_distinct(F.transform(kept, name))
    grouped = F.flatten(F.transform(names, lambda n: F.filter(kept, lambda p: name(p) == n)))
    query = F.array_join(grouped, "&")
    bare = F.when(head == "", u).otherwise(head)
    return F.lower(F.concat(bare, F.when((query != "") & (head != ""), F.concat(F.lit("?"), query)).otherwise("")))


def slug(c: Column, length: int = 80) -> Column:
    """For a file name."""
    return F.left(F.translate(c, "/:*?&=", "______"), F.lit(length))


def is_listing(url: Column, title: Column, profile: Profile = DEFAULT) -> Column:
    """No article by its address, or else by its title."""
    u, t = F.coalesce(url, F.lit("")), F.coalesce(title, F.lit(""))
    return u.rlike(profile.junk_host) | u.rlike(profile.home_url) | u.rlike(profile.listing_url) | t.rlike(profile.listing_title)


def is_prefilter_junk(url: Column, profile: Profile = DEFAULT) -> Column:
    u = F.coalesce(url, F.lit(""))
    return u.rlike(profile.junk_host) | u.rlike(profile.home_url_query) | u.rlike(profile.prefilter_url)
