"""What only shows over several partitions: numbers, ranks, sums, hot keys, many crawls."""

import random
from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import plain
from pyspark.sql import functions as F

from millrace import session
from millrace.functions import plan, text
from millrace.operators import coverage, dedup, enrich, index, metrics, ordinal, pointers, relevance, report, sampling
from millrace.plans import queries, refine
from millrace.profile import DEFAULT
from millrace.sources import readers


def wide(spark, n, partitions=16):
    return spark.range(0, n, 1, partitions).select((F.pmod(F.xxhash64("id"), F.lit(7))).alias("event_id"), F.col("id").alias("doc_id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 8).alias("body"))


def test_numbers_of_many_wide_rows(spark):
    # planned twice, adaptive plans cut these partitions in different ways
    got = report.numbered(wide(spark, 600_000), ("event_id", "doc_id"))
    r = got.agg(F.count("*").alias("n"), F.count_distinct("doc_num").alias("d"), F.min("doc_num").alias("a"), F.max("doc_num").alias("b"), F.sum(F.length("body")).alias("w")).first()
    assert (r.n, r.d, r.a, r.b, r.w) == (600_000, 600_000, 1, 600_000, 600_000 * 512)
    rows = got.select("event_id", "doc_id", "doc_num").toPandas().sort_values(["event_id", "doc_id"])
    assert rows.doc_num.tolist() == list(range(1, 600_001))


@pytest.mark.parametrize("settings", [{}, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k"}, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}])
def test_numbers_under_other_settings(spark, settings):
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = report.numbered(wide(spark, 20_000), ("event_id", "doc_id")).select("event_id", "doc_id", "doc_num").toPandas().sort_values(["event_id", "doc_id"])
        assert rows.doc_num.tolist() == list(range(1, 20_001))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_no_partition_holds_a_hot_group(spark):
    rows = spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 20 == 0, None).otherwise("cold").alias("g"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would else be one partition
    try:
        parts = ordinal._ordered(rows, [F.col("g"), F.col("id")]).groupBy("_part").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 2 and max(p["count"] for p in parts) < 0.5 * 40_000
    got = ordinal.within(rows, ["g"], [F.col("id").desc()]).toPandas()
    for g, own in got.groupby("g", dropna=False):
        assert own.sort_values("id", ascending=False)._n.tolist() == list(range(1, len(own) + 1)), g


def test_sums_before(spark):
    rng = random.Random(1)
    data = [(i, rng.randrange(50)) for i in range(5000)]
    got = ordinal.sums_before(spark.createDataFrame(data, "k int, v long").repartition(7), [F.col("k")], ["v"]).toPandas().sort_values("k")
    assert got.before_v.tolist() == [0, *np.cumsum([v for _, v in data])[:-1].tolist()]
    assert ordinal.sums_before(spark.createDataFrame([], "k int, v long"), [F.col("k")], ["v"]).count() == 0


def test_auc_and_rank_sum_of_many_scores(spark):
    rng = np.random.default_rng(2)
    y, x = rng.integers(0, 2, 4000), np.round(rng.random(4000), 3)
    rows = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, x)] + [(None, 0.1)], "y int, x double").repartition(9)
    pos, neg = x[y == 1], x[y == 0]
    u = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    assert metrics.rank_sum(rows, "y", "x").first().u == u
    assert metrics.roc_auc(rows, "y", "x").first().auc == round(u / len(pos) / len(neg), 6)
    assert metrics.roc_auc(rows.filter("y = 2"), "y", "x").first().auc is None


def test_samples_of_hot_groups(spark):
    rows = spark.range(0, 6000, 1, 6).select(F.when(F.col("id") % 10 > 0, 1).otherwise(0).alias("label"), F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("g"), F.col("id").alias("doc_id"))
    split = sampling.split(rows, "label", "doc_id").toPandas()
    assert split.groupby("label").is_train.sum().to_dict() == {0: 480, 1: 4320} and len(split) == 6000
    few = sampling.stratified(rows, "g", {"a": 30, "b": 7}, "doc_id").toPandas()
    assert few.groupby("g").size().to_dict() == {"a": 30, "b": 7}
    again = sampling.stratified(rows.repartition(3), "g", {"a": 30, "b": 7}, "doc_id").toPandas()
    assert sorted(few.doc_id) == sorted(again.doc_id)
    neg = sampling.negatives(rows, "g", F.col("label") == 0, "doc_id", least=5).toPandas()
    assert (neg.label == 0).sum() == 600 and (neg.label == 1).sum() == 1200


def test_duplicates_that_repeat_whole(spark):
    rows = [(1, 1, "https://e/a", "1", "T")] * 3 + [(2, 1, None, None, None)] * 3 + [(3, None, "https://e/a", "1", "T")] * 2 + [(4, 2, "https://e/z", "0", "T")]
    got = dedup.flag_duplicates(spark.createDataFrame(rows, "doc_id int, event_id int, url string, timestamp string, clean_text string").repartition(3)).toPandas()
    assert len(got) == 9 and got[got.doc_id == 1].is_content_duplicate.sum() == 2 and not got[got.doc_id == 2].is_content_duplicate.any() and got[got.doc_id == 3].is_content_duplicate.sum() == 1
    p = spark.createDataFrame([("a", 1, "q", "c", "f", "0", "9", "d", "u", "2")] * 2 + [("b", 1, "q", "c", "f", "0", "9", "d", None, None)], "pointer_id string, event_id int, query_id string, crawl_id string, filename string, offset string, length string, digest string, url string, timestamp string")
    got = pointers.flag_duplicates(pointers.with_rank(p.repartition(2))).toPandas()
    assert sorted(got.retrieval_rank) == [1, 2, 3] and got.is_pointer_duplicate.sum() == 2 and not got.is_digest_duplicate.any()
    assert pointers.latest_by_url(p).toPandas().is_url_duplicate.sum() == 1


def test_coverage_of_many_crawls(spark):
    rng = random.Random(3)
    day = lambda n: datetime(2020, 1, 1) + timedelta(days=n)
    crawls = [(f"c{i:05d}", day(a := rng.randrange(0, 3000)), day(a + rng.randrange(0, 90))) for i in range(12_000)]
    events = [(i, day(a := rng.randrange(-300, 3300)), day(a + rng.randrange(0, 200))) for i in range(60)] + [(90, None, None), (91, day(5), day(4))]
    got = {r.event_id: r for r in coverage.coverage(spark.createDataFrame(events, "event_id int, window_start timestamp, window_end timestamp"), spark.createDataFrame(crawls, "crawl_id string, crawl_from timestamp, crawl_to timestamp")).collect()}
    for i, a, b in events[:60]:
        hits = sorted(c for c, x, y in crawls if x <= b and y >= a)
        whole = any(x <= a and y >= b for c, x, y in crawls if x <= b and y >= a)
        later = min(((x, c, y) for c, x, y in crawls if x > b and (x - b).days <= 120), default=None)
        want = "COVERED" if len(hits) > 1 or whole else "PARTIAL" if hits else "NEAREST" if later else "NO_CRAWL"
        assert got[i].coverage_status == want and got[i].matching_crawls == (hits or ([later[1]] if later else []))
    assert got[90].coverage_status == got[91].coverage_status == "NO_CRAWL" and len(got) == 62
    assert {r.event_id for r in coverage.covered(spark.createDataFrame(list(got.values()))).collect()} == {i for i, r in got.items() if r.coverage_status != "NO_CRAWL"}


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rows", [0, 100_000])
def test_events_do_not_go_through_the_driver(spark, sf, duck, monkeypatch, rows):
    # small as they are in bytes, the optimizer would broadcast events, and all the bins of their windows
    monkeypatch.setattr(plan, "BROADCAST_ROWS", rows)
    for name in ("covered_events", "covered_specs", "events_left_over"):
        got = queries.QUERIES[name](spark, sf)
        assert "BuildLeft" not in executed(got) and executed(got).count("BroadcastExchange") <= (2 if rows else 0), name
        assert plain(got.toPandas()) == plain(duck.execute(queries.SQL[name]).df())


def test_coverage_of_repeated_events(spark):
    at = lambda d: datetime(2024, 1, d)
    events = spark.createDataFrame([(1, at(5), at(9))] * 3 + [(2, None, None)] * 2, "event_id int, window_start timestamp, window_end timestamp")
    crawls = spark.createDataFrame([("a", at(7), at(20))], "crawl_id string, crawl_from timestamp, crawl_to timestamp")
    got = sorted((r.event_id, r.coverage_status, r.matching_crawls) for r in coverage.coverage(events, crawls).collect())
    assert got == [(1, "PARTIAL", ["a"])] * 3 + [(2, "NO_CRAWL", [])] * 2


@pytest.fixture
def written(monkeypatch):
    """Columns of each table that a step writes."""
    seen = []
    for module in (ordinal, report, queries, plan):
        monkeypatch.setattr(module, "materialised", lambda df, f=session.materialised: seen.append(df.columns) or f(df))
    return seen


def texts_read(df):
    """How often a plan cleans texts."""
    return executed(df).count("accept cookies")


def test_rejected_rows_alone(spark, sf, monkeypatch):
    monkeypatch.setattr(refine.dedup, "flag_duplicates", None)  # kept rows aren't made
    got = queries.refine_rejected(spark, sf)
    assert texts_read(got) == 1 and got.count() > 1


def test_only_keys_are_written_for_duplicates(spark, sf, written):
    for f in (queries.exact_dedup, queries.duplicate_rates):
        written.clear()
        assert f(spark, sf).count() > 0
        assert any("text_hash" in c for c in written) and not any({"raw_text", "clean_text", "page_title"} & set(c) for c in written)


def test_flags_of_hashes_and_texts(spark):
    rows = [(1, 1, "https://e/a", "1", "T"), (2, 1, "https://e/b", "2", "T"), (3, 2, "https://e/c", "1", "T"), (4, 2, None, None, None)]
    rows = spark.createDataFrame(rows, "doc_id int, event_id int, url string, timestamp string, clean_text string")
    hashed = rows.withColumn("text_hash", text.text_hash(F.col("clean_text"))).drop("clean_text")
    flags = ["doc_id", "text_hash", "is_content_duplicate", "duplicate_group_id", "cross_event_shared"]
    assert plain(dedup.flag_duplicates(rows).select(flags).toPandas()) == plain(dedup.flag_duplicates(hashed).select(flags).toPandas())


def test_texts_are_cleaned_once(spark, sf, written):
    for f in (queries.dropout_stage, queries.sorted_report, queries.report_numbered, queries.nlp_input):
        written.clear()
        assert texts_read(f(spark, sf)) == 0, f  # what is left to do reads written rows
        assert not any({"raw_text", "clean_text", "page_title"} & set(c) for c in written), f


def test_sorted_rows_are_in_order(spark):
    rows = [(e, bool(a), bool(r), f, d) for d, (e, a, r, f) in enumerate([(2, 0, 1, 1), (1, 0, 0, 9), (1, 1, 1, 2), (1, 0, 1, 3), (1, 0, 1, 3), (None, 0, 0, 0)])]
    got = report.sorted_rows(spark.createDataFrame(rows, "event_id int, is_event_article boolean, is_relevant boolean, flood_term_hits int, doc_id int").repartition(3)).collect()
    assert [r.doc_id for r in got] == [5, 2, 3, 4, 1, 0]


def test_only_ranks_are_written(spark, sf, written):
    got = queries.retrieval_rank(spark, sf)
    assert got.count() == 6000 and all(len(c) <= 6 for c in written)
    assert "SortMergeJoin" not in executed(got)  # 60 groups are looked up


def captures_and_specs(spark):
    rng = random.Random(5)
    at = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)
    pages = [(i, rng.choice("ab"), rng.choice(["d1", "d2", None]), at(rng.randrange(200)), f"u{rng.randrange(9)}", i) for i in range(1500)] + [(9999, "a", "d1", None, "u", 9999)]
    specs = [(e, f"{e}_{rng.choice('AACDz')}", rng.choice("ab"), rng.choice(["d1", "d2"]), at(a := rng.randrange(200)), at(a + rng.choice([0, 1, 5, 90, -3])), rng.choice(["restricted", "restricted", "open", None])) for e in [*range(40), *range(10), 7]]
    specs += [(50, "50_A", "a", "d9", at(0), at(200), "open"), (51, "51_A", "a", "d1", None, at(200), "open"), (52, "52_A", None, "d1", at(0), at(200), "open")]
    got = (spark.createDataFrame(pages, "row_id long, crawl_id string, domain string, ts timestamp, url string, offset long").repartition(5), spark.createDataFrame(specs, "event_id int, query_id string, crawl_id string, domain string, window_start timestamp, window_end timestamp, retrieval_strategy string"))
    pairs = [(s, p) for s in specs for p in pages if p[1] == s[2] and p[2] == s[3] and None not in (p[3], s[4], s[5]) and s[4] <= p[3] <= s[5]]
    return (*got, specs, pairs)


@pytest.mark.parametrize("rows", [0, 100_000])
def test_hits_counts_and_caps(spark, monkeypatch, rows):
    monkeypatch.setattr(plan, "BROADCAST_ROWS", rows)
    pages, own, specs, pairs = captures_and_specs(spark)
    assert sorted((r.event_id, r.query_id, r.row_id) for r in index.match(pages, own).collect()) == sorted((s[0], s[1], p[0]) for s, p in pairs)
    counts = index.hit_counts(pages, own)
    want = Counter((s[0], s[1], s[1][-1], s[2]) for s, _ in pairs if s[1][-1] in "ACD")
    assert {(r.event_id, r.query_id, r.variant, r.crawl_id): r.hit_count for r in counts.collect()} == want
    assert "SortMergeJoin" not in executed(counts)  # captures and specs aren't paired
    assert sum(r.hit_count for r in index.hit_counts_by_variant(pages, own).collect()) == sum(want.values())
    assert {r.event_id for r in index.zero_hit_events(pages, own).collect()} == {s[0] for s in specs} - {s[0] for s, _ in pairs}
    profile, groups = replace(DEFAULT, hit_cap=3, national_hit_cap=2), {}
    for s, p in pairs:
        groups.setdefault((s[0], s[2], s[3]), []).append((p[3], p[4], p[5])) if s[6] == "restricted" else None
    left = Counter((*k, x) for k, v in groups.items() for x in sorted(v)[: 2 if k[2] == "d2" else 3]) + Counter((s[0], s[2], s[3], (p[3], p[4], p[5])) for s, p in pairs if s[6] != "restricted")
    got = index.capped_match(pages, own, ("d2",), profile)
    assert Counter((r.event_id, r.crawl_id, r.domain, (r.ts, r.url, r.offset)) for r in got.collect()) == left
    assert set(got.columns) == set(index.match(pages, own).columns)
    assert Counter((r.event_id, r.crawl_id, r.domain, (r.ts, r.url, r.offset)) for r in index.cap_hits(index.match(pages, own), ("d2",), profile).collect()) == left


def test_no_specs_no_hits(spark):
    pages, own, _, _ = captures_and_specs(spark)
    for f in (index.match, index.hit_counts, index.capped_match, index.zero_hit_events):
        assert f(pages, own.limit(0)).count() == 0
    assert index.hit_counts(pages.limit(0), own).count() == 0 and index.zero_hit_events(pages.limit(0), own).count() == 43


def test_lookup(spark):
    left = spark.createDataFrame([(1, "a", "old"), (2, "a", "x"), (2, "a", "x"), (None, "a", "y")], "k int, v string, url string")
    right = spark.createDataFrame([(1, "u2", 2), (1, "u1", 1), (3, "u3", 1), (None, "u0", 1)], "k int, url string, at int")
    assert sorted((str(r.k), r.v, r.url) for r in enrich.lookup(left, right, ["k"], ["url"], fill="", order=["at"]).collect()) == [("1", "a", "u1"), ("2", "a", ""), ("2", "a", ""), ("None", "a", "")]
    assert enrich.among(left, right, ["k"]).count() == 1 and enrich.not_among(left, right, ["k"]).count() == 3


def test_terms_of_read_lexicons(spark, tmp_path):
    import json

    (tmp_path / "l.json").write_text(json.dumps({"spa": {"flood": ["Inundación", "flash flood", "Inundacion"], "impact": ["muertos"], "other": ["x"]}, "rus": {"river": ["река"]}}))
    lexicon = readers.lexicon(spark, str(tmp_path / "l.json"))
    events = spark.createDataFrame([(1, ["spa", "rus", "spa"]), (2, []), (3, None)], "event_id int, codes array<string>")
    spots = spark.createDataFrame([(1, "San José", ["S. J.", "chepe"], "subnational"), (1, "costa rica", None, "country")], "event_id int, location_normalised string, aliases array<string>, level string")
    terms = relevance.terms_of(events, lexicon, spots)
    assert sorted(r.event_id for r in terms.collect()) == [1, 2, 3]
    texts = [(1, "Una inundación: flash flood, река, muertos en San Jose", None), (1, "inundaciones flash  flood рекавода", "chepe"), (1, "s. j. costa rica", ""), (2, "inundación", ""), (9, None, None)]
    got = relevance.score(spark.createDataFrame(texts, "event_id int, clean_text string, page_title string"), terms).toPandas().sort_values(["event_id"], kind="stable")
    assert sorted(zip(got.event_id, got.flood_term_hits, got.impact_term_hits, got.location_term_hits, got.subnational_hits)) == [(1, 0, 0, 1, 0), (1, 0, 0, 1, 1), (1, 3, 1, 1, 1), (2, 0, 0, 0, 0), (9, 0, 0, 0, 0)]  # no word ends after a full stop
    old = relevance.score(spark.createDataFrame([(1, "chepe s. j. costa rica", "flash flood")], "event_id int, clean_text string, page_title string"), terms, legacy=True).first()
    assert (old.location_term_hits, old.subnational_hits, old.flood_term_hits) == (2, 1, 0)


def test_likelihood_ratio(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 2))
    y = (rng.random(400) < 1 / (1 + np.exp(-(0.8 * x[:, 0] - 0.2)))).astype(int)
    z, w = np.c_[np.ones(400), x], np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-z @ w))
        w += np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z, z.T @ (y - p))
    ll = lambda p: float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())
    want = 2 * (ll(1 / (1 + np.exp(-z @ w))) - ll(np.full(400, y.mean())))
    rows = spark.createDataFrame([(int(a), float(b), float(c)) for a, (b, c) in zip(y, x)] + [(None, 1.0, 1.0)], "y int, a double, b double")
    got = metrics.likelihood_ratio(rows, "y", ["a", "b"]).first()
    assert abs(got.statistic - want) < 1e-3 and got.dof == 2
    assert metrics.likelihood_ratio(rows.filter("y = 1"), "y", ["a"]).first().statistic == 0
