"""Behaviour of single operators on hand-made rows."""

import gzip
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, languages, places, text, urls
from millrace.operators import classify, coverage, dedup, gates, pointers, relevance, report, rules
from millrace.plans.refine import refine
from millrace.sources import archive, readers, sinks
from millrace.streaming import pointers as stream


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "raw, want",
    [
        (None, ""), ("", ""), ("a  b", "a b"), ("a\n\nb", "a\n\nb"), ("a\n\n\n\nb", "a\n\nb"), ("Subscribe now\nx", "x"), ("SIGN UP here\nx", "x"), ("Accept cookies please\nx", "x"),
        ("Subscribers were told\nx", "Subscribers were told\nx"), ("we accept cookies\nx", "we accept cookies\nx"), ("  x  ", "x"), ("a\r\nb\x85c\u2028d", "a\nb\nc\nd"), ("Advertisement\n", ""), ("cookie policy\nok", "ok"),
    ],
)
def test_clean_text(spark, raw, want):
    assert one(spark, raw, text.clean_text) == want


@pytest.mark.parametrize("t, n, w, r", [(None, 0, 0, 0.0), ("", 0, 0, 0.0), ("hello world", 11, 2, 0.0), ("héllo", 5, 1, 0.2), ("فيضان", 5, 1, 1.0), ("a\xa0b", 3, 2, 0.3333)])
def test_metrics(spark, t, n, w, r):
    assert (one(spark, t, text.char_count), one(spark, t, text.word_count), one(spark, t, lambda c: text.non_ascii_ratio(F.coalesce(c, F.lit(""))))) == (n, w, r)


@pytest.mark.parametrize(
    "url, title, want",
    [
        ("https://e.com/news/a", "Flood", False), ("https://e.com/", None, True), ("https://e.com", "", True), ("https://e.com/tag/x", "", True), ("https://e.com/category/x/", "", True), ("https://e.com/page/3", "", True),
        ("https://e.com/a?q=x", "", True), ("https://e.com/2024/10/", "", True), ("https://e.com/2024/10/a", "", False), ("https://e.com/a", "News — Page 2", True), ("https://e.com/a", "Tag: rain", True), (None, "Rain", False),
        ("https://e.com/a", None, False), ("https://www.weather.gov/x", "", True), ("https://e.com/a", "Chapter 5", True), ("https://e.com/a", "3.4 Water", True),
    ],
)
def test_listing(spark, url, title, want):
    row = spark.createDataFrame([(url, title)], "u string, t string").select(urls.is_listing(F.col("u"), F.col("t")).alias("y")).first()
    assert row.y is want


@pytest.mark.parametrize(
    "term, t, want",
    [
        ("flood", "a flood came", True), ("flood", "flooding", False), ("flood", "Flood", True), ("flood", "the flood", True), ("flood", "flood, and", True), ("flood", "éflood", False), ("فيضان", "في فيضان كبير", True),
        ("river burst", "the river burst", True), ("c++", "a c++ b", False),
    ],
)
def test_terms(spark, term, t, want):
    assert one(spark, t, lambda c: F.regexp_like(c, F.lit(text.term_pattern(term)))) is want


def test_accents_and_cuts(spark):
    import unicodedata

    sample = "Ünï ño ĀḂ é ỡ ﬁ ß"
    want = "".join(filter(lambda c: unicodedata.category(c) != "Mn", unicodedata.normalize("NFD", sample)))
    assert one(spark, sample, text.strip_accents) == want
    assert one(spark, "x" * 250, text.truncated) is True and one(spark, "x" * 250 + ".", text.truncated) is False and one(spark, "x", text.truncated) is False
    assert one(spark, 'a"b\tc\n漢d', text.sanitize) == "a'b cd"
    assert one(spark, "x " * 700, text.snippet).endswith("…")


@pytest.mark.parametrize(
    "url, want",
    [
        ("HTTPS://E.com/A/?utm_source=x&b=1&B=&a=2#top", "https://e.com/a?b=1&a=2"), ("https://e.com/a/", "https://e.com/a"), ("https://e.com/?a=1&b=2&a=3", "https://e.com?a=1&a=3&b=2"), (None, ""), ("", ""), ("no address", "no address"),
    ],
)
def test_normalise_url(spark, url, want):
    assert one(spark, url, urls.normalise) == want


def test_domain(spark):
    assert one(spark, "https://www.wayka.pe/x", urls.domain) == "wayka.pe"
    assert one(spark, "https://wayka.pe/x", lambda c: urls.domain(c, faithful=True)) == "ayka.pe"


@pytest.mark.parametrize("x, want", [("d 2024-05-06T1", "2024-05-06"), ("1999-01-01", None), ("2025-02-31", "2025-02-31"), ("2025-13-01", None), ("", None)])
def test_find_date(spark, x, want):
    assert one(spark, x, dates.find_date) == want


@pytest.mark.parametrize(
    "raw, want",
    [("Kerr county (Texas)", ["kerr", "texas"]), ("Roswell (Chaves county, Eastern New Mexico)", ["roswell", "chaves", "new mexico"]), (None, []), ("of; the, Ab", []), ("Lima, lima", ["lima"])],
)
def test_places(spark, raw, want):
    assert one(spark, raw, places.parse) == want


@pytest.mark.parametrize("x, codes, skipped", [("eng,fra", {"eng", "fra", "por", "spa"}, {}), ("lin", {"eng", "fra", "por", "spa"}, {"lin": "tier3_low_coverage"}), ("qqq npi", {"eng", "fra", "npi", "por", "spa"}, {"qqq": "unknown_code"})])
def test_languages(spark, x, codes, skipped):
    got = one(spark, x, languages.query_codes)
    assert set(got) == codes and got == sorted(got) and one(spark, x, languages.skipped) == skipped


GOOD = "/".join(["crawl-data", "CC-MAIN-2023-50", "segments", "17", "warc", "a.warc.gz"])


@pytest.mark.parametrize(
    "offset, length, name, reason",
    [
        ("12345", "98765", GOOD, ""), (None, "1", GOOD, "null offset"), ("-1", "1", GOOD, "negative offset"), ("0", "1", GOOD, ""), ("abc", "1", GOOD, "non-numeric offset"), ("1", None, GOOD, "null length"),
        ("1", "0", GOOD, "non-positive length"), ("1", "-500", GOOD, "non-positive length"), ("1", "1", None, "missing filename"), ("1", "1", "", "missing filename"), ("1", "1", "x", "malformed filename"),
        (None, "abc", "x", "null offset, non-numeric length, malformed filename"),
    ],
)
def test_pointer_reasons(spark, offset, length, name, reason):
    df = spark.createDataFrame([(offset, length, name)], "offset string, length string, filename string")
    assert pointers.validate(df).first().reject_reason == reason


@pytest.mark.parametrize("n, want", [("499", "TOO_SMALL"), ("500", "VALID"), ("5000000", "VALID"), ("5000001", "TOO_LARGE")])
def test_sizes(spark, n, want):
    assert one(spark, n, pointers.size_class) == want


def test_fetch_and_cache(spark):
    rows = spark.createDataFrame([(100, 100, 206), (100, 60, 206), (100, 0, 404), (100, 0, 503)], "e long, r long, s int")
    ok, error = pointers.fetch_result(F.col("e"), F.col("r"), F.col("s"))
    assert [tuple(x) for x in rows.select(ok, error).collect()] == [(True, ""), (True, "PARTIAL"), (False, "NOT_FOUND"), (False, "RATE_LIMITED")]
    p = spark.createDataFrame([("a", "100"), ("b", "100"), ("c", "100")], "pointer_id string, length string")
    files = spark.createDataFrame([("a", 95), ("b", 94)], "pointer_id string, bytes long")
    assert sorted(r.pointer_id for r in pointers.not_cached(p, files).collect()) == ["b", "c"]


def test_coverage(spark):
    crawls = spark.createDataFrame([("c1", None, "2024-01-01T00:00:00Z", "2024-01-10T00:00:00Z"), (None, "c2", "2024-01-20T00:00:00", "2024-02-20T00:00:00"), ("bad", None, None, "x")], "id string, name string, from string, to string")
    crawls = coverage.crawl_windows(crawls)
    assert sorted(r.crawl_id for r in crawls.collect()) == ["c1", "c2"]
    day = date.fromisoformat
    events = [(1, day("2024-01-08"), day("2024-01-09"), 2), (2, day("2024-02-10"), day("2024-02-10"), 0), (3, day("2023-10-01"), None, 1), (4, day("2024-06-01"), None, 1), (5, day("2023-05-01"), None, 1)]
    df = coverage.event_windows(spark.createDataFrame(events, "event_id int, start_date date, end_date date, duration int"))
    got = {r.event_id: r for r in coverage.coverage(df, crawls).collect()}
    assert {k: r.coverage_status for k, r in got.items()} == {1: "COVERED", 2: "PARTIAL", 3: "NEAREST", 4: "NO_CRAWL", 5: "NO_CRAWL"}
    assert got[3].matching_crawls == ["c1"] and str(got[3].window_end) == "2024-01-10 00:00:00"


def test_long_and_late_windows(spark):
    df = spark.createDataFrame([(1, date(2024, 1, 1), None, 60), (2, date(2024, 1, 1), None, 0)], "event_id int, start_date date, end_date date, duration int")
    got = {r.event_id: r for r in coverage.event_windows(df).collect()}
    assert str(got[1].window_end)[:10] == "2024-03-21" and str(got[2].window_end)[:10] == "2024-02-15" and str(got[2].window_start)[:10] == "2023-12-27"
    assert str(coverage.event_windows(df, late=True).collect()[1].window_start)[:10] == "2024-03-01"


LEXICON = {"eng": {"flood": ["flood", "inundation", "river burst"], "impact": ["dead"]}}


def test_relevance(spark):
    terms = relevance.event_terms(spark, {i: ["eng"] for i in (1, 2, 3)}, LEXICON, {1: [("jakarta", "subnational", ["djakarta"]), ("indonesia", "country", [])], 2: [("indonesia", "country", [])]})
    rows = [(1, 1, "A flood, an inundation in Djakarta; two dead", ""), (2, 1, "flood in jakarta", ""), (3, 1, "flood inundation", None), (4, 2, "flood and inundation", "Indonesia"), (5, 3, "flood, inundation", ""), (6, 1, None, None), (7, 9, "flood", "")]
    got = {r.doc_id: r for r in relevance.score(spark.createDataFrame(rows, "doc_id int, event_id int, clean_text string, page_title string"), terms).collect()}
    assert [got[i].is_relevant for i in range(1, 8)] == [True, False, False, True, True, False, False]
    assert got[1].is_event_article and got[1].location_term_hits == 1 and got[4].low_specificity and not got[5].is_soft_relevant and got[7].flood_term_hits == 0


def test_dedup(spark):
    rows = [(1, 1, "https://e/a?utm_source=x", "2", "T"), (2, 1, "https://e/a", "1", "other"), (3, 1, "https://e/b", "1", "T"), (4, 1, "https://e/c", "3", "T"), (5, 2, "https://e/d", "0", "T"), (6, 2, None, None, ""), (7, 2, None, None, None)]
    got = {r.doc_id: r for r in dedup.flag_duplicates(spark.createDataFrame(rows, "doc_id int, event_id int, url string, timestamp string, clean_text string")).collect()}
    assert [got[i].is_content_duplicate for i in range(1, 8)] == [True, False, False, True, False, False, False]
    assert got[5].cross_event_shared and not got[3].cross_event_shared and got[3].duplicate_group_id == got[4].duplicate_group_id != "" and got[1].duplicate_group_id == ""


def test_usability_order(spark):
    df = spark.createDataFrame([("ü" * 50, "403 forbidden"), ("ü" * 50, ""), ("", "x"), ("x" * 300, "ok")], "raw_text string, page_title string")
    rows = gates.with_clean_text(df)
    assert [r[0] for r in rows.select(gates.usability(F.col("page_title"))).collect()] == ["error_page_title", "non_ascii_ratio_too_high", "empty text", None]
    assert [r[0] for r in rows.select(gates.usability(F.col("page_title"), first_match=True)).collect()] == ["char_count_too_short", "char_count_too_short", "empty text", None]


@pytest.mark.parametrize(
    "title, url, domain, body, hits, want",
    [
        ("Weather | Forecast Conditions", "", "", "", 1, "weather_forecast_page"), ("x", "https://e/Staff-Personalities/y", "", "", 1, "journalist_profile"), ("Coronavirus hoy", "", "", "", 1, "covid_content"),
        ("Coronavirus e inundación", "", "", "", 1, ""), ("Dengue", "", "", "", 1, "disease_not_flood"), ("News", "", "", "dengue " * 3, 1, "disease_not_flood"), ("News", "", "", "x" * 300 + " dengue", 1, ""),
        ("Terremoto", "", "", "", 1, "earthquake_not_flood"), ("Sequía", "", "", "", 1, "water_scarcity_not_flood"), ("Nota", "", "clarin.com", "", 1, "strict_domain_no_flood_title"), ("Lluvias", "", "clarin.com", "", 1, ""),
        ("Nota", "", "", "", 0, "zero_keyword_hits"), (None, None, None, None, 1, ""), ("asesino", "", "", "", 1, ""), ("Licitação aberta", "", "cemaden.gov.br", "", 1, "cemaden_institutional"),
    ],
)
def test_post_filter(spark, title, url, domain, body, hits, want):
    df = spark.createDataFrame([(title, url, domain, body, hits)], "t string, u string, d string, b string, h int")
    assert df.select(rules.post_filter_reason(F.col("t"), F.col("u"), F.col("d"), F.col("b"), F.col("h"), F.lit(0))).first()[0] == want


def test_report_number_is_global(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("event_id"), F.col("id").alias("doc_id"))
    got = [r.doc_num for r in report.numbered(df, ("event_id", "doc_id")).orderBy("event_id", "doc_id").collect()]
    assert got == list(range(1, 1001))


def test_upsert_and_csv(spark, tmp_path):
    p = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a"), (2, "b")], "event_id int, v string")
    sinks.upsert_partitions(old, p)
    sinks.upsert_partitions(spark.createDataFrame([(2, "c"), (2, "d")], "event_id int, v string"), p)
    assert sorted(tuple(r) for r in spark.read.parquet(p).select("event_id", "v").collect()) == [(1, "a"), (2, "c"), (2, "d")]
    sinks.csv(spark.createDataFrame([(1, 'say "x",\ny')], "event_id int, v string"), str(tmp_path / "c"))
    assert readers.parts(spark, str(tmp_path / "c/*.csv")).first().v == 'say "x",\ny'
    sinks.manifests(old, str(tmp_path / "m"))
    assert spark.read.text(str(tmp_path / "m/event_id=1")).first().value == '{"event_id":1,"v":"a"}'


def test_merge_keeps_existing(spark):
    old, new = (spark.createDataFrame(x, "k string, v int") for x in ([("a", 1), (None, 1)], [("a", 2), ("b", 3), ("b", 4), (None, 5)]))
    assert sorted((str(r.k), r.v) for r in sinks.merged(old, new, ["k"], ["v"]).collect()) == [("None", 1), ("a", 1), ("b", 3)]


def test_readers(spark, tmp_path):
    (tmp_path / "e.csv").write_text('Flood_ID,ISO,Location,Start Date,End Date,Duration\n1,PER,"A, B",2024-01-01,,3\n')
    row = readers.registry(spark, str(tmp_path / "e.csv")).first()
    assert (row.event_id, row.location, str(row.start_date), row.end_date, row.languages) == (1, "A, B", "2024-01-01", None, None)
    (tmp_path / "l.json").write_text(json.dumps(LEXICON))
    assert readers.lexicon(spark, str(tmp_path / "l.json")).count() == 4
    (tmp_path / "r.jsonl").write_text('{"a":1}\n\nnope\n{"a":2}\n')
    assert [r.a for r in readers.responses(spark, str(tmp_path / "r.jsonl"), "a int").collect()] == [1, 2]
    with gzip.open(tmp_path / "m.gz", "wt") as f:
        f.write("x/subset=warc/p.parquet\nx/subset=robots/p.parquet\n")
    assert readers.manifest(spark, str(tmp_path / "m.gz")).count() == 1
    assert readers.id_ranges("1-3, 7,2") == [1, 2, 3, 7]
    assert readers.first_that_exists(spark, str(tmp_path / "no.csv"), str(tmp_path / "e.csv")).count() == 1 and readers.first_that_exists(spark, str(tmp_path / "no.csv")) is None


PAGE = '<html><head><title>T &amp; x</title><meta name="description" content="d"><meta property="article:published_time" content="2024-05-06T00"></head><body><nav>menu</nav><p>Body one</p><script>var x</script><p>two</p></body></html>'


def test_archive(spark, tmp_path):
    record = b"WARC/1.0\r\nWARC-Type: response\r\n\r\nHTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + PAGE.encode()
    packed = gzip.compress(record)
    (tmp_path / "f.warc.gz").write_bytes(b"xxxx" + packed)
    got = archive.fetch_ranges(spark.createDataFrame([("a", "f.warc.gz", "4", str(len(packed))), ("b", "none", "0", "9")], "pointer_id string, filename string, offset string, length string"), str(tmp_path) + "/{filename}", 1)
    rows = {r.pointer_id: r for r in got.select("*", archive.extract_record("content").alias("p")).collect()}
    assert rows["a"].bytes_received == len(packed) and rows["b"].http_status == 0
    p = rows["a"].p
    assert (p.page_title, p.meta_description, p.pub_date, p.pub_date_source, p.raw_text, p.extraction_success, p.encoding_detected) == ("T & x", "d", "2024-05-06", "meta", "Body one\ntwo", True, "utf-8")
    assert not rows["b"].p.extraction_success and rows["b"].p.extraction_error == "no response record"


def test_index_source(spark, tmp_path):
    for page, n in ((0, 2), (1, 1)):
        (tmp_path / f"C1.{page}").write_text("".join(json.dumps({"url": f"u{page}{i}", "offset": "1"}) + "\n" for i in range(n)))
    spark.dataSource.register(archive.IndexSource)
    df = spark.read.format("crawl-index").options(base=f"file://{tmp_path}/{{crawl_id}}", crawls="C1,C2", patterns="e.com/*", page_size=2).load()
    assert sorted(r.url for r in df.collect()) == ["u00", "u01", "u10"]


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:01"), (2, "2024-01-01 00:00:00")], "k int, t string").select("k", F.to_timestamp("t").alias("ts"))
    rows.write.parquet(str(tmp_path / "in"))
    stream.drain(stream.without_duplicates(stream.arriving(spark, str(tmp_path / "in"), "k int, ts timestamp"), ["k"]), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]


def test_model(spark):
    rows = spark.createDataFrame([(i, "good flood water" if i % 2 else "bad fire smoke", str(i % 2)) for i in range(60)] + [(99, None, "x")], "id int, text string, label string")
    model = classify.fit(classify.training_rows(rows), 1 << 10)
    got = classify.predict(model, spark.createDataFrame([(1, "flood water"), (2, "fire smoke"), (3, None)], "id int, text string")).orderBy("id").collect()
    assert [r.model_positive for r in got] == [True, False, False] and got[2].model_prob is None
    with pytest.raises(ValueError):
        classify.training_rows(rows.limit(10))


def test_refine(spark):
    body = "the flood and the inundation of the town is what it was and this is for it in the end. " * 5
    rows = [(1, 1, body, "A", "https://e/a", "1", "2024-01-02"), (2, 1, body, "A", "https://e/b", "2", None), (3, 1, "short", "A", "https://e/c", "1", None), (4, 1, body, "A", "https://e/", "1", None)]
    articles = spark.createDataFrame(rows, "doc_id int, event_id int, raw_text string, page_title string, url string, timestamp string, pub_date string")
    terms = relevance.event_terms(spark, {1: ["eng"]}, LEXICON, {})
    wanted = spark.createDataFrame([(1, ["eng"], {})], "event_id int, query_codes array<string>, skipped map<string,string>")
    windows = spark.createDataFrame([(1, date(2024, 1, 1), date(2024, 1, 3))], "event_id int, window_start date, window_end date")
    kept, rejected = refine(articles, terms, wanted, windows)
    assert {r.doc_id: (r.is_content_duplicate, r.pub_in_window) for r in kept.collect()} == {1: (False, True), 2: (True, None)}
    assert {r.doc_id: r.reject_reason for r in rejected.collect()} == {3: "char_count_too_short", 4: "tag_or_index_page"}


def test_place_dictionary(spark):
    events = spark.createDataFrame([(1, "Peru", "Lima (Rimac), Callao", "n/a"), (2, "United States", None, "Guadalupe")], "event_id int, country string, location string, river_basin string")
    aliases = spark.createDataFrame([("united states", "USA"), ("lima", "Ciudad de Lima")], "name string, alias string")
    got = {(r.event_id, r.location_normalised): (r.aliases, r.level, r.ambiguous) for r in places.dictionary(events, aliases, ["peru"], ["rimac"]).collect()}
    assert got == {
        (1, "peru"): ([], "country", False), (1, "lima"): (["Ciudad de Lima"], "subnational", False), (1, "callao"): ([], "subnational", False), (1, "rimac"): ([], "subnational", True),
        (2, "united states"): (["USA"], "country", False), (2, "usa"): ([], "country", False), (2, "guadalupe"): ([], "subnational", False),
    }
