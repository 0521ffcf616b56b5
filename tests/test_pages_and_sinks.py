"""Malformed pages, retries, and what is written."""

import json
import urllib.error

import pytest
from pyspark.sql import functions as F

from millrace.operators import classify, index, report
from millrace.sources import archive, readers, sinks

LONG = "Words of the body that go on for a while. " * 8


@pytest.mark.parametrize(
    "markup, text, failed",
    [
        ("", "", False), ("plain", "plain", False), ("<p>a<![foo[x]]>b</p>", "b", True), ("<p>before</p>a<![%", "before", True), ("<p>a</p><![CDATA[x]]><p>b</p>", "a", False), ("<p>a</p><!DOCTYPE [<!x", "a", None),
        ("<div><form><input>f</div><p>rest</p>", "rest", False), ("<form>only this", "only this", False), ("<body><button>b<p>x</p></body>tail", "tail", False), ("<nav>menu<p>in it", "menu", False),
        ("</div></p><p>x</p></article>", "x", False), ("<script>var a='<p>'; </script><p>y</p>", "y", False), ("<p>&#xD800;&#0;&bogus; z</p>", "z", False), ("<p " + "a=b " * 3000 + ">deep", "deep", False), ("<div>" * 3000 + "down", "down", False),
        ("\x00<p>\x00q</p>", "q", False), ("<title>t", "", None), ("<?php echo ?><p>k</p>", "k", False), ("<p>a</p><!-- never ends", "a", None), ("<!-->", None, None),
    ],
)
def test_pages_never_fail(markup, text, failed):
    got = archive.read_page(markup)
    assert set(got) <= set(archive.PAGE_SCHEMA.names)
    if text is not None:
        assert text in got["raw_text"] and bool(got["raw_text"]) == bool(text)
    if failed is not None:
        assert (got["extraction_error"] not in ("", "no text")) == failed


def test_bodies():
    read = lambda m: (lambda p: (p["extraction_method"], p["raw_text"]))(archive.read_page(m))
    assert read(f"<nav>n</nav><p>out</p><article><h1>T</h1><p>{LONG}</p></article>") == ("article", f"T\n{LONG.strip()}")
    assert read(f"<div class=side><a>x</a> <a>y</a></div><div><p>{LONG}</p><p>more</p></div><div>{LONG}</div>") == ("density", f"{LONG.strip()}\nmore")
    assert read(f"<div><p><a>{LONG}</a></p></div><p>z</p>")[0] == "text"
    assert read("<article><p>short</p></article><p>other</p>") == ("text", "short\nother")


def test_pages_in_a_column(spark):
    rows = spark.createDataFrame([(1, "<p>a<![foo[x]]>b</p>"), (2, None), (3, "<title>T</title><p>x</p>")], "id int, html string")
    got = {r.id: r.p for r in rows.select("id", archive.extract_html("html").alias("p")).collect()}
    assert got[1].extraction_error.startswith("AssertionError") and "b" in got[1].raw_text and not got[2].extraction_success and got[3].page_title == "T"


def test_retries():
    assert [archive.backoff(k) for k in (0, 1, 2)] == [1, 5, 25] and archive.backoff(0, True) == 125
    slept, answers = [], [OSError("reset"), b"", b"x"]

    def call():
        got = answers.pop(0)
        if isinstance(got, Exception):
            raise got
        return got

    assert archive.tried(call, 3, sleep=slept.append, usable=bool) == b"x" and slept == [1, 5]
    answers, slept = [urllib.error.HTTPError("u", 503, "slow down", None, None), b"y"], []
    assert archive.tried(call, 3, sleep=slept.append) == b"y" and slept == [125]
    answers = [urllib.error.HTTPError("u", 404, "none", None, None)]
    with pytest.raises(urllib.error.HTTPError):
        archive.tried(call, 3, sleep=slept.append)
    answers = [OSError("a"), OSError("b")]
    with pytest.raises(OSError, match="b"):
        archive.tried(call, 2, sleep=slept.append)


def test_group_csv_and_summaries(spark, tmp_path):
    rows = spark.range(3000).select((F.col("id") % 3).cast("int").alias("event_id"), F.col("id").alias("doc_id"), F.lit('say "x",\ny').alias("t")).repartition(5)
    counts = {r.event_id: r.n for r in sinks.csv_by_group(rows, str(tmp_path / "c"), "event_id", ("doc_id",)).collect()}
    assert counts == {0: 1000, 1: 1000, 2: 1000}
    back = readers.parts(spark, str(tmp_path / "c/event_id=1/*.csv"))
    got = sorted((int(r.doc_num), int(r.doc_id), r.t) for r in back.collect())
    assert [x[:2] for x in got] == [(k + 1, 3 * k + 1) for k in range(1000)] and got[0][2] == 'say "x",\ny'
    sinks.summary(rows.select("event_id", "doc_id"), str(tmp_path / "s"), "Articles", ["event_id", "doc_id"])
    lines = "".join(p.read_text() for p in sorted((tmp_path / "s").glob("part-*"))).splitlines()
    assert lines[:3] == ["Articles", "========", "event_id: 0  doc_id: 0"] and len(lines) == 3002 and lines[-1] == "event_id: 2  doc_id: 2999"
    progress = spark.createDataFrame([(2, 5, 5, 5, 3), (1, 4, 0, 0, 1)], "event_id int, pointers long, fetched long, extracted long, stages int")
    sinks.progress_document(progress, str(tmp_path / "p"), "2024-01-01T00:00:00Z")
    lines = [json.loads(x) for p in sorted((tmp_path / "p").glob("part-*")) for x in p.read_text().splitlines()]
    assert lines[0] == {"generated_at": "2024-01-01T00:00:00Z", "total_events": 2, "complete": 1, "fetched": 0, "begun": 1, "not_begun": 0} and [x["event_id"] for x in lines[1:]] == [1, 2]


def test_plain_sinks_and_sources(spark, tmp_path, monkeypatch):
    one, two = (spark.createDataFrame(x, "k int, v string") for x in ([(1, "a")], [(2, None)]))
    p = str(tmp_path / "t")
    sinks.overwrite(one, p)
    sinks.overwrite(two, p, one.schema)
    sinks.append(one, p)
    assert sorted(r.k for r in spark.read.parquet(p).collect()) == [1, 2]
    for df in (one, two):
        sinks.append(df, str(tmp_path / "log"), "json")
    assert readers.responses(spark, str(tmp_path / "log"), "k int, v string").count() == 2
    other = str(tmp_path / "u")
    spark.createDataFrame([(3, 1.5)], "k int, w double").write.parquet(other)
    both = readers.index_tables(spark, [p, other])
    assert set(both.columns) == {"k", "v", "w"} and both.count() == 3
    (tmp_path / "crawls.json").write_text('[{"id": "C1", "name": "n", "from": "2024-01-01T00:00:00Z", "to": "2024-01-09T00:00:00Z"}, {"name": "x"}]')
    assert [r.id for r in readers.crawls(spark, str(tmp_path / "crawls.json")).collect()] == ["C1", None]
    (tmp_path / "b" / "x").mkdir(parents=True)
    (tmp_path / "b" / "x" / "p7.warc.gz").write_bytes(b"123")
    (tmp_path / "b" / "skip.txt").write_bytes(b"1")
    assert [(r.pointer_id, r.bytes, bytes(r.content)) for r in readers.blobs(spark, str(tmp_path / "b")).collect()] == [("p7", 3, b"123")]
    monkeypatch.setenv("MILLRACE_EVENTS", "4-6,1")
    assert readers.from_environment() == [1, 4, 5, 6] and readers.from_environment("NO_SUCH_NAME") is None
    assert [r.k for r in readers.scope(spark.range(5).withColumnRenamed("id", "k"), "k", [1, 2, 3], [2]).orderBy("k").collect()] == [1, 3]
    scan = readers.scan(spark.read.parquet(p), ["v"], "k", 1, 1)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert [r.v for r in scan.collect()] == ["a"] and "GreaterThanOrEqual(k,1)" in plan


def test_merge_of_lexicons(spark):
    old = spark.createDataFrame([("spa", "flood", "a"), ("spa", "river", "rio"), ("rus", "flood", "b")], "language string, category string, term string")
    new = spark.createDataFrame([("spa", "flood", "c"), ("spa", "river", "no")], "language string, category string, term string")
    assert sorted(tuple(r) for r in readers.merge_lexicons(old, new).collect()) == [("rus", "flood", "b"), ("spa", "flood", "c"), ("spa", "river", "rio")]


def test_specs(spark):
    specs = spark.createDataFrame([("1_A",), ("PER_1",), (None,)], "query_id string")
    assert [r.query_id for r in index.odd_query_ids(specs).collect()] == ["PER_1"]
    with pytest.raises(ValueError):
        index.check_query_ids(specs)
    assert index.check_query_ids(specs.limit(0)).count() == 0
    events = spark.createDataFrame([(1, "PER"), (2, "XXX")], "event_id int, iso string")
    lists = spark.createDataFrame([("PER", ["a.pe", "b.pe"], ["a.pe"], None)], "iso string, news_domains array<string>, gov_domains array<string>, org_domains array<string>")
    got = sorted((r.event_id, r.retrieval_strategy, r.domain) for r in index.resolve_domains(events, lists, ("f.org",)).collect())
    assert got == [(1, "restricted", "a.pe"), (1, "restricted", "b.pe"), (2, "open", "f.org")]


def test_report_filters_without_columns(spark):
    rows = spark.createDataFrame([(1, True, None), (2, None, True), (3, False, False)], "doc_id int, is_relevant boolean, is_soft_relevant boolean")
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    assert ids(report.event_only(rows)) == [1] and ids(report.relevant(rows)) == [1] and ids(report.in_pub_window(rows)) == [] and ids(report.nlp_rows(rows, "soft")) == [1, 2]
    assert ids(report.with_text(spark.createDataFrame([(1, "x" * 51), (2, "x" * 50), (3, None)], "doc_id int, clean_text string"))) == [1]


def test_language_model(spark, sf):
    docs = spark.read.parquet(sf.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "text", "lang")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 2
    model = classify.fit_languages(docs.filter(~held))
    got = classify.languages_of(model, docs.filter(held)).toPandas()
    known = got[got.language != "unknown"]
    assert len(known) > 200 and (known.language == known.lang).mean() > 0.95
    odd = classify.languages_of(model, spark.createDataFrame([(1, None), (2, "short"), (3, "1234567890 " * 9)], "doc_id int, text string")).toPandas()
    assert odd.language.tolist()[:2] == ["unknown", "unknown"] and len(odd) == 3


def test_pages_are_read_in_slices():
    import pyarrow as pa

    parts = list(archive._read([pa.array(["<title>t</title><p>x"] * 1000), pa.array(["y" * archive._BYTES, None, "z"]), pa.array([], pa.string())], archive._page))
    assert [len(p) for p in parts] == [256, 256, 256, 232, 1, 2, 0]  # no slice holds a whole batch of ten thousand pages
    assert parts[0][0].as_py()["page_title"] == "t" and parts[5][0].as_py()["extraction_error"] == "no text"


@pytest.mark.parametrize("title, want", [("a &quot;b&quot; &amp; c", 'a "b" & c'), ("&amp;lt;b&amp;gt;", "&lt;b&gt;"), ("&amp;amp;quot;", "&amp;quot;")])
def test_titles_are_unescaped_once(title, want):
    assert archive.read_page(f"<title> {title} </title>")["page_title"] == want
