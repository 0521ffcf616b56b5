"""Index pages and byte ranges as sources, and what is in a fetched slice.

Both sources speak to a transport, so the tests run on local files. An index query is a Spark data source with a
partition for each crawl and domain; ranges are read inside tasks, retried by Spark.
"""

from __future__ import annotations

import gzip
import json
import re
import time
import urllib.error
import urllib.parse
import urllib.request
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_type

INDEX_SCHEMA = "crawl_id string, url string, timestamp string, status string, mime string, filename string, offset string, length string, digest string"


class _Query(InputPartition):
    def __init__(self, crawl: str, pattern: str):
        super().__init__((crawl, pattern))
        self.crawl, self.pattern = crawl, pattern


def backoff(attempt: int, limited: bool = False, base: float = 5) -> float:
    """Seconds to wait after the attempt (from 0 on): base ** attempt, or, told to slow down, base ** (attempt + 3)."""
    return base ** (attempt + (3 if limited else 0))


def tried(call, attempts: int = 3, wait=backoff, sleep=time.sleep, usable=lambda got: True):
    """call()'s result; tried again after a pause on a network error, a status that asks for patience, or a result that
    isn't usable. The last error is raised; the last unusable result is returned. 404 isn't tried again."""
    for attempt in range(attempts):
        last = attempt == attempts - 1
        try:
            got = call()
            if last or usable(got):
                return got
            limited = False
        except urllib.error.HTTPError as e:
            limited = e.code in (403, 429, 503)
            if last or not limited and e.code < 500:
                raise
        except OSError:
            if last:
                raise
            limited = False
        sleep(wait(attempt, limited))


def _pages(base: str, crawl: str, pattern: str, start: str, end: str, size: int, cap: int, attempts: int = 3):
    """Responses line by line, page after page, until a short page or the cap (a multiple of the page size)."""
    page = got = 0
    while True:
        args = {"url": pattern, "output": "json", "from": start, "to": end, "pageSize": size, "page": page, "filter": ["mime:text/html", "status:200"]}
        remote = base.startswith("http")
        url = f"{base.format(crawl_id=crawl)}?{urllib.parse.urlencode(args, doseq=True)}" if remote else f"{base.format(crawl_id=crawl)}.{page}"

        def read():
            with urllib.request.urlopen(url, timeout=120) as r:  # noqa: B023
                return r.read()

        try:
            lines = tried(read, attempts if remote else 1, usable=bool).decode(errors="replace").splitlines()
        except urllib.error.HTTPError as e:
            if e.code == 404:
                return
            raise
        except urllib.error.URLError:
            if remote:
                raise
            return  # no further page among local files
        for line in lines:
            try:
                yield json.loads(line)
                got += 1
            except ValueError:
                continue
        page += 1
        if len(lines) < size or got >= cap:
            return


class IndexSource(DataSource):
    """spark.read.format("crawl-index"): options base ({crawl_id} in it), crawls and patterns (comma-separated), from, to,
    page_size and cap."""

    @classmethod
    def name(cls):
        return "crawl-index"

    def schema(self):
        return INDEX_SCHEMA

    def reader(self, schema):
        return _IndexReader(self.options)


class _IndexReader(DataSourceReader):
    def __init__(self, options):
        self.o = dict(options)

    def partitions(self):
        return [_Query(c, p) for c in self.o["crawls"].split(",") for p in self.o["patterns"].split(",")]

    def read(self, partition):
        names = [x.split()[0] for x in INDEX_SCHEMA.split(", ")]
        size = int(self.o.get("page_size", 1000))
        for row in _pages(self.o["base"], partition.crawl, partition.pattern, self.o.get("from", ""), self.o.get("to", ""), size, int(self.o.get("cap", 3000))):
            yield tuple(partition.crawl if n == "crawl_id" else row.get(n) for n in names)


FETCH_SCHEMA = "pointer_id string, content binary, bytes_received long, http_status int, error_message string"


def fetch_ranges(pointers: DataFrame, base: str, tasks: int = 8, timeout: float = 30, attempts: int = 3) -> DataFrame:
    """FETCH_SCHEMA for pointers (pointer_id, filename, offset, length); `tasks` bounds how many requests run at once. A
    request that fails is tried again after a pause that grows; what fails for good is a row with its status."""

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                a, n = int(r.offset), int(r.length)
                try:
                    if base.startswith("http"):
                        q = urllib.request.Request(base.format(filename=r.filename), headers={"Range": f"bytes={a}-{a + n - 1}"})

                        def ask():
                            with urllib.request.urlopen(q, timeout=timeout) as got:  # noqa: B023
                                return got.read(), got.status

                        data, status = tried(ask, attempts)
                    else:
                        with open(base.format(filename=r.filename), "rb") as f:
                            f.seek(a)
                            data, status = f.read(n), 206
                    out.append((r.pointer_id, data, len(data), status, ""))
                except urllib.error.HTTPError as e:
                    out.append((r.pointer_id, None, 0, e.code, str(e)))
                except OSError as e:
                    out.append((r.pointer_id, None, 0, 0, str(e)))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in FETCH_SCHEMA.split(", ")])

    return pointers.select("pointer_id", "filename", "offset", "length").repartition(tasks).mapInPandas(run, FETCH_SCHEMA)


# == what a slice holds

_TEXTS = ("page_title", "meta_description", "pub_date", "pub_date_source", "raw_text", "extraction_method", "extraction_error", "encoding_detected")
#: As types, not text: parsing text would need a session on import.
PAGE_SCHEMA = T.StructType([*(T.StructField(n, T.StringType()) for n in _TEXTS), T.StructField("extraction_success", T.BooleanType())])
_SKIP = frozenset({"aside", "button", "footer", "form", "header", "iframe", "nav", "noscript", "script", "style"})
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Elements that a text block may be the body of, and those that are its paragraphs.
_BLOCKS = {"article", "body", "div", "main", "section", "td"}
_PARAGRAPHS = {"blockquote", "h1", "h2", "h3", "h4", "li", "p", "pre"}
_DATES = ("article:published_time", "datepublished", "date", "dc.date", "dc.date.issued", "og:published_time", "parsely-pub-date", "pubdate", "publish-date", "publishdate", "sailthru.date")
#: Characters that a body must have, the share of a page's paragraphs that a block must, and the most of it in links.
_BODY, _SHARE, _LINKS = 200, 0.4, 0.3


class _Page(HTMLParser):
    """Title, description, dates and the text outside of frames, menus and scripts.

    Open elements are a stack: an end tag closes all that was opened since its start tag, so an element that is never
    closed ends with the one around it. An end tag without a start tag is ignored.
    """

    def __init__(self, skip=_SKIP):
        super().__init__(convert_charrefs=True)
        self.title, self.meta, self.dates, self.text, self.article, self.scripts = "", {}, [], [], [], []
        self.skip, self.open, self.skipped, self.n = skip, [], 0, 0
        self.blocks: dict[int, list] = {}  # of a block: lines, characters in paragraphs, characters in links
        self._json = False

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "meta":
            name = (a.get("property") or a.get("name") or a.get("itemprop") or "").lower()
            if name and name not in self.meta:
                self.meta[name] = a.get("content", "")
            if name in _DATES:
                self.dates.append(a.get("content", ""))
        elif tag == "script" and a.get("type", "").lower() == "application/ld+json":
            self._json = True
        if tag not in _VOID:
            self.n += 1
            self.open.append((tag, self.n))
            self.skipped += tag in self.skip

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if all(t != tag for t, _ in self.open):
            return
        while True:
            last, _ = self.open.pop()
            self.skipped -= last in self.skip
            if last == "script":
                self._json = False
            if last == tag:
                return

    def handle_data(self, data):
        if self._json:
            self.scripts.append(data)
        tags = [t for t, _ in self.open]
        if "title" in tags and "svg" not in tags:
            self.title += data
        elif not self.skipped and (t := data.strip()):
            self.text.append(t)
            if "article" in tags:
                self.article.append(t)
            at = next((i for i in range(len(tags) - 1, -1, -1) if tags[i] in _BLOCKS), None)
            block = self.blocks.setdefault(self.open[at][1] if at is not None else 0, [[], 0, 0])
            inner = tags[(at if at is not None else -1) + 1 :]
            block[0].append(t)
            block[1] += len(t) if not _PARAGRAPHS.isdisjoint(inner) else 0
            block[2] += len(t) if "a" in inner else 0

    def body(self) -> tuple[str, str]:
        """(text, method): what <article> holds; else the block that holds most of the page's paragraphs, if it is no list
        of links; else all text."""
        article = "\n".join(self.article)
        if len(article) >= _BODY:
            return article, "article"
        total = sum(b[1] for b in self.blocks.values())
        best = max(self.blocks.values(), key=lambda b: b[1], default=None)
        if best and best[1] >= max(_BODY, _SHARE * total) and best[2] <= _LINKS * best[1]:
            return "\n".join(best[0]), "density"
        return "\n".join(self.text), "text"


def _parsed(markup: str, skip=_SKIP) -> tuple[_Page, str]:
    """The page, and what kept the parser from its end, if anything did; what was read till then stays."""
    p, error = _Page(skip), ""
    try:
        p.feed(markup)
        p.close()
    except Exception as e:  # the parser asserts on some malformed declarations
        error = f"{type(e).__name__}: {e}"[:200]
    return p, error


def _day(s: str) -> str:
    m = re.search(r"([0-9]{4})-([0-9]{2})-([0-9]{2})", s or "")
    return m[0] if m and 2000 <= int(m[1]) <= 2030 and 1 <= int(m[2]) <= 12 and 1 <= int(m[3]) <= 31 else ""


#: Declarations that the parser refuses: a marked section of another name than CDATA, or one that doesn't end.
_ODD_SECTION = re.compile(r"<!\[(?!CDATA\[)")


def read_page(markup: str) -> dict:
    """PAGE_SCHEMA's values of a page; never an error, whatever the markup is. A page that the parser refuses is read
    again without the marked sections that it stumbles over, and extraction_error says what it was."""
    p, error = _parsed(markup)
    if error:
        again, still = _parsed(_ODD_SECTION.sub("<!-- -->", markup))
        p = again if len(again.text) >= len(p.text) else p
    left = {t for t, _ in p.open if t in _SKIP} - {"script", "style"}
    if left and not p.text:  # a menu or form that never ends would hide the whole page
        p, _ = _parsed(_ODD_SECTION.sub("<!-- -->", markup) if error else markup, _SKIP - left)
    date, source = next(((d, "meta") for d in map(_day, p.dates) if d), ("", ""))
    if not date:
        for s in p.scripts:
            found = [_day(m[2]) for k in ("datePublished", "dateCreated", "dateModified") for m in re.finditer(rf'"({k})"\s*:\s*"([^"]*)"', s)]
            if date := next(filter(None, found), ""):
                source = "json-ld"
                break
    body, method = p.body()
    return {
        "page_title": p.title.strip(), "meta_description": p.meta.get("description") or p.meta.get("og:description") or "", "pub_date": date, "pub_date_source": source, "raw_text": body,
        "extraction_method": method, "extraction_success": bool(body), "extraction_error": error or ("" if body else "no text"),
    }


def read_record(data: bytes) -> tuple[str, str, str]:
    """(markup, encoding, error) of a WARC response record, gzipped or not."""
    try:
        data = gzip.decompress(data)
    except (OSError, EOFError, zlib.error):
        pass
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found or not re.search(rb"(?im)^warc-type:\s*response", head):
        return "", "", "no response record"
    http, found, body = rest.partition(b"\r\n\r\n")
    kind = re.search(rb"(?im)^content-type:\s*([^\r\n]*)", http)
    if not found or not kind or b"text/html" not in kind[1].lower():
        return "", "", "no HTML"
    named = re.search(rb"(?i)charset=[\"']?([\w\-]+)", kind[1]) or re.search(rb"(?i)<meta[^>]+charset=[\"']?([\w\-]+)", body[:2048])
    encoding = named[1].decode() if named else "utf-8"
    try:
        return body.decode(encoding, errors="replace"), encoding, ""
    except LookupError:
        return body.decode("utf-8", errors="replace"), "utf-8", ""


#: Pages, and bytes of them, that a worker holds as Python values; Arrow's batches may be of ten thousand pages.
_ROWS, _BYTES = 256, 4 << 20


def _read(batches: Iterator[pa.Array], read) -> Iterator[pa.Array]:
    """PAGE_SCHEMA's values of every page, in slices."""
    kind = to_arrow_type(PAGE_SCHEMA)
    for batch in batches:
        rows, size = [], 0
        for x in batch:
            data = x.as_py()
            rows.append(read(data))
            size += len(data or "")
            if len(rows) >= _ROWS or size >= _BYTES:
                yield pa.array(rows, kind)
                rows, size = [], 0
        if rows or not len(batch):
            yield pa.array(rows, kind)


def _page(markup: str | None) -> dict:
    return read_page(markup or "") | {"encoding_detected": "utf-8"}


def _record(data: bytes | None) -> dict:
    markup, encoding, error = read_record(data or b"")
    page = read_page(markup) if not error else dict.fromkeys(_TEXTS, "") | {"extraction_success": False, "extraction_error": error}
    return page | {"encoding_detected": encoding}


@F.arrow_udf(PAGE_SCHEMA)
def extract_html(markup: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return _read(markup, _page)


@F.arrow_udf(PAGE_SCHEMA)
def extract_record(content: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return _read(content, _record)


def dated_source(page_date: Column, url_date: Column) -> Column:
    """Which of the three dated() takes."""
    return F.when(F.coalesce(page_date, F.lit("")) != "", "page").when(url_date.isNotNull(), "url").otherwise("capture")


def dated(page_date: Column, url_date: Column, captured: Column) -> Column:
    """A page's own date, else its address's, else the capture's."""
    return F.coalesce(F.nullif(page_date, F.lit("")), url_date, F.date_format(captured, "yyyy-MM-dd"))
