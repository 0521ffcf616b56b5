"""The roles of the driver's tables: SQL that both engines read, so a query and its oracle start from the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.plan import spread

ARTICLES = """
SELECT doc_id, CAST(substr(source, 4) AS INT) AS event_id, coalesce(text, '') AS raw_text, lang, n_chars,
  concat('https://', CASE WHEN doc_id % 3 = 0 THEN 'www.' ELSE '' END, 'Site', CAST(doc_id % 37 AS STRING), '.example.com',
    CASE doc_id % 17 WHEN 0 THEN '/' WHEN 1 THEN concat('/tag/', lang) WHEN 2 THEN '/2024/05/' ELSE concat('/', lang, '/', CAST(doc_id % 400 AS STRING)) END,
    CASE doc_id % 9 WHEN 0 THEN '?utm_source=feed' WHEN 1 THEN '?id=7&Ref=x&id=9' WHEN 2 THEN '/' WHEN 3 THEN '#top' WHEN 4 THEN '?page=2' WHEN 5 THEN '/2024-03-09' ELSE '' END) AS url,
  concat('2024', lpad(CAST(doc_id % 12 + 1 AS STRING), 2, '0'), lpad(CAST(doc_id % 28 + 1 AS STRING), 2, '0'), '000000') AS ts,
  CASE doc_id % 13 WHEN 0 THEN 'Error 404' WHEN 1 THEN 'Chapter 5 of it' WHEN 2 THEN 'news - Page 2' WHEN 3 THEN 'Wildfire near the town' WHEN 4 THEN 'Drought and flood' WHEN 5 THEN 'Earthquake report'
    ELSE substr(coalesce(text, ''), 1, 40) END AS page_title
FROM {documents}"""

POINTERS = """
SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 1000 + l_suppkey % 1000 AS pointer_id, CAST(l_suppkey % 20 AS INT) AS event_id, concat(CAST(l_suppkey % 20 AS STRING), '_', CASE l_linenumber % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'C' ELSE 'x' END) AS query_id,
  concat('CC-MAIN-', CAST(2020 + l_orderkey % 3 AS STRING)) AS crawl_id,
  CASE l_linenumber % 7 WHEN 6 THEN NULL WHEN 5 THEN 'abc' ELSE CAST(l_partkey - 3 AS STRING) END AS "offset",
  CASE WHEN l_tax = 0 THEN '0' ELSE CAST(CAST(l_quantity AS INT) * CAST(l_quantity AS INT) * CAST(l_quantity AS INT) * 50 AS STRING) END AS "length",
  CASE WHEN l_discount = 0 THEN 'warc/x.gz' ELSE concat('crawl-data/CC-MAIN-2024-', CAST(10 + l_suppkey % 2 AS STRING), '/segments/1/warc/f.warc.gz') END AS filename,
  CASE WHEN l_returnflag = 'R' THEN '' ELSE CAST(l_partkey % 50 AS STRING) END AS digest,
  CASE WHEN l_linestatus = 'F' THEN NULL ELSE concat('https://h/', CAST(l_partkey % 300 AS STRING)) END AS url,
  concat(CAST(2000 + l_orderkey % 20 AS STRING), '0101000000') AS ts
FROM {lineitem}"""

EVENTS = """
SELECT o_orderkey AS event_id, CAST(o_orderdate AS DATE) AS start_date, CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderdate AS DATE) END AS end_date, CAST(o_orderkey % 31 AS INT) AS duration, o_orderpriority AS priority
FROM {orders}"""

#: A crawl from the 3rd to the 20th of every other month that has orders.
CRAWLS = """
SELECT concat('crawl-', substr(m, 1, 7)) AS crawl_id, CAST(concat(substr(m, 1, 8), '03 00:00:00') AS TIMESTAMP) AS crawl_from, CAST(concat(substr(m, 1, 8), '20 00:00:00') AS TIMESTAMP) AS crawl_to
FROM (SELECT DISTINCT substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 8) AS m FROM {orders}) t
WHERE substr(m, 6, 2) IN ('01', '03', '05', '07', '11')"""

#: Headlines and addresses that every rule and every pattern of listings has a case of, in turn over the documents.
TITLES = (
    "Weather | Forecast Conditions", "Traffic | road conditions now", "Our staff personalities", "Coronavirus hoy", "Coronavirus e inundación", "Vacunación COVID-19", "Licitação aberta", "Previsão de risco geo-hidrológico",
    "Noticias :: hoy", "Rumo aos 30 anos | OCHA", "News Archives", "Live: late news", "Watch local videos online", "Pronóstico de la semana", "Previsão do tempo", "Pronóstico: lluvias", "Cambio climático", "Climate change and flood",
    "Wildfire near the town", "Incêndio e temporal", "Dengue", "El ébola vuelve", "Balacera en el centro", "narco detenido", "Mina de oro", "Mount Polley", "Terremoto", "Temblor y tormenta", "Floods in Bangladesh", "Vida en China", "Inundaciones en China", "Sequía",
    "Falta de agua", "Drought and flood", "Nota", "Lluvias", "asesino", "Page 2 of news", "news - Page 2", "Halaman 3", "March 4, 2024 - all", "2023 archives", "Archive 2019", "All articles tagged rain", "Tag: rain", "Berita terbaru banjir hari ini",
    "Berita tentang air terkini", "Informasi hujan terkini dan terbaru", "3.4 Water", "Chapter 5 of it", "Annex b", "El Sitio - Inicio", "Some paper — Home", "flooding of the river", "The floods came", "",
)
PATHS = ("/a/b", "/", "", "/tag/x", "/tags", "/category/y/", "/categories/z", "/page/3", "/news_page_4", "/a?page=2", "/a?q=rain", "/2024/05/", "/2024/05/a", "/opac/x", "/rubrique/y", "/staff-personalities/z", "/a;jsessionid=1F", "/BrowseThesaurus", "/buscar/1", "/topics/w", "/a?pages=2")
HOSTS = ("e.com", "www.weather.gov", "cemaden.gov.br", "clarin.com", "sub.eltiempo.com", "e.org")


def _in_turn(values: tuple[str, ...], step: int = 1) -> str:
    return f"CASE {'doc_id' if step == 1 else f'CAST(floor(doc_id / {step}) AS INT)'} % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


HEADLINES = f"""
SELECT doc_id, substr(coalesce(text, ''), 1, 400) AS raw_text, {_in_turn(TITLES)} AS page_title, {_in_turn(HOSTS, 3)} AS domain,
  concat('https://', {_in_turn(HOSTS, 3)}, {_in_turn(PATHS)}) AS url, CAST(doc_id % 5 AS INT) AS hits
FROM {{documents}}"""

#: Index rows: an event row's user is its domain.
INDEX = """
SELECT event_id AS row_id, concat('CC-', event_type) AS crawl_id, concat('d', CAST(user_id % 60 AS STRING)) AS domain, ts, CASE WHEN event_id % 11 = 0 THEN 404 ELSE 200 END AS status,
  CASE WHEN event_id % 13 = 0 THEN 'image/png' ELSE 'text/html' END AS mime, concat('u', CAST(event_id % 700 AS STRING)) AS url, event_id AS "offset"
FROM {events}"""

SPECS = """
SELECT CAST(c_custkey AS INT) AS event_id, concat(CAST(c_custkey AS STRING), '_', CASE c_custkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'D' ELSE 'zz' END) AS query_id,
  concat('CC-', CASE c_nationkey % 4 WHEN 0 THEN 'view' WHEN 1 THEN 'click' WHEN 2 THEN 'purchase' ELSE 'other' END) AS crawl_id, concat('d', CAST(c_custkey % 60 AS STRING)) AS domain,
  CAST(concat('2024-01-', lpad(CAST(c_custkey % 20 + 1 AS STRING), 2, '0'), ' 00:00:00') AS TIMESTAMP) AS window_start,
  CAST(concat('2024-01-', lpad(CAST(c_custkey % 20 + 5 AS STRING), 2, '0'), ' 00:00:00') AS TIMESTAMP) AS window_end,
  CASE WHEN c_custkey % 2 = 0 THEN 'restricted' ELSE 'open' END AS retrieval_strategy
FROM {customer}"""

LANGUAGES = """
SELECT n_nationkey AS event_id, CASE n_nationkey % 6 WHEN 0 THEN 'eng, lin' WHEN 1 THEN 'spa por' WHEN 2 THEN 'XXX,arb' WHEN 3 THEN NULL WHEN 4 THEN 'swa,zzz,npi' ELSE 'deu' END AS languages
FROM {nation}"""

PLACES = """
SELECT s_suppkey AS event_id, CASE s_suppkey % 7 WHEN 0 THEN 'Kerr county (Texas)' WHEN 1 THEN 'Roswell (Chaves county, Eastern New Mexico)' WHEN 2 THEN 'the Northern Province, Lima;  and Cusco region.'
  WHEN 3 THEN NULL WHEN 4 THEN 'North Kivu and the long valley of the lower river and Bas Congo' WHEN 5 THEN 'of, island, Ab' ELSE concat('Town  ', s_name) END AS location
FROM {supplier}"""


def rows(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The DataFrame of one of the above."""
    name = sql[sql.index("{") + 1 : sql.index("}")]
    body = sql.replace('AS "offset"', "AS offset").replace('AS "length"', "AS length")
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(body, **{name: spread(table) if name == "documents" else table})


def oracle(sql: str) -> str:
    """The same for DuckDB."""
    name = sql[sql.index("{") + 1 : sql.index("}")]
    return sql.replace("{" + name + "}", name)
