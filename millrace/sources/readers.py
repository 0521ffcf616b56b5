"""Tables, listings, lookups and raw responses."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "Flood_ID int, ISO string, Country string, Subregion string, Region string, Location string, `River Basin` string, `Start Date` date, `End Date` date, Duration int, Language_ISO_639_3 string, Local_Languages string"


def registry(spark: SparkSession, path: str) -> DataFrame:
    """The event registry with plain column names. Columns are read by name; a file without one of them gives nulls."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    names = {"Flood_ID": "event_id", "Start Date": "start_date", "End Date": "end_date", "River Basin": "river_basin", "Language_ISO_639_3": "languages"}
    out = []
    for f in spark.createDataFrame([], EVENTS).schema:
        c = F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)
        out.append(c.alias(names.get(f.name, f.name.lower())))
    return raw.select(*out)


def index_tables(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Columnar index files of several schemas, united by name."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def manifest(spark: SparkSession, path: str, part: str = "/subset=warc/") -> DataFrame:
    """Paths of Parquet files in a (gzipped) listing."""
    return spark.read.text(path).filter(F.col("value").contains(part) & F.col("value").endswith(".parquet")).withColumnRenamed("value", "path")


def scan(rows: DataFrame, columns: list[str], key: str, first, last) -> DataFrame:
    """The columns of rows whose key lies in first..last; range and columns reach the files."""
    return rows.filter(F.col(key).between(first, last)).select(*columns)


def crawls(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id string, name string, `from` string, `to` string").option("multiLine", True).json(path)


def lexicon(spark: SparkSession, path: str) -> DataFrame:
    """(language, category, term) of a JSON object of objects of lists."""
    raw = spark.read.option("wholetext", True).text(path).select(F.from_json("value", "map<string,map<string,array<string>>>").alias("m"))
    return raw.select(F.explode("m").alias("language", "c")).select("language", F.explode("c").alias("category", "t")).select("language", "category", F.explode("t").alias("term"))


def merge_lexicons(old: DataFrame, new: DataFrame, keep: tuple[str, ...] = ("river",)) -> DataFrame:
    """New languages win as a whole, but for the categories that are kept; languages that new lacks stay."""
    stays = old.join(new.select("language").distinct().withColumn("_new", F.lit(True)), "language", "left")
    return new.filter(~F.col("category").isin(list(keep))).unionByName(stays.filter(F.col("_new").isNull() | F.col("category").isin(list(keep))).drop("_new")).distinct()


def responses(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank and malformed ones are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def blobs(spark: SparkSession, path: str, pattern: str = "*.warc.gz") -> DataFrame:
    """(path, pointer_id, bytes, content) of cached files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select("path", F.regexp_extract("path", "([^/]+?)\\.warc\\.gz$", 1).alias("pointer_id"), F.col("length").alias("bytes"), "content")


def parts(spark: SparkSession, pattern: str) -> DataFrame:
    """CSV part files by glob, each row with its file."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(pattern).withColumn("source_file", F.col("_metadata.file_path"))


def first_that_exists(spark: SparkSession, *paths: str) -> DataFrame | None:
    """The combined file, else the part files, else none; parts that can't be read are skipped."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for p in paths:
        path = hadoop.Path(p)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path):
            return spark.read.option("header", True).option("ignoreCorruptFiles", True).option("multiLine", True).option("escape", '"').csv(p)
    return None


def id_ranges(text: str) -> list[int]:
    """'1-3,7' as [1, 2, 3, 7]."""
    out: list[int] = []
    for part in filter(None, (x.strip() for x in text.split(","))):
        a, dash, b = part.partition("-")
        out += range(int(a), int(b) + 1) if dash else [int(a)]
    return sorted(set(out))


def scope(rows: DataFrame, column: str, only: list[int] | None = None, skip: list[int] | None = None) -> DataFrame:
    if only is not None:
        rows = rows.filter(F.col(column).isin(only))
    return rows.filter(~F.col(column).isin(skip)) if skip else rows


def from_environment(name: str = "MILLRACE_EVENTS") -> list[int] | None:
    return id_ranges(os.environ[name]) if os.environ.get(name) else None
