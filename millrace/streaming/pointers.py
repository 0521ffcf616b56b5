"""Pointers as they arrive: new Parquet files in a folder, duplicates within the watermark dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def arriving(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def without_duplicates(rows: DataFrame, keys: list[str], at: str = "ts", late: str = "1 day") -> DataFrame:
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def drain(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Takes in what is there and stops; a rerun goes on after it."""
    rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path).awaitTermination()
