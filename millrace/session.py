"""Sessions, and the package on the workers' path."""

from __future__ import annotations

import atexit
import io
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_made: list[str] = []


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once an application: they need not share the driver's path."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    path = os.path.join(tempfile.mkdtemp(prefix="millrace-package-"), "millrace.zip")
    Path(path).write_bytes(data.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A name for a new folder under the checkpoint folder that the cluster names (spark.checkpoint.dir); a local session
    without one gets its own."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base and not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(base or "file://" + tempfile.mkdtemp(prefix="millrace-checkpoints-"))
    return f"{context.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame) -> DataFrame:
    """df as files in the shared folder. Lineage ends there; columns that nothing asks for aren't read again. The files go
    when the driver exits."""
    if len({c.lower() for c in df.columns}) < len(df.columns) or "void" in df.schema.simpleString():  # no table has such columns
        shared_folder(df.sparkSession, "")
        return df.checkpoint()
    at = shared_folder(df.sparkSession, "rows")
    _made.append(at)
    df.write.option("compression", "zstd").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


@atexit.register
def _clean() -> None:
    while _made:
        try:
            files, path = pafs.FileSystem.from_uri(_made.pop())
            files.delete_dir(path)
        except (OSError, ValueError):
            pass


def session(name: str = "millrace", **conf: str) -> SparkSession:
    """A session with the settings that results depend on (time zone) and those that scale needs (adaptive plans)."""
    builder = SparkSession.builder.appName(name)
    fixed = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
    for k, v in (fixed | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ship(spark)
    return spark
