"""What the operators of this subpackage share: tables, the shared folder, bounded lookups.

Conventions: a null text counts as the empty text; a null key is a key of its own that sorts before all others.
Operators select the columns they need by name, so extra columns of the input never clash with their own.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

#: Rows and bytes of text that a worker handles at once; a longer text stands alone. The session's own bounds on Arrow
#: batches (rows, and 64 MB by default) stay as they are.
BATCH_ROWS, BATCH_BYTES = 2048, 16 << 20
#: Largest table (bytes as written) that is sent to every executor; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
#: Sub-keys over which a shuffled join spreads each key of its large side.
SALTS = 8

_unset: dict[str, str] = {}
_made: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """This package on the workers' path. No session setting is changed."""
    ship(spark)


def small(batches):
    """Slices of the batches, in order, of at most BATCH_ROWS rows and about BATCH_BYTES of text and binary values."""
    for batch in batches:
        wide = [c for c in batch.columns if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) or pa.types.is_binary(c.type)]
        size = sum((pc.binary_length(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in wide), np.zeros(batch.num_rows, np.int64))
        ends, at = np.cumsum(size), 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = min(at + BATCH_ROWS, max(at + 1, int(np.searchsorted(ends, before + BATCH_BYTES, "right"))))
            yield batch.slice(at, to - at)
            at = to
        if not batch.num_rows:
            yield batch


def shared_base(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session, or the folder that setCheckpointDir has set. Where neither is set, a local
    session (as in tests) gets a folder of its own; a cluster has none that all executors see, so there it is an error."""
    if base := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return base
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _unset:
        _unset[app] = "file://" + tempfile.mkdtemp(prefix="millrace-")
    return _unset[app]


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one. It goes when the driver exits; see scratch() for an earlier end."""
    base = shared_base(spark)
    if "://" not in base:
        base = "file://" + os.path.abspath(base.removeprefix("file:"))
    folder = f"{base.rstrip('/')}/millrace-{name}-{uuid.uuid4().hex}"
    files, path = pafs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    _made.append(folder)
    return folder


def made() -> set[str]:
    """The folders that there are now."""
    return set(_made)


def drop_made(before: set[str], kept: set[str] = frozenset()) -> None:
    """Deletes the folders made since, but for those kept."""
    for folder in [x for x in _made if x not in before and x not in kept]:
        drop_now(folder)


def drop_now(folder: str) -> None:
    drop_folder(folder)
    _made.remove(folder)


@contextmanager
def scratch():
    """Deletes the folders that were made within it, but for those that `keep` is called with: for steps whose tables
    nothing lazy reads afterwards."""
    before, kept = made(), set()
    try:
        yield kept.add
    finally:
        drop_made(before, kept)


def drop_folder(folder: str) -> None:
    files, path = pafs.FileSystem.from_uri(folder)
    try:
        files.delete_dir(path)
    except OSError:
        pass


@atexit.register
def _clean() -> None:
    while _made:
        drop_folder(_made.pop())


def put(uri: str, data: bytes) -> None:
    """Writes a file under another name, then renames it: a task that is run again leaves the same file."""
    files, path = pafs.FileSystem.from_uri(uri)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with files.open_output_stream(part, compression=None) as out:
        out.write(data)
    files.move(part, path)


def get(uri: str) -> bytes:
    files, path = pafs.FileSystem.from_uri(uri)
    with files.open_input_stream(path, compression=None) as data:
        return data.read()


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: its lineage ends there, and it outlives executors."""
    return written_at(df, name)[0]


def written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), folder


def folder_bytes(folder: str) -> int:
    files, path = pafs.FileSystem.from_uri(folder)
    return sum(x.size or 0 for x in files.get_file_info(pafs.FileSelector(path, recursive=True)) if x.is_file)


def first_by_hash(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """At most n rows of df, the first by hash of keys. Of a large df only those below a hash bound that about 2n rows
    pass are sorted, so tasks don't each send n rows on."""
    h = F.xxhash64(*keys)
    total = df.count()
    if total > 4 * n:
        df = df.filter(F.pmod(h, F.lit(1 << 40)) < int((1 << 40) * 2 * n / total))
    return df.orderBy(h, *keys).limit(n)


def join_lookup(large: DataFrame, lookup: DataFrame, key: str, name: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """large left join lookup (unique in key). The lookup is written first: up to `limit` bytes it is broadcast, beyond
    that the join shuffles, with every key of large spread over SALTS sub-keys so that a hot one is no single task's."""
    small, folder = written_at(lookup, name)
    if folder_bytes(folder) <= limit:
        return large.join(F.broadcast(small), key, "left")
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")  # row by row: equal rows are spread too
    spread = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return large.withColumn("_salt", salt).join(spread, [key, "_salt"], "left").drop("_salt")


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in a row, and the len(texts) + 1 offsets."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) for x in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def pieces(texts: list[bytes], limit: int = 1 << 20):
    """Ranges (from, to) of consecutive texts of about `limit` bytes together; a longer text stands alone and whole."""
    start, size = 0, 0
    for i, x in enumerate(texts):
        if i > start and size + len(x) > limit:
            yield start, i
            start, size = i, 0
        size += len(x)
    if start < len(texts):
        yield start, len(texts)
