"""Line dedup: two Bloom filters (seen once, seen twice) name the suspects; only those shuffle for exact confirmation.

A map task writes its documents' keys (digests, with their documents) to a file, and sends each of the filters' shards
the 64-bit hashes of its keys that fall there. A shard's reducer puts them into its once- and twice-filter, then answers
every sender with a bit a hash: is it in the twice-filter. With those bits a task reads its file again and emits the
suspects. So the filters never leave their reducers, and their number grows with the table: no size is too large for
them. Collisions only add suspects; no repeat is missed.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MIN_CHARS = 40
MIN_DOCS = 5
#: Bits of a shard of each filter, and bits for each line that the table can have at most.
SHARD_BITS = 1 << 22
LINE_BITS = 16
SPACE = b" \t\n\r\x0b\x0c"
#: Lines of a file.
FLUSH = 1 << 18


def key_of(line: bytes, min_chars: int) -> bytes | None:
    """The line stripped and with A-Z in lower case; None if shorter than min_chars code points."""
    if len(line) < min_chars:
        return None
    key = line.strip(SPACE).lower()  # of bytes: A-Z only
    if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
        return None
    return key


def keys_of(text: bytes, min_chars: int) -> set[bytes]:
    return {k for line in text.split(b"\n") if (k := key_of(line, min_chars)) is not None}


def digest(key: bytes) -> bytes:
    return hashlib.sha256(key).digest()[:16]


def bits_of(hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each hash, and its two bits there: (n,) and (n, 2)."""
    a = (hashes & np.uint64(SHARD_BITS - 1)).astype(np.int64)
    b = (hashes >> np.uint64(22) & np.uint64(SHARD_BITS - 1)).astype(np.int64)
    return (hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % shards, np.stack([a, b], 1)


ROW = np.dtype([("hash", "<u8"), ("key", "V16"), ("doc", "<i8"), ("null", "?"), ("text", "<u8")])


def _send(folder: str, shards: int, min_chars: int, lines: int):
    """(shard, source, hashes, dup) of the keys of each `lines` lines; the lines' rows go to the source's file. Hashes are
    in order and each once; dup has a bit for those that the source has in several documents."""

    def flush(found: list):
        rows = np.array(found, ROW)
        shard, _ = bits_of(rows["hash"], shards)
        rows = rows[np.lexsort((rows["hash"], shard))]
        source = uuid.uuid4().int >> 65  # not the partition: a task that is run again answers for its own file
        common.put(f"{folder}/{source}.lines", zlib.compress(rows.tobytes(), 1))
        h, n = np.unique(rows["hash"], return_counts=True)
        own, _ = bits_of(h, shards)
        order = np.argsort(own, kind="stable")
        ends = np.searchsorted(own[order], np.arange(shards + 1))
        filled = [(s, order[ends[s] : ends[s + 1]]) for s in range(shards) if ends[s] < ends[s + 1]]
        return pa.RecordBatch.from_arrays(
            [pa.array([s for s, _ in filled], pa.int32()), pa.array([source] * len(filled), pa.int64()), pa.array([h[x].tobytes() for _, x in filled], pa.binary()), pa.array([np.packbits(n[x] > 1).tobytes() for _, x in filled], pa.binary())],
            ["shard", "source", "hashes", "dup"],
        )

    def run(batches):
        found: list = []
        for batch in common.small(batches):
            for doc, text in zip(batch.column(0).to_pylist(), common.texts_of(batch.column(1))):
                if keys := keys_of(text, min_chars):
                    own = (0 if doc is None else doc, doc is None, xxhash.xxh64_intdigest(text))
                    found += [(xxhash.xxh64_intdigest(k), digest(k), *own) for k in keys]
                if len(found) >= lines:
                    yield flush(found)
                    found = []
        if found:
            yield flush(found)

    return run


class Filters:
    """A shard's once- and twice-filter."""

    def __init__(self):
        self.once, self.twice = np.zeros(SHARD_BITS, bool), np.zeros(SHARD_BITS, bool)

    def add(self, hashes: np.ndarray, dup: np.ndarray) -> None:
        """Different hashes; dup: which of them stand for several documents."""
        at = bits_of(hashes, 1)[1]
        again = at[self.once[at].all(1) | dup]
        self.twice[again] = True
        self.once[at] = True

    def suspects(self, hashes: np.ndarray) -> np.ndarray:
        return self.twice[bits_of(hashes, 1)[1]].all(1)


def _judge(batches):
    """(source, shard, suspect): a bit for each hash that the source sent to the shard. Rows come sorted by shard."""

    def answer(shard, held):
        filters = Filters()
        for _, h, dup in held:
            filters.add(h, dup)
        sizes = [(source, np.packbits(filters.suspects(h)).tobytes()) for source, h, _ in held]
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in sizes], pa.int64()), pa.array([shard] * len(sizes), pa.int32()), pa.array([x for _, x in sizes], pa.binary())], ["source", "shard", "suspect"])

    at, held = None, []
    for batch in batches:
        for shard, source, h, dup in zip(*(c.to_pylist() for c in batch.columns)):
            if shard != at:
                if held:
                    yield answer(at, held)
                at, held = shard, []
            h = np.frombuffer(h, "<u8")
            held.append((source, h, np.unpackbits(np.frombuffer(dup, np.uint8), count=len(h)).astype(bool)))
    if held:
        yield answer(at, held)


def _suspects(folder: str, shards: int):
    """(key, doc_id, text) of the suspects, text being the text's hash. Rows come sorted by source, then shard."""

    def read(source, answers):
        rows = np.frombuffer(zlib.decompress(common.get(f"{folder}/{source}.lines")), ROW)
        new = np.concatenate([[True], rows["hash"][1:] != rows["hash"][:-1]])  # by shard and hash, as they were sent
        shard = bits_of(rows["hash"][new], shards)[0]
        ends = np.searchsorted(shard, np.arange(shards + 1))
        good = np.zeros(len(shard), bool)
        for s, bits in answers:
            good[ends[s] : ends[s + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=ends[s + 1] - ends[s])
        rows = rows[good[np.cumsum(new) - 1]]
        raw = pa.Array.from_buffers(pa.binary(16), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows["key"]).tobytes())])
        return pa.RecordBatch.from_arrays([raw.cast(pa.binary()), pa.array(rows["doc"], pa.int64(), mask=rows["null"].copy()), pa.array(rows["text"].astype(np.int64))], ["key", "doc_id", "text"])

    def run(batches):
        at, held = None, []
        for batch in batches:
            for source, shard, bits in zip(*(c.to_pylist() for c in batch.columns)):
                if source != at:
                    if held:
                        yield read(at, held)
                    at, held = source, []
                held.append((shard, bits))
        if held:
            yield read(at, held)

    return run


def suspects(docs: DataFrame, min_chars: int, shards: int = 1, flush: int = FLUSH) -> DataFrame:
    """(key, doc_id, text) of each key that the twice-filter has, for each document that holds it. There are `shards`
    shards, or more where the table needs them."""
    spark = docs.sparkSession
    # a text has no more keys than lines, nor than its length allows: what a reducer holds is bounded by that
    size = F.octet_length("text")
    most = F.least((size + 1) / (min_chars + 1), size - F.octet_length(F.replace("text", F.lit("\n"))) + 1)
    lines = docs.agg(F.sum(most)).first()[0] or 0
    while shards * SHARD_BITS < lines * LINE_BITS:
        shards *= 2
    parts = min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")) * 8)
    folder = common.shared_folder(spark, "lines")
    sent = docs.select("doc_id", "text").mapInArrow(_send(folder, shards, min_chars, flush), "shard int, source long, hashes binary, dup binary")
    answers = sent.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(_judge, "source long, shard int, suspect binary")
    answers = answers.repartition("source").sortWithinPartitions("source", "shard")
    return common.written(answers.mapInArrow(_suspects(folder, shards), "key binary, doc_id long, text long"), "suspects")


def _apply(drop, min_chars: int, names: list[str]):
    """drop: the holders by key, or None where the last column has the keys that each document loses."""

    def run(batches):
        holder = drop and drop.value
        for batch in common.small(batches):
            ids = batch.column(0).to_pylist()
            lost = batch.column(batch.num_columns - 1).to_pylist() if drop is None else ids
            texts, n_lines, n_dropped = [], [], []
            for doc, text, own in zip(ids, common.texts_of(batch.column(1)), lost):
                lines = text.split(b"\n")
                if drop is None:
                    mine = set(own or ())
                    kept = [x for x in lines if not mine or (k := key_of(x, min_chars)) is None or digest(k) not in mine]
                else:
                    kept = [x for x in lines if (k := key_of(x, min_chars)) is None or (h := holder.get(digest(k), False)) is False or h == doc]
                texts.append(b"\n".join(kept) if len(kept) < len(lines) else text)
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            rest = [batch.column(k) for k in range(2, 2 + len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), *rest], ["doc_id", "text", "n_lines", "n_dropped", *names])

    return run


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, carry: tuple[str, ...] = (), limit: int = common.BROADCAST_BYTES, shards: int = 1, flush: int = FLUSH) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped, *carry): docs without the lines whose key min_docs documents or more hold,
    but for those in the largest doc_id that holds it.

    A null or empty text is one empty line. Rows of the same doc_id count as one document and keep or lose a key
    together; null is one doc_id, the smallest. Lines of any length are keyed whole. An empty table gives no rows.
    Columns beyond doc_id, text and carry are left out, so they can't clash. The keys that go are sent to all executors
    up to a quarter of limit bytes; beyond that a join brings every text the keys that it loses.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    before = common.made()
    found = suspects(docs, min_chars, shards, flush)
    held = found.groupBy("key", "doc_id").agg(F.lit(1).alias("one")).groupBy("key").agg(F.count("one").alias("n"), F.max("doc_id").alias("holder"))
    drops, folder = common.written_at(held.filter(F.col("n") >= min_docs).select("key", "holder"), "repeated-lines")
    schema = f"doc_id long, text string, n_lines long, n_dropped long{''.join(f', `{c}` {docs.schema[c].dataType.simpleString()}' for c in carry)}"
    if common.folder_bytes(folder) <= limit // 4:
        holders = spark.sparkContext.broadcast({bytes(r.key): r.holder for r in drops.collect()})
        common.drop_made(before)
        return docs.mapInArrow(_apply(holders, min_chars, list(carry)), schema)
    # by id and text: a list is no longer than its text, though many rows may have one id
    mine = found.join(drops, "key").filter(~F.col("doc_id").eqNullSafe(F.col("holder")))
    mine = mine.groupBy("doc_id", "text").agg(F.collect_set("key").alias("_lost"))
    row = lambda h: F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), h.cast("string"))
    mine = mine.select(row(F.col("text")).alias("_row"), "_lost")
    hashed = docs.mapInArrow(_with_hash, docs.select("*", F.lit(0).cast("long").alias("_hash")).schema)
    rows = common.join_lookup(hashed.withColumn("_row", row(F.col("_hash"))), mine, "_row", "lost-lines", limit)
    return rows.select("doc_id", "text", *carry, "_lost").mapInArrow(_apply(None, min_chars, list(carry)), schema)


def _with_hash(batches):
    for batch in common.small(batches):
        h = np.array([xxhash.xxh64_intdigest(x) for x in common.texts_of(batch.column(1))], np.uint64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(h.astype(np.int64))], [*batch.schema.names, "_hash"])


def op5_line_dedup(spark, sf_dir):
    """Every document without repeated lines, by digest. Null, empty, repeated, long and missing rows: see line_dedup."""
    rows = line_dedup(common.table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
rep AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT coalesce(doc_id::VARCHAR, '-')) >= 5),
m AS (SELECT k.r, k.doc_id, k.i, k.line, rep.key IS NOT NULL AND k.doc_id IS DISTINCT FROM rep.holder AS gone FROM k LEFT JOIN rep ON k.key = rep.key)
SELECT min(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""
