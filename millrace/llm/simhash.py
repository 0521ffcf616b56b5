"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint is cut into blocks. Two at 6 or fewer differing bits differ in few bits (6 / blocks) of one block at least.
In a block the anchors are the words of a covering code: perfect [15, 11] Hamming codes side by side, with the other bits
free, so the covering radius is the number of codes. A fingerprint's home is its anchor within that radius; it is
replicated to every anchor within radius plus those few bits, so it meets each fingerprint that is near in that block at
the other's home. A pair counts only in the first block that makes it near. Equal fingerprints are one row with a count,
so groups of copies neither skew a bucket nor multiply pairs.

Few blocks make more replicas and fewer comparisons. Every layout finds the same pairs; the cheapest for the number of
fingerprints is taken.
"""

from __future__ import annotations

from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, graph

BITS = 6
#: Homes that are compared at once; a bucket with more is cut into sub-buckets, each with all of the replicas. Replicas
#: pass by in chunks.
BUCKET_HOMES, CHUNK = 20_000, 1 << 16
PAIRS_AT_ONCE = 1 << 21
#: Replicas that are made at once.
REPLICAS_AT_ONCE = 1 << 20
#: What a comparison costs, if making, sorting and reading a replica costs 1.
COMPARISON = 0.002
_HASH = partial(xxhash.xxh64_intdigest, seed=42)
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes) -> np.ndarray:
    words = text.lower().split()  # of bytes: A-Z, and 0x20 and 0x09 to 0x0D
    if len(words) < 2:
        return np.array([_HASH(w) for w in words], np.uint64)
    return np.fromiter(map(_HASH, map(b" ".join, zip(words, words[1:]))), np.uint64, len(words) - 1)


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """Unsigned fingerprint of each text: bit i is set if over half of its shingles' hashes have it; no words: 0."""
    hashes = [shingle_hashes(x) for x in texts]
    n = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    h = np.concatenate([hashes[i] for i in full])
    ends = np.cumsum(n[full])
    starts = ends - n[full]
    # eight bits at a time, one a byte lane: runs of at most 255 hashes can't overflow a lane
    runs = -(-n[full] // 255)
    first = np.concatenate([[0], np.cumsum(runs)[:-1]])
    cuts = np.repeat(starts, runs) + 255 * (np.arange(runs.sum()) - np.repeat(first, runs))
    count = np.empty((len(full), 64), np.int64)
    for k in range(8):
        lanes = np.add.reduceat(h >> np.uint64(k) & _LANES, cuts)
        per_run = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
        count[:, k::8] = np.add.reduceat(per_run, first, axis=0)
    set_bits = 2 * count > n[full][:, None]
    out[full] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


class Layout:
    """Blocks of `widths` bits, the lowest first, each with `codes` Hamming codes in its lowest bits."""

    def __init__(self, widths: tuple[int, ...], codes: int, bits: int = BITS):
        self.widths, self.codes, self.within = widths, codes, bits // len(widths)
        self.shifts = [sum(widths[:k]) for k in range(len(widths))]
        self.patterns = {w: self._patterns(w) for w in set(widths)}
        self.replicas = sum(sum(map(len, self.patterns[w])) / len(self.patterns[w]) for w in widths)
        #: Expected replicas that a home is compared with, as a share of all fingerprints.
        self.share = sum(sum(map(len, self.patterns[w])) / (1 << w) for w in widths)

    def cost(self, n: int) -> float:
        """Of a fingerprint, if there are n random ones."""
        return self.replicas + COMPARISON * self.share * n

    def syndrome(self, v: np.ndarray) -> np.ndarray:
        out = np.zeros(len(v), np.int64)
        for c in range(self.codes):
            s = np.zeros(len(v), np.int64)
            for bit in range(15):
                s ^= (v >> (15 * c + bit) & 1) * (bit + 1)
            out |= s << 4 * c
        return out

    def _patterns(self, width: int) -> list[np.ndarray]:
        """By syndrome: the words of weight radius + within or less that lead from a word of that syndrome to an anchor."""
        found = level = np.zeros(1, np.int64)
        last = np.full(1, -1)
        for _ in range(self.codes + self.within):
            row, bit = np.nonzero(np.arange(width)[None, :] > last[:, None])
            level, last = level[row] | 1 << bit, bit
            found = np.concatenate([found, level])
        s = self.syndrome(found)
        return [found[s == k] for k in range(16**self.codes)]

    def block(self, fp: np.ndarray, b: int) -> np.ndarray:
        return (fp >> np.uint64(self.shifts[b]) & np.uint64((1 << self.widths[b]) - 1)).astype(np.int64)

    def home(self, v: np.ndarray) -> np.ndarray:
        s = self.syndrome(v)
        for c in range(self.codes):
            own = s >> 4 * c & 15
            v = np.where(own > 0, v ^ (1 << (15 * c + np.maximum(own - 1, 0))), v)
        return v

    def near(self, v: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(index into v, anchor) of all anchors within radius + within."""
        s = self.syndrome(v)
        rows, out = [], []
        for k in np.unique(s).tolist():
            own = np.flatnonzero(s == k)
            e = self.patterns[self.widths[b]][k]
            rows.append(np.repeat(own, len(e)))
            out.append((v[own][:, None] ^ e[None, :]).ravel())
        return np.concatenate(rows or [np.zeros(0, np.int64)]), np.concatenate(out or [np.zeros(0, np.int64)])


LAYOUTS = (((16, 16, 16, 16), 1), ((22, 21, 21), 1), ((32, 32), 2))


@lru_cache
def layout(k: int) -> Layout:
    return Layout(*LAYOUTS[k])


def cheapest(n: int) -> int:
    return min(range(len(LAYOUTS)), key=lambda k: layout(k).cost(n))


def _homes(k: int):
    """The bucket of each fingerprint's home in each block."""

    def run(batches):
        own = layout(k)
        for batch in batches:
            fp = batch.column(0).to_numpy().astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([own.home(own.block(fp, b)) | b << 32 for b in range(len(own.widths))]))], ["bucket"])

    return run


def _replicate(k: int):
    def run(batches):
        own = layout(k)
        step = max(1, int(REPLICAS_AT_ONCE / own.replicas))
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                fp, n = part.column(0).to_numpy().astype(np.uint64), part.column(1).to_numpy()
                for b in range(len(own.widths)):
                    v = own.block(fp, b)
                    row, at = own.near(v, b)
                    yield pa.RecordBatch.from_arrays([pa.array(at | b << 32), pa.array(fp[row].astype(np.int64)), pa.array(n[row]), pa.array(at == own.home(v)[row])], ["bucket", "fp", "n", "is_home"])

    return run


def linked(home: np.ndarray, other: np.ndarray, block: int, own: Layout, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (home, other) of different fingerprints at `bits` or fewer, near in `block` and in no earlier one."""
    a, b = np.nonzero(np.bitwise_count(home[:, None] ^ other[None, :]) <= bits)
    x = home[a] ^ other[b]
    good = x != 0
    for k in range(block + 1):
        near = np.bitwise_count(own.block(x, k)) <= own.within
        good &= near if k == block else ~near
    return a[good], b[good]


class _Bucket:
    """Rows of one bucket, the homes first. add() and flush() give (fp, root, near) of the fingerprints that are linked in
    what came since the last time: near counts documents, for homes only, and adds up."""

    def __init__(self, bucket: int, own: Layout):
        self.block, self.own = bucket >> 32, own
        self.parts: list = []
        self.size, self.homes = 0, None

    def add(self, fp, n, is_home):
        self.parts.append((fp, n, is_home))
        self.size += len(fp)
        return self.flush() if self.size >= CHUNK and not is_home[-1] else None

    def flush(self):
        if not self.parts:
            return None
        fp, n, is_home = (np.concatenate(c) for c in zip(*self.parts))
        self.parts, self.size = [], 0
        begin = 0
        if self.homes is None:
            self.homes = fp[is_home], n[is_home]
        else:
            begin = len(self.homes[0])
        homes = self.homes[0]
        fp, n = np.concatenate([homes, fp[~is_home]]), np.concatenate([self.homes[1], n[~is_home]])
        if not len(homes) or len(fp) < 2:
            return None
        root = np.arange(len(fp))
        sums = np.zeros(len(fp), np.int64)
        step = max(1, PAIRS_AT_ONCE // max(1, len(fp) - begin))
        for i in range(0, len(homes), step):
            a, b = linked(homes[i : i + step], fp[begin:], self.block, self.own)
            a, b = a + i, b + begin
            np.add.at(sums, a, n[b])
            while len(a):
                low = np.minimum(root[a], root[b])
                np.minimum.at(root, root[a], low)
                np.minimum.at(root, root[b], low)
                while (root[root] != root).any():
                    root = root[root]
                open_ = root[a] != root[b]
                a, b = a[open_], b[open_]
        used = np.flatnonzero((sums > 0) | (root != np.arange(len(fp))))
        return (fp[used], fp[root[used]], sums[used]) if len(used) else None


def _compare(k: int):
    def out(got):
        return pa.RecordBatch.from_arrays([pa.array(got[0].astype(np.int64)), pa.array(got[1].astype(np.int64)), pa.array(got[2])], ["fp", "root", "near"])

    def run(batches):
        own, at, bucket = layout(k), None, None
        for batch in batches:
            key, cut = batch.column(0).to_numpy(), batch.column(4).to_numpy()
            fp, n, is_home = batch.column(1).to_numpy().astype(np.uint64), batch.column(2).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((np.diff(key) != 0) | (np.diff(cut) != 0)) + 1).tolist(), len(key)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if (key[a], cut[a]) != at:
                    if bucket and (got := bucket.flush()):
                        yield out(got)
                    at = (key[a], cut[a])
                    bucket = _Bucket(int(key[a]), own)
                if got := bucket.add(fp[a:b], n[a:b], is_home[a:b]):
                    yield out(got)
        if bucket and (got := bucket.flush()):
            yield out(got)

    return run


def _fingerprints(names: list[str]):
    def run(batches):
        for batch in common.small(batches):
            texts = common.texts_of(batch.column(1))
            fp = np.concatenate([fingerprints(texts[a:b]) for a, b in common.pieces(texts)] or [np.zeros(0, np.uint64)])
            rest = [batch.column(k) for k in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *([batch.column(1), *rest] if names else []), pa.array(fp.astype(np.int64))], ["doc_id", *names, "fp"])

    return run


def with_fingerprints(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp), or with carry (doc_id, text, *carry, fp), row by row."""
    common.prepare(docs.sparkSession)
    names = ["text", *carry] if carry else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    schema = ", ".join(["doc_id long", *(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names), "fp long"])
    return rows.mapInArrow(_fingerprints(names), schema)


def link_classes(rows: DataFrame, which: int | None = None, bucket_homes: int = BUCKET_HOMES) -> DataFrame:
    """(fp, n, n_near, component_id, root) for each fingerprint of rows (doc_id, fp); n is its number of rows. which: the
    layout, else the cheapest."""
    with common.scratch() as keep:
        classes = common.written(rows.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")), "classes")
        k = cheapest(classes.count()) if which is None else which
        placed = classes.select("fp", "n").mapInArrow(_replicate(k), "bucket long, fp long, n long, is_home boolean")
        # the buckets with too many homes for one task are cut: of n fingerprints, no more than 4 * n / bucket_homes buckets
        large = classes.select("fp").mapInArrow(_homes(k), "bucket long").groupBy("bucket").count().filter(F.col("count") > bucket_homes)
        cut = common.written(large.select("bucket", F.ceil(F.col("count") / bucket_homes).cast("int").alias("cuts")), "cuts")
        if cut.isEmpty():
            placed = placed.withColumn("cut", F.lit(0))
        else:
            placed = placed.join(F.broadcast(cut), "bucket", "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
            own = F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")
            placed = placed.withColumn("cut", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
            placed = placed.select("bucket", "fp", "n", (F.col("is_home") & (F.col("cut") == own)).alias("is_home"), "cut")
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        met = placed.repartition(parts, "bucket", "cut").sortWithinPartitions("bucket", "cut", F.desc("is_home")).mapInArrow(_compare(k), "fp long, root long, near long")
        met = common.written(met, "links")
        near = met.groupBy("fp").agg(F.sum("near").alias("near"))
        roots = graph.components(met.select(F.col("fp").alias("u"), F.col("root").alias("v"))).withColumnRenamed("u", "fp")
        out = classes.join(near, "fp", "left").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        out, folder = common.written_at(out.select("fp", "n", "first", "root", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_near")), "linked")
        keep(folder)
    least = out.groupBy("root").agg(F.min("first").alias("component_id"))
    return out.join(least, "root").select("fp", "n", "n_near", "component_id", "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, n_near, component_id) for every row of docs (doc_id, text).

    Null and empty texts have fingerprint 0 and are linked by it. Repeated rows are documents of their own, linked to
    each other. component_id is the smallest doc_id that is not null in the component, null if there is none. Texts
    count whole at any length; an empty table gives no rows.
    """
    rows = common.written(with_fingerprints(docs), "fingerprints")
    out = common.join_lookup(rows, link_classes(rows).drop("n", "root"), "fp", "near")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "n_near", "component_id")


def one_of_each(docs: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """The rows of docs whose doc_id is their component's smallest: (doc_id, text, *carry). Of rows of equal doc_id in
    one component, one stays; a component of null ids alone keeps one row."""
    docs = common.written(with_fingerprints(docs, carry), "fingerprints")  # texts lie beside their fingerprints
    narrow = docs.select("doc_id", "fp")
    classes = common.written(link_classes(narrow).select("fp", F.col("component_id").alias("_component"), F.col("root").alias("_root")), "near-classes")
    stays = F.col("doc_id").eqNullSafe(F.col("_component"))
    # the few ids that several rows of a component share: one row of theirs stays, by text; others aren't shuffled
    again = common.join_lookup(narrow, classes, "fp", "near").filter(stays).groupBy("doc_id", "_root").count().filter("count > 1").select(F.col("doc_id").alias("_id"), F.col("_root").alias("_of"), F.lit(True).alias("_again"))
    rows = common.join_lookup(docs, classes, "fp", "near").filter(stays)
    again, folder = common.written_at(again, "repeated-ids")
    if again.isEmpty():
        return rows.select("doc_id", "text", *carry)
    if common.folder_bytes(folder) <= common.BROADCAST_BYTES:
        again = F.broadcast(again)
    rows = rows.join(again, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_root") == F.col("_of")), "left")
    one = rows.filter("_again").dropDuplicates(["doc_id", "_root"])
    return rows.filter("_again is null").unionByName(one).select("doc_id", "text", *carry)


def op8_simhash(spark, sf_dir):
    """Every document's links and component. Null, empty, repeated, long and missing rows: see near_duplicates."""
    return near_duplicates(common.table(spark, sf_dir, "documents"))
