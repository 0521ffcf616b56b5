"""Repeated windows by a depth-limited most-significant-digit radix sort of suffixes.

A window is the first `width` bytes of a suffix; matches never cross texts. The first digit of a suffix is its anchor:
the least hash of the GRAM-byte strings in its window, with the anchor's place in it. It is the same for equal windows,
so suffixes are dealt out by anchor, and anchors that occur once end there. The suffixes of one anchor and place form a
run; runs of equal bytes around one anchor (by a 128-bit digest of them) are one class, of which the passes order one
member with the class's size as its weight. The windows of an anchor's classes are ordered by their bytes, eight at a
time, through `width` bytes and no deeper. A group of one leaves after every pass, repeated if it stands for several
suffixes; the groups that are left are repeated windows too.

Texts are put into shard files once. Only anchors, one run of a class, and verdicts are shuffled: verdicts go to the
shards' texts, not texts to verdicts. An anchor with more than HOT_CLASSES classes isn't compared in
one task: the windows of its classes are counted by 128-bit hash, with a map-side combine.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WIDTH = 200
GRAM = 80
#: Bytes of text in a shard file, but for a longer text; bytes that are hashed at once; bytes of the cuts of a longer text.
SHARD_BYTES, PIECE, CUT = 8 << 20, 1 << 20, 8 << 20
#: The low bits of a hash that give way to a position. The same for every piece, so equal windows have equal anchors.
PLACE_BITS = 24
HOT_CLASSES = 20_000
#: Windows that are sorted at once, but for a larger group.
SORT_WINDOWS = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Hashes:
    """Hash of any stretch of `data`, by sums of bytes times powers modulo 2**64."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray):
        size = 1 << max(20, int(len(data)).bit_length())
        if size not in self._powers:
            self._powers.clear()
            pows = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
            for k, b in enumerate((_BASE, _INVERSE)):
                while len(pows[k]) < size:
                    pows[k] = np.concatenate([pows[k], pows[k] * np.uint64(pow(b, len(pows[k]), 1 << 64))])
            self._powers[size] = (pows[0], pows[1])
        up, self.down = self._powers[size]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])


def runs_of(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH, gram: int = GRAM):
    """(anchor hash, anchor position, least and largest window start) of every run of data, where windows of
    consecutive starts have one anchor. offsets: where the texts start and, last, where data ends."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n >= 1 << PLACE_BITS:
        raise ValueError("a piece is too long for its positions")
    if n < width:
        return none.astype(np.uint64), none, none, none
    h = Hashes(data)
    at = np.arange(n - gram + 1)
    g = h.of(at, at + gram)
    bits = PLACE_BITS
    v = (g & ~np.uint64((1 << bits) - 1)) | at.astype(np.uint64)  # the leftmost of equal ones
    span, have = width - gram + 1, 1
    while 2 * have <= span:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    least = np.minimum(v[: n - width + 1], v[span - have : span - have + n - width + 1])
    starts = np.arange(n - width + 1)
    inside = np.zeros(n + 1, np.int32)  # windows that lie in one text
    good_from, good_to = offsets[:-1], np.maximum(offsets[1:] - width + 1, offsets[:-1])
    np.add.at(inside, good_from, 1)
    np.add.at(inside, good_to, -1)
    starts = starts[np.cumsum(inside)[: len(starts)] > 0]
    if not len(starts):
        return none.astype(np.uint64), none, none, none
    anchor = (least[starts] & np.uint64((1 << bits) - 1)).astype(np.int64)
    cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(starts) != 1))
    first, last = starts[np.concatenate([[0], cut + 1])], starts[np.concatenate([cut, [len(starts) - 1]])]
    anchor = anchor[np.concatenate([[0], cut + 1])]
    return g[anchor], anchor, first, last


def digests(raw: bytes, anchor: np.ndarray, first: np.ndarray, last: np.ndarray, width: int) -> np.ndarray:
    """Two numbers for each run: a 128-bit digest of its bytes and of where its anchor lies in them."""
    shape = ((anchor - first) << 16 | (last - first)).tolist()
    out = [xxhash.xxh3_128_digest(raw[a:b], s) for a, b, s in zip(first.tolist(), (last + width).tolist(), shape)]
    return np.frombuffer(b"".join(out), "<i8").reshape(-1, 2)


def _shard_bytes(doc_ids, lengths, data: bytes) -> bytes:
    head = struct.pack("<Q", len(doc_ids)) + np.array([x or 0 for x in doc_ids], "<i8").tobytes() + np.array([x is None for x in doc_ids], np.uint8).tobytes() + np.array(lengths, "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + data)


def _shard(folder: str, shard: int):
    """doc_ids, offsets and bytes of a shard."""
    raw = zstandard.ZstdDecompressor().decompress(common.get(f"{folder}/{shard}.shard"))
    n = struct.unpack_from("<Q", raw)[0]
    ids, none = np.frombuffer(raw, "<i8", n, 8), np.frombuffer(raw, np.uint8, n, 8 + 8 * n)
    lengths = np.frombuffer(raw, "<i8", n, 8 + 9 * n)
    return [None if z else int(x) for x, z in zip(ids, none)], np.concatenate([[0], np.cumsum(lengths)]), np.frombuffer(raw, np.uint8, offset=8 + 17 * n)


def _runs(folder: str, width: int, shard_bytes: int, piece: int, most: int):
    def run(batches):
        from pyspark import TaskContext

        part, k = TaskContext.get().partitionId(), 0

        def flush(ids, texts):
            shard = part << 12 | k
            common.put(f"{folder}/{shard}.shard", _shard_bytes(ids, [len(x) for x in texts], b"".join(texts)))
            out, base = [], 0
            for a, b in common.pieces(texts, piece):
                data, offsets = common.joined(texts[a:b])
                # a text beyond a piece is cut, each cut with the bytes that its last window needs
                for c in range(0, max(1, len(data)), most):
                    d = data[c : c + most + width - 1]
                    o = offsets if len(data) <= most else np.array([0, len(d)])
                    anchor, at, first, last = runs_of(d, o, width, min(GRAM, width))
                    out.append((anchor, digests(d.tobytes(), at, first, last, width), at + base + c, at - first, at - last))
                base += len(data)
            anchor, sign, at, high, low = (np.concatenate(x) for x in zip(*out))
            ref = at | shard << 32
            columns = [pa.array(anchor.astype(np.int64)), pa.array(sign[:, 0].copy()), pa.array(sign[:, 1].copy()), pa.array(ref), pa.array(low.astype(np.int16)), pa.array(high.astype(np.int16))]
            one = [*(pa.array([None], pa.int64()) for _ in range(3)), pa.array([shard << 32], pa.int64()), pa.array([0], pa.int16()), pa.array([0], pa.int16())]
            for c in (columns, one):
                yield pa.RecordBatch.from_arrays(c, ["anchor", "run", "more", "ref", "low", "high"])

        ids, texts, size = [], [], 0
        for batch in common.small(batches):
            for doc, text in zip(batch.column(0).to_pylist(), common.texts_of(batch.column(1))):
                if texts and size + len(text) > shard_bytes:
                    yield from flush(ids, texts)
                    k, ids, texts, size = k + 1, [], [], 0
                ids.append(doc)
                texts.append(text)
                size += len(text)
        if texts:
            yield from flush(ids, texts)

    return run


def _by_shard(batches, folder: str):
    """(shard, its contents, its rows as columns) for rows sorted by their last column, the shard."""
    at, held = None, []
    for batch in batches:
        shard = batch.column(batch.num_columns - 1).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if shard[a] != at:
                if held:
                    yield at, _shard(folder, at), pa.Table.from_batches(held)
                at, held = int(shard[a]), []
            held.append(batch.slice(a, b - a))
    if held:
        yield at, _shard(folder, at), pa.Table.from_batches(held)


def _contexts(folder: str, width: int):
    """anchor, run, more, n, low, high and the bytes of the run."""

    def run(batches):
        for _, (_, _, data), rows in _by_shard(batches, folder):
            ref, low, high = (rows.column(c).to_numpy() for c in ("ref", "low", "high"))
            at = ref & 0xFFFFFFFF
            raw = data.tobytes()
            for i in range(0, len(at), 4096):
                j = slice(i, i + 4096)
                span = [raw[a:b] for a, b in zip((at[j] - high[j]).tolist(), (at[j] - low[j] + width).tolist())]
                part = rows.slice(i, 4096)
                yield pa.RecordBatch.from_arrays([part.column(c).combine_chunks() for c in ("anchor", "run", "more", "n", "low", "high")] + [pa.array(span, pa.binary())], ["anchor", "run", "more", "n", "low", "high", "span"])

    return run


def repeated(group: np.ndarray, start: np.ndarray, weight: np.ndarray, data: np.ndarray, width: int) -> np.ndarray:
    """Which windows (first digit, start in data) occur twice: passes over eight bytes each, in lexicographic order. A
    group of one leaves: it is repeated if its weight is two or more, as no later digit can part what is one class."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.zeros(len(data) + 1, np.uint64)
    for k in range(8):
        words |= padded[k : k + len(words)].astype(np.uint64) << np.uint64(56 - 8 * k)
    live = np.arange(len(group))
    key = group
    out = np.zeros(len(group), bool)
    for depth in range(-1, -(-width // 8)):
        if not len(live):
            break
        if depth < 0:
            digit = np.zeros(len(live), np.uint64)
        else:
            digit = words[start[live] + 8 * depth]
            if width - 8 * depth < 8:
                digit = digit >> np.uint64(8 * (8 - width + 8 * depth))
        order = np.lexsort((digit, key))
        k, d = key[order], digit[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])])
        ident = np.cumsum(new) - 1
        live = live[order]
        keep = np.bincount(ident)[ident] >= 2
        out[live[~keep & (weight[live] >= 2)]] = True
        live, key = live[keep], ident[keep]
    out[live] = True
    return out


def _compare(width: int):
    """Runs (anchor, run, more, least and largest offset) of repeated windows of the classes."""

    def sort(rows):
        anchor, run, more, n, low, high = (rows.column(c).to_numpy() for c in ("anchor", "run", "more", "n", "low", "high"))
        data, begin = common.joined([x.as_py() for x in rows.column("span").combine_chunks()])
        size = (high - low + 1).astype(np.int64)
        row = np.repeat(np.arange(len(size)), size)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low.astype(np.int64), size)
        same = np.concatenate([[0], np.cumsum(anchor[1:] != anchor[:-1])])
        found = repeated(same[row] * (width + 1) + offset, begin[row] + high[row] - offset, np.minimum(n, 2)[row], data, width)
        pick = np.flatnonzero(found)
        if not len(pick):
            return None
        row, offset = row[pick], offset[pick]
        cut = np.flatnonzero((np.diff(row) != 0) | (np.diff(offset) != 1))
        a, b = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(row) - 1]])
        return pa.RecordBatch.from_arrays([pa.array(x[row[a]]) for x in (anchor, run, more)] + [pa.array(offset[a].astype(np.int16)), pa.array(offset[b].astype(np.int16))], ["anchor", "run", "more", "low", "high"])

    def run(batches):
        held, windows = [], 0
        for batch in batches:
            anchor = batch.column(0).to_numpy()
            if held and windows >= SORT_WINDOWS:  # cut where the anchor changes
                last = held[-1].column(0)[-1].as_py()
                other = np.flatnonzero(anchor != last)
                k = int(other[0]) if len(other) else len(anchor)
                held.append(batch.slice(0, k))
                if k < len(anchor):
                    if (out := sort(pa.Table.from_batches(held))) is not None:
                        yield out
                    held, windows = [], 0
                batch = batch.slice(k)
            if len(batch):
                held.append(batch)
                windows += int((batch.column(5).to_numpy() - batch.column(4).to_numpy() + 1).sum())
        if held and (out := sort(pa.Table.from_batches(held))) is not None:
            yield out

    return run


def _windows(folder: str, width: int):
    """Every window of the runs, by two hashes."""

    def run(batches):
        for _, (_, _, data), rows in _by_shard(batches, folder):
            anchor, run_, more, ref, n, low, high = (rows.column(c).to_numpy() for c in ("anchor", "run", "more", "ref", "n", "low", "high"))
            raw = data.tobytes()
            for i in range(len(ref)):
                at = int(ref[i]) & 0xFFFFFFFF
                offsets = np.arange(low[i], high[i] + 1)
                digests = [hashlib.blake2b(raw[at - o : at - o + width], digest_size=16).digest() for o in offsets.tolist()]
                size = len(offsets)
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), *(pa.array(np.full(size, x[i])) for x in (anchor, run_, more, n)), pa.array(offsets.astype(np.int16))], ["window", "anchor", "run", "more", "n", "offset"])

    return run


def _apply(folder: str, width: int, texts: bool):
    def run(batches):
        for _, (ids, offsets, data), rows in _by_shard(batches, folder):
            ref, low, high = (rows.column(c).to_numpy() for c in ("ref", "low", "high"))
            real = high >= 0
            at = (ref & 0xFFFFFFFF)[real]
            edge = np.zeros(len(data) + 1, np.int64)
            np.add.at(edge, at - high[real], 1)
            np.add.at(edge, at - low[real] + width, -1)
            gone = np.cumsum(edge[:-1]) > 0
            out = []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                g = gone[a:b]
                removed = int(g.sum())
                kept = data[a:b][~g].tobytes() if removed else data[a:b].tobytes()
                spans = int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()) if removed else 0
                out.append((b - a, removed, spans, hashlib.sha256(kept).hexdigest(), kept if texts else None))
            columns = [pa.array(ids, pa.int64()), *(pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]))]
            k = 6 if texts else 5
            yield pa.RecordBatch.from_arrays(columns[:k], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:k])

    return run


def repeated_windows(docs: DataFrame, width: int = WIDTH, texts: bool = False, hot: int = HOT_CLASSES, shard_bytes: int = SHARD_BYTES, piece: int = PIECE, cut: int = CUT) -> DataFrame:
    """SCHEMA for every row of docs (doc_id, text), and with texts the bytes that stay, `kept`.

    A null or empty text has no bytes; texts shorter than width lose none. Repeated rows are texts of their own, so from
    width bytes on they lose everything. A null doc_id stays null. Texts count whole; no rows: none.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = common.shared_folder(spark, "texts")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    runs = common.written(docs.mapInArrow(_runs(folder, width, shard_bytes, piece, cut), "anchor long, run long, more long, ref long, low short, high short"), "runs")
    real = runs.filter("anchor is not null")
    twice = real.groupBy("anchor").count().filter("count > 1").select("anchor")
    shared = common.written(real.join(twice, "anchor"), "shared-runs")
    classes = shared.groupBy("anchor", "run", "more").agg(F.count("*").alias("n"), F.min("ref").alias("ref"), F.min("low").alias("low"), F.min("high").alias("high"))
    classes, at_classes = common.written_at(classes.withColumn("shard", F.shiftright("ref", 32)), "run-classes")
    # the first digit: an anchor with one class parts from all others, and its group has more than one suffix
    several, at_several = common.written_at(classes.groupBy("anchor").agg(F.count("*").alias("m")).filter("m > 1"), "anchors")
    alone = classes.join(several, "anchor", "left_anti").select("anchor", "run", "more", "low", "high")
    compared = classes.join(several, "anchor").select("anchor", "run", "more", "n", "ref", "low", "high", "m", "shard")
    cold = compared.filter(F.col("m") <= hot).drop("m").repartition(parts, "shard").sortWithinPartitions("shard")
    spans = cold.mapInArrow(_contexts(folder, width), "anchor long, run long, more long, n long, low short, high short, span binary")
    verdicts = spans.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(_compare(width), "anchor long, run long, more long, low short, high short").unionByName(alone)
    crowded = not several.filter(F.col("m") > hot).isEmpty()
    if crowded:
        rows = compared.filter(F.col("m") > hot).drop("m").repartition(parts, "shard").sortWithinPartitions("shard")
        rows = common.written(rows.mapInArrow(_windows(folder, width), "window binary, anchor long, run long, more long, n long, offset short"), "hot-windows")
        often = rows.groupBy("window").agg(F.sum("n").alias("total")).filter("total > 1").select("window")
        verdicts = verdicts.unionByName(rows.join(often, "window").select("anchor", "run", "more", F.col("offset").alias("low"), F.col("offset").alias("high")))
    verdicts = common.written(verdicts, "verdicts")
    for folder_ in (at_classes, at_several):
        common.drop_folder(folder_)
    gone = shared.select("anchor", "run", "more", "ref").join(verdicts, ["anchor", "run", "more"]).select("ref", "low", "high")
    every = runs.filter("anchor is null").select("ref", "low", F.lit(-1).cast("short").alias("high"))
    gone = gone.unionByName(every).withColumn("shard", F.shiftright("ref", 32)).repartition(parts, "shard").sortWithinPartitions("shard")
    return gone.mapInArrow(_apply(folder, width, texts), SCHEMA + (", kept binary" if texts else ""))


def op7_suffix_dedup(spark, sf_dir):
    """Every document without repeated windows, by digest. Null, empty, repeated, long and missing rows: see repeated_windows."""
    return repeated_windows(common.table(spark, sf_dir, "documents"))
