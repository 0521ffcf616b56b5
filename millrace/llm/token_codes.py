"""Token ids in files of directly addressable codes.

An id is cut into chunks of 8 bits. Level k has the k-th chunk of every id that has one, and a bitmap that says which of
them go on at level k + 1. A directory has the ones before every 512 bits of a bitmap, so any id is read by one rank a
level, without decoding a block.

File: magic, little-endian unsigned 64-bit numbers (documents, ids, levels), each document's id (with a byte that tells
null) and its first position, then for each level its length, chunks, bitmap and directory.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

MAGIC = b"DACTOK01"
BLOCK = 512
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def levels_of(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap, directory) of each level."""
    out, rest = [], np.ascontiguousarray(ids, "<u4")
    while True:
        more = rest > 255
        bitmap = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-max(1, len(rest)) // BLOCK) * (BLOCK // 8), np.uint8)
        padded[: len(bitmap)] = bitmap
        ones = _ONES[padded].reshape(-1, BLOCK // 8).sum(1, dtype=np.uint64)
        out.append((rest.astype(np.uint8), padded, np.concatenate([[np.uint64(0)], np.cumsum(ones, dtype=np.uint64)]).astype("<u8")))
        if not more.any():
            return out
        rest = rest[more] >> np.uint32(8)


def pack(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    levels = levels_of(ids)
    starts = np.zeros(len(lengths) + 1, "<u8")
    np.cumsum(lengths, out=starts[1:])
    out = [MAGIC, struct.pack("<QQQ", len(doc_ids), len(ids), len(levels))]
    out += [np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array([x is None for x in doc_ids], np.uint8).tobytes(), starts.tobytes()]
    for chunks, bitmap, directory in levels:
        out += [struct.pack("<Q", len(chunks)), chunks.tobytes(), bitmap.tobytes(), directory.tobytes()]
    return b"".join(out)


class Codes:
    """A file's contents; self[i] is the i-th id, all() are all of them."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("no file of token codes")
        docs, self.n, levels = struct.unpack_from("<QQQ", data, 8)
        at = 32

        def take(kind, count):
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        ids = take("<i8", docs)
        self.doc_ids = [None if none else int(x) for x, none in zip(ids, take(np.uint8, docs))]
        self.starts = take("<u8", docs + 1).astype(np.int64)
        self.levels = []
        for _ in range(levels):
            n = int(take("<u8", 1)[0])
            blocks = -(-max(1, n) // BLOCK)
            self.levels.append((take(np.uint8, n), take(np.uint8, blocks * (BLOCK // 8)), take("<u8", blocks + 1)))
        if at != len(data) or self.n != self.starts[-1] or self.n != len(self.levels[0][0]):
            raise ValueError("the file's parts don't add up")

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = shift = 0
        for chunks, bitmap, directory in self.levels:
            out |= int(chunks[i]) << shift
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK
            first = block * (BLOCK // 8)
            i = int(directory[block]) + int(_ONES[bitmap[first : i >> 3]].sum()) + int(_ONES[bitmap[i >> 3] & ((1 << (i & 7)) - 1)])
            shift += 8
        return out

    def all(self) -> np.ndarray:
        rest = None
        for (chunks, bitmap, _), more in zip(reversed(self.levels), [None, *reversed(self.levels)][: len(self.levels)]):
            out = chunks.astype("<u4")
            if more is not None:
                on = np.unpackbits(bitmap, bitorder="little")[: len(chunks)].astype(bool)
                out[on] |= rest << np.uint32(8)
            rest = out
        return rest


class CodeFile:
    """Random access to a file that isn't read: self[i] takes a byte, a block of the bitmap and a directory entry a level."""

    def __init__(self, uri: str):
        files, path = common.pafs.FileSystem.from_uri(uri)
        self._file = files.open_input_file(path)
        head = self._file.read_at(32, 0)
        if head[:8] != MAGIC:
            raise ValueError("no file of token codes")
        docs, self.n, levels = struct.unpack_from("<QQQ", head, 8)
        at, self._levels = 32 + 9 * docs + 8 * (docs + 1), []
        for _ in range(levels):
            n = struct.unpack("<Q", self._file.read_at(8, at))[0]
            blocks = -(-max(1, n) // BLOCK)
            self._levels.append((at + 8, at + 8 + n, at + 8 + n + blocks * (BLOCK // 8)))
            at += 8 + n + blocks * (BLOCK // 8) + 8 * (blocks + 1)
        if at != self._file.size():
            raise ValueError("the file's parts don't add up")

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = shift = 0
        for chunks, bitmap, directory in self._levels:
            out |= self._file.read_at(1, chunks + i)[0] << shift
            block, bit = divmod(i, BLOCK)
            bits = np.frombuffer(self._file.read_at(BLOCK // 8, bitmap + block * (BLOCK // 8)), np.uint8)
            if not bits[bit >> 3] >> (bit & 7) & 1:
                break
            ahead = struct.unpack("<Q", self._file.read_at(8, directory + 8 * block))[0]
            i = ahead + int(_ONES[bits[: bit >> 3]].sum()) + int(_ONES[bits[bit >> 3] & ((1 << (bit & 7)) - 1)])
            shift += 8
        return out

    def close(self) -> None:
        self._file.close()


def _name(part: int, k: int) -> str:
    return f"part-{part:06d}-{k:05d}.codes"


#: Ids that one file holds at most, but for a document that alone has more.
FILE_IDS = 4_000_000


def _write(folder: str, path: str, end_id: int):
    def run(batches):
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), tokens.encoder(path)
        end = np.array([end_id], "<u4")
        files, doc_ids, held, size = [], [], [], 0

        def flush():
            ids = np.concatenate(held)
            files.append((part, len(files), len(ids)))
            common.put(f"{folder}/{_name(part, files[-1][1])}", pack(doc_ids, [len(x) for x in held], ids))

        for batch in common.small(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.concatenate([np.frombuffer(encoder.encode(text or ""), encoder.dtype).astype("<u4"), end])
                if held and size + len(ids) > FILE_IDS:
                    flush()
                    doc_ids, held, size = [], [], 0
                doc_ids.append(doc)
                held.append(ids)
                size += len(ids)
        if held:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*files) if files else ([], [], []))], ["part", "k", "n"])

    return run


def write_codes(docs: DataFrame, folder: str, path: str, end_id: int = END_ID) -> DataFrame:
    """Encodes docs (doc_id, text) into files in folder, in ascending doc_id order (null first, equal ids by text), and
    returns (part, k, n): each file's place in that order and its number of ids."""
    common.prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the second splits a hot id over partitions, the third a hot row
    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc(), F.pmod(F.monotonically_increasing_id(), F.lit(997)).asc())
    rows = docs.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return common.written(rows.mapInArrow(_write(folder, path, end_id), "part long, k long, n long"), "code-files")


def _read(folder: str):
    def run(batches):
        for batch in batches:
            for part, k, n, before in zip(*(c.to_pylist() for c in batch.columns)):
                codes = Codes(common.get(f"{folder}/{_name(part, k)}"))
                if len(codes) != n:
                    raise ValueError(f"{_name(part, k)} has {len(codes)} ids; {n} were written")
                ids, at = codes.all(), codes.starts
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(codes.doc_ids, pa.int64()), pa.array(at[:-1] + before), pa.array(np.diff(at)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_codes(files: DataFrame, folder: str) -> DataFrame:
    """SCHEMA's row of each document in the files (part, k, n) of folder."""
    from pyspark.sql import Window

    # one row a partition of the writer, then one a file: prefix sums over the partitions' totals alone
    totals = files.groupBy("part").agg(F.sum("n").alias("t"))
    ahead = totals.select("part", (F.sum("t").over(Window.orderBy("part")) - F.col("t")).alias("ahead"))
    own = F.sum("n").over(Window.partitionBy("part").orderBy("k")) - F.col("n")
    rows = files.withColumn("own", own).join(ahead, "part").select("part", "k", "n", (F.col("own") + F.col("ahead")).alias("before"))
    return rows.repartitionByRange(max(1, files.count()), "part", "k").mapInArrow(_read(folder), SCHEMA)


def token_codes(docs: DataFrame, folder: str, path: str, end_id: int = END_ID) -> DataFrame:
    """SCHEMA of docs, as read back from the files that this writes.

    A null or empty text is just the end id. Rows of equal doc_id are documents of their own, in the order of their
    texts' hashes; null doc_ids come first. Texts of any length are encoded whole; an empty table gives no rows.
    """
    return read_codes(write_codes(docs, folder, path, end_id), folder)


def op1_token_codes(spark, sf_dir):
    """Documents as codes on files, read back. Null, empty, repeated, long and missing rows: see token_codes."""
    return token_codes(common.table(spark, sf_dir, "documents"), common.shared_folder(spark, "codes"), tokens.public(TOKENIZER))
