"""WARC archives under Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing marks repeats of a payload as revisits of one response; reading checks magic numbers, frame sizes, header
syntax, block lengths and payload digests, and fails on the first that is wrong.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

FRAME = 0xFD2FB528
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_BYTES = 32 << 10
#: Pages (the first by hash) and leading bytes of each on which the dictionary is trained.
SAMPLE_ROWS, SAMPLE_BYTES = 256, 16 << 10
LEVEL = 3
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


class WarcError(ValueError):
    pass


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _field(value: str) -> str:
    """A header value in one line: line ends and other controls are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else "%%%02X" % ord(c) for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A response record, or the revisit record of a page whose payload the page refers_to has."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    name = "null" if page_id is None else str(page_id)
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{name}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"X-Page-ID: {name}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_field(url)}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"X-Refers-To-Page-ID: {refers_to}", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>"]
    else:
        block += payload
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary; too few or too small samples serve as one as they are."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def archive(records, dictionary: bytes) -> bytes:
    own = _dictionary(dictionary)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_checksum=True, write_content_size=True)
    stored = dictionary if own else b""
    out = [struct.pack("<II", DICTIONARY_FRAME, len(stored)), stored]
    out += (packer.compress(r) for r in records)
    return b"".join(out)


def frame_end(data: bytes, at: int) -> int:
    """Where the frame at `at` ends, by its header and its blocks' headers."""
    if len(data) - at < 6 or struct.unpack_from("<I", data, at)[0] != FRAME:
        raise WarcError(f"no frame at byte {at}")
    d = data[at + 4]
    single, checksum = d >> 5 & 1, d >> 2 & 1
    pos = at + 5 + (0 if single else 1) + (0, 1, 2, 4)[d & 3] + (1 if single and not d >> 6 else (0, 2, 4, 8)[d >> 6])
    while True:
        if pos + 3 > len(data):
            raise WarcError(f"the frame at byte {at} is cut off")
        b = int.from_bytes(data[pos : pos + 3], "little")
        pos += 3 + (1 if b >> 1 & 3 == 1 else b >> 3)
        if b & 1:
            break
    pos += 4 * checksum
    if pos > len(data):
        raise WarcError(f"the frame at byte {at} is cut off")
    return pos


def frames(data: bytes):
    """The records of an archive, decoded frame by frame."""
    if len(data) < 8:
        raise WarcError("no leading skippable frame")
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_FRAME or 8 + size > len(data):
        raise WarcError("no leading dictionary frame")
    stored = data[8 : 8 + size]
    if stored[:4] == struct.pack("<I", FRAME):  # a dictionary may itself be compressed
        stored = zstandard.ZstdDecompressor().decompress(stored)
    unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(stored)) if stored else zstandard.ZstdDecompressor()
    at = 8 + size
    while at < len(data):
        if data[at + 1 : at + 4] == b"\x2a\x4d\x18" and 0x50 <= data[at] <= 0x5F:
            raise WarcError(f"a second skippable frame at byte {at}")
        end = frame_end(data, at)
        yield unpacker.decompress(data[at:end])
        at = end


def _headers(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.decode().partition(":")
        if not colon or not name or not all("!" <= c <= "~" for c in name):
            raise WarcError(f"a bad header line: {line[:60]!r}")
        out[name.lower()] = value.strip()
    return out


def _number(headers: dict[str, str], name: str) -> int:
    if not (value := headers.get(name, "")).isdigit():
        raise WarcError(f"{name} is {value!r}")
    return int(value)


def parse(data: bytes) -> tuple:
    """SCHEMA's values of one record."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not blank or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise WarcError(f"no WARC record: {data[:40]!r}")
    h = _headers(lines)
    kind = h.get("warc-type")
    if kind not in ("response", "revisit"):
        raise WarcError(f"a record of type {kind}")
    size = _number(h, "content-length")
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"a block of {len(rest) - 4} bytes; its header says {size}")
    top, blank, payload = rest[:size].partition(b"\r\n\r\n")
    status, *lines = top.split(b"\r\n")
    if not blank or not status.startswith(b"HTTP/"):
        raise WarcError("the block is no HTTP response")
    n = _number(_headers(lines), "content-length")
    digest = h.get("warc-payload-digest", "").removeprefix("sha1:")
    if len(digest) != 32:
        raise WarcError(f"a payload digest {digest!r}")
    if kind == "response" and (len(payload) != n or payload_digest(payload) != digest):
        raise WarcError("the payload has another length or digest than its headers say")
    if kind == "revisit" and (payload or h.get("warc-profile") != REVISIT):
        raise WarcError("a revisit with a payload or of another profile")
    ident = lambda x: None if x is None or x == "null" else int(x)
    return ident(h.get("x-page-id")), h.get("warc-target-uri"), n, digest, kind, ident(h.get("x-refers-to-page-id")), payload if kind == "response" else None


#: Bytes of records, before compression, that one archive holds at most (a larger record stands alone).
ARCHIVE_BYTES = 64 << 20


def _write(folder: str, dictionary: bytes):
    def run(batches):
        from pyspark import TaskContext

        batches = common.small(batches)

        part, k, held, size, names, rows = TaskContext.get().partitionId(), 0, [], 0, [], []

        def flush():
            name = f"part-{part:06d}-{k:05d}.warc.zst"
            common.put(f"{folder}/{name}", archive(held, dictionary))
            names.append(name)
            rows.append(len(held))

        for batch in batches:
            for page, url, html, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                payload = (html or "").encode()
                held.append(record(page, url, payload, digest, refers, refers is not None))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    flush()
                    k, held, size = k + 1, [], 0
        if held:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(rows, pa.int64())], ["name", "records"])

    return run


def _digests(batches):
    for batch in common.small(batches):
        payloads = [(x or "").encode() for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([payload_digest(x) for x in payloads], pa.string())], ["page_id", "html", "url", "digest"])


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes pages (page_id, url, html) as archives in folder; returns (name, records) of each.

    A null html is the empty payload. Of equal payloads the largest page_id (all rows of it) is a response and the
    others are revisits; a null page_id is the smallest. Html isn't shuffled unless the table of payloads that repeat
    outgrows a broadcast.
    """
    common.prepare(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "html", "url")
    sample = common.first_by_hash(pages.select("page_id", F.substring("html", 1, SAMPLE_BYTES).alias("html")), SAMPLE_ROWS, "page_id", "html").filter("length(html) > 0")
    dictionary = train([r.html.encode()[:SAMPLE_BYTES] for r in sample.collect()])
    rows = pages.mapInArrow(_digests, "page_id long, html string, url string, digest string")
    own = rows.select("digest", "page_id").groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("_first"))
    own = own.filter("n > 1 and _first is not null").select("digest", "_first")
    rows = common.join_lookup(rows, own, "digest", "payloads")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    rows = rows.select("page_id", "url", "html", "digest", refers.alias("refers_to"))
    return common.written(rows.mapInArrow(_write(folder, dictionary), "name string, records long"), "archives")


def _read(folder: str):
    def run(batches):
        for batch in batches:
            for name, n in zip(*(c.to_pylist() for c in batch.columns)):
                rows, size, seen = [], 0, 0
                for x in frames(common.get(f"{folder}/{name}")):
                    rows.append(parse(x))
                    seen += 1
                    size += len(x)
                    if size > 4 << 20:
                        yield out(rows)
                        rows, size = [], 0
                if seen != n:
                    raise WarcError(f"{name} has {seen} records; {n} were written")
                if rows:
                    yield out(rows)

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    out = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
    return run


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """SCHEMA's rows of the archives (name, records) in folder, one per record; a wrong archive fails the job."""
    n = max(1, archives.count())
    return archives.select("name", "records").repartitionByRange(n, "name").mapInArrow(_read(folder), SCHEMA)


def op6_warc(spark, sf_dir):
    """Every page's record, read back from archives. Null, empty, repeated, long and missing rows: see write_archives."""
    folder = common.shared_folder(spark, "warc")
    rows = read_archives(write_archives(common.table(spark, sf_dir, "pages"), folder), folder)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: sha1() gives 40 hex digits: 160 bits, 32 groups of 5 bits.
SQL = f"""
WITH d AS (SELECT page_id, encode(coalesce(html, '')) AS p, sha1(coalesce(html, '')) AS h FROM pages),
u AS (SELECT h, max(page_id) AS first_id,
  list_aggregate(list_transform(range(32), lambda i: substr('{B32}', 1 + (CAST('0x' || substr(h || '0', 1 + (i * 5) // 4, 2) AS INTEGER) >> (3 - (i * 5) % 4)) % 32, 1)), 'string_agg', '') AS b
  FROM d GROUP BY h)
SELECT d.page_id, octet_length(d.p) AS payload_bytes, u.b AS payload_digest,
  CASE WHEN d.page_id IS NOT DISTINCT FROM u.first_id OR u.first_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN d.page_id IS DISTINCT FROM u.first_id THEN u.first_id END AS refers_to
FROM d JOIN u USING (h)
"""
