"""Media columns: baseline JPEG. Markers are parsed, scans are Huffman-decoded in numpy with one lane a restart interval
(of many images at once), and luminance thumbnails come from the DC coefficients alone.

A payload is stored losslessly in the unit that a JPEG keeps exactly, the quantised coefficient. Bytes are ranked by how
usual they are in text (ORDER, fixed), and a rank is one of the numbers 1, -1, 2, -2, ... in JPEG's order of sizes, so a
usual byte takes few bits. 192 bytes are an MCU of three blocks (4:4:4), each MCU its own restart interval, so DC
differences are the numbers themselves.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

UNIT = 192
#: An image's columns of MCUs: as many as its rows, but so that neither side exceeds 65,535 pixels.
MAX_SIDE = 8191
ZIGZAG = np.array(
    [0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28, 35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63]
)
TAG = b"MILLRACE"


class JpegError(ValueError):
    pass


# == writing


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _order() -> bytes:
    usual = b" etaonirshdlucm.,\nfpgbwyvkqxjz\xc3\xa9\xa8\xaa\xa7\xbc\xb6\xa4\xb3\xad\xa1\xb1\xa0\xba'-0123456789ETAONIRSHDLUCMFPGBWYVKQXJZ\"!?:;()<>/=&#*$%|\t_@+[]{}\r"
    return usual + bytes(i for i in range(256) if i not in usual)


#: Bytes by rank.
ORDER = _order()
#: Code lengths of the sizes 1 to 8 and of 0 (no number; the end of a block). Code words are those that the format gives.
_LENGTHS = (2, 2, 2, 3, 4, 5, 6, 7, 8)
_SYMBOLS = bytes([1, 2, 3, 4, 5, 6, 7, 8, 0])


def _table(kind: int, ident: int) -> bytes:
    return bytes([kind << 4 | ident, *(_LENGTHS.count(k) for k in range(1, 17))]) + _SYMBOLS


def _codes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By byte, the bits of its code and number and how many they are; by number + 512, its byte or -1."""
    words, code, before = [], 0, _LENGTHS[0]
    for n in _LENGTHS:
        code <<= n - before
        words.append(code)
        code, before = code + 1, n
    bits, length, back = np.zeros(256, np.int64), np.zeros(256, np.int64), np.full(1024, -1)
    for rank, b in enumerate(ORDER):
        size = (rank + 2).bit_length() - 1
        spelled = rank + 2 - (1 << size)  # as the format spells numbers of that size, the negative ones first
        bits[b], length[b] = words[size - 1] << size | spelled, _LENGTHS[size - 1] + size
        back[512 + (spelled if spelled >> (size - 1) else spelled - (1 << size) + 1)] = b
    return bits, length, back


_BITS, _LENGTH, _BYTE = _codes()
#: An MCU without numbers: three times no DC difference and the end of the block.
_BLANK = b"\xfe" * 6


def encode_all(texts: list[bytes]) -> list[bytes]:
    """The JPEG of each text and the spaces that fill it up to a positive multiple of 192 bytes."""
    fills = [-len(x) % UNIT or (0 if x else UNIT) for x in texts]
    payload = np.frombuffer(b"".join(y for x, f in zip(texts, fills) for y in (x, b" " * f)), np.uint8).reshape(-1, UNIT)
    counts = np.array([(len(x) + f) // UNIT for x, f in zip(texts, fills)], np.int64)
    size = _LENGTH[payload]
    ends = np.cumsum(size, axis=1)
    total = ends[:, -1]
    width = (total + 7) >> 3
    start = np.cumsum(width) - width
    at = (ends - size + 8 * start[:, None]).ravel()
    value = _BITS[payload].ravel() << (24 - (at & 7) - size.ravel())
    n = int(width.sum())
    raw = np.zeros(n + 3, np.int64)
    for k in range(3):  # codes share bytes, but no bits
        raw += np.bincount((at >> 3) + k, weights=value >> (16 - 8 * k) & 255, minlength=n + 3).astype(np.int64)
    raw = raw[:n].astype(np.uint8)
    raw[start + width - 1] |= ((1 << (8 * width - total)) - 1).astype(np.uint8)
    # a 0 after every FF, and a restart marker after every MCU
    row = np.repeat(np.arange(len(width)), width)
    full = raw == 0xFF
    place = np.arange(n) + np.cumsum(full) - full + 2 * row
    end = place[start + width - 1] + 1 + full[start + width - 1]
    out = np.zeros(n + int(full.sum()) + 2 * len(width), np.uint8)
    out[place] = raw
    first = np.cumsum(counts) - counts
    out[end], out[end + 1] = 0xFF, 0xD0 + (np.arange(len(width)) - np.repeat(first, counts)) % 8
    cuts = np.concatenate([[0], (end + 2)[np.cumsum(counts) - 1]]) if len(texts) else []
    return [_framed(x, int(c), out[a:b].tobytes()) for x, c, a, b in zip(texts, counts, cuts, cuts[1:])]


def _framed(text: bytes, n: int, body: bytes) -> bytes:
    """An image of n MCUs, with blank ones that make it a rectangle. body: their restart intervals, each with its marker."""
    cols = max(int(np.ceil(np.sqrt(n))), -(-n // MAX_SIDE))
    rows = -(-n // cols)
    if cols > MAX_SIDE:
        raise JpegError(f"{len(text)} bytes don't fit an image")
    head = b"".join(
        [
            b"\xff\xd8",
            _segment(0xE0, b"JFIF\0\x01\x01\0\0\x01\0\x01\0\0"),
            _segment(0xFE, TAG + struct.pack(">QQ", len(text), n * UNIT)),
            _segment(0xDB, b"\0" + b"\x01" * 64),
            _segment(0xC0, struct.pack(">BHHB", 8, rows * 8, cols * 8, 3) + bytes([1, 0x11, 0, 2, 0x11, 0, 3, 0x11, 0])),
            _segment(0xC4, _table(0, 0) + _table(1, 0)),
            _segment(0xDD, struct.pack(">H", 1)),
            _segment(0xDA, bytes([3, 1, 0, 2, 0, 3, 0, 0, 63, 0])),
        ]
    )
    body += b"".join(_BLANK + bytes([0xFF, 0xD0 + k % 8]) for k in range(n, rows * cols))
    return head + body[:-2] + b"\xff\xd9"


def encode(text: bytes) -> bytes:
    return encode_all([text])[0]


# == reading


class Image:
    """What the markers say: sides, components (h, v, quantisation table), Huffman tables and restart segments."""

    def __init__(self, data: bytes):
        if data[:2] != b"\xff\xd8":
            raise JpegError("no start of image")
        self.comment = None
        self.quant: dict[int, np.ndarray] = {}
        self.huff: dict[tuple[int, int], bytes] = {}
        self.restart, self.components, self.scan = 0, None, None
        at = 2
        while self.scan is None:
            if at + 4 > len(data) or data[at] != 0xFF:
                raise JpegError(f"no marker at byte {at}")
            marker = data[at + 1]
            if marker == 0xFF:  # fill byte
                at += 1
                continue
            size = struct.unpack_from(">H", data, at + 2)[0]
            body = data[at + 4 : at + 2 + size]
            if size < 2 or len(body) != size - 2:
                raise JpegError(f"marker {marker:02X} is cut off")
            at += 2 + size
            if marker == 0xFE:
                self.comment = body
            elif marker == 0xDB:
                while body:
                    wide, k = body[0] >> 4, body[0] & 15
                    step = 128 if wide else 64
                    self.quant[k] = np.frombuffer(body[1 : 1 + step], ">u2" if wide else np.uint8).astype(np.int64)
                    body = body[1 + step :]
            elif marker == 0xC4:
                while body:
                    n = sum(body[1:17])
                    self.huff[body[0] >> 4, body[0] & 15] = body[1 : 17 + n]
                    body = body[17 + n :]
            elif marker == 0xDD:
                self.restart = struct.unpack(">H", body)[0]
            elif marker == 0xC0:
                depth, self.height, self.width, n = struct.unpack_from(">BHHB", body)
                if depth != 8 or not self.height or not self.width or n not in (1, 3):
                    raise JpegError("a frame that isn't baseline with 1 or 3 components")
                self.components = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            elif 0xC1 <= marker <= 0xCF:
                raise JpegError(f"frame type {marker:02X} isn't baseline")
            elif marker == 0xDA:
                if self.components is None or body[0] != len(self.components):
                    raise JpegError("not one interleaved scan")
                self.scan = [(body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])]
        if len(self.components) == 1:  # a lone component isn't interleaved: its MCU is a block
            self.components = [(self.components[0][0], 1, 1, self.components[0][3])]
        self.h, self.v = max(c[1] for c in self.components), max(c[2] for c in self.components)
        self.cols, self.rows = -(-self.width // (8 * self.h)), -(-self.height // (8 * self.v))
        #: component of each block of an MCU
        self.blocks = [k for k, c in enumerate(self.components) for _ in range(c[1] * c[2])]
        self.layout = (tuple(self.blocks), tuple((self.huff[0, d], self.huff[1, a]) for d, a in self.scan))
        raw = np.frombuffer(data, np.uint8)[at:]
        ff = np.flatnonzero(raw[:-1] == 0xFF)
        after = raw[ff + 1]
        end = ff[(after != 0) & ((after < 0xD0) | (after > 0xD7)) & (after != 0xFF)]
        if not len(end) or raw[end[0] + 1] != 0xD9:
            raise JpegError("the scan doesn't end with the end of the image")
        cuts = ff[(after >= 0xD0) & (after <= 0xD7) & (ff < end[0])]
        if (raw[cuts + 1] != 0xD0 + np.arange(len(cuts)) % 8).any():
            raise JpegError("a restart marker out of turn")
        per = self.restart or self.rows * self.cols
        self.mcus = self.rows * self.cols
        if len(cuts) + 1 != -(-self.mcus // per):
            raise JpegError(f"{len(cuts) + 1} restart intervals for {self.mcus} MCUs")
        self.per = per
        starts, ends = np.concatenate([[0], cuts + 2]), np.concatenate([cuts, end[:1]])
        stuffed = ff[(after == 0) & (ff < end[0])] + 1
        if len(stuffed):  # drop stuffed zeros; positions move by the zeros before them
            starts, ends = starts - np.searchsorted(stuffed, starts), ends - np.searchsorted(stuffed, ends)
            keep = np.ones(end[0], bool)
            keep[stuffed] = False
            raw = raw[: end[0]][keep]
        self.data, self.starts, self.ends = raw[: ends[-1]], starts, ends


def lookup(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code length (0: no such code) and symbol for each next 16 bits."""
    length, symbol = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    code = k = 0
    for bits in range(1, 17):
        for _ in range(table[bits - 1]):
            a, b = code << (16 - bits), (code + 1) << (16 - bits)
            if b > 1 << 16:
                raise JpegError("a Huffman table with too many codes")
            length[a:b], symbol[a:b] = bits, table[16 + k]
            code, k = code + 1, k + 1
        code <<= 1
    return length, symbol


def decode(images: list[Image]) -> list[np.ndarray]:
    """Quantised coefficients of each image, (MCUs, blocks of an MCU, 64) in zigzag order with DC sums; the images must
    share one layout. All restart intervals are read in step, a symbol of each at a time."""
    first = images[0]
    per = max(i.per for i in images)
    counts = np.concatenate([np.minimum(i.per, i.mcus - i.per * np.arange(len(i.starts))) for i in images])
    base = np.cumsum([0] + [len(i.data) for i in images])
    # 64 bits from every byte on: a Huffman code and the bits after it are at most 16 + 11
    data = np.concatenate([*(i.data for i in images), np.full(16, 0xFF, np.uint8)])
    window = np.zeros(len(data) - 8, np.uint64)
    for k in range(8):
        window |= data[k : k + len(window)].astype(np.uint64) << np.uint64(56 - 8 * k)
    pos = 8 * np.concatenate([i.starts + b for i, b in zip(images, base)])
    stop = 8 * np.concatenate([i.ends + b for i, b in zip(images, base)])
    tables = [(lookup(d), lookup(a)) for d, a in first.layout[1]]
    lanes = np.arange(len(pos))
    out = np.zeros((len(pos), per, len(first.blocks), 64), np.int16)
    dc = np.zeros((len(pos), len(first.components)), np.int64)

    def read(at: np.ndarray, table) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and number of each lane at its place; moves on."""
        p = pos[at]
        if (p > stop[at]).any():
            raise JpegError("a restart interval is cut off")
        bits = window[p >> 3] << (p & 7).astype(np.uint64)
        code = (bits >> np.uint64(48)).astype(np.int64)
        length, symbol = table[0][code], table[1][code]
        if not length.all():
            raise JpegError("bits that are no Huffman code")
        size = symbol & 15
        value = ((bits << length.astype(np.uint64)) >> np.uint64(1) >> (63 - size).astype(np.uint64)).astype(np.int64)
        value = np.where(value < (1 << size) >> 1, value - (1 << size) + 1, value)
        pos[at] = p + length + size
        return symbol, value

    for m in range(per):
        live = lanes[counts > m]
        for b, c in enumerate(first.blocks):
            _, value = read(live, tables[c][0])
            dc[live, c] += value
            out[live, m, b, 0] = dc[live, c]
            k = np.ones(len(live), np.int64)
            at = live
            while len(at):
                symbol, value = read(at, tables[c][1])
                k += symbol >> 4
                number = (symbol & 15) > 0
                if (k[number] > 63).any():
                    raise JpegError("a block of over 64 coefficients")
                out[at[number], m, b, k[number]] = value[number]
                on = (number | (symbol == 0xF0)) & (k < 63)
                if on.all():
                    k += 1
                else:
                    at, k = at[on], k[on] + 1
    if (pos > stop).any() or (stop - pos >= 8).any():
        raise JpegError("a restart interval has another length than its MCUs")
    result, lane = [], 0
    for i in images:
        n = len(i.starts)
        result.append(out[lane : lane + n, : i.per].reshape(n * i.per, len(i.blocks), 64)[: i.mcus])
        lane += n
    return result


def thumbnail(image: Image, coefficients: np.ndarray) -> np.ndarray:
    """Luminance at an eighth of the size from DC alone: (block rows, block columns), 0 to 255."""
    _, h, v, q = image.components[0]
    dc = coefficients[:, : h * v, 0].astype(np.int64) * image.quant[q][0]
    grid = dc.reshape(image.rows, image.cols, v, h).transpose(0, 2, 1, 3).reshape(image.rows * v, image.cols * h)
    return np.clip((grid + 4) // 8 + 128, 0, 255).astype(np.uint8)[: -(-image.height // 8), : -(-image.width // 8)]


def average_hash(thumb: np.ndarray) -> int:
    """64 bits: which cells of an 8 x 8 grid of means are above the mean of all."""
    rows, cols = (np.arange(9) * n / 8 for n in thumb.shape)
    sums = np.zeros((thumb.shape[0] + 1, thumb.shape[1] + 1), np.int64)
    sums[1:, 1:] = thumb.astype(np.int64).cumsum(0).cumsum(1)
    r0, c0 = np.floor(rows[:-1]).astype(int), np.floor(cols[:-1]).astype(int)
    r1, c1 = np.maximum(np.ceil(rows[1:]).astype(int), r0 + 1), np.maximum(np.ceil(cols[1:]).astype(int), c0 + 1)
    box = sums[r1][:, c1] - sums[r0][:, c1] - sums[r1][:, c0] + sums[r0][:, c0]
    mean = box / ((r1 - r0)[:, None] * (c1 - c0)[None, :])
    return int.from_bytes(np.packbits((mean > mean.mean()).ravel()).tobytes(), "big")


def payload_of(image: Image, coefficients: np.ndarray) -> tuple[bytes, int]:
    """The payload that encode() stored, and how many of its bytes are text."""
    if not image.comment or not image.comment.startswith(TAG):
        raise JpegError("no image of a payload")
    n_bytes, size = struct.unpack_from(">QQ", image.comment, len(TAG))
    values = coefficients[: size // UNIT].reshape(-1).astype(np.int64)
    if len(values) != size or (np.abs(values) > 511).any() or ((found := _BYTE[values + 512]) < 0).any():
        raise JpegError("coefficients that are no payload")
    return found.astype(np.uint8).tobytes(), n_bytes


# == columns

SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, width long, height long"
#: Coefficients that are decoded at once.
DECODE_AT_ONCE = 1 << 20


def _encode(batches):
    for batch in common.small(batches):
        texts = common.texts_of(batch.column(1))
        for a, b in common.pieces(texts, 1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(encode_all(texts[a:b]), pa.binary())], ["doc_id", "media"])


def media_column(docs: DataFrame) -> DataFrame:
    """(doc_id, media): the JPEG of every text of docs (doc_id, text)."""
    common.prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_encode, "doc_id long, media binary")


def decode_all(media: list[bytes]) -> list[tuple[Image, np.ndarray]]:
    """Images and coefficients; images of one layout are decoded together, DECODE_AT_ONCE numbers at a time."""
    images = [Image(x) for x in media]
    out: list = [None] * len(images)
    groups: dict = {}
    for i, x in enumerate(images):
        groups.setdefault(x.layout, []).append(i)
    for own in groups.values():
        held, size = [], 0
        for i in [*own, None]:
            n = 0 if i is None else images[i].mcus * len(images[i].blocks) * 64
            if held and (i is None or size + n > DECODE_AT_ONCE):
                for j, c in zip(held, decode([images[j] for j in held])):
                    out[j] = (images[j], c)
                held, size = [], 0
            held.append(i)
            size += n
    return out


def _features(batches):
    for batch in common.small(batches):
        ids, media = batch.column(0), batch.column(1).to_pylist()
        for a, b in common.pieces(media, 4 << 20):
            rows = []
            for data, (image, c) in zip(media[a:b], decode_all(media[a:b])):
                payload, n = payload_of(image, c)
                feature = f"{image.width}x{image.height}:{average_hash(thumbnail(image, c)):016x}"
                rows.append((n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature, image.width, image.height))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), *(pa.array(x, k) for x, k in zip(zip(*rows), kinds))], [x.split()[0] for x in SCHEMA.split(", ")])


def media_features(media: DataFrame) -> DataFrame:
    """SCHEMA for every row of media (doc_id, media), all read from the stored bytes.

    A null or empty text is 192 spaces. Equal texts have equal images; repeated rows and null doc_ids keep their rows.
    Texts are stored whole up to 65,535 x 65,535 pixels; bytes that are no such JPEG fail the job. No rows: none.
    """
    common.prepare(media.sparkSession)
    return media.select("doc_id", "media").mapInArrow(_features, SCHEMA)


def op2_media(spark, sf_dir):
    """Documents as stored images, read back. Null, empty, repeated, long and missing rows: see media_features."""
    stored = common.written(media_column(common.table(spark, sf_dir, "documents")), "media")
    return media_features(stored)
