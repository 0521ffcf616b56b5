"""Lexical retrieval packing: sequences of a fixed length, each a seed document and its unused BM25 neighbours.

Documents are spread over shards of about SHARD_DOCS by hash, whose ids and postings are written as files; document
frequencies and the mean length are counted over all documents. A seed opens a sequence, all of its terms query every
shard, and the unused neighbours of the whole corpus follow in the order of their scores (after them, unused documents
in order) until the sequence is full. What a cut leaves over seeds another one.

Sequences are filled in rounds. Those open in a round query the documents left, indexed anew in groups of shards; each
seed's NEIGHBOURS best of all groups are merged by seed, and the driver hands them out in order. A seed whose list is used
up before its sequence is full stays open and queries again in the next round, so a list's length is no limit.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections import deque
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

LENGTH = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SHARD_DOCS = 5000
#: Terms of a seed that query the index: None, so all of them.
QUERY_TERMS = None
#: Documents of an index, and neighbours that a seed takes from it at a time.
GROUP_DOCS = 20_000
NEIGHBOURS = 16
#: In a round, the sequences that one part in SHARE of the tokens left would fill are open.
SHARE = 4
#: Sequences that are open in a round at most: their neighbours and terms come to the driver.
ROUND_SEEDS = 200_000
#: Seeds whose terms a task holds at once; all of a round's are in files.
SLICE = 8192
#: Documents of a block and seeds that are multiplied at a time; below ROWS rows, nothing is gained by their order.
BLOCK, SEEDS, ROWS = 1024, 512, 256
#: A block holds a term that more than one of its documents in DENSE has as a row of a matrix; it is multiplied if more
#: than WORTH of the pairs of seed and document share it. PIECE: documents of whose scores one bounds the k-th best.
DENSE, WORTH, PIECE = 32, 0.002, 16
#: Rounds of k-means among a sample that tell kinds of documents apart.
MEANS = 5
#: Only the pairs of a block that can be near are multiplied if they are less than this share of all.
FEW = 0.7
K1, B = 1.2, 0.75
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_shard(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    head = struct.pack("<QQ", len(doc_ids), len(ids))
    return b"".join([head, np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array([x is None for x in doc_ids], np.uint8).tobytes(), np.asarray(lengths, "<i8").tobytes(), ids.tobytes()])


def read_shard(data: bytes, dtype) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    n, total = struct.unpack_from("<QQ", data)
    at = 16 + 8 * n
    none = np.frombuffer(data, np.uint8, n, at)
    doc_ids = [None if z else int(x) for x, z in zip(np.frombuffer(data, "<i8", n, 16), none)]
    lengths = np.frombuffer(data, "<i8", n, at + n)
    ids = np.frombuffer(data, dtype, total, at + 9 * n)
    if lengths.sum() != total:
        raise ValueError("a shard file whose parts don't add up")
    return doc_ids, lengths, ids


def _tokenise(folder: str, path: str, end_id: int):
    def run(batches):
        from pyspark import TaskContext

        shard, encoder = TaskContext.get().partitionId(), tokens.encoder(path)
        end = np.array([end_id], encoder.dtype).tobytes()
        docs = []
        for batch in common.small(batches):
            docs += ((x is not None, x or 0, encoder.encode(t or "") + end) for x, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        if not docs:
            return
        docs.sort()  # rows arrive in no fixed order
        lengths = np.array([len(d[2]) for d in docs], np.int64) // encoder.dtype.itemsize
        ids = np.frombuffer(b"".join(d[2] for d in docs), encoder.dtype)
        common.put(f"{folder}/shard-{shard:06d}.ids", pack_shard([x if known else None for known, x, _ in docs], lengths, ids))
        doc, token, tf = postings(lengths, ids)
        order = np.argsort(doc, kind="stable")
        common.put(f"{folder}/shard-{shard:06d}.sizes", np.stack([lengths, np.bincount(doc, minlength=len(docs))]).astype("<i8").tobytes())
        common.put(f"{folder}/shard-{shard:06d}.terms", token[order].astype(encoder.dtype).tobytes())
        common.put(f"{folder}/shard-{shard:06d}.tf", zlib.compress(tf[order].astype("<u4").tobytes(), 1))
        used, df = np.unique(token, return_counts=True)
        names = ["shard", "token", "n"]
        key = np.concatenate([[-1, -2], used.astype(np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), shard, np.int64)), pa.array(key), pa.array(np.concatenate([[len(docs), len(ids)], df]))], names)

    return run


def postings(lengths: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, token, count) of each pair, by token, then by document."""
    n = len(lengths)
    key = ids.astype(np.int64) * n + np.repeat(np.arange(n), lengths)
    key, count = np.unique(key, return_counts=True)
    return key % n, key // n, count


class Index:
    """An inverted index with BM25 impacts; idf and mean length are those of the whole corpus. pairs: the postings, if known."""

    def __init__(self, lengths: np.ndarray, ids: np.ndarray | None, idf: np.ndarray, mean_length: float, pairs: tuple | None = None):
        doc, token, tf = pairs or postings(lengths, ids)
        norm = K1 * (1 - B + B * lengths / mean_length)
        self.n, self.doc, self.idf = len(lengths), doc, idf
        self.impact = np.empty(len(doc), np.float32)
        for a in range(0, len(doc), 1 << 19):  # so that no more than these are held in double precision
            b = slice(a, a + (1 << 19))
            self.impact[b] = idf[token[b]] * tf[b] * (K1 + 1) / (tf[b] + norm[doc[b]])
        self.start = np.concatenate([[0], np.cumsum(np.bincount(token, minlength=len(idf)))])

    @cached_property
    def queries(self) -> tuple[np.ndarray, np.ndarray]:
        """The query of each document, all of its terms that another document here has, and where those of each begin."""
        size = np.diff(self.start)
        shared = np.flatnonzero(np.repeat(size > 1, size))
        order = shared[np.argsort(self.doc[shared], kind="stable")]
        return np.repeat(np.arange(len(size)), size)[order], np.searchsorted(self.doc[order], np.arange(self.n + 1))

    def scores(self, seed: int) -> np.ndarray:
        out = np.zeros(self.n, np.float32)
        token, start = self.queries
        for t in token[start[seed] : start[seed + 1]].tolist():
            i, j = self.start[t], self.start[t + 1]
            out[self.doc[i:j]] += self.impact[i:j]
        return out

    def nearest(self, terms: np.ndarray, ends: np.ndarray, k: int):
        """(query, documents, scores) of each query's k best documents above 0, the best first; query q has the terms up
        to ends[q]."""
        own, starts = terms.astype(np.int64), np.concatenate([[0], ends[:-1]])
        sizes = ends - starts
        of = np.repeat(np.arange(len(ends)), sizes)
        column = self.columns[own]
        queries = np.zeros((len(ends), self.columns.max(initial=-1) + 1), bool)
        queries[of[column >= 0], column[column >= 0]] = True
        kind, weight = kinds(queries), np.bincount(of, self.idf[own], len(ends))
        order = np.lexsort((weight, kind))  # seeds that share terms and reach about the same scores lie together
        for a, b in zip(*(x.tolist() for x in (np.searchsorted(kind[order], np.arange(kind.max(initial=0) + 1), side) for side in ("left", "right")))):
            for pick in np.array_split(order[a:b], -(-(b - a) // SEEDS) or 1):
                at = np.arange(sizes[pick].sum()) + np.repeat(starts[pick] - np.cumsum(sizes[pick]) + sizes[pick], sizes[pick])
                query, docs, scores = self._best(own[at], np.repeat(np.arange(len(pick)), sizes[pick]), len(pick), k)
                cut = np.searchsorted(query, np.arange(len(pick) + 1)).tolist()
                for q, i, j in zip(pick.tolist(), cut, cut[1:]):
                    j = min(j, i + k)
                    yield q, docs[i:j], scores[i:j]

    @cached_property
    def columns(self) -> np.ndarray:
        """A number for each term that tells kinds of documents apart, -1 for the others."""
        frequent = np.diff(self.start) * 16 > self.n
        return np.where(frequent, np.cumsum(frequent) - 1, -1)

    @cached_property
    def blocks(self) -> list[Block]:
        """All documents, those of a kind and with high sums of impacts together."""
        size = np.diff(self.start)
        token = np.repeat(np.arange(len(size), dtype=np.int32), size)
        column = self.columns[token]
        has = np.zeros((self.n, column.max(initial=-1) + 1), bool)
        has[self.doc[column >= 0], column[column >= 0]] = True
        del column
        order = np.argsort(-np.bincount(self.doc, self.impact, self.n), kind="stable")
        order = order[alike(has[order])]
        place = np.empty(self.n, np.int32)
        place[order] = np.arange(self.n)
        where = place[self.doc]
        by = np.argsort((where // BLOCK).astype(np.uint16) if self.n < BLOCK << 16 else where // BLOCK, kind="stable")
        cut = np.searchsorted(where[by] // BLOCK, np.arange(-(-self.n // BLOCK) + 1)).tolist()
        return [Block(order[k * BLOCK : (k + 1) * BLOCK], token[by[i:j]], where[by[i:j]] - k * BLOCK, self.impact[by[i:j]], len(size)) for k, (i, j) in enumerate(zip(cut, cut[1:]))]

    def _best(self, token: np.ndarray, query: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, document, score), by query and the best first, of n queries' k best documents above 0 and perhaps some
        more; each query has some tokens. The terms that a query has add at most what the document has of those in
        `wide`, whether the query has them or not, and the block's highest impact of each of its others. Queries and
        documents of a block are left out if that is below the query's k best so far."""
        order = np.argsort(token.astype(np.uint16) if len(self.idf) <= 1 << 16 else token, kind="stable")
        token, query = token[order], query[order]
        used, first, count = np.unique(token, return_index=True, return_counts=True)
        row, starts, asks = np.zeros((3, len(self.idf)), np.int32)
        row[:] = len(used)
        row[used], starts[used], asks[used] = np.arange(len(used)), first, count
        has = np.zeros((len(used) + 1, n), np.float32)
        has[row[token], query] = 1
        share = (count / n).astype(np.float32)
        most, mean = (np.stack([x[used] for x in xs]) for xs in zip(*((x.most, x.mean) for x in self.blocks)))
        wide = mean < share * most  # so the bound is the closest for the mean pair
        others = np.where(wide, 0, most) @ has[:-1]
        asked = np.zeros(len(self.idf), bool)
        best, least, found = np.zeros((n, k), np.float32), np.zeros(n, np.float32), []
        for i in np.argsort(-(mean @ share), kind="stable").tolist():  # by the mean score of its pairs
            block = self.blocks[i]
            asked[used] = wide[i]
            reach = block.reach(asked)[: len(block.docs)]
            needed = least * np.float32(0.9999) - others[i] * np.float32(1.0001) - np.float32(1e-3)
            rows, docs, steps = stairs(needed, reach)
            if docs is None and len(rows):
                size = block.size[used]
                dense = (size * count > WORTH * n * len(block.docs)) & (block.column[used] >= 0)
                queries = has[:-1][dense]
                scores = (queries if len(rows) == n else queries.take(rows, 1)).T @ block.matrix[block.column[used[dense]]]
                rare = np.flatnonzero((size > 0) & ~dense)
                block.add(scores, used[rare], first[rare], count[rare], query, rows, n)
                found += better(scores, rows, block.docs, best, least)
            elif len(rows):
                term, matrix, (token, doc, impact) = block.part(docs, asks, n)
                queries = has[row[term]].take(rows, 1)
                own = asks[token].astype(np.int64)
                of, doc, impact = place_of(rows, n)[query[spans(starts[token], own)]], np.repeat(doc, own), np.repeat(impact, own)
                for x, y, width in steps:
                    scores = queries[:, x:y].T @ matrix[:, :width]
                    kept = np.flatnonzero((of >= x) & (of < y) & (doc < width))
                    np.add.at(scores.reshape(-1), (of[kept] - x) * width + doc[kept], impact[kept])
                    found += better(scores, rows[x:y], block.docs[docs], best, least)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
        of, docs, scores = map(np.concatenate, zip(*found))
        keep = scores >= least[of]
        of, docs, scores = of[keep], docs[keep], scores[keep]
        order = np.lexsort((docs, -scores, of))
        return of[order], docs[order], scores[order]


class Block:
    """Some documents of an index: the impacts of frequent terms as a matrix, those of all terms as postings by term."""

    def __init__(self, docs: np.ndarray, token: np.ndarray, doc: np.ndarray, impact: np.ndarray, vocabulary: int):
        self.docs, self.doc, self.impact = docs, doc.astype(np.int32), impact
        self.size = np.bincount(token, minlength=vocabulary).astype(np.int32)
        self.start = (np.cumsum(self.size) - self.size).astype(np.int32)
        self.mean = (np.bincount(token, impact, vocabulary) / max(1, len(docs))).astype(np.float32)
        self.most = np.zeros(vocabulary, np.float32)
        own = np.flatnonzero(self.size)
        self.most[own] = np.maximum.reduceat(impact, self.start[own]) if len(own) else 0
        self.terms = np.flatnonzero(self.size * DENSE > len(docs))
        self.column = np.full(vocabulary, -1, np.int32)
        self.column[self.terms] = np.arange(len(self.terms))
        column = self.column[token]
        dense = column >= 0
        self.matrix = np.zeros((len(self.terms), -(-len(docs) // 64) * 64), np.float32)
        self.matrix[column[dense], doc[dense]] = impact[dense]
        self.by_doc = np.ascontiguousarray(self.matrix[:, : len(docs)].T)
        self.rare = token[~dense], doc[~dense], impact[~dense]

    def reach(self, used: np.ndarray) -> np.ndarray:
        """The sum of impacts of the terms used, by document."""
        token, doc, impact = self.rare
        own = used[token]
        return used[self.terms].astype(np.float32) @ self.matrix + np.bincount(doc[own], impact[own], self.matrix.shape[1]).astype(np.float32)

    def part(self, docs: np.ndarray, asks: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Terms and their matrix, with a multiple of 64 columns, for some documents, and the postings of other terms.
        A term is asked by `asks` of n queries; of those of none, no postings are given."""
        column = place_of(docs, len(self.docs))
        token, doc, impact = self.rare
        kept = np.flatnonzero((column[doc] >= 0) & (asks[token] > 0))
        token, doc, impact = token[kept], column[doc[kept]], impact[kept]
        begin = np.flatnonzero(np.diff(token, prepend=-1))
        term, size = token[begin], np.diff(begin, append=len(token))
        worth = size * asks[term] > WORTH * n * len(docs)
        own = np.repeat(np.where(worth, np.cumsum(worth) - 1, -1), size)
        term = np.concatenate([self.terms, term[worth]])
        out = np.zeros((-(-len(docs) // 64) * 64, len(term)), np.float32)
        out[: len(docs), : len(self.terms)] = self.by_doc[docs]
        out[doc[own >= 0], len(self.terms) + own[own >= 0]] = impact[own >= 0]
        return term, out.T, (token[own < 0], doc[own < 0], impact[own < 0])

    def add(self, scores: np.ndarray, terms: np.ndarray, first: np.ndarray, count: np.ndarray, query: np.ndarray, rows: np.ndarray, n: int) -> None:
        """Adds the impacts of terms to the rows of scores; the queries of a term are `count` from `first` on."""
        of = place_of(rows, n)[query[spans(first, count)]]
        term = np.repeat(terms, count)[of >= 0]
        of, size = of[of >= 0], self.size[term].astype(np.int64)
        posting = spans(self.start[term], size)
        np.add.at(scores.reshape(-1), np.repeat(of * scores.shape[1], size) + self.doc[posting], self.impact[posting])


def place_of(rows: np.ndarray, n: int) -> np.ndarray:
    """For each of n numbers its place in rows, or -1."""
    out = np.full(n, -1)
    out[rows] = np.arange(len(rows))
    return out


def spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The `count` numbers from each of first on, in a row."""
    return np.arange(count.sum()) + np.repeat(first - np.cumsum(count) + count, count)


def better(scores: np.ndarray, rows: np.ndarray, docs: np.ndarray, best: np.ndarray, least: np.ndarray) -> list[tuple]:
    """(query, document, score) of those scores of rows by docs that may be among the best, which they raise."""
    pieces = scores.reshape(len(rows), PIECE, -1)
    top = pieces.max(1)  # each is another document's
    own = np.flatnonzero(top.max(1) >= least[rows])
    if not len(own):
        return []
    of, top = rows[own], top[own]
    best[of] = np.partition(np.concatenate([best[of], top], 1), -best.shape[1], 1)[:, -best.shape[1] :]
    least[of] = best[of].min(1)
    r, p = np.nonzero((top >= least[of][:, None]) & (top > 0))
    own = pieces[own[r], :, p]
    x, y = np.nonzero((own >= least[of[r]][:, None]) & (own > 0))
    return [(of[r[x]], docs[y * top.shape[1] + p[x]], own[x, y])]


def stairs(needed: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray | None, list[tuple[int, int, int]]]:
    """Queries and documents of which (from query, to query, up to document) together hold each pair whose document
    reaches what its query needs; documents None: all, for these queries."""
    order = np.argsort(-reach, kind="stable")
    many = np.searchsorted(-reach[order], -needed, "right")
    rows = np.flatnonzero(many)
    if many.sum() > FEW * len(rows) * len(reach):
        return rows, None, []
    rows = rows[np.argsort(-many[rows], kind="stable")]
    fewer, at, out = -many[rows], 0, []
    while at < len(rows):
        width = -int(fewer[at])
        to = len(rows) if width <= 64 else int(np.searchsorted(fewer, -width // 2, "right"))
        out.append((at, to, -(-width // 64) * 64))
        at = to
    return rows, order[: out[0][2]] if out else None, out


def alike(queries: np.ndarray) -> np.ndarray:
    """The rows in an order that has those that share columns side by side: by the nearest of some rows that differ."""
    if len(queries) <= ROWS:
        return np.arange(len(queries))
    return np.argsort(kinds(queries), kind="stable")


def kinds(queries: np.ndarray, n: int = 8) -> np.ndarray:
    """For each row the number of the nearest of some n rows that differ."""
    if not len(queries) or not queries.shape[1]:
        return np.zeros(len(queries), np.int64)
    unit = lambda rows: rows / np.sqrt((rows * rows).sum(1, keepdims=True)).clip(1e-9)
    some = unit(queries[:: max(1, len(queries) // 1000)].astype(np.float32))
    chosen, near = [some[0]], some @ some[0]
    while len(chosen) < n:
        chosen.append(some[int(near.argmin())])
        near = np.maximum(near, some @ chosen[-1])
    other = np.array(chosen).T
    for _ in range(MEANS):  # from rows on the rim to the middle of those nearest
        of = (some @ other).argmax(1)
        other = unit(np.array([some[of == i].mean(0) if (of == i).any() else other[:, i] for i in range(n)])).T
    return np.concatenate([(queries[i : i + 4096].astype(np.float32) @ other).argmax(1) for i in range(0, len(queries), 4096)])


def pack(lengths: np.ndarray, scores_of, length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """One sequence after another, for a corpus of one index: (document, start, length, sequence, offset) of each piece.
    scores_of(seed): a fresh array, above 0 for neighbours."""
    n, used, out = len(lengths), np.zeros(len(lengths), bool), []
    sequence, offset, following, seed = 0, 0, 0, None
    scores = None

    def put(doc: int) -> None:
        nonlocal sequence, offset, seed, scores
        start, left = 0, int(lengths[doc])
        used[doc] = True
        while left:
            if offset == 0:
                seed, scores = doc, None
            take = min(left, length - offset)
            out.append((doc, start, take, sequence, offset))
            start, left, offset = start + take, left - take, offset + take
            if offset == length:
                sequence, offset = sequence + 1, 0

    while True:
        while following < n and used[following]:
            following += 1
        if following == n:
            return out
        if offset == 0:
            put(following)
            continue
        if scores is None:
            scores = scores_of(seed)
            scores[used] = 0
        best = int(scores.argmax())
        if scores[best] > 0:
            own = scores
            own[best] = 0
            put(best)
        else:
            put(following)
            if scores is not None:
                scores[used] = 0


def _group_index(folder: str, dtype, files: list[int], left: list[np.ndarray], idf: np.ndarray, mean_length: float) -> Index:
    """The index of the documents left in some shards, numbered in a row."""
    lengths, token, tf, doc, n = [], [], [], [], 0
    for k, here in zip(files, left):
        name = f"{folder}/shard-{k:06d}"
        size = np.frombuffer(common.get(f"{name}.sizes"), "<i8").reshape(2, -1)
        kept = np.repeat(here, size[1])
        lengths.append(size[0][here])
        token.append(np.frombuffer(common.get(f"{name}.terms"), dtype)[kept])
        tf.append(np.frombuffer(zlib.decompress(common.get(f"{name}.tf")), "<u4")[kept])
        doc.append(np.repeat(np.arange(n, n + len(lengths[-1]), dtype=np.int32), size[1][here]))
        n += len(lengths[-1])
    token, tf, doc = np.concatenate(token), np.concatenate(tf), np.concatenate(doc)
    order = np.argsort(token, kind="stable")
    return Index(np.concatenate(lengths), None, idf, mean_length, (doc[order], token[order], tf[order]))


def _nearest(folder: str, asked: str, dtype, shared, made: list[int], idf: np.ndarray, mean_length: float):
    """Rows of a group of shards to its best documents for each seed: the seed's number, and arrays of documents by
    their numbers in the corpus and of scores. asked: the folder of the seeds' terms."""

    def run(batches):
        tokens.forget()  # what encoding remembers would stand beside the index
        left, first, seeds = shared.value
        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns)):
                here = np.flatnonzero(left[first[a] : first[b]])
                if not len(here):
                    continue
                index = _group_index(folder, dtype, made[a:b], [left[first[k] : first[k + 1]] for k in range(a, b)], idf, mean_length)
                for j in range(0, seeds, SLICE):
                    terms, ends = _asked(asked, dtype, j, min(SLICE, seeds - j))
                    best = [(j + q, (here[d] + first[a]).astype("<i8").tobytes(), x.tobytes()) for q, d, x in index.nearest(terms, ends, NEIGHBOURS) if len(d)]
                    if best:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*best), (pa.int64(), pa.binary(), pa.binary()))], ["seed", "docs", "scores"])

    return run


def _ask(asked: str, terms: np.ndarray, ends: np.ndarray) -> None:
    """Writes the terms of a round's seeds, SLICE of them in a file."""
    for j in range(0, len(ends), SLICE):
        before, own = int(ends[j - 1]) if j else 0, ends[j : j + SLICE]
        common.put(f"{asked}/{j:09d}", (own - before).astype("<i8").tobytes() + terms[before : own[-1]].tobytes())


def _asked(asked: str, dtype, j: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The terms of n seeds from j on, and where those of each end."""
    data = common.get(f"{asked}/{j:09d}")
    return np.frombuffer(data, dtype, offset=8 * n), np.frombuffer(data, "<i8", n)


def _merge(batches):
    """Each seed's best documents of those that its groups gave. Rows come sorted by seed."""
    kinds, names = (pa.int64(), pa.binary(), pa.binary()), ["seed", "docs", "scores"]
    at, held, out = None, [], []

    def best():
        docs = np.concatenate([np.frombuffer(d, "<i8") for d, _ in held])
        scores = np.concatenate([np.frombuffer(x, np.float32) for _, x in held])
        order = np.lexsort((docs, -scores))[:NEIGHBOURS]
        return at, docs[order].tobytes(), scores[order].tobytes()

    for batch in batches:
        for seed, docs, scores in zip(*(c.to_pylist() for c in batch.columns)):
            if seed != at:
                if held:
                    out.append(best())
                at, held = seed, []
            held.append((docs, scores))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
            out = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*[best()]), kinds)], names)


def _terms_of(folder: str, dtype, made: list[int], first: np.ndarray, ranges: list[np.ndarray], docs: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The terms of docs in a row, and where those of each end."""
    out: list[bytes] = [b""] * len(docs)
    shard = np.searchsorted(first, docs, "right") - 1
    for s in np.unique(shard).tolist():
        files, path = common.pafs.FileSystem.from_uri(f"{folder}/shard-{made[s]:06d}.terms")
        with files.open_input_file(path) as data:
            for k in np.flatnonzero(shard == s).tolist():
                i, j = ranges[s][docs[k] - first[s] : docs[k] - first[s] + 2].tolist()
                out[k] = data.read_at((j - i) * dtype.itemsize, i * dtype.itemsize)
    return np.frombuffer(b"".join(out), dtype), np.cumsum([len(x) // dtype.itemsize for x in out])


def _round_file(folder: str, k: int) -> str:
    return f"{folder}/round-{k:06d}.pieces"


def pack_corpus(spark, folder: str, dtype, made: list[int], idf: np.ndarray, mean_length: float, length: int, group: int) -> list[np.ndarray]:
    """Writes the pieces of each round, rows of (document in its shard, start, length, sequence, offset) by shard, and
    returns where the rows of each shard begin and end in each round's file. The driver holds some numbers for each
    document, and the pieces of a round."""
    sizes = [np.frombuffer(common.get(f"{folder}/shard-{s:06d}.sizes"), "<i8").reshape(2, -1) for s in made]
    first = np.concatenate([[0], np.cumsum([x.shape[1] for x in sizes])])
    ranges = [np.concatenate([[0], np.cumsum(x[1])]) for x in sizes]
    total = np.concatenate([x[0] for x in sizes])
    del sizes
    left = total.copy()
    places: list[np.ndarray] = []
    groups = [(a, min(a + group, len(made))) for a in range(0, len(made), group)]
    tasks = spark.createDataFrame(groups, "a long, b long").repartitionByRange(len(groups), "a")
    pieces = array("q")  # five numbers each
    filled = array("q")  # tokens of each sequence
    most = ROUND_SEEDS
    open_: list[tuple[int, int]] = []  # sequence, seed
    cut: deque[int] = deque()
    following, rest = 0, int(total.sum())

    def put(doc: int, sequence: int) -> None:
        nonlocal rest
        take = min(int(left[doc]), length - filled[sequence])
        pieces.extend((doc, int(total[doc] - left[doc]), take, sequence, filled[sequence]))
        left[doc] -= take
        rest -= take
        filled[sequence] += take
        if left[doc]:
            cut.append(doc)

    def flush() -> None:
        nonlocal pieces
        rows = np.frombuffer(pieces, np.int64).reshape(-1, 5)
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        ends = np.searchsorted(rows[:, 0], first)
        rows[:, 0] -= np.repeat(first[:-1], np.diff(ends))
        common.put(_round_file(folder, len(places)), rows.astype("<i8").tobytes())
        places.append(ends)
        pieces = array("q")

    def unused() -> int:
        nonlocal following
        while cut:
            if left[doc := cut.popleft()]:
                return doc
        while not left[following]:
            following += 1
        return following

    while rest:
        while rest and len(open_) < min(most, max(1, rest // (length * SHARE))):
            filled.append(0)
            put(doc := unused(), len(filled) - 1)
            if filled[-1] < length:
                open_.append((len(filled) - 1, doc))
        if not open_ or not rest:
            continue
        terms, ends = _terms_of(folder, dtype, made, first, ranges, [d for _, d in open_])
        asked = common.shared_folder(spark, "seeds")
        _ask(asked, terms, ends)
        del terms, ends
        shared = spark.sparkContext.broadcast((left > 0, first, len(open_)))
        none = np.zeros(0, np.int64)
        found = [none] * len(open_)
        schema = "seed long, docs binary, scores binary"
        near = tasks.mapInArrow(_nearest(folder, asked, dtype, shared, made, idf, mean_length), schema)
        if len(groups) > 1:
            near = near.repartition("seed").sortWithinPartitions("seed").mapInArrow(_merge, schema)
        for r in near.select("seed", "docs").toArrow().to_batches():
            for q, d in zip(*(c.to_pylist() for c in r.columns)):
                found[q] = np.frombuffer(d, "<i8")
        shared.destroy()
        common.drop_now(asked)
        still = []
        for (sequence, seed), own in zip(open_, found):
            best = own.tolist()
            for doc in best:
                if left[doc]:
                    put(doc, sequence)
                    if filled[sequence] == length:
                        break
            while len(best) < NEIGHBOURS and filled[sequence] < length and rest:  # no neighbour is left
                put(unused(), sequence)
            if filled[sequence] < length:
                still.append((sequence, seed))
        open_ = still
        flush()
    if len(pieces):
        flush()
    return places


def _pieces(folder: str, dtype, made: list[int], shared):
    def run(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                own = made.index(shard)
                files, path = common.pafs.FileSystem.from_uri(folder)
                parts = []
                for k, ends in enumerate(shared.value):
                    a, b = int(ends[own]), int(ends[own + 1])
                    if a < b:
                        with files.open_input_file(_round_file(path, k)) as data:
                            parts.append(data.read_at((b - a) * 40, a * 40))
                doc_ids, lengths, ids = read_shard(common.get(f"{folder}/shard-{shard:06d}.ids"), dtype)
                first = np.concatenate([[0], np.cumsum(lengths)])
                doc, start, size, sequence, offset = np.frombuffer(b"".join(parts), "<i8").reshape(-1, 5).T
                crc = [zlib.crc32(ids[a : a + k].astype("<u4")) for a, k in zip((first[doc] + start).tolist(), size.tolist())]
                columns = [pa.array([doc_ids[d] for d in doc.tolist()], pa.int64()), pa.array(start), pa.array(size), pa.array(crc, pa.int64()), pa.array(lengths[doc]), pa.array(sequence), pa.array(offset)]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in SCHEMA.split(", ")])

    return run


def _dealt(docs: DataFrame, shards: int) -> DataFrame:
    """docs over shards by hash; rows that repeat one are dealt out too, by their place in what was read."""
    return docs.repartition(shards, F.xxhash64("doc_id", "text", F.pmod(F.monotonically_increasing_id(), F.lit(997))))


def shard_order(docs: DataFrame, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(shard, doc_id): the shard that each document goes to."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _dealt(docs, max(1, -(-docs.count() // shard_docs))).select(F.spark_partition_id().cast("long").alias("shard"), "doc_id")


def retrieval_packing(docs: DataFrame, path: str, end_id: int = END_ID, length: int = LENGTH, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """SCHEMA's row for each piece of docs (doc_id, text); only the last sequence is not full.

    A null or empty text is just the end id. Repeated rows and equal doc_ids (null too) are documents of their own, each
    with all of its pieces. A text longer than a sequence runs on through the next ones. No rows: none.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    folder = common.shared_folder(spark, "shards")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shards = max(1, -(-docs.count() // shard_docs))
    rows = _dealt(docs, shards).mapInArrow(_tokenise(folder, path, end_id), "shard long, token long, n long")
    rows = common.written(rows, "frequencies")
    encoder = tokens.encoder(path)
    df = np.zeros(max(encoder.library.get_vocab_size(), end_id + 1), np.float64)
    total = {}
    for r in rows.groupBy("token").agg(F.sum("n").alias("n")).collect():  # of the vocabulary's size
        if r.token < 0:
            total[r.token] = r.n
        else:
            df[r.token] = r.n
    n = total.get(-1, 0)
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    made = sorted(r.shard for r in rows.filter("token = -1").select("shard").collect())
    places = pack_corpus(spark, folder, encoder.dtype, made, idf, total[-2] / n, length, max(1, GROUP_DOCS // shard_docs)) if made else []
    shared = spark.sparkContext.broadcast(places)
    return rows.filter("token = -1").select("shard").repartitionByRange(shards, "shard").mapInArrow(_pieces(folder, encoder.dtype, made, shared), SCHEMA)


def op10_packing(spark, sf_dir):
    """Every document's pieces in their sequences. Null, empty, repeated, long and missing rows: see retrieval_packing."""
    return retrieval_packing(common.table(spark, sf_dir, "documents"), tokens.public(TOKENIZER))
