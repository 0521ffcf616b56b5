"""The training-data operators against brute force, on tables with nulls, empty and long texts, ties, repeated rows,
clashing columns, and no rows at all."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from millrace.llm import common, graph, line_dedup, media, mixing, packing, quality_model, quality_rules, queries, simhash, suffix_dedup, token_codes, tokens, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LINE = "A line that is long enough to be found in many documents, é."
CLASH = "score double, fp string, kept string, n_lines int, low int, rate int, page_title string, n int, digest string, quality string"


def texts():
    rng = random.Random(5)
    words = ["ab", "cde", "fghi", "zu", "Über", "naïve", "x1", "end.", "日本", "don't"]
    out = [" ".join(rng.choice(words) for _ in range(rng.randrange(3, 120))) for _ in range(40)]
    out = [t + "\n" + LINE if i % 4 == 0 else t for i, t in enumerate(out)]
    out += [None, "", " ", "\n\n", "word", "two words", "a" * 700, "x y " * 300, " \t" + LINE.upper().replace("É", "é") + " \n\n" + LINE, "naïve  café\tx y\r\n" * 5, "#$% | <b>" * 20]
    out += [" ".join(rng.choice(words) for _ in range(9000))]
    base = " ".join(rng.choice(words) + str(i) for i in range(150))
    return out + [base, base, base.replace("x1", "x2", 1), "prefix " * 4 + base[100:700], base[:250] + " and then something else"]


@pytest.fixture(scope="session")
def rows():
    t = texts()
    out = [(i, x) for i, x in enumerate(t)]
    return out + [(3, t[3]), (3, t[3]), (5, "another text under a used id"), (None, t[4]), (None, None)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return _docs(spark, rows)


def _docs(spark, rows):
    full = [(i, x, "en" if (i or 0) % 2 else None, None, None if x is None else len(x), 1.0, "f", "k", 7, 1, 2, "p", 3, "d", "q") for i, x in rows]
    return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}").repartition(3)


@pytest.fixture(scope="session")
def labels(spark):
    out = [(i, int(i % 3 > 0), int(i % 7 == 1)) for i in range(40)] + [(2, 1, 0), (None, 1, 0), (4, None, 1), (6, 1, None), (1000, 1, 0)]
    return spark.createDataFrame(out, "doc_id long, quality int, toxic int")


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def no_docs(spark):
    return _docs(spark, [(1, "x")]).limit(0)


# 1


def test_token_codes(spark, docs, rows):
    path = tokens.public(token_codes.TOKENIZER)
    got = [tuple(r) for r in token_codes.token_codes(docs, common.shared_folder(spark, "t"), path).collect()]
    library = tokens.Encoder(path)._library
    want = Counter()
    for i, x in rows:
        ids = np.append(np.frombuffer(library(x or ""), "<u2"), 2).astype("<u4")
        want[i, len(ids), zlib.crc32(ids)] += 1
    assert Counter((r[0], r[2], r[3]) for r in got) == want
    order = sorted(got, key=lambda r: r[1])
    assert [r[1] for r in order] == np.concatenate([[0], np.cumsum([r[2] for r in order])[:-1]]).tolist()
    ids = [-1 if r[0] is None else r[0] for r in order]
    assert ids == sorted(ids)
    assert token_codes.token_codes(no_docs(spark), common.shared_folder(spark, "t"), path).count() == 0


@pytest.mark.parametrize("top", [1, 255, 256, 60_000, 1 << 20, (1 << 32) - 1])
def test_code_files(top, tmp_path):
    rng = np.random.default_rng(top)
    x = rng.integers(0, top, 3000, dtype=np.uint64, endpoint=True).astype(np.uint32)
    c = token_codes.Codes(token_codes.pack([4, None, 9], [1000, 0, 2000], x))
    assert (c.all() == x).all() and c.doc_ids == [4, None, 9] and c.starts.tolist() == [0, 1000, 1000, 3000]
    assert all(c[i] == x[i] for i in range(0, 3000, 7))
    (tmp_path / "x.codes").write_bytes(token_codes.pack([4, None, 9], [1000, 0, 2000], x))
    f = token_codes.CodeFile(f"file://{tmp_path}/x.codes")
    assert len(f) == 3000 and all(f[i] == x[i] for i in [*range(0, 3000, 7), 2999])
    with pytest.raises(IndexError):
        f[3000]
    f.close()
    with pytest.raises(IndexError):
        c[3000]
    with pytest.raises(ValueError):
        token_codes.Codes(b"nothing of it" * 9)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder(name):
    e = tokens.Encoder(tokens.public(name))
    rng = random.Random(name)
    odd = ["  a", "a  b", "\n", "<|endoftext|> x", "é ̀a", "Σας ΣΑΣ", "x\x1cy z", "a\x00b", "foo'S bar'LL", "\r\nx\r\n", "İstanbul ß", "a b c"]
    for x in odd + ["".join(rng.choice("abZÉßé '.,!\n\t  12-_«»日|#'sStT") for _ in range(rng.randrange(1, 25))) for _ in range(1500)] + [t for t in texts() if t]:
        assert e.encode(x) == e._library(x), repr(x[:60])


# 2


def test_media(spark, docs, rows):
    got = media.media_features(media.media_column(docs)).collect()
    want = Counter()
    for i, x in rows:
        b = (x or "").encode()
        p = b + b" " * (-len(b) % 192 or (0 if b else 192))
        want[i, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == want
    by_text = {}
    for r in got:
        by_text.setdefault(r.payload_sha256, set()).add((r.media_sha256, r.media_bytes, r.feature))
    assert sum(map(len, by_text.values())) <= len(by_text) + 1  # null, empty and blank share a payload but not a length
    assert media.media_features(media.media_column(no_docs(spark))).count() == 0


def test_jpeg_bytes():
    for x in (bytes(range(256)) * 3, b"\xff" * 500, b"", b"q" * 192):
        ((image, c),) = media.decode_all([media.encode(x)])
        payload, n = media.payload_of(image, c)
        assert payload[:n] == x and image.width % 8 == image.height % 8 == 0
    good = media.encode(b"some text")
    for bad in (b"", good[:100], good[:-2], b"\xff\xd8" + good[4:], good.replace(b"\xff\xc0", b"\xff\xc2", 1)):
        with pytest.raises(media.JpegError):
            media.decode_all([bad])


def jpeg(blocks, cols, rows, sampling, restart):
    """A JPEG of given coefficients by a plain encoder: fixed codes of 8 bits for 16 * run + size."""
    codes = {s: i for i, s in enumerate(range(0, 251))}
    bits, out, previous, n = "", [], [0, 0, 0], 0
    table = bytes([0] * 7 + [251] + [0] * 8) + bytes(range(251))

    def number(v):
        size = abs(int(v)).bit_length()
        return size, format(v if v > 0 else v + (1 << size) - 1, f"0{size}b") if size else ""

    def flush():
        nonlocal bits
        bits += "1" * (-len(bits) % 8)
        out.append(int(bits or "0", 2).to_bytes(len(bits) // 8, "big").replace(b"\xff", b"\xff\0"))
        bits = ""

    for m, mcu in enumerate(blocks):
        if restart and m and m % restart == 0:
            flush()
            out.append(bytes([0xFF, 0xD0 + n % 8]))
            n, previous = n + 1, [0, 0, 0]
        for c, block in mcu:
            size, text = number(block[0] - previous[c])
            previous[c] = block[0]
            bits += format(codes[size], "08b") + text
            run = 0
            for k in range(1, 64):
                if block[k] == 0:
                    run += 1
                    continue
                while run > 14:  # 0xF0 has a code here, larger ones haven't
                    bits += format(codes[0xF0], "08b") if run > 15 else ""
                    run -= 16 if run > 15 else 0
                    if run <= 15:
                        break
                size, text = number(block[k])
                bits += format(codes[run * 16 + size], "08b") + text
                run = 0
            if run:
                bits += format(codes[0], "08b")
    flush()
    seg = media._segment
    comps = b"".join(bytes([i + 1, h << 4 | v, 0]) for i, (h, v) in enumerate(sampling))
    scan = bytes([len(sampling), *(x for i in range(len(sampling)) for x in (i + 1, 0)), 0, 63, 0])
    h, v = max(s[0] for s in sampling), max(s[1] for s in sampling)
    import struct

    head = b"\xff\xd8" + seg(0xDB, b"\0" + bytes([8] * 64)) + seg(0xC0, struct.pack(">BHHB", 8, rows * 8 * v, cols * 8 * h, len(sampling)) + comps)
    head += seg(0xC4, b"\x00" + table + b"\x10" + table) + (seg(0xDD, struct.pack(">H", restart)) if restart else b"") + seg(0xDA, scan)
    return head + b"".join(out) + b"\xff\xd9"


@pytest.mark.parametrize("sampling, restart", [([(1, 1)], 0), ([(2, 2), (1, 1), (1, 1)], 2), ([(1, 1), (1, 1), (1, 1)], 0), ([(2, 1), (1, 1), (1, 1)], 3)])
def test_jpeg_decoder_on_other_images(sampling, restart):
    rng = np.random.default_rng(3)
    cols, rows = 3, 2
    layout = [c for c, (h, v) in enumerate(sampling) for _ in range(h * v)]
    want = []
    for _ in range(cols * rows):
        mcu = []
        for c in layout:
            block = np.where(rng.random(64) < 0.15, rng.integers(-200, 200, 64), 0).astype(int)
            block[14::13] = 3  # no run beyond the codes that this table has
            block[0] = rng.integers(-100, 100)
            mcu.append((c, block.tolist()))
        want.append(mcu)
    data = jpeg(want, cols, rows, sampling, restart)
    twice = media.decode_all([data, data])
    for image, got in twice:
        assert got.tolist() == [[b for _, b in mcu] for mcu in want]
        thumb = media.thumbnail(image, got)
        h, v = sampling[0]
        assert thumb.shape == (rows * v, cols * h)
        assert thumb[0, 0] == min(255, max(0, want[0][0][1][0] + 128)) and 0 <= media.average_hash(thumb) < 1 << 64


# 3


def base_of(x):
    x = x or ""
    w = WORD.findall(x)
    tri = [tuple(w[j : j + 3]) for j in range(len(w) - 2)]
    often, cover, seen, dup = Counter(tri), set(), set(), 0
    for j, t in enumerate(tri):
        if often[t] > 1:
            cover |= {j, j + 1, j + 2}
    for line in x.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), dup, len(cover)


def score_of(x, weight):
    b = (x or "").encode()
    code = [(int.from_bytes(b[i : i + 4], "little") * 0x9E3779B1 & 0xFFFFFFFF) >> 16 for i in range(len(b) - 3)]
    return sum(int(weight[c]) for c in code) / (len(code) * quality_rules.UNIT) if code else 0.0


def test_quality_rules(spark, docs, rows, labels):
    weight, least = quality_rules.fit(docs, labels)
    want = Counter()
    for i, x in rows:
        b = base_of(x)
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        want[i, *b, failed, not failed and score_of(x, weight) >= least] += 1
    got = quality_rules.quality_rules(docs, labels)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in got.collect()) == want
    raw = quality_rules.counts(docs)
    assert raw.sum() == sum(max(0, len((x or "").encode()) - 3) for _, x in rows)
    scores = {}
    for n in (1, 5):  # a score is its text's alone, to the last bit
        for r in quality_rules.quality_rules(docs.repartition(n), labels).collect():
            scores.setdefault((r.doc_id, r.n_words, r.word_chars, r.n_symbols), set()).add(r.score)
    assert all(len(v) <= 2 for v in scores.values()) and {x for v in scores.values() for x in v} == {score_of(x, weight) for _, x in rows}
    none = labels.limit(0)
    assert all(r.kept != r.base_failed for r in quality_rules.quality_rules(docs, none).collect())
    assert quality_rules.quality_rules(no_docs(spark), labels).count() == 0
    kept = quality_rules.kept_documents(docs, labels, ("lang",))
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got.filter("kept").collect())


def test_rules_on_labelled_documents(spark, sf):
    sf = sf.replace("0.001", "0.01")
    got = queries.QUERIES["op3_quality_rules"](spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    judged = got[~got.base_failed]
    assert judged[judged.quality == 1].kept.mean() > 0.99 and judged[judged.quality == 0].kept.mean() < 0.05


def test_rules_count_all_labels(spark, docs, rows, labels, monkeypatch):
    marks = {r.doc_id: r for r in quality_rules.marks(labels).collect()}
    assert (marks[6].quality, marks[6].toxic) == (0, 0)  # of two labels that differ
    want = quality_rules.weights(target_of(rows, marks), quality_rules.counts(docs))
    monkeypatch.setattr(quality_rules, "MAX_LABELLED", 3)
    monkeypatch.setattr(quality_rules.common, "first_by_hash", lambda df, n, *keys: df.limit(3))
    weight, least = quality_rules.fit(docs, labels)
    assert (weight == want).all() and np.isfinite(least)


def target_of(rows, marks):
    out = np.zeros(quality_rules.BUCKETS)
    for i, x in rows:
        if i in marks and marks[i].quality == 1 and not marks[i].toxic:
            code, inside, _ = quality_rules.grams([(x or "").encode()])
            out += np.bincount(code[inside], minlength=quality_rules.BUCKETS)
    return out


# 4


def test_mixing(spark, sf, docs, labels):
    sf = sf.replace("0.001", "0.01")
    documents, known = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    r = mixing.document_rates(documents, known).toPandas()
    p, t = r[[f"p_{k}" for k in mixing.DOMAINS]].to_numpy(), r.n_tokens.to_numpy()
    assert np.allclose(p.sum(1), 1) and (r.rate >= 0).all() and (abs(r.copies - r.rate) < 1).all()
    natural, got = t @ p, (t * r.rate.to_numpy()) @ p
    want = mixing.reachable(natural, mixing.TARGETS)
    assert np.abs(got - want).max() / natural.sum() < 1e-3
    # the same by projected gradient on every rate
    a, rate = (t[:, None] * p).T / natural.sum(), np.ones(len(t))
    step = 1 / np.linalg.norm(a / np.sqrt(t.clip(1)), 2) ** 2
    for _ in range(20_000):
        rate = np.clip(rate - step * (a.T @ (a @ rate - want / natural.sum())) / t.clip(1), 0, mixing.MAX_RATE)
    assert np.abs(rate - r.rate.to_numpy())[t > 0].max() < 0.05
    m = r.merge(known.toPandas(), on="doc_id")
    assert m[(m.quality == 1) & (m.toxic == 0)].rate.mean() > 1 > 0.5 > m[m.toxic == 1].rate.mean()
    odd = mixing.document_rates(docs, labels)
    assert odd.count() == docs.count() and odd.filter("rate is null or rate < 0").count() == 0
    assert {round(x.rate, 6) for x in mixing.document_rates(docs, labels.limit(0)).collect()} == {1.0}
    assert mixing.document_rates(no_docs(spark), labels).count() == 0
    copies = {x.doc_id: x.copies for x in r.itertuples()}
    mixed = Counter(x.doc_id for x in mixing.remix(documents, known, ("lang",)).collect())
    assert mixed == {k: v for k, v in copies.items() if v}
    sums = {x.domain: x for x in mixing.totals(mixing.document_rates(documents, known)).collect()}
    for k, name in enumerate(mixing.DOMAINS):
        x = sums[name]
        assert np.allclose([x.natural, x.aimed, x.expected], [natural[k], want[k], got[k]], rtol=1e-6)
        assert abs(x.asked - mixing.TARGETS[name] * natural.sum()) < 1 and abs(x.drawn - x.expected) < 0.05 * natural.sum()
    assert [x.natural for x in mixing.totals(mixing.document_rates(no_docs(spark), labels)).collect()] == [0, 0, 0]


def test_posteriors_by_brute_force(spark, docs, rows, labels):
    marks = {r.doc_id: r for r in quality_rules.marks(labels).collect()}
    sample = quality_rules.labelled(docs, labels)
    known = [(2 if marks[i].toxic == 1 else 0 if marks[i].quality == 1 else 1, (t or "").encode()) for i, t in rows if i in marks]
    first = [(d, t) for d, t in known if zlib.crc32(t) % 2 == 1]
    words = lambda t: set(re.sub(rb"[!-/:-@\[-`{-~]", b" ", t.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))).split())
    held, per = Counter((w, d) for d, t in first for w in words(t)), Counter(d for d, _ in first)
    want = {}
    for w in {w for w, _ in held}:
        n = [held[w, d] for d in range(3)]
        if sum(n) >= 5:
            want[w] = tuple(np.log((n[d] + 1) / (sum(n) * per[d] / len(first) + 1)) for d in (1, 2))
    weight, model = mixing.fit_posterior(sample)
    assert weight.keys() == want.keys() and all(np.allclose(weight[w], want[w]) for w in want)
    # the regression is where its penalised likelihood is flat, and that is its only maximum
    second = [(d, t) for d, t in known if zlib.crc32(t) % 2 == 0]
    x, y = np.array([mixing.vector(t, weight) for _, t in second]), np.array([d for d, _ in second])
    z = np.clip((x - model.mean) / model.scale, -10, 10)
    p = np.exp(z @ model.w.T)
    p /= p.sum(1, keepdims=True)
    reg = np.r_[1e-3, np.ones(x.shape[1] - 1)]
    assert np.abs((p - np.eye(3)[y]).T @ z + reg * model.w).max() < 1e-3
    got = Counter((r.doc_id, *(round(r[f"p_{k}"], 6) for k in mixing.DOMAINS)) for r in mixing.document_rates(docs, labels).collect())
    assert got == Counter((i, *(round(float(v), 6) for v in model(np.array([mixing.vector((t or "").encode(), weight)]))[0])) for i, t in rows)


def test_repeated_rows_are_rounded_one_by_one(spark, labels):
    text = "some words that all of these rows have"
    df = spark.createDataFrame([(None, text)] * 500 + [(1, text)] * 500, "doc_id long, text string").coalesce(1)
    for rate in (0.3, 1.7):
        rows = mixing.posteriors(df, {}, None).withColumn("copies", mixing.copies(mixing.F.lit(rate)))
        got = {r.doc_id: r.n for r in rows.groupBy("doc_id").agg(mixing.F.sum("copies").alias("n")).collect()}
        assert all(abs(got[k] - 500 * rate) < 5 for k in (None, 1)), got


# 5


def dedup_lines(rows, min_chars=40, min_docs=5):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\r\x0b\x0c"))
    held = {}
    for i, x in rows:
        for line in (x or "").split("\n"):
            held.setdefault(key(line), set()).add(i)
    out = Counter()
    for i, x in rows:
        lines = (x or "").split("\n")
        gone = [len(k := key(y)) >= min_chars and len(held[k]) >= min_docs and i != max((z for z in held[k] if z is not None), default=None) for y in lines]
        kept = "\n".join(y for y, g in zip(lines, gone) if not g)
        out[i, len(lines), sum(gone), kept] += 1
    return out


@pytest.mark.parametrize("limit", [common.BROADCAST_BYTES, 1])
def test_line_dedup(spark, docs, rows, limit):
    got = line_dedup.line_dedup(docs, carry=("lang",), limit=limit)
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()) == dedup_lines(rows)
    assert got.filter("n_dropped > 0").count() > 5
    assert line_dedup.line_dedup(no_docs(spark), limit=limit).count() == 0


@pytest.mark.parametrize("shards, flush", [(1, 1 << 18), (8, 7)])
def test_suspects_are_repeats_and_few_others(docs, rows, shards, flush):
    seen = Counter(k for _, x in rows for k in line_dedup.keys_of((x or "").encode(), 4))
    got = line_dedup.suspects(docs, 4, shards, flush).collect()
    want = {line_dedup.digest(k) for k, n in seen.items() if n > 1}
    found = {bytes(r.key) for r in got}
    assert want and want <= found and len(found - want) <= 2  # of hundreds of keys
    assert Counter((bytes(r.key), r.doc_id) for r in got if bytes(r.key) in want) == Counter((line_dedup.digest(k), i) for i, x in rows for k in line_dedup.keys_of((x or "").encode(), 4) if seen[k] > 1)


def test_line_dedup_over_many_filters(spark, docs, rows):
    for limit in (common.BROADCAST_BYTES, 1):
        got = line_dedup.line_dedup(docs, min_chars=4, min_docs=2, shards=16, flush=11, limit=limit)
        assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()) == dedup_lines(rows, 4, 2)


def test_bloom_filters():
    rng = np.random.default_rng(2)
    h = np.unique(rng.integers(0, 1 << 63, 200_000, dtype=np.uint64))
    f = line_dedup.Filters()
    f.add(h, np.zeros(len(h), bool))
    f.add(h[::50], np.zeros(len(h[::50]), bool))
    f.add(h[1::500], np.ones(len(h[1::500]), bool))
    hit = f.suspects(h)
    assert hit[::50].all() and hit[1::500].all() and hit.mean() < 0.06


# 6


def test_warc(spark, rows):
    folder = common.shared_folder(spark, "w")
    pages = [(i, None if (i or 0) % 5 == 0 else f"https://e/{i}\r\nX: y", x) for i, x in rows]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'c' digest", "1 records").repartition(2)
    got = warc.read_archives(warc.write_archives(df, folder), folder).collect()
    first = {}
    for i, _, x in pages:
        first[x or ""] = max(first.get(x or "", -1), -1 if i is None else i)
    want = Counter()
    for i, _, x in pages:
        b, top = (x or "").encode(), first[x or ""]
        again = top >= 0 and i != top
        want[i, len(b), warc.payload_digest(b), "revisit" if again else "response", top if again else None, None if again else x or ""] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload).decode()) for r in got) == want
    empty = df.limit(0)
    assert warc.read_archives(warc.write_archives(empty, folder), folder).count() == 0


def test_warc_errors():
    data = [warc.record(1, "u", b"<p>", warc.payload_digest(b"<p>"), None, False)]
    good = warc.archive(data, warc.train([b"<p>abc</p>" * 3]))
    assert [warc.parse(x)[0] for x in warc.frames(good)] == [1]
    with pytest.raises(warc.WarcError, match="second skippable"):
        list(warc.frames(good + b"\x50\x2a\x4d\x18\0\0\0\0"))
    for bad in (b"", good[8:], good[:-3], good + b"xxxxxxx", b"\0" + good[1:]):
        with pytest.raises(warc.WarcError):
            list(warc.frames(bad))
    r = data[0]
    for bad in (r.replace(b"WARC/1.1", b"WARC/9"), r.replace(b"<p>", b"<q>"), r[:-1], r.replace(b"Content-Length: 3", b"Content-Length: 4"), r.replace(b"WARC-Date:", b"WARC-Date"), r.replace(b"response\r\nWARC-R", b"request\r\nWARC-R")):
        with pytest.raises(warc.WarcError):
            warc.parse(bad)


# 7


def windows_removed(rows, w):
    c = Counter()
    for _, t in rows:
        b = (t or "").encode()
        c.update(b[i : i + w] for i in range(len(b) - w + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        g = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - w + 1):
            if c[b[i : i + w]] > 1:
                g[i : i + w] = True
        kept = bytes(x for x, y in zip(b, g) if not y)
        out.append((d, len(b), int(g.sum()), int((np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("width, hot, sizes", [(200, suffix_dedup.HOT_CLASSES, {}), (50, suffix_dedup.HOT_CLASSES, {}), (200, 1, {}), (200, suffix_dedup.HOT_CLASSES, {"shard_bytes": 3000, "piece": 900, "cut": 5000})])
def test_repeated_windows(spark, docs, rows, width, hot, sizes):
    # the last: several shard files a task, and texts that are cut
    assert tuples(suffix_dedup.repeated_windows(docs, width, hot=hot, **sizes)) == windows_removed(rows, width)
    if hot > 1 and not sizes:
        assert suffix_dedup.repeated_windows(no_docs(spark), width).count() == 0


def test_repeated_windows_of_few_letters(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randrange(0, 400)))) for i in range(40)] + [(7, "a" * 500), (8, "ab" * 200), (8, "ab" * 200)]
    rows += [(100 + i, rng.choice(rows)[1][rng.randrange(0, 60) :] + rng.choice(rows)[1]) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for w in (90, 21):
        assert tuples(suffix_dedup.repeated_windows(df, w)) == windows_removed(rows, w)


def test_windows_whose_sums_collide(spark):
    # Thue-Morse strings: sums of bytes times powers modulo 2**64 can't tell them apart
    t = "a"
    while len(t) < 4096:
        t += t.translate({97: "b", 98: "a"})
    x, y = t[:2048], t[2048:4096]
    h = [suffix_dedup.Hashes(np.frombuffer(z.encode(), np.uint8)) for z in (x, y)]
    assert h[0].of(np.array([0]), np.array([2048])) == h[1].of(np.array([0]), np.array([2048]))
    rows = [(1, x), (2, y), (3, "z" * 30 + x[:1500]), (4, y[300:900] + "q" * 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for w, cut in ((200, 8 << 20), (600, 700)):
        assert tuples(suffix_dedup.repeated_windows(df, w, cut=cut)) == windows_removed(rows, w)


def test_anchors_do_not_depend_on_the_piece():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    whole = {int(f): int(a) for _, a, first, last in zip(*suffix_dedup.runs_of(data, np.array([0, 5000]), 60, 20)) for f, a in ((f, a) for f in range(first, last + 1))}
    part = suffix_dedup.runs_of(data[1000:1400], np.array([0, 400]), 60, 20)
    assert all(whole[f + 1000] == a + 1000 for _, a, first, last in zip(*part) for f in range(first, last + 1))


# 8


def fingerprint_of(x):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x or ""))
    h = [xxhash.xxh64_intdigest(k.encode(), seed=42) for k in ([" ".join(w[i : i + 2]) for i in range(len(w) - 1)] if len(w) > 1 else w)]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def links(ids, fps):
    f = np.array(fps, np.uint64)
    near = [np.bitwise_count(f ^ v) <= 6 for v in f]
    lab = np.arange(len(f))
    while (new := np.array([lab[n].min() for n in near])).tolist() != lab.tolist():
        lab = new
    least = {k: min((i for i, z in zip(ids, lab) if z == k and i is not None), default=None) for k in set(lab.tolist())}
    return Counter((i, f"{v:016x}", int(n.sum()) - 1, least[z]) for i, v, n, z in zip(ids, fps, near, lab.tolist()))


def test_simhash(spark, docs, rows):
    got = simhash.near_duplicates(docs)
    assert Counter((r.doc_id, r.fingerprint, r.n_near, r.component_id) for r in got.collect()) == links([i for i, _ in rows], [fingerprint_of(x) for _, x in rows])
    assert simhash.near_duplicates(no_docs(spark)).count() == 0 and simhash.one_of_each(no_docs(spark), ("lang",)).count() == 0
    one = simhash.one_of_each(docs, ("lang",))
    roots = simhash.link_classes(simhash.with_fingerprints(docs)).select("root", "component_id").distinct()
    assert Counter(r.doc_id for r in one.collect()) == Counter(r.component_id for r in roots.collect())


@pytest.mark.parametrize("which, homes", [(0, simhash.BUCKET_HOMES), (0, 3), (1, simhash.BUCKET_HOMES), (1, 2), (2, simhash.BUCKET_HOMES)])
def test_links_of_planted_fingerprints(spark, which, homes):
    rng = random.Random(1)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(240):
        v = rng.choice(fps)
        for b in rng.sample(range(64), rng.randrange(0, 8)):
            v ^= 1 << b
        fps.append(v)
    df = spark.createDataFrame([(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(fps)], "doc_id long, fp long")
    classes = {r.fp & (1 << 64) - 1: r for r in simhash.link_classes(df, which, homes).collect()}
    got = Counter((i, f"{v:016x}", classes[v].n_near, classes[v].component_id) for i, v in enumerate(fps))
    assert got == links(list(range(len(fps))), fps)


def test_replicas_that_pass_by_in_chunks(monkeypatch):
    own, rng = simhash.layout(0), np.random.default_rng(3)
    fp = np.unique(rng.integers(0, 1 << 10, 300).astype(np.uint64) << np.uint64(16))  # one home in block 0
    n, is_home = np.arange(1, len(fp) + 1), np.arange(len(fp)) < 60
    want = np.bitwise_count(fp[:60, None] ^ fp[None]) <= 6
    sums = (want * n).sum(1) - n[:60]
    for chunk in (1 << 16, 64, 1):
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        bucket, got, edges = simhash._Bucket(0, own), Counter(), set()
        parts = [bucket.add(fp[i : i + 20], n[i : i + 20], is_home[i : i + 20]) for i in range(0, len(fp), 20)] + [bucket.flush()]
        for x in filter(None, parts):
            for f, r, k in zip(*x):
                got[int(f)] += int(k)
                edges |= {(int(f), int(r))}
        assert [got[int(f)] for f in fp[:60]] == sums.tolist()


@pytest.mark.parametrize("which", [0, 1, 2])
def test_anchors_cover(which):
    own = simhash.layout(which)
    rng = np.random.default_rng(0)
    assert sum(own.widths) == 64
    for b, w in enumerate(own.widths):
        v = rng.integers(0, 1 << w, 200)
        home = own.home(v)
        assert (own.syndrome(home) == 0).all() and np.bitwise_count((v ^ home).astype(np.uint64)).max() <= own.codes
        row, at = own.near(v, b)
        met = set(zip(row.tolist(), at.tolist()))
        assert len(met) == len(row) and (np.bitwise_count((v[row] ^ at).astype(np.uint64)) <= own.codes + own.within).all()
        for i in range(200):  # whatever is within reach has its home among the anchors
            e = sum(1 << int(x) for x in rng.choice(w, rng.integers(0, own.within + 1), replace=False))
            assert (i, int(own.home(np.array([int(v[i]) ^ e]))[0])) in met


def test_layouts_by_size():
    assert [simhash.cheapest(n) for n in (0, 10**5, 10**7, 10**8, 10**9)] == [0, 0, 0, 1, 2]


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 50)] + [(100, x) for x in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r.u: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


# 9


def test_quality_model(spark, sf, docs, labels):
    sf = sf.replace("0.001", "0.01")
    r = queries.QUERIES["op9_quality_model"](spark, sf).toPandas()
    assert (r.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in r.doc_id]).all() and r.score.between(0, 1).all()
    m = r[r.held_out].merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    assert (m.predicted == m.quality).mean() > 0.97
    good, bad = m[m.quality == 1].score.to_numpy(), m[m.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.98
    odd = quality_model.quality_scores(docs, labels)
    assert odd.count() == docs.count() and odd.filter("score is null or isnan(score)").count() == 0
    assert {x.score for x in quality_model.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_model.quality_scores(no_docs(spark), labels).count() == 0


def statistics_of(text):
    """The statistics, counted character by character."""
    x = text or ""
    b = x.encode()
    if not b:
        return [0.0] * quality_model.D
    n = len(b)
    count = lambda chars: sum(c in chars.encode() for c in b)
    upper, lower, digits = count("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), count("abcdefghijklmnopqrstuvwxyz"), count("0123456789")
    space, points, symbols, bang, pipe, high = count(" \t\n\r\x0b\x0c"), count(".,;:'-"), count("#*$%&<>"), count("!"), count("|"), sum(c >= 128 for c in b)
    other = n - upper - lower - digits - space - points - symbols - bang - pipe - high
    words, lines = WORD.findall(x), [y for y in x.split("\n") if y]
    freq = Counter(b)
    same = sum(a == c for a, c in zip(words, words[1:])) / len(words) if words else 0.0
    entropy = -sum(v / n * np.log2(v / n) for v in freq.values())
    shares = [upper / max(1, upper + lower + high), digits / n, space / n, points / n, symbols / n, other / n, high / n, bang / n, pipe / n, same]
    return [np.log1p(len(words)), min(50.0, (n - space) / max(1, len(words))), *np.sqrt(shares), len(set(words)) / (len(words) + 8), np.sqrt(1 - len(set(lines)) / len(lines)) if lines else 0.0, entropy]


def test_scores_by_brute_force(spark, docs, rows, labels):
    names = quality_model.STATISTICS
    order = [names.index(k) for k in names]
    x = np.array([statistics_of(t) for _, t in rows])[:, order]
    marks = {r.doc_id: r.quality for r in quality_rules.marks(labels).collect()}
    y = np.array([marks.get(i, -1) for i, _ in rows])
    params, total = [], (y >= 0).sum()
    pooled = x[y >= 0].var(0)
    for c in (0, 1):
        own = x[y == c]
        cov = 0.8 * np.cov(own.T, bias=True) + np.diag(0.2 * pooled + 1e-4)
        params.append((own.mean(0), np.linalg.inv(cov), np.linalg.slogdet(cov)[1]))
    log = [-0.5 * np.einsum("ij,jk,ik->i", x - m, inv, x - m) - 0.5 * det for m, inv, det in params]
    margin = np.clip((log[1] - log[0] + np.log(((y == 1).sum() + 1) / ((y == 0).sum() + 1))) / x.shape[1], -30, 30)
    at = np.minimum(((margin + 30) * 4096 / 60).astype(int), 4095)
    wrong = [(at[y == 1] <= k).mean() + (at[y == 0] > k).mean() for k in range(4096)]
    best = [k for k in range(4096) if wrong[k] <= min(wrong) + 1e-12]
    runs = [[best[0]]]
    for k in best[1:]:
        runs[-1].append(k) if k == runs[-1][-1] + 1 else runs.append([k])
    widest = max(runs, key=len)
    cut = (widest[0] + widest[-1] + 2) / 2 * 60 / 4096 - 30
    want = 1 / (1 + np.exp(-(margin + np.log(0.7 / 0.3) - cut)))
    got = quality_model.quality_scores(docs, labels).collect()
    assert total > 20 and Counter((r.doc_id, round(r.score, 7)) for r in got) == Counter((i, round(float(v), 7)) for (i, _), v in zip(rows, want))
    assert all(r.predicted == int(r.score >= 0.7) for r in got)


def test_discriminant_is_the_formula():
    rng = np.random.default_rng(1)
    d = quality_model.D
    xs = [rng.normal(size=(200, d)) @ rng.normal(size=(d, d)) + c for c in (0, 2)]
    sums = np.array([np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()]) for x in xs])
    model = quality_model.Discriminant(sums, 0.3)
    pooled = np.concatenate(xs).var(0)
    z, log = rng.normal(size=(5, d)), []
    for x in xs:
        s = 0.7 * np.cov(x.T, bias=True) + np.diag(0.3 * pooled + quality_model.FLOOR)
        log.append([-0.5 * (v - x.mean(0)) @ np.linalg.solve(s, v - x.mean(0)) - 0.5 * np.linalg.slogdet(s)[1] for v in z])
    assert np.allclose(model.margins(z), np.clip((np.array(log[1]) - log[0]) / d, -30, 30))


# 10


def test_packing(spark, docs, rows):
    path = tokens.public(packing.TOKENIZER)
    got = packing.retrieval_packing(docs, path, length=256, shard_docs=30).toPandas()
    library = tokens.Encoder(path)._library
    ids = [np.append(np.frombuffer(library(x or ""), "<u2"), 1).astype("<u4") for _, x in rows]
    by = {}
    for (i, _), x in zip(rows, ids):
        by.setdefault((i, len(x)), []).append(x)
    key = lambda i: None if i is None or i != i else int(i)
    assert all(any(zlib.crc32(x[r.start : r.start + r.length]) == r.ids_crc32 for x in by[key(r.doc_id), r.doc_tokens]) for r in got.itertuples())
    assert got.length.sum() == sum(map(len, ids))
    cover = Counter()
    for r in got.itertuples():
        cover.update((key(r.doc_id), r.doc_tokens, k) for k in range(r.start, r.start + r.length))
    want = Counter((i, len(x), k) for (i, _), x in zip(rows, ids) for k in range(len(x)))
    assert cover == want
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == np.concatenate([[0], np.cumsum(g.length)[:-1]]).tolist() and g.length.sum() <= 256
    sizes = got.groupby("sequence_id").length.sum()
    assert (sizes < 256).sum() <= 3
    assert packing.retrieval_packing(no_docs(spark), path).count() == 0


def test_bm25_and_order():
    rng = np.random.default_rng(4)
    docs = [rng.integers(2, 60, n) for n in rng.integers(5, 40, 30)]
    lengths, ids = np.array([len(x) for x in docs]), np.concatenate(docs).astype(np.uint16)
    df = np.array([sum(t in x for x in docs) for t in range(60)], float)
    idf, mean = np.log1p((30 - df + 0.5) / (df + 0.5)), lengths.mean()
    index = packing.Index(lengths, ids, idf, mean)

    def impact(t, d):
        tf = (docs[d] == t).sum()
        return idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * lengths[d] / mean))

    for seed in range(30):
        terms = sorted({int(t) for t in docs[seed] if df[t] > 1}, key=lambda t: (-np.float32(impact(t, seed)), t))[: packing.QUERY_TERMS]
        assert np.allclose(index.scores(seed), [sum(impact(t, d) for t in terms) for d in range(30)], atol=1e-4)
    pieces = packing.pack(lengths, index.scores, 64)
    first = pieces[0][0]
    follow = next(p[0] for p in pieces if p[0] != first)
    s = index.scores(first)
    s[first] = 0
    assert follow == int(s.argmax())


def test_all_terms_of_a_seed_count():
    rng = np.random.default_rng(9)
    docs = [rng.permutation(200)[:n] for n in rng.integers(60, 150, 20)]  # far more terms than 32
    lengths, ids = np.array([len(x) for x in docs]), np.concatenate(docs).astype(np.uint16)
    df = np.bincount(ids, minlength=200).astype(float)
    idf, mean = np.log1p((20 - df + 0.5) / (df + 0.5)), lengths.mean()
    index = packing.Index(lengths, ids, idf, mean)
    for seed in range(20):
        want = [sum(idf[t] * 2.2 / (1 + 1.2 * (0.25 + 0.75 * lengths[d] / mean)) for t in set(docs[seed]) & set(docs[d]) if df[t] > 1) for d in range(20)]
        assert np.allclose(index.scores(seed), want, atol=1e-4)


def test_nearest_is_the_sort(monkeypatch):
    rng = np.random.default_rng(6)
    docs = [(rng.zipf(1.3, n) % 400).astype(np.uint16) for n in rng.integers(5, 90, 3000)]
    lengths, ids = np.array([len(x) for x in docs]), np.concatenate(docs)
    df = np.bincount(packing.postings(lengths, ids)[1], minlength=400).astype(float)
    index = packing.Index(lengths, ids, np.log1p((3000 - df + 0.5) / (df + 0.5)), lengths.mean())
    queries_ = [np.unique(x) for x in docs[:300]]
    for q, found, got in index.nearest(np.concatenate(queries_), np.cumsum([len(x) for x in queries_]), 16):
        scores = index.scores(q)
        for t in queries_[q]:  # scores() leaves out terms that only the seed has
            if df[t] == 1:
                scores[q] += index.impact[index.start[t]]
        assert np.allclose(got, np.sort(scores)[::-1][:16], atol=1e-3) and np.allclose(got, scores[found], atol=1e-3)


def packed_by_brute_force(docs, length, neighbours=None):
    """Pieces (document, start, length, sequence, offset) of docs, arrays of ids in their order: scores by the formula, one
    pair at a time, and the rounds of the module's docstring."""
    neighbours = neighbours or packing.NEIGHBOURS
    n, df = len(docs), Counter(t for x in docs for t in set(x.tolist()))
    mean, tf = sum(map(len, docs)) / n, [Counter(x.tolist()) for x in docs]
    idf = {t: np.log1p((n - v + 0.5) / (v + 0.5)) for t, v in df.items()}
    bm25 = lambda q, d: sum(np.float32(idf[t] * tf[d][t] * 2.2 / (tf[d][t] + 1.2 * (0.25 + 0.75 * len(docs[d]) / mean))) for t in tf[q] if t in tf[d])
    left, out, filled, open_, cut = [len(x) for x in docs], [], [], [], []

    def put(d, s):
        take = min(left[d], length - filled[s])
        out.append((d, len(docs[d]) - left[d], take, s, filled[s]))
        left[d] -= take
        filled[s] += take
        if left[d]:
            cut.append(d)

    def unused():
        while cut:
            d = cut.pop(0)
            if left[d]:
                return d
        return next(d for d in range(n) if left[d])

    while sum(left):
        while sum(left) and len(open_) < max(1, sum(left) // (length * packing.SHARE)):
            filled.append(0)
            put(d := unused(), len(filled) - 1)
            if filled[-1] < length:
                open_.append((len(filled) - 1, d))
        live = [d for d in range(n) if left[d]]
        lists = [sorted((d for d in live if bm25(q, d) > 0), key=lambda d, q=q: (-round(float(bm25(q, d)), 4), d))[:neighbours] for _, q in open_]
        still = []
        for (s, q), best in zip(open_, lists):
            for d in best:
                if left[d] and filled[s] < length:
                    put(d, s)
            while len(best) < neighbours and filled[s] < length and sum(left):
                put(unused(), s)
            if filled[s] < length:
                still.append((s, q))
        open_ = still
    return out


@pytest.mark.parametrize("length, shard_docs", [(64, 1000), (300, 1000), (64, 9)])
def test_packing_by_brute_force(spark, length, shard_docs):
    rng = random.Random(11)
    words = ["rain", "river", "town", "bridge", "house", "road", "night", "field", "storm", "water", "people", "street", "school", "market", "church", "valley"]
    rows = [(i, " ".join(rng.choice(words[: 4 + i % 13]) + str(rng.randrange(30)) for _ in range(rng.randrange(1, 40)))) for i in range(70)] + [(70, None), (71, ""), (72, "rain " * 200)]
    path = tokens.public(packing.TOKENIZER)
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = packing.retrieval_packing(df, path, length=length, shard_docs=shard_docs).toPandas()
    encoder = tokens.Encoder(path)
    ids = {i: np.append(np.frombuffer(encoder._library(x or ""), "<u2"), 1) for i, x in rows}
    where = {i: p for p, i in packing.shard_order(df, shard_docs).collect()}
    order = sorted(ids, key=lambda i: (where[i], i))
    want = packed_by_brute_force([ids[i] for i in order], length)
    pieces = sorted((order[d], a, k, s, o) for d, a, k, s, o in want)
    assert sorted((r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in got.itertuples()) == pieces


def test_hot_rows_are_dealt_out(spark):
    df = spark.createDataFrame([(5, "the same row again and again")] * 4000 + [(i, f"another row {i}") for i in range(1000)], "doc_id long, text string").repartition(4)
    sizes = packing.shard_order(df, 500).groupBy("shard").count().toPandas()["count"]
    assert len(sizes) == 10 and sizes.max() < 900


def test_alike_queries_lie_together():
    rng = np.random.default_rng(5)
    kind = rng.integers(0, 4, 3000)
    rows = (rng.random((3000, 200)) < 0.5) & (np.arange(200)[None, :] // 50 == kind[:, None])
    order = packing.alike(rows)
    assert sorted(order.tolist()) == list(range(3000)) and (np.diff(kind[order]) != 0).sum() < 12
    assert packing.alike(rows[:5]).tolist() == list(range(5))


def test_a_search_leaves_out_what_cannot_be_near(monkeypatch):
    # two languages and lengths from 5 to 160 words: the neighbours are those of the whole sort, from fewer scores
    rng = np.random.default_rng(3)
    docs = [(rng.zipf(1.2, rng.integers(5, 160)) % 300 + 300 * (i % 2)).astype(np.uint16) for i in range(3000)]
    docs += [np.array([599], np.uint16)] * 3 + docs[:5]  # very short ones, and ties
    lengths, ids = np.array([len(x) for x in docs]), np.concatenate(docs)
    df = np.bincount(packing.postings(lengths, ids)[1], minlength=600).astype(float)
    index = packing.Index(lengths, ids, np.log1p((len(docs) - df + 0.5) / (df + 0.5)), lengths.mean())
    scored, add = [], packing.Block.add
    monkeypatch.setattr(packing, "BLOCK", 128)
    monkeypatch.setattr(packing.Block, "add", lambda self, scores, *rest: (scored.append(scores.size), add(self, scores, *rest)))
    picked = [*range(0, 1000), 3000, 3001, 3004]
    queries_ = [np.unique(docs[i]) for i in picked]
    got = {q: (d, x) for q, d, x in index.nearest(np.concatenate(queries_), np.cumsum([len(x) for x in queries_]), 16)}
    assert sum(scored) < 0.5 * len(picked) * len(docs)
    assert sorted(got) == list(range(len(picked)))
    for q, (found, x) in got.items():
        scores = np.zeros(len(docs))
        for t in queries_[q]:
            a, b = index.start[t], index.start[t + 1]
            scores[index.doc[a:b]] += index.impact[a:b]
        assert len(set(found)) == 16 and np.allclose(x, np.sort(scores)[::-1][:16], atol=1e-3) and np.allclose(x, scores[found], atol=1e-3)


def test_a_search_multiplies_only_pairs_that_can_be_near(monkeypatch):
    # three languages that share words, each query with a few words of the others: a bound from what any query of the
    # product has leaves nothing out here, one from what most have does; neighbours are those of the whole sort
    rng = np.random.default_rng(14)
    word = lambda i, n: np.where(rng.random(n) < 0.05, rng.integers(0, 900, n), rng.zipf(1.2, n) % 300 + 300 * (i % 3))
    docs = [word(i, n).astype(np.uint16) for i, n in enumerate(rng.integers(20, 300, 3000))] + [np.array([899], np.uint16)] * 2
    lengths, ids = np.array([len(x) for x in docs]), np.concatenate(docs)
    df = np.bincount(packing.postings(lengths, ids)[1], minlength=900).astype(float)
    index = packing.Index(lengths, ids, np.log1p((len(docs) - df + 0.5) / (df + 0.5)), lengths.mean())
    scored, better = [], packing.better
    monkeypatch.setattr(packing, "BLOCK", 256)
    monkeypatch.setattr(packing, "better", lambda scores, *rest: (scored.append(scores.size), better(scores, *rest))[1])
    picked = [*range(1000, 2000), 3001]
    queries_ = [np.unique(docs[i]) for i in picked]
    got = {q: (d, x) for q, d, x in index.nearest(np.concatenate(queries_), np.cumsum([len(x) for x in queries_]), 16)}
    assert sum(scored) < 0.5 * len(picked) * len(docs)
    assert sorted(got) == list(range(len(picked)))
    for q, (found, x) in got.items():
        scores = np.zeros(len(docs))
        for t in queries_[q]:
            a, b = index.start[t], index.start[t + 1]
            scores[index.doc[a:b]] += index.impact[a:b]
        assert len(set(found)) == len(found) == min(16, (scores > 0).sum()) and np.allclose(x, np.sort(scores)[::-1][: len(x)], atol=1e-3) and np.allclose(x, scores[found], atol=1e-3)


def test_stairs_hold_every_pair_that_reaches():
    rng = np.random.default_rng(2)
    for n, m, shift in [(1, 1, 0), (50, 200, 0), (300, 1024, -1.5), (300, 1000, 2), (20, 64, 9), (20, 64, -9)]:
        needed, reach = rng.normal(size=n), rng.normal(size=m) + shift
        rows, docs, steps = packing.stairs(needed, reach)
        held = np.zeros((n, m), bool)
        if docs is None:
            held[rows] = True
        for a, b, width in steps:
            assert not held[rows[a:b]].any()
            held[np.ix_(rows[a:b], docs[:width])] = True
        assert (held | (reach[None] < needed[:, None])).all() and len(set(rows)) == len(rows)


def test_a_search_holds_a_slice_of_the_seeds(tmp_path, monkeypatch):
    # what a worker holds beside the index must not grow with the seeds of a round, nor include the encoder
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa

    rng = np.random.default_rng(12)
    ids = [rng.permutation(3000)[:90].astype("<u2") for _ in range(400)]
    folder, end = f"file://{tmp_path}", [np.sort(x) for x in ids]
    common.put(f"{folder}/shard-000000.sizes", np.array([[90] * 400] * 2, "<i8").tobytes())
    common.put(f"{folder}/shard-000000.terms", np.concatenate(end).tobytes())
    common.put(f"{folder}/shard-000000.tf", zlib.compress(np.ones(400 * 90, "<u4").tobytes()))
    monkeypatch.setattr(packing, "SLICE", 200)
    got, peak = {}, {}
    for n in (200, 12_000):
        tokens.encoder(tokens.public(packing.TOKENIZER))
        asked = f"{folder}/asked-{n}"
        (tmp_path / f"asked-{n}").mkdir()
        packing._ask(asked, np.concatenate([end[i % 400] for i in range(n)]), np.arange(1, n + 1) * 90)
        shared = SimpleNamespace(value=(np.ones(400, bool), np.array([0, 400]), n))
        run = packing._nearest(folder, asked, np.dtype("<u2"), shared, [0], np.ones(3000), 90.0)
        tracemalloc.start()
        got[n] = []
        for batch in run([pa.RecordBatch.from_pydict({"a": [0], "b": [1]})]):
            rows = batch.to_pydict()
            got[n] += [(q, np.frombuffer(d, "<i8")[0]) for q, d in zip(rows["seed"], rows["docs"])]
        peak[n] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert not tokens._encoders
        assert sorted(got[n]) == [(q, q % 400) for q in range(n)]  # each finds itself
    assert peak[12_000] < 2 * peak[200] + 3e6


def test_neighbours_come_from_other_shards(spark):
    # pairs that share words no other document has: each must lie together, wherever the hash put the two
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(9))
    pairs = []
    for i in range(60):
        own = [word() for _ in range(12)]
        pairs += [(i, " ".join(own)), (1000 + i, " ".join(own[::-1]))]
    path = tokens.public(packing.TOKENIZER)
    got = packing.retrieval_packing(spark.createDataFrame(pairs, "doc_id long, text string"), path, length=1024, shard_docs=10).toPandas()
    assert (got.groupby("sequence_id").length.sum() < 1024).sum() <= 1
    where = {}
    for r in got.sort_values(["sequence_id", "offset"]).itertuples():
        where.setdefault(r.doc_id, []).append(r.sequence_id)
    whole = [i for i in range(60) if len(where[i]) == len(where[1000 + i]) == 1]
    assert len(whole) > 30 and sum(where[i] == where[1000 + i] for i in whole) > 0.6 * len(whole)


# the list of queries


def test_oracles(spark, sf, duck):
    from conftest import plain

    for name, sql in queries.SQL.items():
        assert plain(queries.QUERIES[name](spark, sf).toPandas()) == plain(duck.execute(sql).df()), name


def test_pipeline(spark, docs, rows, tmp_path, labels):
    import corpus_pipeline

    from pyspark.sql import functions as F

    sf_dir = str(tmp_path)
    labels.write.parquet(f"{sf_dir}/labels.parquet")
    docs.write.parquet(f"{sf_dir}/documents.parquet")
    left = common.table(spark, sf_dir, "documents")
    weight, least = quality_rules.fit(left, labels)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, left = left, common.written(stage(spark, left, sf_dir), name.replace(" ", "-"))
        if k < 4:
            assert tuple(left.columns) == corpus_pipeline.DOCUMENT
        was = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
        if k == 0:
            good = lambda x: (b := base_of(x))[0] >= 50 and 100 * b[4] <= 50 * b[0] and score_of(x, weight) >= least
            assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter(x for x in was if good(x[1]))
        elif k == 1:
            assert Counter((r.doc_id, r.text, r.n_chars) for r in left.collect()) == Counter({(i, t, len(t)): n for (i, _, _, t), n in dedup_lines(was).items()})
        elif k == 2:
            want = {c[3] for c in links([i for i, _ in was], [fingerprint_of(x) for _, x in was])}
            assert Counter(r.doc_id for r in left.collect()) == Counter(want)
        elif k == 3:
            rates = mixing.document_rates(before, labels)  # themselves held against brute force
            want = Counter()
            for r in rates.collect():
                want[r.doc_id] += r.copies
            assert Counter(r.doc_id for r in left.collect()) == +want
        else:
            path = tokens.public(packing.TOKENIZER)
            ids = [np.append(np.frombuffer(tokens.encoder(path).encode(x or ""), "<u2"), 1) for _, x in was]
            assert left.agg(F.sum("length")).first()[0] == sum(map(len, ids))
            order = sorted(range(len(was)), key=lambda i: (was[i][0] is not None, was[i][0] or 0, ids[i].tobytes()))
            want = packed_by_brute_force([ids[i] for i in order], packing.LENGTH)
            got = sorted((r.doc_id or -1, r.start, r.length, r.sequence_id, r.offset) for r in left.collect())
            assert got == sorted((was[order[d]][0] or -1, *rest) for d, *rest in want)
    none = no_docs(spark).select(*corpus_pipeline.DOCUMENT)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0, name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near-duplicates", "mixing", "packing"]
