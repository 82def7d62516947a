"""The training-data operators against brute force, SQL, exact round trips and held-out labels."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF
from oracle import connect, differences
from pyspark.sql import functions as F

from cellgrain.llm import common, entry, hilbert, maxent, mcd, media, shards, simhash, sptok, urlbloom, warc, zstdclf

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word other thing " * 9000


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, an empty and a very long text, ties, repeated rows, and columns with clashing names."""
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, LONG, "en", "a", 1), (4, "same words here " * 20, "en", "a", 1), (4, "same words here " * 20, "en", "a", 1), (5, "same words here " * 20, "en", None, 1), (None, "a # b", None, "a", 1), (6, " \n\t ", "en", "a", 1)]
    clash = {c: F.lit(7) for c in ("media", "payload", "codec", "score", "shard", "slot", "size", "start", "kept", "n_words", "_w", "fp", "component_id", "ids", "grp", "z1", "weight")}
    return spark.createDataFrame(rows, DOC).withColumns(clash)


OPERATORS = {
    "media": (media.media_features, 8), "rules": (mcd.outlier_rules, 8), "shards": (shards.shard_documents, 8), "packing": (hilbert.packed_pieces, None),
    "pieces": (sptok.encoded_texts, 8), "simhash": (simhash.near_copies, 8), "maxent": (maxent.language_scores, 8),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_odd_rows_and_empty_tables(odd, name):
    f, n = OPERATORS[name]
    assert n is None or f(odd).count() == n
    assert f(odd.limit(0)).count() == 0


def test_odd_rows_classifier(spark, odd):
    labels = spark.createDataFrame([(2, 1, 0), (3, 0, 0), (4, 1, None), (4, 0, 0), (None, 1, 0), (9, None, 1)], "doc_id long, quality int, toxic int")
    r = zstdclf.classify(odd, labels).collect()
    assert len(r) == 8 and all(0 <= x["score"] <= 1 for x in r)
    none = zstdclf.classify(odd, labels.limit(0)).collect()
    assert {x["score"] for x in none} == {0.5}
    assert zstdclf.classify(odd.limit(0), labels).count() == 0


# 1 -----------------------------------------------------------------------------------------------------------------


def test_media_brute_force(docs, texts):
    got = {r["doc_id"]: r for r in media.media_features(docs).collect()}
    for i, t in texts.items():
        b = t.encode()
        p = b + b" " * (-len(b) % 192 if b else 192)
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]))
        stored = media.build(p)
        assert (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest())
        assert b"".join(stored[k["offset"] : k["offset"] + k["length"]] for k in r["keyframes"]) == b"".join(p[k : k + 192] for k in range(0, len(p), 192 * media.GROUP))


def test_media_other_tables():
    """Variable sizes, 32-bit offsets, two runs of chunks, no stss; a 64-bit and an open box; broken files."""
    full, box = media.full, media.box
    u = lambda *x: b"".join(v.to_bytes(4, "big") for v in x)
    data = bytes(range(100))
    stbl = box(b"stbl", full(b"stsd", u(1), box(b"avc1", b"\0" * 20)), full(b"stts", u(2, 2, 10, 1, 5)), full(b"stsc", u(2, 1, 2, 1, 2, 1, 1)), full(b"stsz", u(0, 3, 10, 20, 30)), full(b"stco", u(2, 16, 46)))
    moov = box(b"moov", box(b"trak", box(b"mdia", full(b"mdhd", u(0, 0, 1000, 0, 0)), box(b"minf", stbl))))
    mdat = u(1) + b"mdat" + (16 + 100).to_bytes(8, "big") + data
    r = media.describe(mdat + moov)
    assert (r["error"], r["codec"], r["duration"], [(k["offset"], k["length"]) for k in r["keyframes"]]) == (None, "avc1", 25, [(16, 10), (26, 20), (46, 30)])
    assert r["sample_sha256"] == hashlib.sha256(data[:60]).hexdigest()
    assert media.describe(moov[:-4])["error"] and media.describe(mdat + u(0) + moov[4:])["error"] is None
    two = box(b"moov", *[box(b"trak", box(b"mdia", full(b"mdhd", u(0, 0, 1000, 0, 0)), box(b"minf", stbl)))] * 2)
    r = media.describe(mdat + two)
    assert r["n_samples"] == 3 and r["error"] == "1 further tracks aren't described"
    assert "fragments" in media.describe(mdat + moov + box(b"moof", b""))["error"]
    for cut in range(0, len(mdat + moov), 7):
        assert media.describe((mdat + moov)[:cut])["codec"] is None


# 2 -----------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == []


def test_base_stats_brute_force(docs, texts):
    import re

    for r in mcd.base_stats(docs.select("doc_id", "text")).collect():
        t = texts[r["doc_id"]]
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = Counter(zip(w, w[1:], w[2:]))
        covered = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_mcd_is_robust(spark):
    """A third of gross outliers doesn't move the estimates; a plain covariance would keep them."""
    rng = np.random.default_rng(1)
    clean, bad = rng.normal(0, 1, (400, 4)), rng.normal(12, 0.5, (130, 4))
    rows = [("g", *map(float, x)) for x in np.vstack([clean, bad])]
    df = spark.createDataFrame(rows, "grp string, z1 double, z2 double, z3 double, z4 double")
    fitted = mcd.factored(mcd.fit(df, support=0.7).drop("det"))
    e = fitted.first()
    assert all(abs(e[f"m{i}"]) < 0.4 for i in range(1, 5))
    d2 = df.crossJoin(fitted.drop("grp")).select("z1", mcd.squared(df).alias("d2"))
    assert d2.where((F.col("z1") > 8) & (F.col("d2") <= mcd.CUTOFF)).count() == 0
    assert d2.where((F.col("z1") < 5) & (F.col("d2") > mcd.CUTOFF)).count() <= 4


def test_mcd_finds_the_least_determinant(spark):
    """Small groups against every subset of their rows: no determinant is lower than brute force's, few are higher."""
    from itertools import combinations

    rng = np.random.default_rng(2)
    groups = {f"g{k}": np.vstack([rng.normal(0, 1, (9, 4)), rng.normal(15, 1, (3, 4))]).round(6) for k in range(12)}
    df = spark.createDataFrame([(g, *map(float, x)) for g, v in groups.items() for x in v], "grp string, z1 double, z2 double, z3 double, z4 double")
    got = {r["grp"]: r for r in mcd.fit(df).collect()}
    floor = np.diag(np.square(mcd.SCALE_FLOOR))
    exact = 0
    for g, v in groups.items():
        best = min(np.linalg.slogdet(mcd.CONSISTENCY * np.cov(v[[*some]].T, bias=True) + floor)[1] for some in combinations(range(12), 9))
        assert got[g]["det"] > best - 1e-6
        assert np.abs([got[g][f"m{i}"] for i in range(1, 5)]).max() < 3  # the gross outliers are outside
        exact += got[g]["det"] < best + 1e-6
    assert exact >= 10


def test_small_groups_lean_on_their_language(spark):
    """Junk that is its source's only row is judged by the language, whatever its own estimate."""
    rng = np.random.default_rng(4)
    rows = [("0", "1en", "2en|big", *map(float, x)) for x in rng.normal(0, 0.1, (300, 4))] + [("0", "1en", f"2en|junk{k}", 3.0 + k, 3.0, 0.0, 0.0) for k in range(3)]
    df = spark.createDataFrame(rows, "_all string, _lang string, _own string, z1 double, z2 double, z3 double, z4 double")
    scored = df.join(mcd.estimates(df), "_own")
    far = scored.where(mcd.squared(scored) > mcd.CUTOFF).collect()
    assert sorted(r["_own"] for r in far) == ["2en|junk0", "2en|junk1", "2en|junk2"]


# 3 -----------------------------------------------------------------------------------------------------------------


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    scored = entry.op3(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = ([x["score"] for x in scored if x["quality"] == y] for y in (1, 0))
    auc = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert auc > 0.9
    assert np.mean([x["predicted"] == 1 for x in scored if x["quality"] == 1]) > 0.95


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_classifier_brute_force(spark, sf):
    """Every score from the labels on: sample, dictionaries, sizes, and the calibration by plain descent."""
    import struct

    import xxhash
    import zstandard

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r["quality"] is not None}
    known = {i: y for i, y in quality.items() if zlib.crc32(str(i).encode()) % 5}
    hashed = lambda i: (xxhash.xxh64_intdigest(struct.pack("<q", i), 42) + (1 << 63)) % (1 << 64)
    of = {}
    for y in (0, 1):
        picked = sorted((i for i, k in known.items() if k == y), key=hashed)[: zstdclf.SAMPLE_ROWS]
        of[y] = [texts[i].encode() for i in sorted(picked) if i in texts]
    compressors = {}
    for y, v in of.items():
        blocks = [t[k : k + 4096] for n, t in enumerate(v) if n % 4 for k in range(0, len(t), 4096)]
        try:
            data = zstandard.train_dictionary(64 << 10, blocks, level=3).as_bytes()
        except zstandard.ZstdError:
            assert sf == SF  # too few to train on
            data = b"".join(t for n, t in enumerate(v) if n % 4)[-(64 << 10) :]
        compressors[y] = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(data), level=3, write_content_size=False, write_checksum=False, write_dict_id=False)
    size = lambda y, t: sum(len(compressors[y].compress(t[k : k + 4096])) for k in range(0, len(t), 4096))
    difference = lambda t: (size(0, t) - size(1, t)) / (size(0, t) + size(1, t)) if t else 0.0
    x = np.array([difference(t) for y in (0, 1) for t in of[y][::4]])
    y = np.array([y for y in (0, 1) for _ in of[y][::4]])
    share = sum(known.values()) / len(known)
    weight = np.where(y == 1, share / y.sum(), (1 - share) / (1 - y).sum()) * len(y)
    scale = math.sqrt((x * x).mean())
    a, c = 0.0, 0.0
    for _ in range(400_000):
        p = 1 / (1 + np.exp(-(a * x / scale + c)))
        da, dc = (weight * (p - y) * x / scale).sum() + 1e-3 * a, (weight * (p - y)).sum() + 1e-3 * c
        a, c = a - 0.5 * da / len(y), c - 0.5 * dc / len(y)
        if abs(da) + abs(dc) < 1e-7:
            break
    got = {r["doc_id"]: r for r in entry.op3(spark, sf).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        want = 1 / (1 + math.exp(-max(-30.0, min(30.0, a * difference(t.encode()) / scale + c))))
        assert got[i]["score"] == pytest.approx(want, abs=1e-4)


def test_sample_is_bounded_in_bytes(spark, docs, monkeypatch):
    seen = []
    monkeypatch.setattr(zstdclf, "dictionary", lambda texts: seen.append(sum(map(len, texts))) or b"")
    monkeypatch.setattr(zstdclf, "SAMPLE_BYTES", 30_000)
    zstdclf.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), F.lit(True))
    assert len(seen) == 2 and all(0 < n <= 30_000 for n in seen)


# 4 -----------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("partitions", [1, 5])
def test_shards_brute_force(spark, docs, texts, partitions):
    got = sorted(shards.shard_documents(docs.repartition(partitions)).collect(), key=lambda r: r["doc_id"])
    sizes = [len(texts[r["doc_id"]].encode()) + 8 for r in got]
    at, slots = 0, Counter()
    for r, n in zip(got, sizes, strict=True):
        s = min(23, at * 24 // sum(sizes))
        assert (r["shard"], r["slot"], r["size"], r["law"], r["grown_shard"]) == (s, slots[s], n, "bytes", None)
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        slots[s] += 1
        at += n


# 5 -----------------------------------------------------------------------------------------------------------------


def test_packing_brute_force(spark, docs, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    extra = {70_000: "a <|endoftext|> b", 70_001: "x\x1c\x85 \u2003y  z\u200b \U0001e8d0\U00016ac0 ½²Ⅷ it's IT'S ''s \u1c89\ua7cb", 70_002: "\n \n\t\r\n a  "}
    texts = texts | extra
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(extra.items()), "doc_id long, text string"))
    ids = {i: [*e.ids, 1] for i, e in zip(texts, t.encode_batch(list(texts.values()), add_special_tokens=False), strict=True)}
    assert 50256 in ids[70_000]
    got = hilbert.pack(docs).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["length"] == len(part) > 0 and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert np.frombuffer(r["ids"], "<u4").tolist() == part
    for i, parts in by_doc.items():
        assert sum(p["length"] for p in parts) == len(ids[i])
    assert set(by_doc) == set(ids)
    for s, parts in by_seq.items():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == 2048 or s == max(by_seq)
    # The order along the curve.
    keys = [p["curve_key"] for s in sorted(by_seq) for p in sorted(by_seq[s], key=lambda p: p["offset"])]
    assert keys == sorted(keys)


def test_encoder_equals_the_library_at_every_character(monkeypatch):
    """Whole texts of the library, for all assigned planes and any memory of words."""
    monkeypatch.setattr(hilbert, "MEMO", 50)
    e = hilbert.Encoder(hilbert.public_vocabulary())
    texts = ["".join(f"a{chr(c)} {chr(c)}1{chr(c)}" for c in range(i, i + 256) if not 0xD800 <= c < 0xE000) for i in [*range(0, 0x3000, 256), 0xA700, 0xFF00, 0x10D00, 0x16A00, 0x1D400, 0x1E800, 0x1F600]]
    want = [[*x.ids, 1] for x in e.library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in e.ids(texts, 1)] == want
    assert sum(e.agree(set(t)) for t in texts) > len(texts) / 2


def random_texts(characters: list[str], n: int, size: int) -> list[str]:
    pick = random.Random(5)
    return ["".join(pick.choices(characters[: pick.randint(3, len(characters))], k=pick.randint(0, size))) for _ in range(n)]


def test_encoder_cuts_white_space_and_signs_as_the_library(monkeypatch):
    monkeypatch.setattr(hilbert, "MEMO", 500)
    e = hilbert.Encoder(hilbert.public_vocabulary())
    texts = random_texts([" ", "\n", "a", "é", ",", "'", "s", "t", "1", "\t", "\0", "字", "!", "\u0301"], 5000, 14)
    want = [[*x.ids, 1] for x in e.library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in e.ids(texts, 1)] == want
    assert len(e.memo) == 500


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_neighbours(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = hilbert.hilbert_key(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


# 6 -----------------------------------------------------------------------------------------------------------------



def test_url_filter_beyond_its_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)  # the filter meets the pages in a salted shuffle
    pages = spark.range(3000).select(F.concat(F.lit("h.org/"), (F.col("id") % 1000).cast("string")).alias("u"), "id").unionByName(spark.createDataFrame([(None, -1)], "u string, id long"))
    listed = spark.range(0, 1000, 3).select(F.concat(F.lit("h.org/"), F.col("id").cast("string")).alias("url"))
    got = {r["id"]: r["listed"] for r in urlbloom.mark_listed(pages, listed, "u").collect()}
    assert got == {-1: False} | {i: i % 1000 % 3 == 0 for i in range(3000)}


def test_urls(spark):
    urls = ["http://Example.COM/en/7x?a#b", "https://a.example.net/de/81", "http://net/de/", "xnet://xnet/de/1", "no scheme", None, "http://org", "http://www.casino.com:80/x.html?utm_source=1&b=2&a=1#z", "https://m.casino.com/x/?a=1&b=2", "http://EXAMPLE.com?q", ""]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1)).withColumn("_salt", F.lit(2))
    got = {r["page_id"]: r for r in urlbloom.url_verdicts(pages).collect()}
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in range(8)] == [
        ("example.com", "/en/7x", "example.com/en/7", "allow"), ("a.example.net", "/de/81", "example.net/de/8", "block"), ("net", "/de/", "net/de/", "allow"), ("xnet", "/de/1", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("org", "", None, "allow"), ("www.casino.com:80", "/x.html", None, "block"),
    ]
    assert got[7]["canonical_url"] == got[8]["canonical_url"] == "casino.com/x?a=1&b=2" and got[8]["listed"]
    assert urlbloom.url_verdicts(pages.limit(0)).count() == 0


def test_filter_misses_nothing_and_passes_little(spark):
    urls = spark.range(4000).select(F.concat(F.lit("h/"), "id").alias("u"))
    listed = urls.where("u like '%7'")
    bits, blocks = urlbloom.build_filter(listed, "u", listed.count())
    keys = urls.select("u", *urlbloom.bloom_key(F.col("u"), blocks)).join(bits, "_block", "left")
    hit = keys.where(" AND ".join(f"_f{w} & _w{w} = _w{w}" for w in range(urlbloom.WORDS)))
    assert hit.where("u like '%7'").count() == 400 and hit.count() < 440
    marked = urlbloom.mark_listed(urls.withColumnRenamed("u", "canonical_url"), listed)
    assert marked.where("listed").count() == 400 and marked.count() == 4000


# 7 -----------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("chunk", "block"), [(50, 7), (50, 50), (700, 64), (sptok.CHUNK, sptok.BLOCK)])
def test_pieces_equal_the_library(spark, docs, texts, chunk, block):
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=sptok.public_model())
    extra = {1000: "QWxhZGRpbjpvcGVuIHNlc2FtZQ" * 60, 1001: "日本語 𝔘𝔫" * 60, 1002: " " * 300, 1003: "", 1004: "a\r\nb \n c\0 d" * 50, 1005: " lead  two " * 30, 1006: "▁a▁▁b" * 40}
    if chunk == sptok.CHUNK:  # text without a space, longer than a chunk
        extra[1007] = hashlib.sha512(b"x").hexdigest() * 300
    every = 5 if chunk < sptok.CHUNK else 1
    some = docs.select("doc_id", "text").where(f"doc_id % {every} = 0").unionByName(spark.createDataFrame(list(extra.items()), "doc_id long, text string"))
    want = {i: t for i, t in (texts | extra).items() if i % every == 0 or i >= 1000}
    got = {r["doc_id"]: r for r in sptok.decode(sptok.encode(some, chunk=chunk, block=block)).collect()}
    assert set(got) == set(want)
    for i, t in want.items():
        assert np.frombuffer(got[i]["ids"], "<u4").tolist() == m.encode(t) and got[i]["text"] == t.replace("▁", " ")
        assert got[i]["n_chunks"] >= len(t) // block


@pytest.mark.parametrize("block", [5, 9, sptok.BLOCK])
def test_parts_of_words_equal_the_library(block):
    import sentencepiece

    m, library = sptok.model_of(sptok.public_model()), sentencepiece.SentencePieceProcessor(model_file=sptok.public_model())
    texts = random_texts([" ", "\n", "a", "é", ",", "'", "s", "t", "1", "ing", "the", "0", "字", "▁", "!", "$$", "..", ".\n"], 3000, 24)
    for text in texts:
        t = sptok.normalized(text)
        ids, _ = sptok.traced(m, (t, 0, len(t), True, True), block)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text)


def test_transfer_product_is_associative():
    a, b, c = {(0, 1), (0, 2)}, {(1, 3), (2, 3), (2, 4)}, {(3, 0), (4, 5)}
    assert sptok.combine(sptok.combine(a, b), c) == sptok.combine(a, sptok.combine(b, c)) == {(0, 0), (0, 5)}
    assert sptok.boundary_states(sptok.tree([a, b, c])) in ([(0, 1), (1, 3), (3, 0)], [(0, 2), (2, 3), (3, 0)])


# 8 -----------------------------------------------------------------------------------------------------------------


def test_warc(spark):
    big, small = "x" * 1000, "y" * 999
    rows = [(1, "u1", big), (2, "u 2\n", big), (3, None, small), (4, "u4", small), (5, "u5", None), (None, "u6", big), (2, "u2b", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    got = sorted((tuple(r)[:5] for r in warc.archived_pages(pages).collect()), key=str)
    d = lambda s: hashlib.sha1((s or "").encode()).hexdigest()
    want = [(1, 1000, d(big), "revisit", 2), (2, 1000, d(big), "response", None), (2, 1000, d(big), "response", None), (3, 999, d(small), "response", None), (4, 999, d(small), "response", None), (5, 0, d(""), "response", None), (None, 1000, d(big), "revisit", 2)]
    assert got == sorted(want, key=str)
    assert warc.archived_pages(pages.limit(0)).count() == 0


def test_warc_reader_reports_damage():
    a, b, c = (warc.record(str(i), "u", bytes([65 + i]) * 5000, None) for i in range(3))
    assert [r["payload"][:1] for r in warc.read_archive(a + b + c)] == [b"A", b"B", b"C"]
    hurt = bytearray(b)
    hurt[len(b) // 2] ^= 255
    found = list(warc.read_archive(a + bytes(hurt) + c))
    assert found[0]["error"] is None and found[1]["error"] and found[-1]["payload"][:1] == b"C"
    assert "cut off" in list(warc.read_archive(a + b[:-9]))[-1]["error"]
    z = zlib.decompressobj(31)
    wrong = z.decompress(a).replace(base64.b32encode(hashlib.sha1(b"A" * 5000).digest()), base64.b32encode(hashlib.sha1(b"B" * 5000).digest()), 1)
    with pytest.raises(ValueError, match="payload"):
        warc.parse(wrong)


# 9 -----------------------------------------------------------------------------------------------------------------


def components(fps: dict, radius: int) -> dict:
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    ids = sorted(fps)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def plain_fingerprint(t: str, size: int = 3) -> int:
    import xxhash

    w = t.encode().lower().split()
    hs = [xxhash.xxh64_intdigest(b" ".join(w[k : k + size]), 42) for k in range(max(1, len(w) - size + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


@pytest.mark.parametrize("tile", [8, 32_768])
def test_simhash_brute_force(spark, docs, texts, tile):
    near = [(9000 + k, " ".join([*("w%d" % i for i in range(400)), "t%d" % k]), None, None, None) for k in range(12)]
    rows = docs.unionByName(spark.createDataFrame([*near, (9100, None, None, None, None), (9101, "  ", None, None, None)], DOC))
    fps = {i: plain_fingerprint(t) for i, t in (texts | {r[0]: r[1] or "" for r in near} | {9100: "", 9101: "  "}).items()}
    want = components(fps, 2)
    got = simhash.near_duplicates(rows, tile=tile).collect()
    assert {r["doc_id"]: int.from_bytes(r["fp"], "big") for r in got} == fps
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert len(set(want.values())) < len(want) - 8


def test_native_hash_agrees(spark, texts):
    t = texts[3].lower()
    w = t.encode().split()
    first = b" ".join(w[:3]).decode()
    h = spark.range(1).select(F.xxhash64(F.lit(first))).first()[0]
    assert h % (1 << 64) == int(simhash.shingle_hashes(t, 3)[0])


def test_forest_joins_what_all_pairs_join():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    x = np.array([b ^ np.uint64(1 << int(rng.integers(64))) for b in base for _ in range(60)])
    got = components_of_edges({v: v for v in map(int, x)}, [(int.from_bytes(a, "little"), int.from_bytes(b, "little")) for a, b in simhash.forest(simhash.words_of([v.tobytes() for v in np.unique(x)]), simhash.words_of([v.tobytes() for v in np.unique(x)]), True, 2)])
    want = components({int(v): int(v) for v in x}, 2)
    assert len(set(got.values())) == len(set(want.values()))


def test_forest_has_links_whose_first_words_differ_most():
    a = np.zeros((1, 4), np.uint64)
    b = a.copy()
    b[0, 0] = (1 << 40) - 1
    assert len(list(simhash.forest(a, b, False, 44))) == 1 and not list(simhash.forest(a, b, False, 39))


def components_of_edges(root: dict, edges: list) -> dict:
    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        root[find(a)] = find(b)
    return {i: find(i) for i in list(root)}


def test_stage_catches_near_copies_and_keeps_others(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(3000)]
    rows, n = [], 0
    for g in range(20):
        t = list(rng.choice(words, 300))
        rows.append((n, " ".join(t)))
        for _ in range(2):
            u = list(t)
            for k in rng.choice(300, 3, replace=False):
                u[k] = "changed"
            n += 1
            rows.append((n, " ".join(u)))
        n += 1
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("extra", F.lit("x"))
    kept = simhash.without_copies(df)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3 * g for g in range(20)] and kept.columns == df.columns


def jaccard(texts: dict) -> dict:
    sets = {i: set(simhash.shingle_hashes(t, 5).tolist()) for i, t in texts.items()}
    return {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in sets for j in sets if i < j and sets[i] | sets[j]}


def exact_roots(rows: dict) -> dict:
    """Each id's least linked id; texts without words have equal, empty sets."""
    empty = [i for i, t in rows.items() if not t.encode().split()]
    roots = components_of_edges({i: i for i in rows}, [p for p, x in jaccard(rows).items() if x >= 0.8] + list(zip(empty, empty[1:], strict=False)))
    least = {}
    for i, r in roots.items():
        least[r] = min(i, least.get(r, i))
    return {i: least[r] for i, r in roots.items()}


def test_stage_judges_rows_and_not_ids(spark):
    """Another text under an id stays; of identical rows one stays; a null id yields to another."""
    a, b = ("word%d " * 60 % tuple(range(k, k + 60)) for k in (0, 100))
    rows = [(1, a), (2, a), (2, b), (3, b), (3, b), (None, a), (None, "other " * 60), (None, "other " * 60), (4, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_place0", F.lit(5)).repartition(3)
    kept = simhash.without_copies(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], (r["text"] or "")[:6]) for r in kept.collect()), key=str) == sorted([(1, "word0 "), (2, "word10"), (None, "other "), (4, "")], key=str)


def test_rules_stage_tells_nulls_apart(spark, docs):
    """A rejected row takes no row of another group with it, whichever columns are null."""
    import corpus_pipeline

    good = [r["text"] for r in docs.where("lang = 'en' and n_chars > 600").orderBy("doc_id").limit(40).collect()]
    odd = " ".join(f"#{w}#$%" for w in good[0].split())
    rows = [(k, t, lang, source) for k, t in enumerate(good) for lang, source in ((None, "x"), ("x", None))] + [(900, odd, None, "x")] + [(901, odd, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = mcd.judge(df, ["doc_id", "lang", "source"]).where("kept").collect()
    assert sorted(map(str, ((r["doc_id"], r["lang"], r["source"]) for r in kept))) == sorted(map(str, ((r["doc_id"], r["lang"], r["source"]) for r in corpus_pipeline.rules(spark, df, SF).collect())))


@pytest.mark.parametrize("block", [100, 300, simhash.BLOCK])
def test_stage_goes_by_exact_similarity(spark, monkeypatch, block):
    """Pairs on both sides of 0.8, many of which a fingerprint radius of 44 decides wrongly, and groups in several blocks."""
    rng = np.random.default_rng(11)
    words, rows = [f"w{i}" for i in range(5000)], {}
    for g in range(60):
        t = list(rng.choice(words, 300))
        u = list(t)
        for k in range(int(rng.integers(4, 11))):
            u[7 + 13 * k] = f"x{k}"
        rows |= {10 * g: " ".join(t), 10 * g + 1: " ".join(u), 10 * g + 2: " ".join(t)}
    base = list(rng.choice(words, 120))
    rows |= {5000 + k: " ".join([*base, f"end{k}"]) for k in range(30)}
    exact = jaccard(rows)
    assert any(0.8 <= x < 0.85 for x in exact.values()) and any(0.7 < x < 0.8 for x in exact.values())
    true_links = simhash.true_links
    monkeypatch.setattr(simhash, "true_links", lambda *a: true_links(*a, block=block))
    links, tile = simhash.links, 20 if block <= 300 else simhash.TILE
    monkeypatch.setattr(simhash, "links", lambda fps, radius, _, *a: links(fps, radius, tile, *a))
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    assert {r["doc_id"] for r in simhash.without_copies(df).collect()} == set(exact_roots(rows).values())


def test_a_false_link_hides_no_true_one():
    """The candidates of a row join only by the check, although the first is nearer."""
    sets = [np.arange(0, 10, dtype=np.uint64), np.arange(50, 60, dtype=np.uint64), np.arange(1, 11, dtype=np.uint64)]
    x = np.array([[0, 1], [1, 2], [3, 3]], np.uint64)
    assert [(a[8], b[8]) for a, b in simhash.forest(x, x, True, 2, 1, simhash.similar(sets, sets, 0.8))] == [(1, 3)]


# 10 ----------------------------------------------------------------------------------------------------------------


def test_language_model(spark, docs, texts):
    got = maxent.language_scores(docs).collect()
    toks = {i: maxent.tokens(t) for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(w for i, t in toks.items() if not held[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    for r in got:
        t = toks[r["doc_id"]]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(t), sum(w in counts for w in t), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    gain = sum(r["score"] - r["base_score"] for r in got if r["held_out"])
    assert gain > 0


def test_language_model_helps_unseen_text(spark):
    """At sf0.1 the model takes five hundredths at least off the loss of held-out text."""
    loss = entry.queries()["op10_maxent_scores"](spark, "/root/testdata/sf0.1").where("held_out").agg(F.sum("base_score").alias("b"), F.sum("score").alias("s")).first()
    assert loss["s"] / loss["b"] < 0.95


def test_score_brute_force(spark):
    """Every score of a small corpus, token by token from the model's parts, and the shares of all words sum to one."""
    rng = np.random.default_rng(9)
    languages = [[f"{a}{k}" for k in range(30)] for a in ("ba", "ko")]
    rows = [(i, " ".join(rng.choice(languages[i % 2], 25))) for i in range(60)] + [(60, None), (61, "unseen " + "y" * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    train = df.where("doc_id < 50")
    m = maxent.model(train)
    shape, counts = m["shape"], {bytes(r["token"]): r["c"] for r in m["counts"].collect()}

    def shares(before: list[bytes]) -> np.ndarray:
        groups = [int(shape.groups[maxent.bucket(w)]) for w in before]
        votes = Counter(groups[-maxent.WINDOW :])
        context = min(votes, key=lambda g: (-votes[g], g)) if votes else maxent.NONE
        skip = groups[-2] if len(groups) > 1 else maxent.NONE
        last = maxent.hash_of(before[-1] if before else b"") % shape.last
        w, g1 = m["weights"].astype(float), maxent.GROUPS + 1
        pair = int(hilbert.mix(np.array([last * g1 + context]), 11)[0] % np.uint64(shape.pair))
        z = w[last] + w[shape.last + skip * g1 + context] + w[shape.last + g1 * g1 + pair] + w[-1]
        p = np.exp(z - z.max())
        return m["softmax"] * p / p.sum() + (1 - m["softmax"]) * m["share"]

    def cls(w: bytes) -> int:
        return 0 if not w else shape.own.get(w, 1 + maxent.OWN + int(shape.classes[maxent.bucket(w)]))

    got = {r["doc_id"]: r["score"] for r in maxent.score(df, m).collect()}
    for i, t in rows:
        words = maxent.tokens(t)
        want = sum(math.log10(shares(words[:k])[cls(w)] * (counts.get(w, 0) + 1) / m["mass"][cls(w)]) for k, w in enumerate(words))
        assert got[i] == pytest.approx(want, rel=1e-5)
    known = sum(shares([b"ba1"])[cls(w)] * (c + 1) / m["mass"][cls(w)] for w, c in counts.items())
    unknown = sum(shares([b"ba1"])[c] / m["mass"][c] for c in range(1 + maxent.OWN, maxent.CLASSES))
    assert known + unknown == pytest.approx(1, abs=1e-4) and m["softmax"] > 0


def test_buckets_grow_with_the_corpus():
    zeros = np.zeros(maxent.SUFFIX, int)
    sizes = [maxent.Shape(n, [], zeros, zeros).features for n in (10**5, 10**7, 10**9, 10**12)]
    assert sizes == sorted(set(sizes))


def test_rare_and_long_words_take_the_join(spark, docs, monkeypatch):
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(7000 + k, "ruled " + "=" * 80 + f" line{k}") for k in range(40)], "doc_id long, text string"))
    want = {r["doc_id"]: (r["n_known"], round(r["base_score"], 6)) for r in maxent.language_scores(docs).collect()}
    assert len({want[7000 + k] for k in range(40)}) <= 2 and min(want[7000 + k][0] for k in range(40)) >= 3
    monkeypatch.setattr(maxent, "HOT", 40)
    assert {r["doc_id"]: (r["n_known"], round(r["base_score"], 6)) for r in maxent.language_scores(docs).collect()} == want


def test_updates_raise_the_likelihood(docs):
    shape = maxent.Shape(70_000, [], *maxent.clusters(maxent.neighbours(docs)))
    cells = maxent.cut(maxent.class_counts(docs, shape))
    like = [maxent.gradient(cells, shape, maxent.train_weights(cells, shape, k))[1] for k in (0, 4, 12)]
    assert like[0] < like[1] < like[2]
    g, _ = maxent.gradient(cells, shape, np.zeros((shape.features, maxent.CLASSES)))
    assert abs(g[-1].sum()) < 1


# helpers and pipeline ------------------------------------------------------------------------------------------------


def test_lookup_join_is_the_same_beyond_the_broadcast_bound(spark, monkeypatch):
    left = spark.range(500).select("id", (F.col("id") % 7).cast("string").alias("k"))
    right = spark.createDataFrame([(str(i), i * i) for i in range(5)], "k string, v long")
    for how in ("left", "inner", "left_anti"):
        a = sorted(common.lookup_join(left, right, ["k"], F.col("id"), how).collect())
        monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
        assert sorted(common.lookup_join(left, right, ["k"], F.col("id"), how).collect()) == a
        monkeypatch.undo()


def test_pipeline_brute_force(spark, docs, texts, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "quality rules", "simhash near-dedup", "packing"] and corpus_pipeline.ORACLE_SQL is None
    now, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
        now.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        seen.append(now)
    first, second, third, last = seen
    assert first.columns == second.columns == third.columns == docs.columns
    # Classifier: the model's own score of each text.
    model = zstdclf.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), common.crc_fold(F.col("doc_id"), 5) != 0)
    sizes = zstdclf.Sizes(model["good"], model["bad"])
    want = {i for i, t in texts.items() if 1 / (1 + math.exp(-max(-30.0, min(30.0, model["slope"] * sizes.difference(t.encode()) + model["intercept"])))) >= 0.3}
    assert {r["doc_id"] for r in first.collect()} == want
    # Rules: their SQL over what was kept.
    con = connect(SF)
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{tmp_path / 'quality classifier'}/*.parquet')")
    con.execute(mcd.sql())
    names = [c[0] for c in con.description]
    want = {r[names.index("doc_id")] for r in con.fetchall() if r[names.index("kept")]}
    assert {r["doc_id"] for r in second.collect()} == want
    # Near copies: the exact similarity of all pairs of shingle sets.
    roots = exact_roots({i: texts[i] for i in want})
    assert {r["doc_id"] for r in third.collect()} == set(roots.values())
    # Packing keeps every id of every document.
    e = hilbert.Encoder(hilbert.public_vocabulary())
    got = Counter()
    for r in last.collect():
        got[r["doc_id"]] += r["length"]
    assert dict(got) == {i: len(e.ids([texts[i]], 1)[0]) for i in set(roots.values())}
    assert sorted(corpus_pipeline.run(spark, SF).collect(), key=str) == sorted(last.collect(), key=str)


def test_pipeline_stages_take_odd_rows_and_empty_tables(spark, odd):
    import corpus_pipeline

    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            n = out.count()
            if name == "packing":
                assert (n > 0) == (docs is odd)
            else:
                assert out.columns == docs.columns and n <= 8 and (docs is odd or n == 0)
    # A null id stays where nothing else has its text, and the copies of one text leave one row.
    kept = [r["doc_id"] for r in corpus_pipeline.copies(spark, odd, SF).collect()]
    assert None in kept and 5 not in kept and kept.count(4) == 1


def test_url_and_archive_operators_take_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x", "h" * 1200), (2, "http://a.com/x", "h" * 1200), (None, None, None)], "page_id long, url string, html string")
    clash = pages.withColumns({c: F.lit(1) for c in ("host", "path", "rule", "verdict", "listed", "canonical_url", "_block", "payload", "refers_to", "content", "archive")})
    assert urlbloom.url_verdicts(clash).count() == 3 and warc.archived_pages(clash).count() == 3
