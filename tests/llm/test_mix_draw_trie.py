"""Mixing, resampling and the conversation trie against brute force, on odd rows and on lopsided inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SF
from pyspark.sql import functions as F

from cellgrain.llm import common, mixing, resample, trie

DOC = "doc_id long, text string, lang string, source string, n_chars long"
TURN = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "word other thing " * 9000, "en", "a", 1), (4, "same words here " * 20, "en", "a", 1), (4, "same words here " * 20, "en", "a", 1), (4, "other words here " * 20, "en", "a", 1), (5, "same words here " * 20, "en", None, 1), (None, "a # b" * 30, None, "é", 1), (6, " \n\t ", "en", "Z", 1)]
    clash = {c: F.lit(7) for c in ("_src", "_row", "_hash", "_low", "_id", "_place", "size", "target", "weight", "score", "rank", "words", "at", "epoch", "_part", "_size", "_rows", "_at")}
    return spark.createDataFrame(rows, DOC).withColumns(clash)


# 11 ----------------------------------------------------------------------------------------------------------------


def level_targets(sizes: list[int]) -> list[float]:
    """By the contract's words: share by weight, stop at twice the size, share the excess again."""
    w, open_, out, budget = [(5, 2, 1)[i % 3] for i in range(len(sizes))], set(range(len(sizes))), {}, 1.5 * sum(sizes)
    while open_:
        unit = budget / sum(w[i] for i in open_)
        full = {i for i in open_ if unit * w[i] >= 2 * sizes[i]}
        if not full:
            out |= {i: unit * w[i] for i in open_}
            break
        for i in full:
            out[i] = 2.0 * sizes[i]
            budget -= out[i]
        open_ -= full
    return [out[i] for i in range(len(sizes))]


def check_mix(docs, rows):
    sizes, sources = defaultdict(int), {}
    for r in docs.select("doc_id", "text", "source").collect():
        sources[r["doc_id"]] = r["source"]
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want, got = dict(zip(order, level_targets([sizes[s] for s in order]), strict=True)), Counter()
    for r in rows:
        s = sources[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s], rel=1e-12)
        assert 0 <= r["taken"] <= 2 * r["size"]
        got[s] += r["taken"]
    for s in order:
        assert want[s] - 1 <= got[s] <= want[s] + 1e-6
    assert sum(got.values()) <= 1.5 * sum(sizes.values())


@pytest.mark.parametrize("partitions", [1, 7])
def test_mixture_meets_its_targets(docs, partitions):
    rows = mixing.mixed_documents(docs.repartition(partitions)).collect()
    assert len(rows) == docs.count()
    check_mix(docs, rows)
    assert sorted(rows) == sorted(mixing.mixed_documents(docs).collect())


def test_mixture_of_a_hot_source_and_of_odd_rows(spark, odd):
    check_mix(odd, mixing.mixed_documents(odd).collect())
    assert mixing.mixed_documents(odd.limit(0)).count() == 0
    assert [r["taken"] for r in mixing.mixed_documents(odd.where("doc_id IN (1, 2, 6)")).collect()] == [0, 0, 0]
    hot = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(id % 50 as int))").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("source"))
    check_mix(hot, mixing.mixed_documents(hot).collect())


def test_mixture_is_a_stream_in_the_order_of_finish_times(docs, monkeypatch):
    rows = [r for r in mixing.mixture(docs).collect() if r["words"]]
    at = 0
    for r in sorted(rows, key=lambda r: r["at"]):
        assert r["at"] == at and r["words"] <= r["size"]
        at += r["words"]
    seen = Counter()
    for r in sorted(rows, key=lambda r: r["at"]):  # at any point all sources have had the same part of their targets
        seen[r["_src"]] += r["words"]
        parts = {x["_src"]: (seen[x["_src"]] / x["target"], max(y["size"] for y in rows if y["_src"] == x["_src"]) / x["target"]) for x in rows} if r["at"] % 7 == 0 else {}
        now = max((p for p, _ in parts.values()), default=0)
        assert all(p + step >= now - 1e-9 for p, step in parts.values())
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)  # targets meet the queues in a salted shuffle
    check_mix(docs, mixing.mixed_documents(docs).collect())


# 12 ----------------------------------------------------------------------------------------------------------------


def brute_scores(docs, target):
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    of = [(r["doc_id"], [zlib.crc32(w) % 10_000 for w in words(r["text"])]) for r in docs]
    s, t = Counter(b for _, x in of for b in x), Counter(zlib.crc32(w) % 10_000 for r in target for w in words(r["text"]))
    ns, nt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ns + 10_000) / ((s[b] + 1) * (nt + 10_000))))
    out = []
    for i, x in of:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = math.floor(sum(map(gain, x)) / len(x)) if x else 0
        out.append((i, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    return out


def test_resampling_brute_force(spark, docs, odd):
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    for table in (docs, odd):
        want = brute_scores(table.select("doc_id", "text").collect(), target.collect())
        got = resample.resampled_documents(table, target).collect()
        key = lambda r: tuple((x is None, x or 0) for x in r)
        assert sorted((tuple(r[:4]) for r in got), key=key) == sorted(want, key=key)
        fit = sorted((-r[3], r[0] is None, r[0] or 0) for r in want if r[1] >= 20)
        drawn = sorted((r["rank"], -r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in got if r["rank"])
        assert [r[1:] for r in drawn] == fit[: len(fit) * 10 // 100] and [r[0] for r in drawn] == list(range(1, len(drawn) + 1))
    assert resample.resampled_documents(docs.limit(0), target).count() == 0
    none = resample.resample(docs, target.limit(0))
    assert none.where("rank IS NOT NULL").count() == none.where("n_words >= 20").count() // 10 > 0


@pytest.mark.parametrize("shape", ["sorted", "one hot partition", "ties", "scattered"])
def test_cutoff_is_exact(spark, shape):
    """Partitions that hold one end of the order each, all rows, or nothing; equal scores throughout."""
    n, pick = 6000, random.Random(3)
    low = {"sorted": lambda i: i, "one hot partition": lambda i: pick.randint(-10**12, 10**12), "ties": lambda i: i % 3, "scattered": lambda i: i * 7919 % n}[shape]
    rows = [(low(i), i % 50, i) for i in range(n)]
    df = spark.createDataFrame(rows, "_low long, _id long, _place long")
    df = df.repartition(9, F.when(F.col("_place") % 50 > 0, 0).otherwise(F.col("_place"))) if shape == "one hot partition" else df.repartitionByRange(9, "_low") if shape == "sorted" else df.repartition(9)
    df = common.cut(df.sortWithinPartitions("_low", "_id", "_place"))
    for k in (1, 2, 600, 3000, n - 1, n):
        assert resample.cutoff(df, k, few=50) == sorted(rows)[k - 1]


def test_longer_runs_are_features(spark):
    docs = spark.createDataFrame([(1, "A b-c b c"), (2, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["n_features"] for r in resample.resample(docs, docs, grams=3, least_words=1).collect()} == {1: 5 + 4 + 3, 2: 0}
    n, found = resample.features("A b-c b c", 2, resample.Buckets(1000))
    assert n == 5 and found.tolist() == [zlib.crc32(x) % 1000 for x in (b"a", b"b", b"c", b"b", b"c", b"a b", b"b c", b"c b", b"b c")]


# 13 ----------------------------------------------------------------------------------------------------------------


def brute_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    new = {}
    for c, own in convs.items():
        h = zlib.crc32(("" if c is None else str(c)).encode()) % 6
        new[c] = convs.get(None if c is None else c - int(math.fmod(c, 100)), [])[:h] + own[h:]
    nodes = defaultdict(list)
    for c, t in new.items():
        for d in range(len(t) + 1):
            nodes[tuple(t[:d])].append(c)
    low = lambda cs: min(cs, key=lambda c: (c is not None, c or 0))
    kids, leaves, saved = Counter(p[:-1] for p in nodes if p), Counter(), Counter()
    for p, cs in nodes.items():
        own = (len(cs) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += own
    out = []
    for p, cs in nodes.items():
        at_end = sorted((c for c in cs if len(new[c]) == len(p)), key=lambda c: (c is not None, c or 0))
        sha = hashlib.sha256(",".join("" if c is None else str(c) for c in at_end).encode()).hexdigest()
        out.append((low(cs), len(p), low(nodes[p[:-1]]) if p else None, len(cs), kids[p], leaves[p], saved[p], sha))
    return sorted(out, key=str)


def same_trie(spark, rows, **k):
    got = sorted((tuple(r) for r in trie.conversation_trie(spark.createDataFrame(rows, TURN), **k).collect()), key=str)
    want = brute_trie(rows)
    wrong = [p for p in zip(got, want, strict=False) if p[0] != p[1]]
    assert len(got) == len(want) and wrong[:3] == []


@pytest.mark.parametrize("limit", [40, 1 << 12])
def test_trie_brute_force(spark, limit):
    """A third of all turns in one conversation, with branches off every one of them, copies, and odd rows."""
    pick = random.Random(limit)
    rows = [(700, k, "user", f"t{k}") for k in range(60)]
    rows += [(701 + j, k, "user", f"t{k}" if k < j * 3 else f"x{j}") for j in range(20) for k in range(j * 3 + 1)]
    rows += [(c, k, pick.choice(["user", "assistant"]), pick.choice("ab")) for c in range(60) for k in range(pick.randint(1, 7))]
    rows += [(c, k, "user", "copy") for c in range(300, 340) for k in range(2)]
    rows += [(None, 1, None, "n"), (None, None, "user", None), (None, None, "user", None), (205, 0, "user", "base is absent"), (-7, None, "user", ""), (-7, 2, None, None), (-7, 3, "é", "é\U0001f600")]
    same_trie(spark, rows, limit=limit)


def test_trie_takes_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (2, 0, "user", "a")], TURN)
    assert trie.conversation_trie(df.limit(0)).count() == 0
    assert trie.conversation_trie(df.withColumns({c: F.lit(1) for c in ("_c", "q", "n", "node", "parent", "comp", "weight", "d1", "pos", "part", "_part")})).count() == 2


def test_long_lists_of_ends_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 40)
    rows = [(c, k, "user", "copy") for c in range(1000, 1400) for k in range(6)]
    same_trie(spark, rows)


def test_split_component_on_chains_and_stars():
    pick = random.Random(1)
    for shape in (lambda i: i - 1, lambda i: 0, lambda i: pick.randrange(i), lambda i: max(0, i - pick.randint(1, 2))):
        n = 400
        parent = [-1] + [shape(i) for i in range(1, n)]
        values = [(pick.randint(0, 5), pick.randint(0, 5)) for _ in range(n)]
        weight, want = [1] * n, [list(v) for v in values]
        for i in range(n - 1, 0, -1):
            weight[parent[i]] += weight[i]
            want[parent[i]] = [a + b for a, b in zip(want[parent[i]], want[i], strict=True)]
        assert [list(t) for t in trie.split_component(parent, weight, values)] == want
