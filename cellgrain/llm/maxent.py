"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class). The most frequent words and the end of a text are classes of
their own. Other words, known or not, share classes by the bucket of their last bytes; buckets whose neighbours in the
training texts are alike (those of one language, mostly) are put into one class by weighted k-means.

The class softmax has weights for hashed n-gram features (the last word's bucket, the bucket with its context) and skip
features (the group of the word before it, with the group that most of the WINDOW words before belong to). It is mixed
with the plain class shares; how far is chosen on a part of the training texts whose counts don't train the weights.
Within its class a word has its smoothed share of the class's training tokens (a factor without features); a shared
class keeps one count for its unknown words.

Training reads all training texts: word counts, neighbours of buckets, then counts of (history, class), by grouped
sums. The number of buckets, and so of features and histories, grows with the cube root of the training tokens. Each
update is a distributed gradient: partitions of the history table emit their part of it, which Spark sums by feature.
Scoring looks up the sparse features of a batch of tokens in numpy. Words under the HOT most frequent meet their counts
in a shuffle join; none of them has more than a small share of the rows, because HOT others are more frequent.

Cases: a null text is empty and has its end only; a null id counts as an empty text for the fold; a word of over
MAX_WORD bytes goes by a 128-bit digest, whatever its frequency; repeated rows score alike; without training rows every
token is unknown and class shares are uniform; extra columns are left out; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cellgrain.llm.common import crc_fold, cut, no_cycle_search, table
from cellgrain.llm.hilbert import mix
from cellgrain.llm.media import pieces

#: Classes: the end, OWN frequent words, SHARED classes of the other words.
OWN, SHARED, HOT, MAX_WORD = 31, 32, 50_000, 64
CLASSES = 1 + OWN + SHARED
#: Buckets of last bytes, and of their neighbours; groups of buckets (and one number for none) and words that vote.
SUFFIX, NEAR, GROUPS, WINDOW = 4096, 256, 8, 8
NONE = GROUPS
UPDATES, RATE, RIDGE, FLUSH = 12, 0.6, 1.0, 200_000
#: Histories of a row of the history table, features of a block of the gradient, and partial sums of one array.
ROW, BLOCK, PARTIAL = 512, 256, 256
#: Shares of the softmax that are tried, one text in VALIDATE chooses, and rows of a hash table in the join.
SHARES, VALIDATE, JOIN_ROWS = (*(k / 20 for k in range(20)), 0.98), 10, 500_000


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z lower-cased, and one end. Long words are replaced by a space and their
    digest."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if words and max(map(len, words)) > MAX_WORD:
        words = [w if len(w) <= MAX_WORD else b" " + xxhash.xxh3_128_digest(w) for w in words]
    return [*words, b""]


def hash_of(word: bytes) -> int:
    """A fixed hash of a word (Python's own differs between processes)."""
    return xxhash.xxh64_intdigest(word, 42)


def bucket(word: bytes) -> int:
    return hash_of(word[-3:]) % SUFFIX


class Memo(dict):
    """Words met so far, up to FLUSH of them; others are computed each time."""

    def __init__(self, f: Callable[[bytes], int]):
        super().__init__()
        self.f = f

    def __missing__(self, w: bytes) -> int:
        x = self.f(w)
        if len(self) < FLUSH:
            self[w] = x
        return x

    def of(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words of texts, one after another, and the texts' sizes."""
        sizes = np.array([len(t) for t in texts], np.int64)
        return np.fromiter(map(self.__getitem__, chain.from_iterable(texts)), np.int64, sizes.sum()), sizes


class Shape:
    """How words and histories are numbered: ``last`` buckets of the last word, what is a class, what a group."""

    def __init__(self, tokens: int, own: list[bytes], classes: np.ndarray, groups: np.ndarray):
        self.last = 1 << max(6, math.ceil(math.log2(max(tokens, 1)) / 3))
        self.pair, self.own, self.classes, self.groups = 8 * self.last, {w: 1 + i for i, w in enumerate(own)}, classes, groups
        self.histories = self.last * (GROUPS + 1) ** 2
        self.features = self.last + (GROUPS + 1) ** 2 + self.pair + 1

    def code(self, w: bytes) -> int:
        """Class, bucket and group of a word as one number."""
        b = bucket(w)
        cls = self.own.get(w, 1 + OWN + int(self.classes[b])) if w else 0
        return (cls * self.last + hash_of(w) % self.last) * (GROUPS + 1) + (int(self.groups[b]) if w else NONE)

    def class_of(self, codes: np.ndarray) -> np.ndarray:
        return codes // (GROUPS + 1) // self.last

    def of_texts(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The history number of each token of texts of ``sizes`` tokens, one after another, and its class. A text
        begins after an end."""
        at = np.arange(len(codes))
        start = np.repeat(np.cumsum(sizes) - sizes, sizes)
        group = codes % (GROUPS + 1)
        last = np.where(at > start, np.roll(codes // (GROUPS + 1) % self.last, 1), hash_of(b"") % self.last)
        skip = np.where(at > start + 1, np.roll(group, 2), NONE)
        # Votes of the words before each place, as differences of running counts; the least group wins a tie.
        begin = np.maximum(at - WINDOW, start)
        best, context = np.zeros(len(codes), np.int32), np.full(len(codes), NONE, np.int64)
        for k in range(GROUPS):
            run = np.concatenate(([0], np.cumsum(group == k, dtype=np.int32)))
            votes = run[:-1] - run[begin]
            context[votes > best] = k
            np.maximum(best, votes, out=best)
        return (last * (GROUPS + 1) + skip) * (GROUPS + 1) + context, self.class_of(codes)

    def rows(self, history: np.ndarray) -> np.ndarray:
        """The three feature rows of histories."""
        last, context, both = history // (GROUPS + 1) ** 2, history % (GROUPS + 1), history % (GROUPS + 1) ** 2
        pair = (mix(last * (GROUPS + 1) + context, 11) % np.uint64(self.pair)).astype(np.int64)
        return np.stack([last, self.last + both, self.last + (GROUPS + 1) ** 2 + pair], axis=1)

    def log_softmax(self, weights: np.ndarray, history: np.ndarray) -> np.ndarray:
        """Log class shares of histories, one row each."""
        f = self.rows(history)
        z = weights[f[:, 0]] + weights[f[:, 1]] + weights[f[:, 2]] + weights[-1]
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def word_counts(train: DataFrame) -> DataFrame:
    """token, c over all texts. Tasks pre-aggregate; Spark sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["token", "c"])

        for whole in batches:
            for b in pieces(whole, "text", 4 << 20):
                for t in b.column("text"):
                    held.update(tokens(t.as_py()))
                if len(held) > FLUSH:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return train.select("text").mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def arrays_summed(parts: DataFrame) -> DataFrame:
    """block, idx, n: sums of sparse arrays (idx unsigned 32-bit, n 64-bit) by block, in two levels, so that no task
    holds the arrays of all others."""

    def add(t: pa.Table) -> pa.Table:
        idx = np.concatenate([np.frombuffer(x, "<u4") for x in t.column("idx").to_pylist()])
        n = np.concatenate([np.frombuffer(x, "<f8") for x in t.column("n").to_pylist()])
        cells, at = np.unique(idx, return_inverse=True)
        return pa.table({"block": pa.array([t.column("block")[0].as_py()], pa.int32()), "idx": [cells.astype("<u4").tobytes()], "n": [np.bincount(at, n, len(cells)).astype("<f8").tobytes()]})

    schema = "block int, idx binary, n binary"
    some = parts.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(PARTIAL))).groupBy("block", "_salt").applyInArrow(lambda t: add(t), schema)
    return some.groupBy("block").applyInArrow(lambda t: add(t), schema)


def counted(train: DataFrame, cells_of: Callable[[list[list[bytes]]], np.ndarray], width: int) -> DataFrame:
    """block, idx, n: how often each number that ``cells_of`` gives for texts' tokens occurs over all texts; ``width``
    numbers make a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: tuple[np.ndarray, np.ndarray] | None = None
        for whole in batches:
            for b in pieces(whole, "text", 8 << 20):
                with no_cycle_search():
                    cells, n = np.unique(cells_of([tokens(t) for t in b.column("text").to_pylist()]), return_counts=True)
                if total is not None:
                    cells, at = np.unique(np.concatenate([total[0], cells]), return_inverse=True)
                    n = np.bincount(at, np.concatenate([total[1], n]), len(cells))
                total = cells, n
        if total is not None and len(total[0]):
            blocks, first = np.unique(total[0] // width, return_index=True)
            ends = [*first[1:], len(total[0])]
            idx, n = (total[0] % width).astype("<u4"), total[1].astype("<f8")
            yield pa.RecordBatch.from_arrays([pa.array(blocks.astype(np.int32)), *(pa.array([x[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()) for x in (idx, n))], names=["block", "idx", "n"])

    return arrays_summed(train.select("text").mapInArrow(run, "block int, idx binary, n binary"))


def neighbours(train: DataFrame) -> np.ndarray:
    """SUFFIX x NEAR counts: buckets beside each bucket of last bytes, over all texts."""
    memo = Memo(bucket)

    def cells(texts: list[list[bytes]]) -> np.ndarray:
        s, sizes = memo.of(texts)
        both = np.ones(len(s), bool)  # places whose token and next one are words of one text
        both[np.cumsum(sizes) - 1] = False
        both[np.cumsum(sizes)[sizes > 1] - 2] = False
        a, b = s[both], np.roll(s, -1)[both]
        return np.concatenate([b * NEAR + a % NEAR, a * NEAR + b % NEAR])

    out = np.zeros(SUFFIX * NEAR)
    for r in counted(train, cells, 64 * NEAR).collect():  # SUFFIX * NEAR numbers
        out[r["block"] * 64 * NEAR + np.frombuffer(r["idx"], "<u4").astype(np.int64)] = np.frombuffer(r["n"], "<f8")
    return out.reshape(SUFFIX, NEAR)


def k_means(y: np.ndarray, weight: np.ndarray, k: int, rounds: int = 30) -> np.ndarray:
    """Labels of weighted rows. Centres start from the heaviest row and then the row that is farthest, by weight, from
    the centres so far; nothing is random."""
    centres = [y[np.argmax(weight)]]
    for _ in range(k - 1):
        far = np.min([((y - c) ** 2).sum(axis=1) for c in centres], axis=0)
        centres.append(y[np.argmax(far * weight)])
    c = np.array(centres)
    for _ in range(rounds):
        label = ((y[:, None, :] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        for j in range(k):
            mine = label == j
            if weight[mine].sum() > 0:
                c[j] = np.average(y[mine], axis=0, weights=weight[mine])
    return label


def clusters(near: np.ndarray, dims: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Class and group of each bucket: k-means along the directions in which neighbours differ most."""
    mass = near.sum(axis=1)
    if not mass.any():
        return np.arange(SUFFIX) % SHARED, np.arange(SUFFIX) % GROUPS
    x = np.sqrt(near / np.maximum(mass, 1)[:, None])
    x = (x - np.average(x, axis=0, weights=mass)) * (mass / (mass + 50))[:, None]
    _, axes = np.linalg.eigh((x * mass[:, None]).T @ x)
    y = x @ axes[:, : -1 - dims : -1]
    return k_means(y, mass, SHARED), k_means(y[:, :4], mass, GROUPS)


def class_counts(train: DataFrame, shape: Shape) -> DataFrame:
    """block, idx, n: counts of (history, class) over all texts, ROW histories a row."""
    memo = Memo(shape.code)

    def cells(texts: list[list[bytes]]) -> np.ndarray:
        h, c = shape.of_texts(*memo.of(texts))
        return h * CLASSES + c

    return counted(train, cells, ROW * CLASSES)


def dense(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The histories of each row of a history table and their class counts."""
    for block, idx, n in zip(b.column("block").to_pylist(), b.column("idx").to_pylist(), b.column("n").to_pylist(), strict=True):
        seen = np.zeros(ROW * CLASSES)
        seen[np.frombuffer(idx, "<u4")] = np.frombuffer(n, "<f8")
        seen = seen.reshape(ROW, CLASSES)
        there = np.flatnonzero(seen.any(axis=1))
        yield block * ROW + there, seen[there]


def by_feature(cells: DataFrame, shape: Shape, part: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, float]]) -> tuple[np.ndarray, float]:
    """Sums, by feature, of a matrix that ``part`` gives for histories and their class counts (a row a history), and of
    a number. Tasks emit their part as arrays by block of BLOCK features, which are summed by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, total = np.zeros((shape.features, CLASSES)), 0.0
        for b in batches:
            for history, seen in dense(b):
                d, x = part(history, seen)
                total += x
                f = shape.rows(history)
                for k in range(3):
                    order = np.argsort(f[:, k], kind="stable")
                    rows, first = np.unique(f[order, k], return_index=True)
                    g[rows] += np.add.reduceat(d[order], first)
                g[-1] += d.sum(axis=0)
        rows = [i for i in range(0, shape.features, BLOCK) if g[i : i + BLOCK].any()]
        parts = [g[i : i + BLOCK].astype("<f4").tobytes() for i in rows]
        yield pa.RecordBatch.from_arrays([pa.array([*rows, -1], pa.int32()), pa.array([*parts, np.array([total]).tobytes()], pa.binary())], names=["block", "g"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        kind = "<f8" if pdf["block"].iloc[0] < 0 else "<f4"
        total = np.sum([np.frombuffer(x, kind) for x in pdf["g"]], axis=0, dtype=np.float64)
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "g": [total.tobytes()]})

    g, total = np.zeros((shape.features, CLASSES)), 0.0
    for r in cells.mapInArrow(run, "block int, g binary").groupBy("block").applyInPandas(add, "block int, g binary").collect():  # features * CLASSES numbers
        x = np.frombuffer(r["g"], "<f8")
        if r["block"] < 0:
            total = float(x[0])
        else:
            g[r["block"] : r["block"] + BLOCK] = x.reshape(-1, CLASSES)
    return g, total


def gradient(cells: DataFrame, shape: Shape, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Observed less expected class counts by feature, and the log likelihood."""
    shared = cells.sparkSession.sparkContext.broadcast(weights)

    def part(history: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, float]:
        logs = shape.log_softmax(shared.value, history)
        return seen - np.exp(logs) * seen.sum(axis=1, keepdims=True), float((seen * logs).sum())

    out = by_feature(cells, shape, part)
    shared.destroy()
    return out


def train_weights(cells: DataFrame, shape: Shape, updates: int = UPDATES) -> np.ndarray:
    """Full-batch updates, scaled per feature by its tokens (a bound on the curvature)."""
    seen, _ = by_feature(cells, shape, lambda history, seen: (seen, 0.0))
    w = np.zeros((shape.features, CLASSES))
    shares = seen[-1] + 0.5
    total = shares.sum()
    share = shares / total
    w[-1] = np.log(share)
    # A feature's own class counts, and those expected of it before the first update, bound its part of the curvature.
    bound = seen + seen.sum(axis=1)[:, None] * np.maximum(share, 1e-4)[None, :] + 20
    bound[-1] *= 2
    momentum = np.zeros_like(w)
    for _ in range(updates):
        g, _like = gradient(cells, shape, w + 0.7 * momentum)
        pull = RIDGE * w
        pull[-1] = 0
        step = RATE * (g - pull) / bound  # three features and the bias share a step
        momentum = 0.7 * momentum + np.clip(step, -1, 1)
        w += momentum
    return w.astype(np.float32)


def mixed(cells: DataFrame, shape: Shape, weights: np.ndarray, share: np.ndarray) -> float:
    """The share of the softmax, of SHARES, under which these histories' classes are likeliest."""
    shared = cells.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        like = np.zeros(len(SHARES))
        for b in batches:
            for history, seen in dense(b):
                p = np.exp(shape.log_softmax(shared.value, history))
                like += [(seen * np.log(a * p + (1 - a) * share)).sum() for a in SHARES]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(SHARES)), pa.int32()), pa.array(like)], names=["k", "like"])

    found = cells.mapInArrow(run, "k int, like double").groupBy("k").agg(F.sum("like").alias("like")).collect()
    shared.destroy()
    return SHARES[max(found, key=lambda r: (round(r["like"], 6), -r["k"]))["k"]] if any(r["like"] for r in found) else 0.0


def model(train: DataFrame) -> dict:
    """Counts (a table), N, V, the hot words' counts, class masses, shape, weights and their share."""
    spark = train.sparkSession
    counts = table(word_counts(train))
    n, v = (int(x or 0) for x in counts.agg(F.sum("c"), F.count("*")).first())
    top = counts.orderBy(F.desc("c"), "token").limit(HOT).collect()  # HOT words of MAX_WORD bytes at most
    hot = {bytes(r["token"]): r["c"] for r in top}
    own = [w for w in hot if w][:OWN]
    shape = Shape(n, own, *clusters(neighbours(train)))
    parts = max(8, shape.histories // (16 * ROW))
    aside = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(VALIDATE)) == 0  # copies of a text are on one side
    cells, check = (cut(class_counts(train.where(x), shape).repartition(parts, "block")) for x in (~aside, aside))
    weights = train_weights(cells, shape)

    def masses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(shape.code)
        for b in batches:
            c = shape.class_of(memo.of([b.column("token").to_pylist()])[0])
            m = np.bincount(c, b.column("c").to_numpy() + 1.0, CLASSES)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES), pa.int32()), pa.array(m)], names=["cls", "m"])

    mass = np.zeros(CLASSES)
    for r in counts.mapInArrow(masses, "cls int, m double").groupBy("cls").agg(F.sum("m").alias("m")).collect():
        mass[r["cls"]] = r["m"]
    mass[1 + OWN :] += 1
    share = mass / mass.sum()
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), v // JOIN_ROWS + 1)
    return {"counts": counts, "n": n, "v": v, "hot": hot, "mass": mass, "share": share, "shape": shape, "weights": weights, "softmax": mixed(check, shape, weights, np.maximum(share, 1e-12)), "floor": min(hot.values(), default=0) if len(hot) == HOT else 0, "partitions": partitions}


def score(docs: DataFrame, m: dict) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row."""
    n, v = m["n"], m["v"]
    prior = np.log(np.maximum(m["mass"], 1.0) / (n + v + 1))
    shared = docs.sparkSession.sparkContext.broadcast({k: m[k] for k in ("hot", "shape", "weights", "share", "softmax")})  # HOT words and features * CLASSES numbers
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = shared.value
        shape, weights, share = x["shape"], x["weights"], x["softmax"]
        memo = Memo(shape.code)
        logs = {w: math.log10(c + 1) for w, c in x["hot"].items()}
        for whole in batches:
            for b in pieces(whole, "text", 2 << 20):
                with no_cycle_search():
                    texts = [tokens(t.as_py()) for t in b.column("text")]
                    codes, sizes = memo.of(texts)
                    history, cls = shape.of_texts(codes, sizes)
                    which, at = np.unique(history, return_inverse=True)
                    shares = np.concatenate([np.log(share * np.exp(shape.log_softmax(weights, which[i : i + 4096])) + (1 - share) * np.maximum(x["share"], 1e-12)) for i in range(0, len(which), 4096)])
                    gain = np.add.reduceat(shares[at, cls] - prior[cls], np.cumsum(sizes) - sizes) / math.log(10)
                    base, known, rare, often, offsets = [], [], [], [], [0]
                    for t in texts:
                        s, k = 0.0, 0
                        for w, f in Counter(t).items():
                            if (lg := logs.get(w)) is None:
                                rare.append(w)
                                often.append(f)
                            else:
                                s += f * lg
                                k += f
                        base.append(s)
                        known.append(k)
                        offsets.append(len(rare))
                ends = pa.array(offsets, pa.int32())
                cols = [pa.array(sizes, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(gain, pa.float64()), pa.ListArray.from_arrays(ends, pa.array(rare, pa.binary())), pa.ListArray.from_arrays(ends, pa.array(often, pa.int64()))]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols], names=["doc_id", "n_tokens", "known", "base", "gain", "w", "f"])

    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, known long, base double, gain double, w array<binary>, f array<long>")
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    flat = rows.select("_row", "doc_id", "n_tokens", "known", "base", "gain", F.explode_outer(F.arrays_zip("w", "f")).alias("e")).select("_row", "doc_id", "n_tokens", "known", "base", "gain", F.col("e.w").alias("token"), F.col("e.f").alias("f"))
    # Texts without rare words get a key of their own (a space and digits are no word's key), so that they aren't dealt to one task.
    flat = flat.withColumn("token", F.coalesce("token", F.concat(F.lit(" ").cast("binary"), F.col("_row").cast("string").cast("binary"))))
    rest = m["counts"].where(F.col("c") <= m["floor"]).repartition(m["partitions"], "token")
    met = flat.repartition(m["partitions"], "token").join(rest.hint("shuffle_hash"), "token", "left")  # JOIN_ROWS counts or so as hash table; the many rows aren't sorted
    once = lambda c: F.first(c).alias(c)
    out = met.groupBy("_row").agg(*map(once, ("doc_id", "n_tokens", "known", "base", "gain")), F.sum(F.when(F.col("c").isNotNull(), F.col("f")).otherwise(0)).alias("more"), F.sum(F.coalesce(F.col("f") * F.log10(F.col("c") + 1), F.lit(0.0))).alias("add"))
    base = F.col("base") + F.col("add") - F.col("n_tokens") * math.log10(n + v + 1)
    return out.select("doc_id", "n_tokens", (F.col("known") + F.col("more")).alias("n_known"), base.alias("base_score"), (base + F.col("gain")).alias("score"))


def language_scores(docs: DataFrame) -> DataFrame:
    """The contract's rows: fold 2 of crc32(doc_id) mod 7 is held out."""
    held = crc_fold(F.col("doc_id"), 7) == 2
    m = model(docs.select("doc_id", "text").where(~held))
    return score(docs, m).select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(m["n"]).cast("long").alias("train_tokens"), "base_score", "score")
