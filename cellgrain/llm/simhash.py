"""SimHash near-duplicates: a tiled exact comparison of all fingerprints.

A text's fingerprint has a bit set where over half of its word shingles' hashes have it. Distinct fingerprints are
ranked by their population count and cut into tiles of TILE. Tiles whose population counts are further apart than the
radius are skipped; the others are compared in pairs, by numpy exclusive-or and bit counts. A pair of tiles reports a
spanning forest of the links that it finds (so a group of n near copies costs n links, not n squared), and the
components of all forests are those of all links. They are found by rounds of star contraction on the link table.

All pairs of unskipped tiles are compared, so the work grows with the square of the number of distinct fingerprints.

With a ``similarity`` the fingerprints only search candidates, at a wide radius. A pair of tiles reports the members of
each of its components, and every true link lies inside one of these. They are laid out by component, weighed by the
size of their shingle sets, and cut into blocks of BLOCK shingles; pairs of blocks that share a component compare the sets themselves, and only pairs
whose exact Jaccard index (of 64-bit shingle hashes) reaches the similarity enter the forest, so a false link neither
joins texts nor hides a true one.

Cases: a null text is empty; a text without words has fingerprint zero and is linked like any other; fewer words than
a shingle give one shingle; repeated rows share a fingerprint and a component; a null id is never a component's name
while there is another (null if not); extra columns are left out; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from cellgrain.llm.common import cut, lookup_join, prefix_sums
from cellgrain.llm.media import pieces

SHINGLE, SEED, RADIUS, TILE, ROWS = 3, 42, 2, 32_768, 64
#: Of the pipeline's stage: shingles of five words and an exact similarity of 0.8. Sets of that similarity have a cosine
#: of 0.89, so 15 % of the bits differ (39 of 256, standard deviation 6); the radius leaves room for over four deviations.
STAGE_SHINGLE, STAGE_BITS, STAGE_RADIUS, STAGE_SIMILARITY = 5, 256, 64, 0.8
#: Shingles in a block of the exact comparison (8 bytes each), and sets compared with one set at a time.
BLOCK, CHECKED = 1 << 19, 64


def shingle_hashes(text: str, size: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each word shingle, repeats included. bytes.lower() and bytes.split() see ASCII only."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        joined = [b" ".join(words)]
    else:
        joined = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    h = xxhash.xxh64_intdigest
    return np.array([h(x, seed) for x in joined], np.uint64)


def fingerprint(h: np.ndarray, bits: int = 64) -> bytes:
    """Big-endian fingerprint. Bits beyond 64 come from mixes of the same hashes."""
    out = b""
    for word in range(bits // 64):
        if word:
            h = (h ^ h >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15 + 2 * word)
            h = h ^ h >> np.uint64(29)
        ones = np.zeros(64, np.int64)
        for i in range(0, len(h), 8192):
            part = np.ascontiguousarray(h[i : i + 8192].astype(">u8"))
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out += np.packbits(2 * ones > len(h)).tobytes()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, bits: int = 64, digest: bool = False) -> DataFrame:
    """doc_id and fp of every text. With ``digest`` also size, the number of distinct shingles, and fp goes on with the
    16-byte digest of their hashes in order, so that only equal sets share it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole, "text", 4 << 20):
                fps, sizes = [], []
                for t in b.column("text"):
                    h = shingle_hashes(t.as_py() or "", shingle)
                    some = np.unique(h) if digest else h[:0]
                    fps.append(fingerprint(h, bits) + (xxhash.xxh3_128_digest(some.tobytes()) if digest else b""))
                    sizes.append(len(some))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps, pa.binary()), pa.array(sizes, pa.int64())], names=["doc_id", "fp", "size"])

    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, fp binary, size long")
    return out if digest else out.drop("size")


def with_sets(rows: DataFrame, shingle: int) -> DataFrame:
    """Puts hs, the distinct shingle hashes in order (8 bytes each), in the place of the column text."""
    names = [c for c in rows.columns if c != "text"]
    schema = T.StructType([*(rows.schema[c] for c in names), T.StructField("hs", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole, "text", 4 << 20):
                sets = [np.unique(shingle_hashes(t.as_py() or "", shingle)).tobytes() for t in b.column("text")]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(sets, pa.binary())], names=[*names, "hs"])

    return rows.mapInArrow(run, schema)


def order_of(fps: list[bytes], words: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of 64-bit words, and their order by the population count of the first ``words``."""
    x = np.frombuffer(b"".join(fps), np.uint64).reshape(len(fps), -1)
    return x, np.argsort(np.bitwise_count(x[:, :words]).sum(axis=1, dtype=np.int64), kind="stable")


def words_of(fps: list[bytes], words: int | None = None) -> np.ndarray:
    """Rows of 64-bit words, ordered by population count."""
    x, order = order_of(fps, words)
    return x[order]


def similar(sets_a: list[np.ndarray], sets_b: list[np.ndarray], similarity: float) -> Callable[[int, np.ndarray], np.ndarray]:
    """A check for forest(): which sets of the second list reach the Jaccard index with one of the first."""
    sizes = np.array([len(x) for x in sets_b])

    def check(i: int, js: np.ndarray) -> np.ndarray:
        mine = sets_a[i]
        out = np.minimum(sizes[js], len(mine)) >= similarity * np.maximum(sizes[js], len(mine))
        if not out.any() or not len(mine):
            return out
        js = js[out]
        theirs = np.concatenate([sets_b[j] for j in js])
        found = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
        both = np.add.reduceat(found, np.cumsum(sizes[js]) - sizes[js], dtype=np.int64)
        out[out] = both / (sizes[js] + len(mine) - both) >= similarity
        return out

    return check


def forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int, words: int | None = None, check: Callable[[int, np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[bytes, bytes]]:
    """A spanning forest of the links between two tiles, or within one. Only the first ``words`` are compared; with a
    ``check`` of a row of ``a`` and some of ``b``, only pairs that pass it are links."""
    keys_a, keys_b = a, b
    a, b = a[:, :words], b[:, :words]
    pop_a, pop_b = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (a, b))
    offset = 0 if same else len(a)
    label = np.arange(offset + len(b))
    words = a.shape[1]
    of_b = [np.ascontiguousarray(b[:, w]) for w in range(words)]
    for i in range(0, len(a), ROWS):
        rows = a[i : i + ROWS]
        low = np.searchsorted(pop_b, pop_a[i] - radius, "left")
        high = np.searchsorted(pop_b, pop_a[min(i + ROWS, len(a)) - 1] + radius, "right")
        if same:
            low = max(low, i)
        for at in range(low, high, 8192):
            to = min(at + 8192, high)
            # Of the words of a link one at least has no more than its share of the radius.
            few = np.bitwise_count(rows[:, :1] ^ of_b[0][None, at:to]) <= radius // words
            for w in range(1, words):
                few |= np.bitwise_count(rows[:, w : w + 1] ^ of_b[w][None, at:to]) <= radius // words
            r, c = np.nonzero(few)
            if same:
                r, c = r[at + c > i + r], c[at + c > i + r]
            if not len(r):
                continue
            if words > 1:
                near = np.bitwise_count(rows[r] ^ b[at + c]).sum(axis=1, dtype=np.int64) <= radius
                r, c = r[near], c[near]
            for k in np.unique(r):
                mine, hits = i + k, at + c[r == k]
                while len(hits := hits[label[offset + hits] != label[mine]]):
                    part, hits = (hits[:1], hits) if check is None else (hits[:CHECKED], hits[CHECKED:])
                    for hit in part if check is None else part[check(mine, part)]:
                        if label[offset + hit] != label[mine]:
                            yield keys_a[mine].tobytes(), keys_b[hit].tobytes()
                            label[label == label[offset + hit]] = label[mine]


def members(edges: list[tuple[bytes, bytes]], name: bytes) -> list[tuple[bytes, bytes]]:
    """Every vertex of a forest with ``name`` and a vertex of its tree."""
    root: dict[bytes, bytes] = {}

    def find(v: bytes) -> bytes:
        while root.setdefault(v, v) != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for a, b in edges:
        root[find(a)] = find(b)
    return [(v, name + find(v)) for v in list(root)]


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE, words: int | None = None, grouped: bool = False) -> DataFrame:
    """a, b: a spanning forest, per pair of tiles, of the distinct fingerprints at most ``radius`` bits apart in their
    first ``words`` of 64 bits. If ``grouped``, a is a member and b the name of a tree of it instead."""
    ranked, _ = prefix_sums(fps.select("pop", "fp", F.lit(1).cast("long").alias("one")), ["pop", "fp"], "one", "at")
    tiles = cut(ranked.withColumn("tile", F.expr(f"at div {tile}")).groupBy("tile").agg(F.min("pop").alias("low"), F.max("pop").alias("high"), F.collect_list("fp").alias("fps")))
    # Ranks follow population counts, so the tiles in reach of x are x and those after it, up to the last whose lowest
    # count is at most x.high + radius. Lowest counts are few (the bits of a fingerprint), so no join by a hot count is needed.
    ends = tiles.groupBy("low").agg(F.max("tile").alias("last")).agg(F.collect_list(F.struct("low", "last")).alias("ends"))
    last = F.array_max(F.transform(F.filter("ends", lambda e: e["low"] <= F.col("high") + radius), lambda e: e["last"]))
    pairs = tiles.select(F.col("tile").alias("x"), "high").crossJoin(F.broadcast(ends)).select("x", F.explode(F.sequence("x", last)).alias("y"))  # one row
    both = pairs.join(tiles.select(F.col("tile").alias("x"), F.col("fps").alias("fx")), "x").join(tiles.select(F.col("tile").alias("y"), F.col("fps").alias("fy")), "y")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y, fx, fy in zip(*(batch.column(k) for k in ("x", "y", "fx", "fy")), strict=True):
                a = words_of(fx.as_py(), words)
                b = a if x.as_py() == y.as_py() else words_of(fy.as_py(), words)
                found = list(forest(a, b, x.as_py() == y.as_py(), radius, words))
                if grouped:
                    found = members(found, b"%d|%d|" % (x.as_py(), y.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.binary()) for i in (0, 1)], names=["a", "b"])

    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return both.repartition(n).mapInArrow(compare, "a binary, b binary")


def true_links(candidates: DataFrame, groups: DataFrame, docs: DataFrame, shingle: int, radius: int, words: int, similarity: float, block: int = BLOCK) -> DataFrame:
    """a, b: a spanning forest, per pair of blocks, of the links inside the candidates' groups (links() with
    ``grouped``) whose sets have at least the Jaccard index ``similarity``. ``groups`` has fp, size and the key of one of
    its texts, ``docs`` key and text: sets are made of the candidates' texts only, when their blocks are known."""
    salt = F.monotonically_increasing_id()
    named = lookup_join(groups, candidates.select(F.col("a").alias("fp"), F.col("b").alias("root")), ["fp"], salt, "inner")
    ranked, _ = prefix_sums(named.select("root", "fp", "key", "size"), ["root", "fp"], "size", "at")
    ranked = cut(ranked.select("root", "fp", "key", F.expr(f"at div {block}").alias("mine")))
    spans = ranked.groupBy("root").agg(F.min("mine").alias("low"), F.max("mine").alias("high"))
    # Only keys are laid out; a set goes once to every pair of blocks that its component has with its own block.
    spread = lookup_join(ranked, spans, ["root"], salt).select("fp", "key", "mine", F.explode(F.sequence("low", "high")).alias("other"))
    places = spread.select("fp", "key", F.struct(F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine").alias("place"))
    places = places.groupBy("key").agg(F.first("fp").alias("fp"), F.collect_set("place").alias("places"))
    sets = with_sets(lookup_join(docs.select("key", "text"), places, ["key"], salt, "inner").drop("key"), shingle)
    held = sets.select("fp", "hs", F.explode("places").alias("at")).groupBy("at.x", "at.y", "at.mine", "fp").agg(F.first("hs").alias("hs"))

    def ordered(rows: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
        x, order = order_of(rows.column("fp").to_pylist(), words)
        sets = rows.column("hs").to_pylist()
        return x[order], [np.frombuffer(sets[k], np.uint64) for k in order]

    def compare(pair: pa.Table) -> pa.Table:
        x, y = pair.column("x")[0].as_py(), pair.column("y")[0].as_py()
        mine = np.array(pair.column("mine"))
        found = []
        # A set of over a block leaves numbers without sets behind it.
        if (mine == x).any() and (mine == y).any():
            a, sets_a = ordered(pair.filter(pa.array(mine == x)))
            b, sets_b = (a, sets_a) if x == y else ordered(pair.filter(pa.array(mine == y)))
            found = list(forest(a, b, x == y, radius, words, similar(sets_a, sets_b, similarity)))
        return pa.table([pa.array([p[i] for p in found], pa.binary()) for i in (0, 1)], names=["a", "b"])

    return held.groupBy("x", "y").applyInArrow(compare, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """v, root: every vertex of the edges (a, b) with the least vertex of its component. Large and small stars in
    turn until nothing changes, however many rounds that takes; each round is checkpointed."""
    salt = F.monotonically_increasing_id()
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    last, state = None, ()
    while state != last:
        last = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = lookup_join(both, low, ["u"], salt).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(large.where("u <> v").distinct())
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        small = lookup_join(e, low, ["u"], salt)
        e = cut(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        state = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return e.select(F.col("u").alias("v"), F.col("v").alias("root")).unionByName(e.select("v", F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = 64, radius: int = RADIUS, tile: int = TILE, similarity: float | None = None) -> DataFrame:
    """doc_id, fp, component_id of every row: the least id that links reach. With a ``similarity``, fingerprints (here
    followed by the digest of the shingle set) at most ``radius`` apart are candidates, and links are checked exactly;
    doc_id is then a struct whose field key is never null and equal for equal texts only."""
    rows = cut(fingerprints(docs, shingle, bits, similarity is not None))
    pop = F.aggregate(F.sequence(F.lit(1), F.lit(bits // 64)), F.lit(0), lambda a, i: a + F.bit_count(F.conv(F.hex(F.substring("fp", i * 8 - 7, F.lit(8))), 16, -10).cast("long")))
    size = [F.first("size").alias("size")] if similarity is not None else []
    groups = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"), *size).withColumn("pop", pop))
    edges = links(groups, radius, tile, bits // 64, similarity is not None)
    if similarity is not None:
        edges = true_links(edges, groups.select("fp", "size", "first.key"), docs.select("doc_id.key", "text"), shingle, radius, bits // 64, similarity)
    roots = cut(components(edges))
    salt = F.monotonically_increasing_id()
    linked = lookup_join(groups, roots.withColumnRenamed("v", "fp"), ["fp"], salt, "inner")
    names = linked.groupBy("root").agg(F.min("first").alias("name"))
    named = cut(lookup_join(linked, names, ["root"], salt).select("fp", "name"))
    known = cut(lookup_join(groups, named.withColumn("hit", F.lit(True)), ["fp"], salt).select("fp", "n", "first", F.when(F.col("hit"), F.col("name")).otherwise(F.col("first")).alias("component_id")))
    # A fingerprint of one row is that row; only shared ones go back to their rows.
    single = known.where("n = 1").select(F.col("first").alias("doc_id"), "fp", "component_id")
    shared = lookup_join(rows.select("doc_id", "fp"), known.where("n > 1").select("fp", "component_id"), ["fp"], salt, "inner")
    return single.unionByName(shared.select("doc_id", "fp", "component_id"))


def near_copies(docs: DataFrame) -> DataFrame:
    """The contract's rows."""
    return near_duplicates(docs).select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def without_copies(docs: DataFrame, shingle: int = STAGE_SHINGLE, bits: int = STAGE_BITS, radius: int = STAGE_RADIUS, similarity: float = STAGE_SIMILARITY) -> DataFrame:
    """One row of each component of ``docs``: the one with the least id, null ids last. Rows are told apart by a digest
    of id and text, so rows that share an id but not a text are judged apart; of rows that share both, one stays."""
    key = next(n for n in (f"_key{k}" for k in range(len(docs.columns) + 1)) if n not in docs.columns)
    keyed = docs.withColumn(key, F.md5(F.to_json(F.struct("doc_id", "text"))))
    rows = keyed.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(key).alias("key")).alias("doc_id"), "text")
    found = near_duplicates(rows, shingle, bits, radius, similarity=similarity)
    found = cut(found.groupBy(F.col("doc_id.key").alias(key)).agg(F.first(F.col("doc_id.key") == F.col("component_id.key")).alias("stays"), F.count("*").alias("n")).where("not stays or n > 1"))
    salt = F.monotonically_increasing_id()
    kept = lookup_join(keyed, found.select(key), [key], salt, "left_anti")
    again = found.where("stays").select(key)
    if not again.isEmpty():
        kept = kept.unionByName(lookup_join(keyed, again, [key], salt, "inner").dropDuplicates([key]))
    return kept.drop(key)
