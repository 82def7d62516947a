"""Importance resampling: draws the documents whose words look most like those of a target collection.

Words and runs of words are counted in hashed buckets, once for the corpus and once for the target. A bucket's gain is
the scaled logarithm of its share in the target over its share in the corpus; a document's weight is the mean gain of
its features. Gumbel noise by hash of the id is added (the highest scores are then a draw without replacement in
proportion to the exponentials of the weights), and the highest scores are drawn.

The cutoff is found by a weighted median of medians. Every partition of the (sorted, checkpointed) keys reports how many
of them remain and their median; the median of these, weighted by what remains, is the pivot: at least a quarter of the
remaining keys lies on either side of it, whatever the partitions hold. A round counts both sides, drops the one without
the cutoff and takes the medians of the other from the same job. Only a row a partition reaches the driver, and the
last FEW keys. The winners alone are sorted.

Cases: a null text is empty; a document without words has weight 0 and isn't drawn; repeated rows are scored one by
one, and ties of score and id are settled by place; a null id hashes as an empty one and comes last among ties; extra
columns are left out; an empty corpus gives an empty table, an empty target gives gains all the same.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cellgrain.llm.common import cut, prefix_sums
from cellgrain.llm.media import pieces
from cellgrain.llm.shards import crc32_sql

GRAMS, BUCKETS, LEAST_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, 2024
#: Words whose buckets a worker keeps, and keys that the driver may sort at the end of the search.
MEMO, FEW = 1 << 18, 1024
#: A-Z to a-z; digits, a-z and all bytes beyond ASCII stay, the rest parts words.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256))
KEY = ["_low", "_id", "_place"]


class Buckets(dict):
    """The bucket of a feature, as bytes."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        found = zlib.crc32(feature) % self.buckets
        if len(self) < MEMO:
            self[feature] = found
        return found


def features(text: str | None, grams: int, bucket: Buckets) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every run of one to ``grams`` words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()
    found = [np.fromiter(map(bucket.__getitem__, words), np.int64, len(words))]
    for n in range(2, grams + 1):
        found.append(np.array([bucket[b" ".join(words[i : i + n])] for i in range(len(words) - n + 1)], np.int64))
    return len(words), np.concatenate(found)


def bucket_counts(texts: DataFrame, grams: int, buckets: int) -> np.ndarray:
    """Features by bucket. A task sends a row a bucket at most, and so does the driver's sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for whole in batches:
            for b in pieces(whole, "text", 4 << 20):
                found = [features(t.as_py(), grams, bucket)[1] for t in b.column("text")]
                total += np.bincount(np.concatenate(found), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each of B buckets."""
    b = len(corpus)
    over, under = (target + 1.0) * (float(corpus.sum()) + b), (corpus + 1.0) * (float(target.sum()) + b)
    return np.array([math.floor(1000 * math.log(x / y)) for x, y in zip(over.tolist(), under.tolist(), strict=True)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, grams: int) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = Buckets(len(gain))
        for whole in batches:
            for b in pieces(whole, "text", 4 << 20):
                found = [features(t.as_py(), grams, bucket) for t in b.column("text")]
                mean = [int(gain[x].sum()) // len(x) if len(x) else 0 for _, x in found]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([n for n, _ in found], pa.int64()), pa.array([len(x) for _, x in found], pa.int64()), pa.array(mean, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from 32 bits of the id's digest."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def beyond(key: tuple[int, ...]) -> Column:
    """Rows whose key comes after ``key``."""
    out = F.lit(False)
    for name, value in list(zip(KEY, key, strict=True))[::-1]:
        out = (F.col(name) > F.lit(value)) | ((F.col(name) == F.lit(value)) & out)
    return out


def medians(keys: DataFrame, pivot: tuple[int, ...] | None) -> tuple[list[tuple], list[tuple]]:
    """(remaining, their median) of each partition, up to the pivot and beyond it. Partitions are sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.stack([b.column(c).to_numpy() for c in KEY], axis=1) for b in batches if b.num_rows]
        if parts:
            x, out = np.concatenate(parts), []
            after = np.zeros(len(x), bool)
            if pivot:
                for c in (2, 1, 0):
                    after = (x[:, c] > pivot[c]) | ((x[:, c] == pivot[c]) & after)
            at = len(x) - int(after.sum())
            for side, rows in ((0, x[:at]), (1, x[at:])):
                if len(rows):
                    out.append((side, len(rows), *rows[(len(rows) - 1) // 2].tolist()))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["side", "n", *KEY])

    found = keys.mapInArrow(run, "side long, n long, " + ", ".join(f"{c} long" for c in KEY)).collect()  # two rows a partition
    return tuple([(r["n"], tuple(r[c] for c in KEY)) for r in found if r["side"] == side] for side in (0, 1))


def cutoff(keys: DataFrame, k: int, few: int = FEW) -> tuple[int, ...]:
    """The k-th smallest key (k from 1 on); partitions of ``keys`` are sorted."""
    remaining = keys
    parts, _ = medians(remaining, None)
    while (total := sum(n for n, _ in parts)) > few:
        seen = 0
        for n, pivot in sorted(parts, key=lambda p: p[1]):
            seen += n
            if 2 * seen >= total:
                break
        low, high = medians(remaining, pivot)
        below = sum(n for n, _ in low)
        if k <= below:
            remaining, parts = remaining.where(~beyond(pivot)), low
        else:
            remaining, parts, k = remaining.where(beyond(pivot)), high, k - below
    return sorted(tuple(r) for r in remaining.select(*KEY).collect())[k - 1]


def resample(docs: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null if not drawn) of every row of ``docs``."""
    gain = gains(bucket_counts(docs, grams, buckets), bucket_counts(target, grams, buckets))
    scored = weights(docs, gain, grams).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    last = F.lit((1 << 63) - 1)
    rows = cut(scored.withColumns({"_low": -F.col("score"), "_id": F.coalesce(F.col("doc_id").cast("long"), last), "_place": F.monotonically_increasing_id()}).sortWithinPartitions(*KEY))
    fit = F.col("n_words") >= least_words
    k = percent * rows.where(fit).count() // 100
    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    if not k:
        return rows.select(*names, F.lit(None).cast("long").alias("rank"))
    drawn = fit & ~beyond(cutoff(rows.where(fit).select(*KEY), k))
    ranked, _ = prefix_sums(rows.where(drawn).withColumn("_one", F.lit(1).cast("long")), KEY, "_one", "_at")
    return ranked.select(*names, (F.col("_at") + 1).alias("rank")).unionByName(rows.where(~drawn).select(*names, F.lit(None).cast("long").alias("rank")))


def resampled_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's rows."""
    return resample(docs, benchmark).select("doc_id", "n_features", "weight", "score", "rank")


def sql() -> str:
    words = lambda t: rf"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM {t}"
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row_id, doc_id, w FROM (SELECT doc_id, {words("documents").replace(" FROM", " AS w FROM")})),
c AS MATERIALIZED (SELECT row_id, word, count(*) AS n FROM (SELECT row_id, unnest(w) AS word FROM d) GROUP BY ALL),
t AS MATERIALIZED (SELECT word, count(*) AS n FROM (SELECT unnest({words("benchmark").replace(" FROM", ") AS word FROM")}) GROUP BY ALL),
v AS MATERIALIZED (SELECT word, {crc32_sql("word")} % {BUCKETS} AS b FROM (SELECT word FROM c UNION SELECT word FROM t)),
s AS (SELECT b, sum(n) AS n FROM c JOIN v USING (word) GROUP BY b), q AS (SELECT b, sum(n) AS n FROM t JOIN v USING (word) GROUP BY b),
g AS (SELECT s.b, CAST(floor(1000 * ln(CAST(coalesce(q.n, 0) + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM s) + {BUCKETS} AS DOUBLE) / (CAST(s.n + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM q) + {BUCKETS} AS DOUBLE)))) AS BIGINT) AS gain FROM s LEFT JOIN q USING (b)),
w AS (SELECT row_id, sum(n) AS n, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight FROM c JOIN v USING (word) JOIN g USING (b) GROUP BY row_id),
h AS (SELECT row_id, doc_id, coalesce(n, 0) AS n, coalesce(weight, 0) AS weight, CAST(CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS DOUBLE) AS h FROM d LEFT JOIN w USING (row_id)),
x AS MATERIALIZED (SELECT row_id, doc_id, n, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM h),
k AS (SELECT row_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM x WHERE n >= {LEAST_WORDS})
SELECT doc_id, CAST(n AS BIGINT) AS n_features, weight, score, rank FROM x LEFT JOIN (SELECT * FROM k WHERE rank <= (SELECT {PERCENT} * count(*) // 100 FROM k)) USING (row_id)"""
