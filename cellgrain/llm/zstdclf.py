"""Quality classifier by compression: a zstandard dictionary of good and one of bad labelled texts.

A text is compressed with either dictionary, in blocks so that the dictionary is near the whole of a long text. The
difference of both sizes over their sum is the only input of a logistic calibration. Labels, languages, sources and
ids are never inputs of a score.

Fitted on a bounded sample of labelled rows: SAMPLE_ROWS of each class, those with the least hash of their id, of at
most SAMPLE_TEXT_BYTES each, in that order as far as SAMPLE_BYTES go. Of each class three texts of four make the
dictionary, the others calibrate, weighted to the class shares of all labelled training rows. Every row is scored over
its whole text.

Cases: null texts count as empty, an empty text has difference 0; a null label is no label; a document labelled both
ways counts as bad; repeated rows get equal scores; without labelled texts of both classes every score is 0.5; where the
library can't train on so few texts, their last bytes are the dictionary as they are (none where there are no bytes);
extra columns pass through; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cellgrain.llm.common import crc_fold
from cellgrain.llm.media import pieces

SAMPLE_ROWS, SAMPLE_TEXT_BYTES, SAMPLE_BYTES = 2000, 128 << 10, 24 << 20
DICT_BYTES, LEVEL, BLOCK, THRESHOLD = 64 << 10, 3, 4096, 0.3


def dictionary(texts: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary; the raw texts' end where there are too few to train one."""
    blocks = [x[i : i + BLOCK] for x in texts for i in range(0, len(x), BLOCK)]
    try:
        return zstandard.train_dictionary(size, blocks, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(texts)[-size:]


class Sizes:
    """Compressed sizes of a text under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.with_dict = []
        for d in (good, bad):
            data = zstandard.ZstdCompressionDict(d) if d else None
            if data is not None:
                data.precompute_compress(level=LEVEL)
            self.with_dict.append(zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False) if data else zstandard.ZstdCompressor(level=LEVEL))

    def difference(self, text: bytes) -> float:
        """(bad - good) / (bad + good): above 0 if the good dictionary fits better."""
        g = b = 0
        for i in range(0, len(text), BLOCK):
            part = text[i : i + BLOCK]
            g += len(self.with_dict[0].compress(part))
            b += len(self.with_dict[1].compress(part))
        return (b - g) / (b + g) if b + g else 0.0


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept of a logistic regression, by Newton steps on scaled inputs."""
    scale = float(np.sqrt((x * x).mean())) or 1.0
    a = np.column_stack([x / scale, np.ones_like(x)])
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + ridge * w
        hess = (a * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ a + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, train: Column, label: str = "quality", rows: int = SAMPLE_ROWS) -> dict | None:
    """The model: both dictionaries, slope and intercept; None without labels of both classes. ``train`` is a
    condition on doc_id."""
    known = labels.where(train & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("_y"))
    counts = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    order = F.xxhash64("doc_id")
    # `rows` ids of each class, by construction: small enough to broadcast.
    picked = known.where("_y = 0").orderBy(order, "doc_id").limit(rows).unionByName(known.where("_y = 1").orderBy(order, "doc_id").limit(rows))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns({"_size": F.octet_length("text"), "_text_hash": F.xxhash64("text")}).where(F.col("_size") <= SAMPLE_TEXT_BYTES)
    # Ids may repeat: their distinct texts by hash again, 4 * rows in all. Sizes are summed before any text moves.
    sizes = texts.drop("text").join(F.broadcast(picked), "doc_id").distinct().orderBy(order, "doc_id", "_text_hash").limit(4 * rows)
    so_far = F.sum("_size").over(Window.partitionBy("_y").orderBy(order, "doc_id", "_text_hash"))
    few = sizes.withColumn("_so_far", so_far).where(F.col("_so_far") <= SAMPLE_BYTES).select("doc_id", "_text_hash", "_y")
    few = texts.join(F.broadcast(few), ["doc_id", "_text_hash"]).dropDuplicates(["doc_id", "_text_hash"])
    sample = sorted(((r["doc_id"], r["_y"], r["text"].encode()) for r in few.collect()), key=lambda r: (r[0], r[2]))
    of = {y: [t for _, k, t in sample if k == y] for y in (0, 1)}
    if not of[0] or not of[1]:
        return None
    learn = {y: [t for i, t in enumerate(v) if i % 4] for y, v in of.items()}
    held = {y: v[::4] for y, v in of.items()}
    good, bad = dictionary(learn[1]), dictionary(learn[0])
    sizes = Sizes(good, bad)
    x = np.array([sizes.difference(t) for y in (0, 1) for t in held[y]])
    y = np.repeat([0.0, 1.0], [len(held[0]), len(held[1])])
    share = counts[1] / (counts[0] + counts[1])
    weight = np.where(y == 1, share / len(held[1]), (1 - share) / len(held[0])) * len(y)
    slope, intercept = calibrate(x, y, weight)
    return {"good": good, "bad": bad, "slope": slope, "intercept": intercept}


def score(df: DataFrame, model: dict | None, text: str = "text", out: str = "score") -> DataFrame:
    """Adds ``out``: the chance of a good label, from the whole text."""
    schema = T.StructType([f for f in df.schema.fields if f.name != out] + [T.StructField(out, T.DoubleType())])
    names = [f.name for f in df.schema.fields if f.name != out]
    if model is None:
        return df.select(*names, F.lit(0.5).alias(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model["good"], model["bad"])
        for whole in batches:
            for b in pieces(whole, text):
                x = [sizes.difference(v.as_py().encode() if v.is_valid else b"") for v in b.column(text)]
                s = [1 / (1 + math.exp(-max(-30.0, min(30.0, model["slope"] * d + model["intercept"])))) for d in x]
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in names), pa.array(s, pa.float64())], names=[*names, out])

    return df.select(*names).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's rows: fold 0 of crc32(doc_id) mod 5 is held out."""
    model = fit(docs, labels, crc_fold(F.col("doc_id"), 5) != 0)
    scored = score(docs.select("doc_id", "text"), model).drop("text")
    return scored.select("doc_id", (crc_fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
