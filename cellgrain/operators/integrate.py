"""Batch integration by soft clustering and ridge regression of batch effects, after the published algorithm."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cellgrain.operators.embed import pca
from cellgrain.sources.layers import stored


def harmony_rounds(emb: DataFrame, batch: str, k: int = 10, theta: float = 2.0, lam: float = 1.0, sigma: float = 0.1, rounds: int = 10, seed: int = 42, tolerance: float = 1e-4, blocks: int = 5, passes: int = 1) -> tuple[DataFrame, list[float]]:
    """(cell_id, batch, vec) with batch effects removed, and the objective of each round.

    Each round assigns points softly to unit-length centres, less so where their batch is over-represented, and fits an
    intercept and a batch effect for each cluster by ridge regression. Points are dealt to ``blocks`` by a hash of their id, and a
    block is reassigned against the counts of all other blocks as they are by then; ``passes`` times a round, with new
    centres after each. The objective is the points' distance to their centres, plus sigma times the entropy of
    assignments, plus sigma * theta times the divergence of clusters' batches from all batches. A round that would raise it isn't
    taken and ends the search, as does one that lowers it by less than ``tolerance`` of its size: the list never rises.

    Only sums leave the tasks: k * batches * dimensions numbers, which Spark adds up. A pass reads each block once (state
    is stored by block), and assignments aren't stored: they follow from the centres and the block's weights.

    Cases: an empty table gives an empty one and no rounds; a null batch is a batch of its own; rows without a vector are an error."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = emb.select("cell_id", F.coalesce(F.col(batch).cast("string"), F.lit("")).alias("batch"), "vec")
    rows = stored(rows.withColumns({"orig": F.col("vec"), "block": F.pmod(F.xxhash64("cell_id", F.lit(seed)), F.lit(blocks)).cast("int")}), by="block")
    counted = rows.groupBy("batch").agg(F.count("*").alias("n")).orderBy("batch").collect()  # a row a batch
    if not counted:
        return rows.select("cell_id", "batch", "vec"), []
    names = [r["batch"] for r in counted]
    code = {b: i for i, b in enumerate(names)}
    share = np.array([r["n"] for r in counted], float)
    share /= share.sum()
    fit = KMeans(k=k, seed=seed, featuresCol="f").fit(rows.select(array_to_vector("vec").alias("f")))
    centres = np.array([c / (np.linalg.norm(c) or 1) for c in fit.clusterCenters()])
    k, dim = centres.shape  # fewer centres than asked for, where there are fewer distinct points
    a, b, c = k * len(names), k * len(names) * (1 + dim), k * len(names) * (1 + dim) + k * dim

    def unpack(batch_: pa.RecordBatch, y: np.ndarray, weights: np.ndarray):
        """Places, unit vectors, originals, batches, blocks, similarities and assignments of a batch's rows."""
        v, o = (batch_.column(x).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch_.num_rows, -1) for x in ("vec", "orig"))
        at, block = np.array([code[x] for x in batch_.column("batch").to_pylist()], int), np.array(batch_.column("block").to_pylist(), int)
        u = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        near = u @ y.T
        z = -2 * (1 - near) / sigma
        r = np.exp(z - z.max(axis=1, keepdims=True)) * weights[block, :, at]
        return u, o, at, block, near, r / np.maximum(r.sum(axis=1, keepdims=True), 1e-300)

    def sums(y: np.ndarray, weights: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((blocks, c + 1))
            for found in batches:
                if not found.num_rows:
                    continue
                u, o, at, block, near, r = unpack(found, y, weights)
                cost = (r * (2 * (1 - near) + sigma * np.log(np.maximum(r, 1e-300)))).sum(axis=1)
                for i in np.unique(block):
                    mass, orig = total[i, :a].reshape(k, -1), total[i, a:b].reshape(k, -1, dim)  # views
                    mine = block == i
                    for j in np.unique(at[mine]):
                        here = mine & (at == j)
                        mass[:, j] += r[here].sum(axis=0)
                        orig[:, j] += r[here].T @ o[here]
                    total[i, b:c] += (r[mine].T @ u[mine]).ravel()
                    total[i, c] += cost[mine].sum()
            flat = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(flat, pa.int64()), pa.array(total.ravel()[flat])], names=["at", "x"])

        return run

    def apply(y: np.ndarray, weights: np.ndarray, effect: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for found in batches:
                if not found.num_rows:
                    continue
                _, o, at, _, _, r = unpack(found, y, weights)
                new = o.copy()
                for j in np.unique(at):
                    new[at == j] -= r[at == j] @ effect[:, j]
                vec = pa.ListArray.from_arrays(pa.array(np.arange(0, new.size + 1, dim), pa.int32()), pa.array(new.ravel()))
                yield pa.RecordBatch.from_arrays([found.column("cell_id"), found.column("batch"), vec, found.column("orig"), found.column("block")], names=["cell_id", "batch", "vec", "orig", "block"])

        return run

    def total(df: DataFrame, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
        flat = np.zeros(blocks * (c + 1))
        for r in df.mapInArrow(sums(y, weights), "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect():
            flat[r["at"]] = r["x"]
        return flat.reshape(blocks, -1)

    def excess(mass: np.ndarray) -> np.ndarray:
        return (mass + 1) / (mass.sum(axis=1, keepdims=True) * share + 1)

    kind = dict(rows.dtypes)["cell_id"]
    state, history = rows, []
    by_block = total(state, centres, np.ones((blocks, k, len(names))))
    for _ in range(rounds):
        for _ in range(passes):
            used, weights = centres, np.ones((blocks, k, len(names)))
            for i in range(blocks):
                others = by_block[np.arange(blocks) != i, :a].sum(axis=0).reshape(k, -1)
                weights[i] = excess(others) ** -theta
                by_block[i] = total(state.where(F.col("block") == i), used, weights)[i]
            unit = by_block[:, b:c].sum(axis=0).reshape(k, dim)
            centres = unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)
        observed, orig = by_block[:, :a].sum(axis=0).reshape(k, -1), by_block[:, a:b].sum(axis=0).reshape(k, -1, dim)
        objective = float(by_block[:, c].sum() + sigma * theta * (observed * np.log(excess(observed))).sum())
        if history and objective > history[-1]:
            break
        # Ridge with an unpenalised intercept: cluster mean, then each batch's shrunk deviation.
        effect = np.zeros_like(orig)
        for q in range(k):
            design = np.zeros((len(names) + 1, len(names) + 1))
            design[0, 0] = max(observed[q].sum(), 1e-12)
            design[0, 1:] = design[1:, 0] = observed[q]
            design[1:, 1:] = np.diag(observed[q] + lam)
            effect[q] = np.linalg.solve(design, np.vstack([orig[q].sum(axis=0), orig[q]]))[1:]
        state = stored(state.mapInArrow(apply(used, weights, effect), f"cell_id {kind}, batch string, vec array<double>, orig array<double>, block int"), by="block")
        history.append(objective)
        if len(history) > 1 and history[-2] - objective < tolerance * abs(history[-2]):
            break
    return state.select("cell_id", "batch", "vec"), history


def harmony(emb: DataFrame, batch: str, **options) -> DataFrame:
    """The table of harmony_rounds()."""
    return harmony_rounds(emb, batch, **options)[0]


def integrate(emb: DataFrame, batch: str, n_comps: int = 50, **options) -> tuple[DataFrame, dict]:
    """PCA, then harmony; and the parameters as a record."""
    reduced, variance = pca(emb, n_comps)
    out, history = harmony_rounds(reduced.join(emb.select("cell_id", batch), "cell_id"), batch, **options)
    return out, {"n_comps": str(n_comps), "batch_key": batch, "explained_variance": str(sum(variance)), "objective": ",".join(f"{x:.6g}" for x in history), **{k: str(v) for k, v in options.items()}}
