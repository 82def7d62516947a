"""Communities of a neighbour graph by modularity, at several resolutions in the same jobs.

Levels of local moves and contraction. A superstep looks at the links of every node into each neighbouring community, and
half of the nodes (by a hash that changes from step to step) move to where modularity gains most, so neighbours don't swap
for ever. Steps go on until modularity stands still, and the best one counts. Then communities become
nodes, their links are summed, and the next level begins, until a level moves nothing. Links hold whole
numbers, so sums are exact and a repeated run gives the same communities.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cellgrain.operators import joins
from cellgrain.operators.joins import lookup
from cellgrain.sources.layers import stored

RESOLUTIONS = (0.5, 1.0, 1.5)
#: Least gain of modularity for which another superstep is taken, and steps in a row that may lack it.
GAIN, PATIENCE = 4e-3, 2


def links_of(edges: DataFrame, resolutions: tuple[float, ...]) -> DataFrame:
    """gamma, src, dst, w: the undirected graph in both directions, weight 1, once for each resolution."""
    e = edges.where("src <> dst").select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).distinct()
    both = e.select(F.explode(F.array(F.struct(F.col("u").alias("src"), F.col("v").alias("dst")), F.struct(F.col("v").alias("src"), F.col("u").alias("dst")))).alias("e")).select("e.*")
    return both.select(F.explode(F.array(*(F.lit(float(g)) for g in resolutions))).alias("gamma"), "src", "dst", F.lit(1.0).alias("w"))


def look(links: DataFrame, state: DataFrame, rows: int, whole: float) -> DataFrame:
    """Of every node (gamma, node, community, k, loop): inside, its links to its own community; best, the community with
    the largest gain (ties: the least); gain, over staying. ``whole`` is the sum of all links."""
    tot = state.groupBy("gamma", F.col("community").alias("c")).agg(F.sum("k").alias("tot"), F.count("*").alias("n"))
    to = lookup(links.where("src <> dst"), state.select("gamma", F.col("node").alias("dst"), F.col("community").alias("c")), ["gamma", "dst"], ["src"], rows=rows)
    seen = to.select("gamma", F.col("src").alias("node"), "c", "w").unionByName(state.select("gamma", "node", F.col("community").alias("c"), F.lit(0.0).alias("w")))
    seen = seen.groupBy("gamma", "node", "c").agg(F.sum("w").alias("kc"))
    # A table of nodes is small as a file: without the hint Spark may send it through the driver, whatever its rows.
    seen = lookup(seen, tot, ["gamma", "c"], ["node"], rows=rows).join(state if rows <= joins.BROADCAST_ROWS else state.hint("merge"), ["gamma", "node"])
    own = F.col("c") == F.col("community")
    value = F.col("kc") - F.col("gamma") * F.col("k") * (F.col("tot") - F.when(own, F.col("k")).otherwise(0.0)) / whole
    seen = seen.withColumn("value", value)
    # Nobody moves to a node that is alone and has a larger name: two of these would change places.
    free = own | (F.col("n") > 1) | (F.col("c") < F.col("community"))
    best = seen.groupBy("gamma", "node").agg(
        F.min(F.when(free, F.struct((-F.col("value")).alias("v"), F.col("c").alias("c")))).alias("b"), F.max(F.when(own, F.col("value"))).alias("stay"), F.max(F.when(own, F.col("kc"))).alias("inside"),
        F.first("community").alias("community"), F.first("k").alias("k"), F.first("loop").alias("loop"),
    )
    return best.select("gamma", "node", "community", "k", "loop", "inside", F.col("b.c").alias("best"), (-F.col("b.v") - F.col("stay")).alias("gain"))


def quality(looked: DataFrame, whole: float) -> dict[float, float]:
    """Modularity by resolution: a row a resolution."""
    c = looked.groupBy("gamma", "community").agg(F.sum(F.col("inside") + F.col("loop")).alias("inside"), F.sum("k").alias("tot"))
    rows = c.groupBy("gamma").agg((F.sum("inside") / whole).alias("a"), F.sum(F.pow(F.col("tot") / whole, F.lit(2.0))).alias("b")).collect()
    return {r["gamma"]: r["a"] - r["gamma"] * r["b"] for r in rows}


def level(links: DataFrame, rows: int, whole: float, seed: int) -> tuple[DataFrame, dict[float, float]]:
    """gamma, node, community after the local moves of one level, and the modularity of each resolution."""
    loops = F.sum(F.when(F.col("src") == F.col("dst"), F.col("w")).otherwise(0.0))
    state = stored(links.groupBy("gamma", F.col("src").alias("node")).agg(F.sum("w").alias("k"), loops.alias("loop")).withColumn("community", F.col("node")))
    names, kept, best, waiting, step = state.columns, {}, {}, {}, 0
    while True:
        looked = stored(look(links, state, rows, whole))
        for gamma, q in quality(looked, whole).items():
            waiting[gamma] = 0 if q > best.get(gamma, -2.0) + GAIN else waiting.get(gamma, 0) + 1
            if q > best.get(gamma, -2.0):
                best[gamma], kept[gamma] = q, looked.where(F.col("gamma") == gamma).select(names)
        if all(n >= PATIENCE for n in waiting.values()):
            return stored(reduce(DataFrame.unionByName, kept.values())), best
        turn = F.pmod(F.xxhash64("node", F.lit(seed), F.lit(step // 2)), F.lit(2)) == step % 2
        state = looked.withColumn("community", F.when(turn & (F.col("gain") > 1e-9), F.col("best")).otherwise(F.col("community"))).select(names)
        step += 1


def find(edges: DataFrame, resolutions: tuple[float, ...] = RESOLUTIONS, seed: int = 42) -> DataFrame:
    """cell_id, resolution, community (the name of one of its cells) of every cell with an edge."""
    links = stored(links_of(edges, resolutions))
    whole = links.where(F.col("gamma") == float(resolutions[0])).agg(F.sum("w")).first()[0]
    member = stored(links.select("gamma", F.col("src").alias("cell_id")).distinct().withColumn("community", F.col("cell_id")))
    rows, last = member.count(), {}
    while rows:
        state, best = level(links, rows, whole, seed)
        moved = state.select("gamma", F.col("node").alias("community"), F.col("community").alias("next"))
        member = stored(lookup(member, moved, ["gamma", "community"], ["cell_id"], rows=rows).select("gamma", "cell_id", F.col("next").alias("community")))
        name = state.select("gamma", F.col("node").alias("src"), F.col("community").alias("a"))
        other = state.select("gamma", F.col("node").alias("dst"), F.col("community").alias("b"))
        both = lookup(lookup(links, name, ["gamma", "src"], ["dst"], rows=rows), other, ["gamma", "dst"], ["src"], rows=rows)
        links = stored(both.groupBy("gamma", F.col("a").alias("src"), F.col("b").alias("dst")).agg(F.sum("w").alias("w")))
        left = state.select("gamma", "community").distinct().count()
        if left == rows or all(best[g] <= last.get(g, -2.0) + GAIN for g in best):
            break
        rows, last = left, best
    return member.select("cell_id", F.col("gamma").alias("resolution"), "community")


def counts(found: DataFrame) -> DataFrame:
    """resolution, n_clusters, n_cells, largest."""
    sizes = found.groupBy("resolution", "community").agg(F.count("*").alias("n"))
    return sizes.groupBy("resolution").agg(F.count("*").alias("n_clusters"), F.sum("n").alias("n_cells"), F.max("n").alias("largest"))
