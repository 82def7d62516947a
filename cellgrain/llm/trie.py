"""Prefix trie of conversations, rolled up by centroid decomposition.

Conversations are rebuilt first: the members of a block of ids share the first turns of the block's first conversation.
A node is a distinct sequence of first turns. Its key is the depth with two sums modulo 2**61 - 1, of the turns' digests
times powers by place (122 bits; two sequences share them with a chance of about depth**2 / 2**122). Sums of that kind
are associative, so they come from a range sort: a partition adds up its own rows, the partitions' tails (one row each)
carry over, and a conversation may be as long as it likes.

Totals over subtrees (leaves, saved tokens) are rolled up over the forest of parent edges. A node's weight is the number
of conversations through it, so the weight of a whole subtree is known from the conversations alone, before any rollup: it
is the sum of the turns that they have from there on. A component's centroid is its lightest subtree of at least half
of the component. What lies below it is totalled, the total is added to each node from the centroid up to the component's
top, and their weights lose the centroid's; the centroid goes, and its children's subtrees and the rest above it are components
of half the weight at most. Large components, all at a time, take such a round in a few joins; a node lies below a centroid
if its conversation passes through it. Components of at most LIMIT are decomposed to the end inside of tasks. A rollup
thus takes a number of rounds that grows with the logarithm of the turns, however deep or lopsided the trie is.

Cases: null roles and texts are empty; turns of one number are ordered by digest; a null turn comes first; a null id is
one conversation, without shared turns, before all others, and its decimal is empty; repeated rows are turns of their
own; other columns are left out; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cellgrain.llm import common
from cellgrain.llm.common import cut, lookup_join, table
from cellgrain.llm.shards import crc32_sql

BLOCK, SHARED = 100, 6
#: Weight of a component that a task decomposes on its own; characters of one piece of a list of ids.
LIMIT, PIECE = 1 << 12, 1 << 20
#: Sums are taken modulo this prime; the powers' bases are digests of their names.
PRIME = (1 << 61) - 1
BASES = tuple(int(hashlib.sha256(name).hexdigest()[:15], 16) for name in (b"first lane", b"second lane"))
#: The number of a null conversation.
NONE = -(1 << 63)
#: Nodes with more than one part in HOT of all nodes as children: fewer than HOT, so they are broadcast.
HOT = 10_000
ROOT = bytes(24)

Sums = tuple[int, ...]


def running(rows: DataFrame, order: list[str], terms: Callable[[pa.RecordBatch], list[Sums]], lanes: int, finish: Callable[[pa.RecordBatch, list[Sums], list[Sums]], list[pa.Array]], schema: str) -> DataFrame:
    """Sums of the terms, modulo PRIME, from the first row of each value of order[0] on. ``finish`` gives the columns
    of ``schema`` from a batch and the sums before and with each of its rows."""
    key, n = order[0], int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))

    def add(a: Sums, b: Sums) -> Sums:
        return tuple((x + y) % PRIME for x, y in zip(a, b, strict=True))

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = first = last = None
        total: Sums = ()
        for b in batches:
            for k, v in zip(b.column(key).to_pylist(), terms(b), strict=True):
                if part is None:
                    part, first = b.column("_part")[0].as_py(), k
                total, last = (add(total, v) if k == last else v), k
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (part, first, last, *total)], names=names)

    names = ["part", "first", "last", *(f"s{i}" for i in range(lanes))]
    carried: dict[int, tuple[int, Sums]] = {}
    before: tuple[int, Sums] | None = None
    for r in sorted(ranged.mapInArrow(tails, ", ".join(f"{c} long" for c in names)).collect()):  # a row a partition
        if before:
            carried[r["part"]] = before
        sums = tuple(r[3:])
        before = (r["last"], add(before[1], sums) if before and before[0] == r["first"] == r["last"] else sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zero, last, total = (0,) * lanes, None, (0,) * lanes
        fresh = True
        for b in batches:
            old, new = [], []
            for k, v in zip(b.column(key).to_pylist(), terms(b), strict=True):
                if fresh:
                    fresh = False
                    last, total = carried.get(b.column("_part")[0].as_py(), (None, zero))
                if k != last:
                    last, total = k, zero
                old.append(total)
                total = add(total, v)
                new.append(total)
            yield pa.RecordBatch.from_arrays(finish(b, old, new), names=[c.split()[0] for c in schema.split(", ")])

    return ranged.mapInArrow(run, schema)


def numbered(turns: DataFrame) -> DataFrame:
    """_c, pos (from 0), d1, d2, chars: the turns of each conversation in order."""
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    number = F.coalesce(F.col("conv_id").cast("long"), F.lit(NONE))
    rows = turns.select(number.alias("_c"), "turn", digest.alias("_digest"), F.length(text).cast("long").alias("chars"))
    lane = lambda at: F.conv(F.substring("_digest", at, 15), 16, 10).cast("long")
    rows = rows.select("_c", "turn", lane(1).alias("d1"), lane(16).alias("d2"), "chars")
    return running(rows, ["_c", "turn", "d1", "d2"], lambda b: [(1,)] * b.num_rows, 1, lambda b, old, _: [b.column("_c"), pa.array([x[0] for x in old], pa.int64()), *(b.column(c) for c in ("d1", "d2", "chars"))], "_c long, pos long, d1 long, d2 long, chars long")


def rebuilt(turns: DataFrame, block: int = BLOCK, shared: int = SHARED) -> DataFrame:
    """_c, q, d1, d2, chars, n: the q-th of the n turns of every rebuilt conversation, and a row with q = 0 before them."""
    own = cut(numbered(turns))
    name = F.when(F.col("_c") == NONE, "").otherwise(F.col("_c").cast("string"))
    per = own.groupBy("_c").agg(F.count("*").alias("_own")).withColumns({"_h": F.crc32(name.cast("binary")) % shared, "_b": F.col("_c") - F.col("_c") % block})
    heads = own.where((F.col("_c") % block == 0) & (F.col("pos") < shared - 1)).groupBy(F.col("_c").alias("_b")).agg(F.sort_array(F.collect_list(F.struct("pos", "d1", "d2", "chars"))).alias("_head"))
    convs = lookup_join(per, heads, ["_b"], F.col("_c"))
    convs = convs.withColumn("_head", F.slice(F.coalesce("_head", F.array().cast(convs.schema["_head"].dataType)), F.lit(1), F.col("_h").cast("int")))
    convs = cut(convs.withColumn("_m", F.size("_head").cast("long")).withColumn("n", F.col("_m") + F.greatest(F.col("_own") - F.col("_h"), F.lit(0))))
    rest = lookup_join(own, convs.select("_c", "_h", "_m", "n"), ["_c"], F.col("pos"), "inner").where("pos >= _h")
    rest = rest.select("_c", (F.col("pos") - F.col("_h") + F.col("_m") + 1).alias("q"), "d1", "d2", "chars", "n")
    first = convs.select("_c", "n", F.posexplode("_head").alias("i", "t")).select("_c", (F.col("i") + 1).cast("long").alias("q"), "t.d1", "t.d2", "t.chars", "n")
    zero = F.lit(0).cast("long")
    return rest.unionByName(first).unionByName(convs.select("_c", zero.alias("q"), zero.alias("d1"), zero.alias("d2"), zero.alias("chars"), "n"))


def prefixes(turns: DataFrame) -> DataFrame:
    """_c, q, n, chars of rebuilt turns, with the key of the node that they reach and of its parent."""

    def terms(b: pa.RecordBatch) -> list[Sums]:
        cols = (b.column(c).to_pylist() for c in ("q", "d1", "d2"))
        return [(x * pow(BASES[0], q, PRIME) % PRIME, y * pow(BASES[1], q, PRIME) % PRIME) for q, x, y in zip(*cols, strict=True)]

    def finish(b: pa.RecordBatch, old: list[Sums], new: list[Sums]) -> list[pa.Array]:
        q = b.column("q").to_pylist()
        node = [struct.pack(">QQQ", k, *s) for k, s in zip(q, new, strict=True)]
        parent = [struct.pack(">QQQ", k - 1, *s) if k else None for k, s in zip(q, old, strict=True)]
        return [*(b.column(c) for c in ("_c", "q", "n", "chars")), pa.array(node, pa.binary()), pa.array(parent, pa.binary())]

    return running(turns, ["_c", "q"], terms, 2, finish, "_c long, q long, n long, chars long, node binary, parent binary")


def split_component(parent: list[int], weight: list[int], values: list[Sums]) -> list[Sums]:
    """Totals over the subtrees of one component, whose nodes come parents first (the top's parent is -1)."""
    total = [(0, 0)] * len(parent)
    todo = [list(range(len(parent)))]
    while todo:
        nodes = todo.pop()
        top, whole = nodes[0], weight[nodes[0]]
        g = min((u for u in nodes if 2 * weight[u] >= whole), key=weight.__getitem__)
        below: dict[int, int] = {g: g}
        parts: dict[int, list[int]] = {}
        a, b = values[g]
        above = []
        for u in nodes:
            if u == g:
                continue
            if (p := below.get(parent[u])) is None:
                above.append(u)
                continue
            below[u] = top_of = u if p == g else p
            parts.setdefault(top_of, []).append(u)
            a, b = a + values[u][0], b + values[u][1]
        u, lost = g, weight[g]
        while True:
            total[u] = (total[u][0] + a, total[u][1] + b)
            if u == top:
                break
            u = parent[u]
            weight[u] -= lost
        todo += parts.values()
        if above:
            todo.append(above)
    return total


def settle(state: DataFrame) -> DataFrame:
    """Decomposes whole components, one at a time in a task, and adds their totals."""
    n = int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = state.columns

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        cols = dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))
        at = {v: i for i, v in enumerate(cols["node"])}
        totals = split_component([at.get(p, -1) for p in cols["parent"]], cols["weight"], list(zip(cols["leaf"], cols["saving"], strict=True)))
        cols["leaves"] = [x + t[0] for x, t in zip(cols["leaves"], totals, strict=True)]
        cols["saved"] = [x + t[1] for x, t in zip(cols["saved"], totals, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(cols[c], pa.binary() if c in ("node", "parent", "comp") else pa.int64()) for c in names], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        which = names.index("comp")
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in names), strict=True):
                if held and held[0][which] != row[which]:
                    yield solved(held)
                    held = []
                held.append(row)
        if held:
            yield solved(held)

    return state.repartition(n, "comp").sortWithinPartitions("comp", "depth").mapInArrow(run, state.schema)


def rollup(nodes: DataFrame, through: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Adds leaves and saved, the totals of leaf and saving over the subtree of every node. ``nodes`` has node, parent,
    conv (a conversation through it), depth and weight (of its whole subtree); ``through`` has the nodes of each
    conversation: _c, q (their depth), node, parent."""
    zero = F.lit(0).cast("long")
    active = nodes.withColumns({"leaves": zero, "saved": zero, "comp": F.lit(bytearray(ROOT))})
    names, done, small = active.columns, [], []
    steps = through.where("parent IS NOT NULL").select(F.col("_c").alias("conv"), F.col("parent").alias("g"), F.col("node").alias("_child"))
    salt = F.xxhash64("node")
    while True:
        large = active.where(F.col("weight") > limit).groupBy("comp").agg(F.max("weight").alias("_whole"))
        halves = lookup_join(active.where(2 * F.col("weight") > limit), large, ["comp"], salt, "inner").where("2 * weight >= _whole")
        lightest = halves.groupBy("comp").agg(F.min_by(F.struct("node", "conv", "depth", "weight"), "weight").alias("_g"))
        centroids = cut(lightest.select("comp", F.col("_g.node").alias("g"), F.col("_g.conv").alias("_through"), F.col("_g.depth").alias("_at"), F.col("_g.weight").alias("_lost")))
        count = centroids.count()
        if not count:
            small.append(active.select(names))
            break

        def near(left: DataFrame, right: DataFrame, how: str = "inner", keys: tuple[str, ...] = ("comp",), rows: int = count) -> DataFrame:
            """A join with a row for each of the centroids at most."""
            return left.join(F.broadcast(right), [*keys], how) if rows <= common.BROADCAST_ROWS else lookup_join(left, right, [*keys], F.xxhash64(*left.columns), how)

        small.append(near(active, centroids.select("comp"), "left_anti").select(names))
        # Nodes on the way from a centroid to its component's top: those of a conversation through it, up to its depth.
        ways = centroids.groupBy(F.col("_through").alias("_c")).agg(F.collect_list(F.struct("comp", "_at")).alias("_ways"))
        path = near(through.select("_c", "q", "node"), ways, keys=("_c",)).select("node", "q", F.explode("_ways").alias("_w")).where("q <= _w._at").select("node", F.col("_w.comp").alias("comp"), F.lit(True).alias("_up"))
        # A node lies below a centroid if its conversation goes on from there.
        below = near(steps, centroids.select("g", "comp"), keys=("g",)).groupBy("conv", "comp").agg(F.max("_child").alias("_child"))
        held = lookup_join(near(active, centroids), below, ["conv", "comp"], salt).join(path, ["node", "comp"], "left")
        gone, down = F.col("node") == F.col("g"), F.col("_child").isNotNull() & (F.col("depth") > F.col("_at"))
        held = cut(held.select(*names, "_lost", gone.alias("_gone"), F.when(down, F.col("_child")).alias("_child"), F.coalesce("_up", F.lit(False)).alias("_up")))
        total = held.where("_gone OR _child IS NOT NULL").groupBy("comp").agg(F.sum("leaf").alias("_leaves"), F.sum("saving").alias("_saved"))
        up = lambda c, by: F.col(c) + F.when(F.col("_up"), F.col(by)).otherwise(0)
        new = {"leaves": up("leaves", "_leaves"), "saved": up("saved", "_saved"), "weight": up("weight", "_minus"), "comp": F.coalesce("_child", "comp")}
        # A table, not a checkpoint: that would keep the joins' estimates of its size, whose digits double in each round.
        moved = table(near(held, total).withColumn("_minus", F.when(F.col("_gone"), 0).otherwise(-F.col("_lost"))).withColumns(new).select(*names, "_gone"))
        done.append(moved.where("_gone").select(names))
        active = moved.where("NOT _gone").select(names)
    return union([settle(union(small)), *done]).drop("comp")


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def shown(c: Column) -> Column:
    """A conversation's id from its number."""
    return F.when(c != NONE, c)


def ends(last: DataFrame) -> DataFrame:
    """node, ends_sha256: of the ids of its rows in order. Ids are joined in pieces by range, so that a hot node's rows
    are sorted in many tasks; only its pieces meet, and are hashed one after another."""
    n = int(last.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = last.select("node", "_c").repartitionByRange(n, "node", "_c").sortWithinPartitions("node", "_c").withColumn("part", F.spark_partition_id())

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, part, k, ids, size = None, 0, 0, [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([part], pa.int32()), pa.array([k], pa.int64()), pa.array([",".join(ids)])], names=["node", "part", "k", "ids"])

        for b in batches:
            for at, c, p in zip(*(b.column(x).to_pylist() for x in ("node", "_c", "part")), strict=True):
                if ids and (at != node or size > PIECE):
                    yield row()
                    ids, size = [], 0
                node, part, k = at, p, k + 1
                ids.append("" if c == NONE else str(c))
                size += len(ids[-1]) + 1
        if ids:
            yield row()

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, h = None, None
        for b in batches:
            out = []
            for at, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if at != node:
                    if h:
                        out.append((node, h.hexdigest()))
                    node, h = at, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.string())], names=["node", "ends_sha256"])
        if h:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([h.hexdigest()])], names=["node", "ends_sha256"])

    pieces = ranged.mapInArrow(join, "node binary, part int, k long, ids string")
    return pieces.repartition(n, "node").sortWithinPartitions("node", "part", "k").mapInArrow(hash_all, "node binary, ends_sha256 string")


def conversation_trie(turns: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The contract's rows."""
    through = cut(prefixes(rebuilt(turns)))
    merged = through.groupBy("node").agg(F.min("_c").alias("conv"), F.first("q").alias("depth"), F.first("parent").alias("parent"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"), F.sum(F.col("n") - F.col("q") + 1).alias("weight"))
    merged = cut(merged)
    kids = merged.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = merged.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = cut(nodes.select("node", "parent", "conv", "depth", "weight", "n_convs", "n_children", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saving")))
    least = max(nodes.count() // HOT, 1)
    rolled = rollup(nodes, through.select("_c", "q", "node", "parent"), limit)
    above = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("_above"), "n_children")
    hot = above.where(F.col("n_children") > least).select("parent", F.col("_above").alias("_hot"))
    cold = above.where(F.col("n_children").between(1, least)).drop("n_children")
    named = rolled.join(F.broadcast(hot), "parent", "left").join(cold, "parent", "left").withColumn("_p", F.coalesce("_hot", "_above"))
    said = named.join(ends(through.where("q = n")), "node", "left")
    return said.select(
        shown(F.col("conv")).alias("conv_id"), "depth", shown(F.col("_p")).alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def sql() -> str:
    return f"""WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos FROM conversations),
c AS MATERIALIZED (SELECT conv_id, conv_id - conv_id % {BLOCK} AS base, {crc32_sql("CAST(conv_id AS VARCHAR)")} % {SHARED} AS h FROM (SELECT DISTINCT conv_id FROM conversations)),
r AS (SELECT c.conv_id, role, text, pos, 0 AS own FROM c JOIN o ON o.conv_id = c.base AND o.pos < c.h UNION ALL SELECT c.conv_id, role, text, pos, 1 FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos >= c.h),
q AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth, role, text FROM r),
p AS MATERIALIZED (SELECT conv_id, depth, length(text) AS chars, list(md5(length(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM q UNION ALL SELECT conv_id, 0, 0, CAST([] AS VARCHAR[]) FROM c),
n AS MATERIALIZED (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saving FROM p GROUP BY path, depth),
k AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
t AS (SELECT path[1:a] AS path, count(*) FILTER (WHERE path NOT IN (SELECT path FROM k)) AS n_leaves, sum(saving) AS saved_tokens FROM (SELECT path, saving, unnest(range(0, depth + 1)) AS a FROM n) GROUP BY 1),
e AS (SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256 FROM (SELECT conv_id, path FROM p QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1) GROUP BY path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM n JOIN t ON t.path = n.path LEFT JOIN k ON k.path = n.path LEFT JOIN e ON e.path = n.path LEFT JOIN n u ON n.depth > 0 AND u.path = n.path[1:n.depth - 1]"""
