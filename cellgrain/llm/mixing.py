"""Mixing sources to target weights by weighted fair queueing.

Every source gets a share of the budget by its weight; a target stops at a number of times what its source holds, and
the excess is shared again by weight until none is above. A source's documents are queued in the order of a hash, as
often as they may repeat. The virtual finish time of a document is the number of words that its source has queued up
to and with it, over the source's target. All queues are merged by range-sorting finish times, and the mix is cut
where its running sum reaches the budget. At virtual time 1 the budget is spent and every source has got its target; each
has at most one document in service then, and the mix takes of it the words that have been served: without that, a
source of few long texts would miss its target by up to a text.

A source's queue is no window over one key: words before a document come from prefix sums over all sources in their
order, less the words of earlier sources, so a source may hold any part of the corpus.

Cases: a null text has no words; a source without words has target 0; a null source is one of its own, after all
others; repeated rows are queued one by one; a null id hashes as an empty one; rows that share id and size are in no
stated order; an empty table gives an empty one; extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cellgrain.llm.common import cut, lookup_join, prefix_sums

WEIGHTS, SHARE, REPEATS, SEED = (5, 2, 1), 1.5, 2, 2024
WORD = "[^\\x20\\x09-\\x0D]+"


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> tuple[DataFrame, int]:
    """_src, source_size, _earlier (words of earlier sources) and target; and the budget in whole words. The level of
    words a unit of weight rises until no further source is full; a round is one aggregation over the sources."""
    ranked, total = prefix_sums(sizes, ["_src"], "source_size", "_earlier", also="_rank")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = cut(ranked.withColumns({"_weight": weight, "_most": (F.col("source_size") * repeats).cast("double")}))
    budget = min(share, repeats) * total
    level, last = 0.0, None
    while True:
        full = F.col("_most") <= F.lit(level) * F.col("_weight")
        r = ranked.agg(F.coalesce(F.sum(F.when(full, F.col("_most"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0.0))).first()
        if (state := tuple(r)) == last or not state[1]:
            break
        last, level = state, (budget - state[0]) / state[1]
    full = F.col("_most") <= F.lit(level) * F.col("_weight")
    return ranked.select("_src", "source_size", "_earlier", F.when(full, F.col("_most")).otherwise(F.lit(level) * F.col("_weight")).alias("target")), int(budget)


def mixture(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """A row for each time that a document may be taken: doc_id, size, source_size, target, epoch (from 0), words that the
    mix takes (0: none), and at, the words of the mix before them (null where it takes none); _row tells rows apart."""
    source = F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("2"))
    rows = cut(docs.select("doc_id", source.alias("_src"), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"), F.monotonically_increasing_id().alias("_row")))
    found, budget = targets(rows.groupBy("_src").agg(F.sum("size").alias("source_size")), weights, share, repeats)
    shuffled = rows.withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")))
    queued, _ = prefix_sums(shuffled, ["_src", "_hash", "doc_id", "size"], "size", "_start")
    known = lookup_join(queued, found, ["_src"], F.col("_row"))
    turns = known.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    turns = turns.withColumn("_begin", F.col("_start") - F.col("_earlier") + F.col("epoch") * F.col("source_size"))
    served = F.greatest(F.lit(0), F.least(F.col("size"), F.floor("target") - F.col("_begin"))).cast("long")
    turns = cut(turns.withColumns({"_served": served, "_finish": F.when(F.col("target") > 0, F.least(F.lit(1.0), (F.col("_begin") + F.col("size")) / F.col("target")))}))
    names = ["_row", "doc_id", "_src", "size", "source_size", "target", "epoch"]
    mixed, _ = prefix_sums(turns.where("_served > 0").select(*names, "_finish", "_begin", "_served"), ["_finish", "_src", "_begin"], "_served", "at")
    taken = mixed.select(*names, F.greatest(F.lit(0), F.least(F.col("_served"), F.lit(budget) - F.col("at"))).cast("long").alias("words"), "at")
    return taken.unionByName(turns.where("_served = 0").select(*names, F.lit(0).cast("long").alias("words"), F.lit(None).cast("long").alias("at")))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The contract's rows."""
    one = [F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")]
    return mixture(docs).groupBy("_row").agg(*one, F.sum("words").alias("taken")).drop("_row")


def sql() -> str:
    cases = " ".join(f"WHEN {k} THEN {float(w)}" for k, w in enumerate(WEIGHTS))
    return rf"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row_id, doc_id, coalesce('1' || source, '2') AS src, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
s AS MATERIALIZED (SELECT src, source_size, CAST({REPEATS} * source_size AS DOUBLE) AS most, CASE (row_number() OVER (ORDER BY CAST(src AS BLOB)) - 1) % {len(WEIGHTS)} {cases} END AS weight FROM (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY src)),
l AS (SELECT *, coalesce(sum(most) OVER w, 0) AS full_most, (SELECT sum(weight) FROM s) - coalesce(sum(weight) OVER w, 0) AS open_weight FROM s WINDOW w AS (ORDER BY most / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT (SELECT level FROM (SELECT src, most, weight, ({SHARE} * (SELECT sum(source_size) FROM s) - full_most) / open_weight AS level FROM l) WHERE level * weight < most ORDER BY most / weight, src LIMIT 1) AS level),
t AS (SELECT src, source_size, CASE WHEN most <= level * weight OR level IS NULL THEN most ELSE level * weight END AS target FROM s, v),
q AS (SELECT *, sum(size) OVER (PARTITION BY src ORDER BY md5('{SEED}:' || doc_id), doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start FROM d)
SELECT doc_id, size, source_size, target, CAST({" + ".join(f"greatest(0, least(size, floor(target) - start - {e} * source_size))" for e in range(REPEATS))} AS BIGINT) AS taken FROM q JOIN t USING (src)"""
