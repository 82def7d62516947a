"""Leakage-safe splits and folds. Rows are shuffled by digests, so a repeated task splits the same way."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from cellgrain.model import hash_rank, need
from cellgrain.operators.quantiles import exact


def patients(cells: DataFrame, patient: str, stratum: str | None = None) -> DataFrame:
    """Distinct patients in a shuffled order, ``k`` from 1 (in each stratum: the patient's most frequent value)."""
    need(cells, patient)
    known = cells.where(F.col(patient).isNotNull())
    if stratum:
        n = known.where(F.col(stratum).isNotNull()).groupBy(patient, stratum).agg(F.count("*").alias("n"))
        who = n.groupBy(patient).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(stratum).alias("s"))).alias("b")).select(patient, F.col("b.s").alias("_s"))
    else:
        who = known.select(patient).distinct().withColumn("_s", F.lit(0))
    return who


def shuffled_rank(df: DataFrame, by: str, key: str, seed: int = 42) -> DataFrame:
    """Adds ``k``, the row's rank (from 1) in the shuffled order of its class, and ``_n``, the class's rows.

    Ranks come from an exact two-level count: rows of a class are dealt over buckets by the first digits of their digest, ranked inside
    of a bucket, and counts of the buckets before are added; so a class of any size is ranked in many tasks."""
    rows = df.withColumn("_h", hash_rank(key, seed=seed)).withColumn("_b", F.substring("_h", 1, 3))
    counts = rows.groupBy(by, "_b").agg(F.count("*").alias("_c"))
    w = Window.partitionBy(by)
    before = F.coalesce(F.sum("_c").over(w.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sides = counts.select(F.col(by).alias("_by"), "_b", before.alias("_before"), F.sum("_c").over(w).alias("_n"))
    local = rows.withColumn("_k", F.row_number().over(Window.partitionBy(by, "_b").orderBy("_h", key)))
    joined = local.join(sides, (local[by].eqNullSafe(sides["_by"])) & (local["_b"] == sides["_b"])).drop(sides["_b"])
    return joined.withColumn("k", F.col("_k") + F.col("_before")).drop("_h", "_b", "_by", "_k", "_before")


def patient_split(cells: DataFrame, patient: str, test_size: float = 0.2, stratum: str | None = None, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: all cells of max(1, ceil(n * test_size)) patients (of each stratum) are. Cells without a
    patient are in neither part."""
    who = shuffled_rank(patients(cells, patient, stratum), "_s", patient, seed)
    flag = F.col("k") <= F.greatest(F.lit(1), F.ceil(F.col("_n") * test_size))
    return cells.join(who.select(patient, flag.alias("is_test")), patient)


def patient_folds(cells: DataFrame, patient: str, folds: int = 5, stratum: str | None = None, seed: int = 42) -> DataFrame:
    """patient, fold: from 0; no more folds than patients."""
    who = shuffled_rank(patients(cells, patient, stratum), "_s", patient, seed)
    total = who.agg(F.least(F.count("*"), F.lit(folds)).alias("_f"))
    return who.crossJoin(F.broadcast(total)).select(patient, F.pmod(F.col("k") - 1, F.col("_f")).cast("int").alias("fold"))


def time_split(cells: DataFrame, time: str, cutoff=None) -> DataFrame:
    """Adds ``is_test``: after the cutoff, by default the median time. Rows without a time are left out."""
    micros = F.unix_micros(F.col(time)) if dict(cells.dtypes)[time] == "timestamp" else F.unix_micros(F.col(time).cast("timestamp"))
    rows = cells.where(F.col(time).isNotNull()).withColumn("_t", micros)
    if cutoff is not None:
        return rows.withColumn("is_test", F.col("_t") > F.unix_micros(F.lit(cutoff).cast("timestamp"))).drop("_t")
    return rows.crossJoin(F.broadcast(exact(rows.select("_t"), {"_m": ("_t", 0.5)}))).withColumn("is_test", F.col("_t") > F.col("_m")).drop("_t", "_m")


def overlap(*frames: DataFrame, patient: str = "patient_id") -> DataFrame:
    """One row: how many patients are in more than one frame, and whether there are none."""
    sides = [f.select(F.col(patient).alias("p")).where("p is not null").distinct().withColumn("f", F.lit(i)) for i, f in enumerate(frames)]
    shared = reduce(DataFrame.unionByName, sides).groupBy("p").agg(F.count("*").alias("n")).where("n > 1")
    return shared.agg(F.count("*").alias("n_shared")).withColumn("disjoint", F.col("n_shared") == 0)


def fold_overlap(folds: DataFrame, patient: str = "patient_id") -> DataFrame:
    """fold_a, fold_b, n of pairs of folds that share patients."""
    f = folds.select("fold", patient).distinct()
    pair = f.select(F.col("fold").alias("fold_a"), patient).join(f.select(F.col("fold").alias("fold_b"), patient), patient).where("fold_a < fold_b")
    return pair.groupBy("fold_a", "fold_b").agg(F.count("*").alias("n"))


def stratified(df: DataFrame, label: str, key: str, parts: int | None = None, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``fold`` (0 to parts - 1), or ``is_test``, dealt evenly inside of each label."""
    out = shuffled_rank(df, label, key, seed)
    if parts:
        return out.withColumn("fold", F.pmod(F.col("k") - 1, F.lit(parts)).cast("int")).drop("k", "_n")
    return out.withColumn("is_test", F.col("k") <= F.ceil(F.col("_n") * test_size)).drop("k", "_n")


def fit_on_train(stages: list, train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both parts through estimators that have seen the first only."""
    from pyspark.ml import Pipeline

    model = Pipeline(stages=stages).fit(train)
    return model.transform(train), model.transform(test)
