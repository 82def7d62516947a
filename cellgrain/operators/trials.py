"""Experiment logs: leaderboards, convergence, importance, validation, contracts, audits.

Orders over the whole log (running best, convergence) are windows inside of an experiment: ``by`` names its keys, so logs of many
experiments are analysed side by side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cellgrain.model import ratio


def running_best(trials: DataFrame, by: list[str], order: str = "trial_id", metric: str = "metric") -> DataFrame:
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return trials.withColumn("best_so_far", F.max(metric).over(w))


def improvements(trials: DataFrame, by: list[str], order: str = "trial_id", metric: str = "metric") -> DataFrame:
    """Per experiment the trials that are above the one before, in log order."""
    before = F.lag(metric).over(Window.partitionBy(*by).orderBy(order))
    return trials.withColumn("_up", F.coalesce(F.col(metric) > before, F.lit(False))).groupBy(*by).agg(F.count_if("_up").alias("n_improvements"), F.count("*").alias("n_trials"))


def convergence(trials: DataFrame, by: list[str], order: str = "trial_id", metric: str = "metric") -> DataFrame:
    """rate: mean step of the running best over the metric's deviation; converged: the best of the last fifth is less
    than a tenth of a deviation below the best."""
    w = Window.partitionBy(*by).orderBy(order)
    rows = running_best(trials, by, order, metric)
    rows = rows.withColumns({"_step": F.abs(F.col("best_so_far") - F.lag("best_so_far").over(w)), "_k": F.row_number().over(w), "_n": F.count("*").over(Window.partitionBy(*by))})
    tail = F.col("_k") > F.col("_n") - F.greatest(F.lit(1), F.floor(F.col("_n") / 5))
    agg = rows.groupBy(*by).agg(F.avg("_step").alias("_m"), F.stddev_samp(metric).alias("_sd"), F.max(metric).alias("best"), F.max(F.when(tail, F.col(metric))).alias("recent_best"))
    return agg.select(*by, "best", "recent_best", ratio(F.col("_m"), F.col("_sd")).alias("rate"), (F.abs(F.col("recent_best") - F.col("best")) < 0.1 * F.col("_sd")).alias("converged"))


def importance(trials: DataFrame, params: list[str], metric: str = "metric", top: int = 15) -> DataFrame:
    """parameter, importance: the absolute correlation of a numeric parameter with the metric, 0 for others. All in
    one aggregation."""
    numeric = {c for c, t in trials.dtypes if t in ("int", "bigint", "double", "float", "smallint", "tinyint") or t.startswith("decimal")}
    row = trials.agg(*(F.coalesce(F.nanvl(F.abs(F.corr(p, metric)), F.lit(0.0)), F.lit(0.0)).alias(p) if p in numeric else F.max(F.lit(0.0)).alias(p) for p in params))
    long = row.select(F.explode(F.array(*(F.struct(F.lit(p).alias("parameter"), F.col(p).alias("importance")) for p in params))).alias("e")).select("e.*")
    return long.orderBy(F.desc("importance"), "parameter").limit(top)


def families(trials: DataFrame, family: str = "family", metric: str = "metric") -> DataFrame:
    """Per family count, mean and best; no rows for a single family."""
    agg = trials.groupBy(family).agg(F.count("*").alias("n"), F.avg(metric).alias("mean"), F.max(metric).alias("best"))
    return agg.crossJoin(F.broadcast(agg.agg(F.count("*").alias("_k")))).where("_k >= 2").drop("_k")


def leaderboard(trials: DataFrame, k: int = 10, metric: str = "metric", order: str = "trial_id") -> DataFrame:
    return trials.orderBy(F.desc(metric), order).limit(k)


def best_trial(trials: DataFrame, by: list[str], metric: str = "metric", order: str = "trial_id") -> DataFrame:
    """Per experiment the first of its best trials."""
    best = trials.where(F.col(metric).isNotNull()).groupBy(*by).agg(F.min(F.struct((-F.col(metric)).alias("m"), F.col(order).alias("t"))).alias("b"))
    return best.select(*by, F.col("b.t").alias(order), (-F.col("b.m")).alias(metric))


def early_stop(trials: DataFrame, by: list[str], patience: int = 10, metric: str = "metric", order: str = "trial_id") -> DataFrame:
    """stop: there are ``patience`` trials and the best of the last ones is under the best of all."""
    k = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(order)))
    agg = trials.withColumn("_k", k).groupBy(*by).agg(F.count("*").alias("n"), F.max(metric).alias("best"), F.max(F.when(F.col("_k") <= patience, F.col(metric))).alias("recent"))
    return agg.select(*by, "n", ((F.col("n") >= patience) & (F.col("recent") < F.col("best"))).alias("stop"))


def search_status(trials: DataFrame, by: list[str], metric: str = "metric", order: str = "trial_id") -> DataFrame:
    """gap between best and mean; saturated under 0.01; whether the best is among the last ten."""
    k = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(order)))
    agg = trials.withColumn("_k", k).groupBy(*by).agg(F.max(metric).alias("best"), F.avg(metric).alias("mean"), F.max(F.when(F.col("_k") <= 10, F.col(metric))).alias("_r"))
    gap = F.col("best") - F.col("mean")
    return agg.select(*by, "best", "mean", gap.alias("gap"), F.when(gap < 0.01, "saturated").otherwise("continue").alias("status"), (F.col("_r") >= F.col("best")).alias("recent_best"))


def compare_runs(runs: DataFrame, metric: str, ids: list | None = None, run: str = "run_id") -> DataFrame:
    rows = runs.where(F.col(metric).isNotNull())
    return (rows.where(F.col(run).isin(ids)) if ids is not None else rows).orderBy(F.desc(metric), run)


def flatten(df: DataFrame, key: str, nested: str) -> DataFrame:
    """key, name, value: the numbers of a nested struct, names joined with underscores."""
    out: list[tuple[str, str]] = []

    def walk(kind, path: str, name: str) -> None:
        for f in kind.fields:
            p, n = f"{path}.`{f.name}`", f"{name}_{f.name}" if name else f.name
            if f.dataType.typeName() == "struct":
                walk(f.dataType, p, n)
            elif f.dataType.typeName() in ("integer", "long", "double", "float", "short", "byte", "decimal"):
                out.append((n, p))

    walk(df.schema[nested].dataType, f"`{nested}`", "")
    long = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(p).cast("double").alias("value")) for n, p in out)))
    return df.select(key, long.alias("e")).select(key, "e.*").where("value is not null")


#: Bounds of numeric parameters and choices of the others.
BOUNDS = {"n_latent": (10, 50), "n_hidden": (64, 256), "n_layers": (1, 5), "learning_rate": (1e-5, 1e-2), "dropout_rate": (0.0, 0.3), "hvg_count": (1000, 5000), "fusion_hidden_dim": (64, 512)}
CHOICES = {"gene_likelihood": ("zinb", "nb", "poisson"), "integration_method": ("harmony", "scvi", "scanvi"), "fusion_method": ("concat", "attention", "moe")}


def validate_configs(spark: SparkSession, configs: DataFrame, key: str = "trial_id", config: str = "config") -> DataFrame:
    """key, valid, error: ``config`` is a map of texts. Errors are joined in the order of parameters."""
    rows = [(i, p, float(a), float(b), None) for i, (p, (a, b)) in enumerate(BOUNDS.items(), 1)] + [(100 + i, p, None, None, list(c)) for i, (p, c) in enumerate(CHOICES.items())]
    rules = F.broadcast(spark.createDataFrame(rows, "ord int, name string, low double, high double, choices array<string>"))  # a fixed table
    long = configs.select(key, F.explode(config).alias("name", "value")).join(rules, "name")
    number = F.col("value").try_cast("double")
    bad = F.when(F.col("choices").isNull(), ~F.coalesce(number.between(F.col("low"), F.col("high")), F.lit(False))).otherwise(~F.array_contains("choices", F.col("value")))
    text = F.when(F.col("choices").isNull(), F.concat_ws("", "name", F.lit(" "), "value", F.lit(" out of range"))).otherwise(F.concat_ws("", "name", F.lit(" '"), "value", F.lit("' not allowed")))
    errors = long.where(bad).groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", text.alias("t")))), lambda e: e["t"]), "; ").alias("_e"))
    lacks = F.when(~F.map_contains_key(config, F.lit("model_type")), "Missing required field: model_type")
    out = configs.join(errors, key, "left").select(key, F.nullif(F.concat_ws("; ", lacks, "_e"), F.lit("")).alias("error"))
    return out.select(key, F.col("error").isNull().alias("valid"), "error")


def contract_check(expr: DataFrame, cells: DataFrame, genes: DataFrame, contract: dict, metrics: DataFrame | None = None, log_normalized: bool | None = None, data_hash: str | None = None) -> DataFrame:
    """check, level, ok: one row a rule of the contract that applies. Warnings don't invalidate."""
    q = contract.get("qc_params", {})
    n_genes, n_cells = genes.agg(F.count("*").alias("g")), cells.agg(F.count("*").alias("c"))
    row = n_genes.crossJoin(n_cells)  # one row each
    checks = []
    if q.get("min_genes") is not None and q.get("max_genes") is not None:
        checks.append(("gene_count", "error", F.col("g").between(q["min_genes"], q["max_genes"])))
    checks.append(("cell_count", "error", F.col("c") >= q.get("min_cells", 0)))
    if q.get("max_mito_pct") is not None and metrics is not None:
        row = row.crossJoin(metrics.agg(F.max("pct_counts_mito").alias("m")))
        checks.append(("max_mito_pct", "warning", F.coalesce(F.col("m") <= q["max_mito_pct"], F.lit(True))))
    if contract.get("n_hvg") is not None and "highly_variable" in genes.columns:
        row = row.crossJoin(genes.agg(F.count_if("highly_variable").alias("h")))
        checks.append(("n_hvg", "warning", F.col("h") == contract["n_hvg"]))
    if contract.get("normalization") and log_normalized is not None:
        checks.append(("normalization", "error", F.lit(log_normalized)))
    if contract.get("data_hash"):
        checks.append(("data_hash", "error", F.lit(data_hash == contract["data_hash"])))
    return row.select(F.explode(F.array(*(F.struct(F.lit(n).alias("check"), F.lit(level).alias("level"), ok.alias("ok")) for n, level, ok in checks))).alias("e")).select("e.*")


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: rows, columns, and an order-free digest of all rows: the sum of their hashes modulo 2^64, so copies of a row
    don't cancel and nothing but sums is shuffled."""
    total = F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(28,0)")), F.lit(0))
    digest = F.pmod(total, F.lit(str(2**64)).cast("decimal(38,0)")).cast("decimal(20,0)").cast("string")
    return df.agg(F.count("*").alias("n_rows"), digest.alias("digest")).withColumn("n_columns", F.lit(len(df.columns)))


def stage_summary(stages: DataFrame) -> DataFrame:
    """Per run: stages, completed and failed ones, seconds, cells at its start and end, status."""
    first, last = F.min_by("cells_in", F.struct("ord", "cells_in")), F.max_by("cells_out", F.struct("ord", "cells_out"))
    agg = stages.groupBy("run_id").agg(F.count("*").alias("n_stages"), F.count_if(F.col("status") == "completed").alias("n_completed"), F.count_if(F.col("status") == "failed").alias("n_failed"), F.sum("seconds").alias("seconds"), first.alias("cells_in"), last.alias("cells_out"))
    return agg.withColumn("status", F.when(F.col("n_failed") > 0, "failed").when(F.col("n_completed") == F.col("n_stages"), "completed").otherwise("running"))


def run_list(stages: DataFrame) -> DataFrame:
    """run_id, started, stages that are completed, in order."""
    done = F.array_sort(F.collect_list(F.when(F.col("status") == "completed", F.struct("ord", "stage"))))
    return stages.groupBy("run_id").agg(F.min("started").alias("started"), F.array_join(F.transform(done, lambda e: e["stage"]), ",").alias("completed"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
