"""Resampling and rank statistics over long tables (group, method, block, score): many tests in one job. Only the closed
tail of a distribution is evaluated per result row."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cellgrain.model import hash_int
from cellgrain.operators.joins import lookup


def numbered(scores: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Adds i (from 0 in the group) and n."""
    w = Window.partitionBy(*group)
    return scores.withColumn("i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("n", F.count("*").over(w))


def resamples(scores: DataFrame, group: list[str], order: list[str], value: str, n_boot: int = 1000, seed: int = 42) -> DataFrame:
    """group, b, mean: draws with replacement. Draw i of resample b is the digest of b, i and the seed, modulo n.

    A group's values are scores of folds or blocks, so they travel as one array and every resample is a row."""
    packed = scores.where(F.col(value).isNotNull()).groupBy(*group).agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_v")))), lambda x: x["_v"]).alias("vs"))
    rows = packed.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1))))
    n = F.size("vs")
    draw = lambda i: hash_int(F.concat_ws(":", F.col("b").cast("string"), i.cast("string"), F.lit(str(seed)))) % n
    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda a, i: a + F.get(F.col("vs"), draw(i).cast("int")))
    return rows.select(*group, "b", (total / n).alias("mean"))


def bca(scores: DataFrame, group: list[str], order: list[str], value: str, n_boot: int = 1000, level: float = 0.95, seed: int = 42) -> DataFrame:
    """group, estimate, z0, acceleration, low, high: bias-corrected accelerated interval of the mean."""
    v = F.col(value)
    base = scores.where(v.isNotNull()).groupBy(*group).agg(F.avg(v).alias("estimate"), F.count(v).alias("n"), F.sum(v).alias("s"), F.collect_list(v).alias("vs"))
    # Jackknife means are (s - x) / (n - 1); their centre is the mean.
    dev = F.transform("vs", lambda x: F.col("estimate") - (F.col("s") - x) / (F.col("n") - 1))
    cube = F.aggregate("_d", F.lit(0.0), lambda a, x: a + x * x * x)
    square = F.aggregate("_d", F.lit(0.0), lambda a, x: a + x * x)
    accel = F.when(square > 0, cube / (6 * F.pow(square, F.lit(1.5)))).otherwise(0.0)
    base = base.withColumn("_d", F.when(F.col("n") > 1, dev).otherwise(F.array().cast("array<double>"))).select(*group, "estimate", accel.alias("acceleration"))
    boot = resamples(scores, group, order, value, n_boot, seed).join(base.select(*group, "estimate"), group)
    share = boot.groupBy(*group).agg((F.count_if(F.col("mean") < F.col("estimate")) / F.count("*")).alias("below"), F.array_sort(F.collect_list("mean")).alias("means"))
    rows = base.join(share, group)
    return with_limits(base.join(share, group), level).select(*group, "estimate", "acceleration", "z0", "low", "high")


def with_limits(rows: DataFrame, level: float) -> DataFrame:
    """Adds z0, low and high from below (the share of resampled means under the estimate), acceleration and the sorted means."""
    q = NormalDist()
    alpha = (1 - level) / 2

    def limits(below: pd.Series, accel: pd.Series, means: pd.Series) -> pd.DataFrame:
        out = []
        for p, a, m in zip(below, accel, means, strict=True):
            z0 = q.inv_cdf(min(max(p, 1 / (2 * len(m))), 1 - 1 / (2 * len(m))))
            ends = []
            for z in (q.inv_cdf(alpha), q.inv_cdf(1 - alpha)):
                at = q.cdf(z0 + (z0 + z) / (1 - a * (z0 + z))) * (len(m) - 1)
                lo = int(at)
                ends.append(m[lo] + (at - lo) * (m[min(lo + 1, len(m) - 1)] - m[lo]))
            out.append((z0, *ends))
        return pd.DataFrame(out, columns=["z0", "low", "high"])

    udf = F.pandas_udf(limits, "z0 double, low double, high double")
    return rows.withColumn("l", udf("below", "acceleration", "means")).select(*rows.columns, "l.*")


#: Rows weighed at once in a task (8 bytes a draw), and groups whose sums a task keeps before it hands them on.
WEIGHED, HELD = 256, 256
#: Fixed values by rule: the Poisson distribution of mean 1, cumulated and scaled to 64 bits.
POISSON = np.array([min(2**64 - 1, int(sum(math.exp(-1) / math.factorial(k) for k in range(j + 1)) * 2**64)) for j in range(20)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits from 64 (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def poisson_resamples(scores: DataFrame, group: list[str], order: list[str], value: str, n_boot: int = 1000, seed: int = 42) -> DataFrame:
    """group, b, mean for groups of any size: each row is in each resample as often as a Poisson number of mean 1 says, which
    follows from a hash of the row's group, order and the resample. Tasks send n_boot sums a group that they meet. A
    resample that drew no row has no mean."""
    rows = scores.where(F.col(value).isNotNull()).select(F.to_json(F.struct(*group)).alias("_g"), F.xxhash64(*group, *order, F.lit(seed)).alias("_h"), F.col(value).cast("double").alias("_v"))
    steps = mixed(np.arange(1, n_boot + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            sums = np.concatenate(list(held.values()), axis=1) if held else np.zeros((2, 0))
            names = pa.array(np.repeat(np.array(list(held), object), n_boot), pa.string())
            return pa.RecordBatch.from_arrays([names, pa.array(np.tile(np.arange(n_boot, dtype=np.int32), len(held))), pa.array(sums[0]), pa.array(sums[1])], names=["_g", "b", "w", "s"])

        for batch in batches:
            g, h, v = batch.column("_g").to_numpy(zero_copy_only=False), batch.column("_h").to_numpy().view(np.uint64), batch.column("_v").to_numpy()
            for name in dict.fromkeys(g):
                mine = np.flatnonzero(g == name)
                total = held.setdefault(name, np.zeros((2, n_boot)))
                for i in range(0, len(mine), WEIGHED):
                    some = mine[i : i + WEIGHED]
                    w = np.searchsorted(POISSON, mixed(h[some, None] ^ steps[None, :]), "right").astype(float)
                    total += np.stack([w.sum(axis=0), v[some] @ w])
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        yield out()

    sums = rows.mapInArrow(run, "_g string, b int, w double, s double").groupBy("_g", "b").agg(F.sum("w").alias("w"), F.sum("s").alias("s")).where("w > 0")
    schema = T.StructType([scores.schema[c] for c in group])
    return sums.select(F.from_json("_g", schema).alias("_k"), "b", (F.col("s") / F.col("w")).alias("mean")).select("_k.*", "b", "mean")


def bca_large(scores: DataFrame, group: list[str], order: list[str], value: str, n_boot: int = 1000, level: float = 0.95, seed: int = 42) -> DataFrame:
    """As bca(), by Poisson weights and central sums: no group is gathered, only its n_boot means are."""
    v = F.col(value)
    rows = scores.where(v.isNotNull())
    mean = rows.groupBy(*group).agg(F.avg(v).alias("estimate"), F.count(v).alias("n"))
    # Jackknife deviations are (x - mean) / (n - 1).
    dev = (v - F.col("estimate")) / F.nullif(F.col("n") - 1, F.lit(0))
    known = lookup(rows, mean, group, order)
    central = known.groupBy(*group).agg(F.first("estimate").alias("estimate"), F.sum(F.pow(dev, F.lit(3.0))).alias("_c"), F.sum(F.pow(dev, F.lit(2.0))).alias("_q"))
    base = central.select(*group, "estimate", F.when(F.col("_q") > 0, F.col("_c") / (6 * F.pow("_q", F.lit(1.5)))).otherwise(0.0).alias("acceleration"))
    boot = poisson_resamples(scores, group, order, value, n_boot, seed).join(base, group)
    share = boot.groupBy(*group).agg((F.count_if(F.col("mean") < F.col("estimate")) / F.count("*")).alias("below"), F.array_sort(F.collect_list("mean")).alias("means"))
    return with_limits(base.join(share, group), level).select(*group, "estimate", "acceleration", "z0", "low", "high")


def compare(diffs: DataFrame, group: list[str], order: list[str], value: str, n_boot: int = 1000, seed: int = 42) -> DataFrame:
    """Paired bootstrap: group, diff, low, high, p_value, significant (the interval excludes 0)."""
    boot = resamples(diffs, group, order, value, n_boot, seed)
    side = F.least(F.count_if(F.col("mean") < 0), F.count_if(F.col("mean") > 0)) / F.count("*")
    agg = boot.groupBy(*group).agg(F.percentile("mean", F.lit(0.025)).alias("low"), F.percentile("mean", F.lit(0.975)).alias("high"), F.least(2 * side, F.lit(1.0)).alias("p_value"))
    mean = diffs.groupBy(*group).agg(F.avg(value).alias("diff"))
    return mean.join(agg, group).withColumn("significant", (F.col("low") > 0) | (F.col("high") < 0))


def differences(scores: DataFrame, method: str, block: str, value: str, group: list[str] | None = None) -> DataFrame:
    """group, method_a < method_b, block, d: of all pairs of methods on the blocks that both have."""
    keys = [*(group or []), block]
    a = scores.select(*keys, F.col(method).alias("method_a"), F.col(value).alias("_a"))
    b = scores.select(*keys, F.col(method).alias("method_b"), F.col(value).alias("_b"))
    return a.join(b, keys).where("method_a < method_b").select(*keys, "method_a", "method_b", (F.col("_a") - F.col("_b")).alias("d"))


def normal_tail(z: Column) -> Column:
    """Two-sided tail of the standard normal distribution, by Chebyshev's approximation of erfc that Press et al.
    print in Numerical Recipes, 6.2 (error under 1.2e-7). Fixed values: its coefficients, in falling powers."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.5 * x)
    poly = F.lit(0.17087277)
    for c in (-0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368):
        poly = poly * t + c
    return t * F.exp(-x * x - 1.26551223 + t * poly)


#: Most differences whose rank sum is tested by its exact distribution.
EXACT = 50


@functools.cache
def rank_sum_counts(n: int) -> list[int]:
    """How many of the 2^n signs of the ranks 1 to n have each sum of positive ranks: rank k is in the sum or not."""
    counts = [1]
    for k in range(1, n + 1):
        counts = [a + b for a, b in zip(counts + [0] * k, [0] * k + counts, strict=True)]
    return counts


def signed_rank_p(n: int, used: int, w: float, ties: float) -> float:
    """Two-sided p-value of the smaller rank sum w of ``used`` of n differences: exact for at most EXACT of them without
    zeros and ties, else the normal tail with the variance of tied ranks."""
    if used == 0:
        return 1.0
    if used == n <= EXACT and ties == 0:
        return min(1.0, 2 * sum(rank_sum_counts(n)[: int(w) + 1]) / 2**n)
    variance = used * (used + 1) * (2 * used + 1) / 24 - ties / 48
    return math.erfc(abs(w - used * (used + 1) / 4) / math.sqrt(2 * variance)) if variance > 0 else 1.0


def wilcoxon(diffs: DataFrame, group: list[str], value: str = "d") -> DataFrame:
    """Signed-rank test: group, n (zeros included), n_used, w = min(W+, W-), effect 1 - 2w / (n(n+1)), p_value, and exact
    (whether it is of the exact distribution). Under two differences effect and p_value are null."""
    v = F.round(F.col(value), 12)
    rows = diffs.where(F.col(value).isNotNull()).withColumn("_d", v)
    n = rows.groupBy(*group).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*group)
    used = rows.where("_d <> 0").withColumn("_a", F.abs("_d"))
    used = used.withColumn("r", F.rank().over(w.orderBy("_a")) + (F.count("*").over(Window.partitionBy(*group, "_a")) - 1) / 2)
    ties = used.groupBy(*group, "_a").agg(F.count("*").alias("t")).groupBy(*group).agg(F.sum(F.pow("t", F.lit(3.0)) - F.col("t")).alias("ties"))
    sums = used.groupBy(*group).agg(F.sum(F.when(F.col("_d") > 0, F.col("r")).otherwise(0.0)).alias("plus"), F.sum(F.when(F.col("_d") < 0, F.col("r")).otherwise(0.0)).alias("minus"), F.count("*").alias("n_used")).join(ties, group)
    j = n.join(sums, group, "left").fillna(0)
    p = F.pandas_udf(lambda a, b, c, d: pd.Series([signed_rank_p(*x) for x in zip(a, b, c, d, strict=True)], dtype="float64"), "double")
    stat, enough = F.least("plus", "minus"), F.col("n") >= 2
    out = j.select(*group, "n", "n_used", stat.alias("w"), F.when(enough, 1 - 2 * stat / (F.col("n") * (F.col("n") + 1))).alias("effect"), p("n", "n_used", stat, "ties").alias("p_value"), ((F.col("n") == F.col("n_used")) & (F.col("n") <= EXACT) & (F.col("ties") == 0)).alias("exact"))
    return out.withColumn("p_value", F.when(enough, F.col("p_value")))


def bonferroni(tests: DataFrame, group: list[str] | None = None, alpha: float = 0.05, p: str = "p_value") -> DataFrame:
    """Adds p_corrected = min(p * tests, 1) and significant."""
    n = tests.groupBy(*(group or [])).agg(F.count(p).alias("_m"))
    out = tests.join(n, group) if group else tests.crossJoin(F.broadcast(n))
    return out.withColumn("p_corrected", F.least(F.col(p) * F.col("_m"), F.lit(1.0))).withColumn("significant", F.col("p_corrected") < alpha).drop("_m")


def all_pairs(scores: DataFrame, method: str, block: str, value: str, alpha: float = 0.05, group: list[str] | None = None) -> DataFrame:
    """wilcoxon() of all pairs of methods, corrected; in each ``group`` on its own."""
    keys = group or []
    return bonferroni(wilcoxon(differences(scores, method, block, value, keys), [*keys, "method_a", "method_b"]), keys, alpha)


def better(scores: DataFrame, method: str, block: str, value: str, alpha: float = 0.05, group: list[str] | None = None) -> DataFrame:
    """group, method_a, method_b, better: a has the larger mean and half the p-value is under alpha."""
    keys = [*(group or []), "method_a", "method_b"]
    d = differences(scores, method, block, value, group)
    mean = d.groupBy(*keys).agg(F.avg("d").alias("m"))
    return wilcoxon(d, keys).join(mean, keys).select(*keys, ((F.col("m") > 0) & (F.col("p_value") / 2 < alpha)).alias("better"))


def chi2_tail(x: float, df: int) -> float:
    """Upper tail of a chi-square distribution, by its series."""
    if x <= 0 or df <= 0:
        return 1.0
    a, h = df / 2, x / 2
    term = math.exp(a * math.log(h) - h - math.lgamma(a + 1))
    total, k = term, 1
    while term > total * 1e-15 and k < 10_000:
        term *= h / (a + k)
        total += term
        k += 1
    return max(0.0, 1 - total)


def friedman(scores: DataFrame, method: str, block: str, value: str, group: list[str] | None = None) -> DataFrame:
    """A row (one for each ``group``): blocks, methods, statistic with ties, p-value; null under two blocks. Blocks
    without all methods are left out."""
    keys = group or []
    rows = scores.where(F.col(value).isNotNull()).withColumn("_one", F.lit(1))  # all rows have this key
    all_of = ["_one", *keys]
    k = rows.groupBy(*all_of).agg(F.count_distinct(method).alias("k"))
    full = rows.groupBy(*all_of, block).agg(F.count("*").alias("c")).join(k, all_of).where("c = k").select(*all_of, block)
    rows = rows.join(full, [*all_of, block], "left_semi")
    r = rows.withColumn("r", F.rank().over(Window.partitionBy(*all_of, block).orderBy(value)) + (F.count("*").over(Window.partitionBy(*all_of, block, value)) - 1) / 2)
    cols = r.groupBy(*all_of, method).agg(F.sum("r").alias("s"), F.count("*").alias("n")).groupBy(*all_of).agg(F.sum(F.col("s") * F.col("s")).alias("ss"), F.max("n").alias("n_blocks"), F.count("*").alias("n_methods"))
    ties = rows.groupBy(*all_of, block, value).agg(F.count("*").alias("t")).groupBy(*all_of).agg(F.sum(F.pow("t", F.lit(3.0)) - F.col("t")).alias("ties"))
    n, m = F.col("n_blocks"), F.col("n_methods")
    raw = 12 * F.col("ss") / (n * m * (m + 1)) - 3 * n * (m + 1)
    fix = 1 - F.col("ties") / (n * (m * m * m - m))
    out = cols.join(ties, all_of).select(*keys, "n_blocks", "n_methods", F.when((n >= 2) & (m >= 2) & (fix > 0), raw / fix).alias("statistic"))
    tail = F.pandas_udf(lambda x, d: pd.Series([None if pd.isna(a) else chi2_tail(a, int(b)) for a, b in zip(x, d, strict=True)], dtype="float64"), "double")
    return out.withColumn("p_value", tail("statistic", F.col("n_methods") - 1)).withColumn("significant", F.col("p_value") < 0.05)


def t_quantile(df: int) -> float:
    """0.975 quantile of Student's distribution, by bisection on its incomplete beta function."""
    def upper(t: float) -> float:
        steps = 2000
        c = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
        h = t / steps
        f = lambda x: c * (1 + x * x / df) ** (-(df + 1) / 2)
        return 0.5 - h / 3 * sum((1 if i in (0, steps) else 4 if i % 2 else 2) * f(i * h) for i in range(steps + 1))

    lo, hi = 0.0, 13.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if upper(mid) > 0.025 else (lo, mid)
    return lo


def summarize(folds: DataFrame, group: list[str], value: str = "value") -> DataFrame:
    """Per group mean, sample deviation (0 for one), t-interval, min, max, n. Null and NaN are left out."""
    rows = folds.where(F.col(value).isNotNull() & ~F.isnan(value))
    agg = rows.groupBy(*group).agg(F.avg(value).alias("mean"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("sd"), F.min(value).alias("low"), F.max(value).alias("high"), F.count("*").alias("n"))
    # A table for small numbers of folds; the normal quantile beyond it.
    t = F.create_map(*(x for d in range(1, 31) for x in (F.lit(d), F.lit(t_quantile(d)))))
    half = F.coalesce(F.try_element_at(t, (F.col("n") - 1).cast("int")), F.when(F.col("n") > 31, F.lit(NormalDist().inv_cdf(0.975))), F.lit(0.0)) * F.col("sd") / F.sqrt("n")
    return agg.withColumns({"ci_low": F.col("mean") - half, "ci_high": F.col("mean") + half})


def rank_sum(expr: DataFrame, cells: DataFrame, group: str, first: str) -> DataFrame:
    """gene_id, n_first, n_rest, u, z, p_value: rank-sum test of each gene between the cells of one group and all others. Zeros
    are not stored: they share one average rank, which their number gives."""
    sizes = cells.agg(F.count_if(F.col(group) == first).alias("n1"), F.count_if(~F.col(group).eqNullSafe(F.lit(first))).alias("n2"))
    bars = expr.where("value > 0").join(cells.select("cell_id", F.coalesce(F.col(group) == first, F.lit(False)).alias("_f")), "cell_id").groupBy("gene_id", "value").agg(F.count("*").alias("c"), F.count_if("_f").alias("c1"))
    w = Window.partitionBy("gene_id")
    nz = F.sum("c").over(w)
    bars = bars.crossJoin(F.broadcast(sizes)).withColumn("zeros", F.col("n1") + F.col("n2") - nz)
    before = F.coalesce(F.sum("c").over(w.orderBy("value").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bars = bars.withColumn("r", F.col("zeros") + before + (F.col("c") + 1) / 2)
    agg = bars.groupBy("gene_id").agg(F.sum(F.col("r") * F.col("c1")).alias("rs"), F.sum("c1").alias("k1"), F.first("n1").alias("n1"), F.first("n2").alias("n2"), F.first("zeros").alias("zeros"), F.sum(F.pow("c", F.lit(3.0)) - F.col("c")).alias("ties"))
    z0 = F.col("zeros").cast("double")
    total = F.col("rs") + (F.col("n1") - F.col("k1")) * (z0 + 1) / 2
    u = total - F.col("n1") * (F.col("n1") + 1) / 2
    n = (F.col("n1") + F.col("n2")).cast("double")
    tie = F.col("ties") + z0 * z0 * z0 - z0
    sd = F.sqrt(F.col("n1") * F.col("n2") / 12.0 * (n + 1 - tie / (n * (n - 1))))
    out = agg.select("gene_id", F.col("n1").alias("n_first"), F.col("n2").alias("n_rest"), u.alias("u"), F.when(sd > 0, (u - F.col("n1") * F.col("n2") / 2.0) / sd).alias("z"))
    return out.withColumn("p_value", normal_tail(F.col("z")))
