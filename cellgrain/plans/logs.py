"""Queries over splits, statistics and experiment logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellgrain.operators import splits, stats, trials as log
from cellgrain.plans.adapter import BASE, CELLS, TRIALS, cells, expr, table, trials
from cellgrain.plans.expression import METRICS, genes, metrics, rounded
from cellgrain.plans.registry import query

HASH = "md5({x} || ':42')"


def rank_of(key: str, by: str = "") -> str:
    return f"row_number() OVER ({by and f'PARTITION BY {by} '}ORDER BY md5(CAST({key} AS VARCHAR) || ':42'), {key})"


@query("patient_split", f"WITH {CELLS}, p AS (SELECT DISTINCT patient_id FROM cells WHERE patient_id IS NOT NULL), r AS (SELECT patient_id, {rank_of('patient_id')} <= greatest(1, ceil((SELECT count(*) FROM p) * 0.2)) AS is_test FROM p) SELECT cell_id, patient_id, is_test FROM cells JOIN r USING (patient_id)")
def patient_split(s, d):
    return splits.patient_split(cells(s, d).select("cell_id", "patient_id"), "patient_id")


@query("patient_split_stratified", f"WITH {CELLS}, n AS (SELECT patient_id, cell_type, count(*) AS n FROM cells GROUP BY ALL), w AS (SELECT patient_id, arg_min(cell_type, (-n, cell_type)) AS s FROM n GROUP BY 1), r AS (SELECT patient_id, {rank_of('patient_id', 's')} <= greatest(1, ceil(count(*) OVER (PARTITION BY s) * 0.2)) AS is_test FROM w) SELECT cell_id, patient_id, cell_type, is_test FROM cells JOIN r USING (patient_id)")
def patient_split_stratified(s, d):
    return splits.patient_split(cells(s, d).select("cell_id", "patient_id", "cell_type"), "patient_id", stratum="cell_type")


@query("time_split", f"WITH {CELLS} SELECT cell_id, epoch_us(ts) > (SELECT median(epoch_us(ts)) FROM cells) AS is_test FROM cells WHERE ts IS NOT NULL")
def time_split(s, d):
    return splits.time_split(cells(s, d).select("cell_id", "ts"), "ts").drop("ts")


@query("patient_folds", f"WITH {CELLS}, p AS (SELECT DISTINCT patient_id FROM cells WHERE patient_id IS NOT NULL) SELECT patient_id, CAST(({rank_of('patient_id')} - 1) % least(5, (SELECT count(*) FROM p)) AS INTEGER) AS fold FROM p")
def patient_folds(s, d):
    return splits.patient_folds(cells(s, d), "patient_id")


@query("patient_overlap", f"WITH {CELLS} SELECT count(*) AS n_shared, count(*) = 0 AS disjoint FROM (SELECT patient_id FROM cells WHERE batch = 'O' INTERSECT SELECT patient_id FROM cells WHERE batch = 'F')")
def patient_overlap(s, d):
    c = cells(s, d)
    return splits.overlap(c.where("batch = 'O'"), c.where("batch = 'F'"))


@query("fold_overlap", f"WITH {CELLS}, f AS (SELECT DISTINCT patient_id, CAST(cell_id % 3 AS INTEGER) AS fold FROM cells) SELECT a.fold AS fold_a, b.fold AS fold_b, count(*) AS n FROM f a JOIN f b ON a.patient_id = b.patient_id AND a.fold < b.fold GROUP BY ALL")
def fold_overlap(s, d):
    return splits.fold_overlap(cells(s, d).select("patient_id", F.pmod("cell_id", F.lit(3)).cast("int").alias("fold")))


@query("stratified_split", f"WITH {CELLS} SELECT cell_id, cell_type, {rank_of('cell_id', 'cell_type')} <= ceil(count(*) OVER (PARTITION BY cell_type) * 0.2) AS is_test FROM cells")
def stratified_split(s, d):
    return splits.stratified(cells(s, d).select("cell_id", "cell_type"), "cell_type", "cell_id")


@query("stratified_folds", f"WITH {CELLS} SELECT cell_id, cell_type, CAST(({rank_of('cell_id', 'cell_type')} - 1) % 5 AS INTEGER) AS fold FROM cells")
def stratified_folds(s, d):
    return splits.stratified(cells(s, d).select("cell_id", "cell_type"), "cell_type", "cell_id", parts=5)


# Scores of methods on blocks: mean price of an order priority (method) on a customer's orders (block) of a nation.
def scores(s, d):
    c = table(s, d, "customer").select(F.col("c_custkey").alias("patient_id"), F.pmod("c_custkey", F.lit(40)).cast("int").alias("block"))
    x = cells(s, d).join(c, "patient_id")
    return x.groupBy(F.col("batch").alias("grp"), F.col("cell_type").alias("method"), "block").agg(F.round(F.avg("price") / 1000, 1).alias("score"))


SCORES = f"{CELLS}, scores AS (SELECT batch AS grp, cell_type AS method, CAST(c_custkey % 40 AS INTEGER) AS block, round(avg(price) / 1000, 1) AS score FROM cells JOIN customer ON c_custkey = patient_id GROUP BY ALL)"
DRAW = "CAST(('0x' || substr(md5(b || ':' || i || ':42'), 1, 8))::BIGINT % len(vs) AS INTEGER) + 1"
PACK = "pk AS (SELECT grp, method, list(score ORDER BY block) AS vs FROM scores GROUP BY ALL), bo AS (SELECT grp, method, b, avg(vs[" + DRAW + "]) AS mean FROM (SELECT *, unnest(range(len(vs))) AS i FROM (SELECT *, unnest(range(1000)) AS b FROM pk)) GROUP BY ALL)"


@query("bootstrap_means", f"WITH {SCORES}, {PACK} SELECT grp, method, b, round(mean, 6) AS mean FROM bo")
def bootstrap_means(s, d):
    return rounded(stats.resamples(scores(s, d), ["grp", "method"], ["block"], "score"), "mean")


@query("bootstrap_ci", f"WITH {SCORES}, e AS (SELECT grp, method, avg(score) AS m, sum(score) AS t, count(*) AS n FROM scores GROUP BY ALL) SELECT grp, method, round(any_value(m), 6) AS estimate, round(sum(power(m - (t - score) / (n - 1), 3)) / (6 * power(sum(power(m - (t - score) / (n - 1), 2)), 1.5)), 6) AS acceleration FROM scores JOIN e USING (grp, method) GROUP BY ALL")
def bootstrap_ci(s, d):
    return rounded(stats.bca(scores(s, d), ["grp", "method"], ["block"], "score").select("grp", "method", "estimate", "acceleration"), "estimate", "acceleration")


@query("bootstrap_intervals")
def bootstrap_intervals(s, d):
    return stats.bca(scores(s, d), ["grp", "method"], ["block"], "score")


@query("bootstrap_large_groups")
def bootstrap_large_groups(s, d):
    """Mean metric of each family of trials: a few groups that hold all rows."""
    return stats.bca_large(trials(s, d), ["family"], ["trial_id"], "metric")


DIFFS = "df AS (SELECT a.grp, a.block, a.method AS method_a, b.method AS method_b, a.score - b.score AS d FROM scores a JOIN scores b ON a.grp = b.grp AND a.block = b.block AND a.method < b.method)"


@query("bootstrap_compare", f"WITH {SCORES}, {DIFFS}, pk AS (SELECT grp, method_a, method_b, list(d ORDER BY block) AS vs FROM df GROUP BY ALL), bo AS (SELECT grp, method_a, method_b, b, avg(vs[{DRAW}]) AS mean FROM (SELECT *, unnest(range(len(vs))) AS i FROM (SELECT *, unnest(range(1000)) AS b FROM pk)) GROUP BY ALL), ag AS (SELECT grp, method_a, method_b, quantile_cont(mean, 0.025) AS low, quantile_cont(mean, 0.975) AS high, least(1, 2 * least(count(*) FILTER (mean < 0), count(*) FILTER (mean > 0)) / count(*)) AS p FROM bo GROUP BY ALL), me AS (SELECT grp, method_a, method_b, avg(d) AS diff FROM df GROUP BY ALL) SELECT grp, method_a, method_b, round(diff, 6) AS diff, round(low, 6) AS low, round(high, 6) AS high, round(p, 6) AS p_value, low > 0 OR high < 0 AS significant FROM me JOIN ag USING (grp, method_a, method_b)")
def bootstrap_compare(s, d):
    x = stats.differences(scores(s, d), "method", "block", "score", ["grp"])
    return rounded(stats.compare(x, ["grp", "method_a", "method_b"], ["block"], "d"), "diff", "low", "high", "p_value")


WILCOXON = """us AS (SELECT *, abs(dd) AS a FROM (SELECT grp, method_a, method_b, round(d, 12) AS dd FROM df) WHERE dd <> 0),
rk AS (SELECT *, rank() OVER (PARTITION BY grp, method_a, method_b ORDER BY a) + (count(*) OVER (PARTITION BY grp, method_a, method_b, a) - 1) / 2 AS r FROM us),
wl AS (SELECT grp, method_a, method_b, count(*) AS n_used, least(coalesce(sum(r) FILTER (dd > 0), 0), coalesce(sum(r) FILTER (dd < 0), 0)) AS w FROM rk GROUP BY ALL), nn AS (SELECT grp, method_a, method_b, count(*) AS n FROM df GROUP BY ALL)"""


# The p-value by ways of its own: the exact distribution by a recursion over ranks, the normal tail by Simpson's rule.
P_VALUE = """te AS (SELECT grp, method_a, method_b, sum(t * t * t - t) AS ties FROM (SELECT grp, method_a, method_b, a, count(*) AS t FROM us GROUP BY ALL) GROUP BY ALL),
ex AS MATERIALIZED (WITH RECURSIVE z(n, w, k) AS (SELECT 0, 0, CAST(1 AS DOUBLE) UNION ALL SELECT n + 1, w + s * (n + 1), sum(k) FROM z, (VALUES (0), (1)) v(s) WHERE n < 50 GROUP BY 1, 2) SELECT n, w, sum(k) OVER (PARTITION BY n ORDER BY w) / power(2, n) AS below FROM z),
te2 AS MATERIALIZED (SELECT nn.*, coalesce(n_used, 0) AS n_used, coalesce(w, 0) AS w, coalesce(ties, 0) AS ties, abs(coalesce(w, 0) - coalesce(n_used, 0) * (coalesce(n_used, 0) + 1) / 4) / nullif(sqrt(greatest(n_used * (n_used + 1) * (2 * n_used + 1) / 24 - ties / 48, 0)), 0) AS x FROM nn LEFT JOIN wl USING (grp, method_a, method_b) LEFT JOIN te USING (grp, method_a, method_b)),
tl AS (SELECT grp, method_a, method_b, greatest(0, 1 - sqrt(2 / pi()) * sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * exp(-power(x * i / 2000, 2) / 2)) * x / 6000) AS tail FROM te2, range(0, 2001) r(i) WHERE x IS NOT NULL GROUP BY grp, method_a, method_b, x),
pv AS (SELECT te2.*, n_used = te2.n AND te2.n <= 50 AND ties = 0 AS exact, CASE WHEN te2.n < 2 THEN NULL WHEN n_used = te2.n AND te2.n <= 50 AND ties = 0 THEN least(1, 2 * below) ELSE coalesce(tail, 1) END AS p FROM te2 LEFT JOIN tl USING (grp, method_a, method_b) LEFT JOIN ex ON ex.n = te2.n AND ex.w = te2.w)"""
TEST = "grp, method_a, method_b, n, n_used, round(w, 6) AS w, round(CASE WHEN n >= 2 THEN 1 - 2 * w / (n * (n + 1)) END, 6) AS effect, round(p, 6) AS p_value"


@query("wilcoxon", f"WITH {SCORES}, {DIFFS}, {WILCOXON}, {P_VALUE} SELECT {TEST}, exact FROM pv")
def wilcoxon(s, d):
    x = stats.differences(scores(s, d), "method", "block", "score", ["grp"])
    return rounded(stats.wilcoxon(x, ["grp", "method_a", "method_b"]), "w", "effect", "p_value")


@query("bonferroni", f"WITH {TRIALS}, p AS (SELECT trial_id, family, (trial_id % 1000 + 1) / 100000 AS p_value FROM trials) SELECT trial_id, family, p_value, round(least(p_value * count(*) OVER (PARTITION BY family), 1), 6) AS p_corrected, p_value * count(*) OVER (PARTITION BY family) < 0.05 AS significant FROM p")
def bonferroni(s, d):
    p = trials(s, d).select("trial_id", "family", ((F.pmod("trial_id", F.lit(1000)) + 1) / 100000).alias("p_value"))
    return rounded(stats.bonferroni(p, ["family"]), "p_corrected")


@query("pairwise_methods", f"WITH {SCORES}, {DIFFS}, {WILCOXON}, {P_VALUE} SELECT {TEST}, round(least(p * count(p) OVER (PARTITION BY grp), 1), 6) AS p_corrected, p * count(p) OVER (PARTITION BY grp) < 0.05 AS significant FROM pv")
def pairwise_methods(s, d):
    return rounded(stats.all_pairs(scores(s, d), "method", "block", "score", group=["grp"]).drop("exact"), "w", "effect", "p_value", "p_corrected")


@query("pairwise_better", f"WITH {SCORES}, {DIFFS}, {WILCOXON}, {P_VALUE} SELECT grp, method_a, method_b, m > 0 AND p / 2 < 0.05 AS better FROM pv JOIN (SELECT grp, method_a, method_b, avg(d) AS m FROM df GROUP BY ALL) USING (grp, method_a, method_b)")
def pairwise_better(s, d):
    return stats.better(scores(s, d), "method", "block", "score", group=["grp"])


@query("friedman", f"WITH {SCORES}, g AS (SELECT s.* FROM scores s JOIN (SELECT grp, block FROM scores GROUP BY grp, block HAVING count(*) = (SELECT count(DISTINCT method) FROM scores z WHERE z.grp = scores.grp)) USING (grp, block)), r AS (SELECT *, rank() OVER (PARTITION BY grp, block ORDER BY score) + (count(*) OVER (PARTITION BY grp, block, score) - 1) / 2 AS r FROM g), c AS (SELECT grp, method, sum(r) AS s, count(*) AS n FROM r GROUP BY ALL), a AS (SELECT grp, sum(s * s) AS ss, max(n) AS n, count(*) AS m FROM c GROUP BY grp), t AS (SELECT grp, sum(t * t * t - t) AS ties FROM (SELECT grp, count(*) AS t FROM g GROUP BY grp, block, score) GROUP BY grp) SELECT grp, n AS n_blocks, m AS n_methods, round(CASE WHEN n >= 2 AND m >= 2 AND 1 - ties / (n * (m * m * m - m)) > 0 THEN (12 * ss / (n * m * (m + 1)) - 3 * n * (m + 1)) / (1 - ties / (n * (m * m * m - m))) END, 6) AS statistic FROM a JOIN t USING (grp)")
def friedman(s, d):
    return rounded(stats.friedman(scores(s, d), "method", "block", "score", ["grp"]).select("grp", "n_blocks", "n_methods", "statistic"), "statistic")


@query("fold_summary", f"WITH {SCORES} SELECT grp, method, round(avg(score), 6) AS mean, round(coalesce(stddev_samp(score), 0), 6) AS sd, min(score) AS low, max(score) AS high, count(*) AS n FROM scores GROUP BY ALL")
def fold_summary(s, d):
    return rounded(stats.summarize(scores(s, d), ["grp", "method"], "score").select("grp", "method", "mean", "sd", "low", "high", "n"), "mean", "sd")


@query("de_ranksum", f"{BASE}, lab AS (SELECT cell_id, batch = 'O' AS f FROM cells), sz AS (SELECT count(*) FILTER (f) AS n1, count(*) FILTER (NOT f) AS n2 FROM lab), b AS (SELECT gene_id, value, count(*) AS c, count(*) FILTER (f) AS c1 FROM expr JOIN lab USING (cell_id) WHERE value > 0 GROUP BY ALL), r AS (SELECT *, n1 + n2 - sum(c) OVER (PARTITION BY gene_id) AS z, coalesce(sum(c) OVER (PARTITION BY gene_id ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pre FROM b, sz) SELECT gene_id, any_value(n1) AS n_first, any_value(n2) AS n_rest, round(sum((z + pre + (c + 1) / 2) * c1) + (any_value(n1) - sum(c1)) * (any_value(z) + 1) / 2 - any_value(n1) * (any_value(n1) + 1) / 2, 4) AS u FROM r GROUP BY gene_id")
def de_ranksum(s, d):
    return rounded(stats.rank_sum(expr(s, d), cells(s, d), "batch", "O").select("gene_id", "n_first", "n_rest", "u"), "u", digits=4)


BY = ["user_id"]


@query("running_best", f"WITH {TRIALS} SELECT trial_id, user_id, metric, max(metric) OVER (PARTITION BY user_id ORDER BY trial_id ROWS UNBOUNDED PRECEDING) AS best_so_far FROM trials")
def running_best(s, d):
    return log.running_best(trials(s, d).select("trial_id", "user_id", "metric"), BY)


@query("improvements", f"WITH {TRIALS} SELECT user_id, count(*) FILTER (metric > before) AS n_improvements, count(*) AS n_trials FROM (SELECT *, lag(metric) OVER (PARTITION BY user_id ORDER BY trial_id) AS before FROM trials) GROUP BY user_id")
def improvements(s, d):
    return log.improvements(trials(s, d), BY)


@query("convergence", f"WITH {TRIALS}, r AS (SELECT *, max(metric) OVER (PARTITION BY user_id ORDER BY trial_id ROWS UNBOUNDED PRECEDING) AS best_so_far, row_number() OVER (PARTITION BY user_id ORDER BY trial_id) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM trials), q AS (SELECT *, abs(best_so_far - lag(best_so_far) OVER (PARTITION BY user_id ORDER BY trial_id)) AS step FROM r), a AS (SELECT user_id, avg(step) AS m, stddev_samp(metric) AS sd, max(metric) AS best, max(metric) FILTER (rn > n - greatest(1, floor(n / 5))) AS recent_best FROM q GROUP BY user_id) SELECT user_id, best, recent_best, round(CASE WHEN sd <> 0 THEN m / sd END, 6) AS rate, abs(recent_best - best) < 0.1 * sd AS converged FROM a")
def convergence(s, d):
    return rounded(log.convergence(trials(s, d), BY), "rate")


@query("param_importance", f"WITH {TRIALS} SELECT parameter, round(importance, 6) AS importance FROM (SELECT 'k' AS parameter, abs(corr(k, metric)) AS importance FROM trials UNION ALL SELECT 'user_id', abs(corr(user_id, metric)) FROM trials UNION ALL SELECT 'family', 0) ORDER BY importance DESC, parameter LIMIT 15")
def param_importance(s, d):
    return rounded(log.importance(trials(s, d), ["k", "user_id", "family"]), "importance")


@query("family_comparison", f"WITH {TRIALS} SELECT family, count(*) AS n, round(avg(metric), 6) AS mean, max(metric) AS best FROM trials GROUP BY family")
def family_comparison(s, d):
    return rounded(log.families(trials(s, d)), "mean")


@query("leaderboard", f"WITH {TRIALS} SELECT trial_id, metric, family FROM trials ORDER BY metric DESC, trial_id LIMIT 20")
def leaderboard(s, d):
    return log.leaderboard(trials(s, d).select("trial_id", "metric", "family"), 20)


@query("best_trial", f"WITH {TRIALS} SELECT user_id, arg_min(trial_id, (-metric, trial_id)) AS trial_id, max(metric) AS metric FROM trials WHERE metric IS NOT NULL GROUP BY user_id")
def best_trial(s, d):
    return log.best_trial(trials(s, d), BY)


@query("early_stop", f"WITH {TRIALS} SELECT user_id, count(*) AS n, count(*) >= 10 AND max(metric) FILTER (rn <= 10) < max(metric) AS stop FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY trial_id DESC) AS rn FROM trials) GROUP BY user_id")
def early_stop(s, d):
    return log.early_stop(trials(s, d), BY)


@query("search_status", f"WITH {TRIALS} SELECT user_id, max(metric) AS best, round(avg(metric), 6) AS mean, round(max(metric) - avg(metric), 6) AS gap, CASE WHEN max(metric) - avg(metric) < 0.01 THEN 'saturated' ELSE 'continue' END AS status, max(metric) FILTER (rn <= 10) >= max(metric) AS recent_best FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY trial_id DESC) AS rn FROM trials) GROUP BY user_id")
def search_status(s, d):
    return rounded(log.search_status(trials(s, d), BY), "mean", "gap")


@query("compare_runs", f"WITH {TRIALS} SELECT user_id AS run_id, round(avg(metric), 6) AS score FROM trials GROUP BY user_id")
def compare_runs(s, d):
    runs = trials(s, d).groupBy(F.col("user_id").alias("run_id")).agg(F.avg("metric").alias("score"))
    return rounded(log.compare_runs(runs, "score"), "score")


@query("flatten_metrics", "SELECT o_orderkey AS run_id, unnest(['integration_asw', 'integration_graph_k', 'total']) AS name, unnest([o_totalprice / 1000, o_custkey, o_totalprice]) AS value FROM orders")
def flatten_metrics(s, d):
    o = table(s, d, "orders")
    nested = F.struct(F.struct((F.col("o_totalprice") / 1000).alias("asw"), F.struct(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("text")).alias("graph")).alias("integration"), F.col("o_totalprice").alias("total"))
    return log.flatten(o.select(F.col("o_orderkey").alias("run_id"), nested.alias("results")), "run_id", "results")


CONFIG = {"n_latent": "CAST(CAST(k AS INTEGER) AS VARCHAR)", "n_layers": "CAST(CAST(user_id % 8 AS INTEGER) AS VARCHAR)", "gene_likelihood": "CASE WHEN user_id % 5 = 0 THEN 'gauss' ELSE 'nb' END"}


@query("validate_configs", f"""WITH {TRIALS}, c AS (SELECT trial_id, family, CASE WHEN k NOT BETWEEN 10 AND 50 THEN 'n_latent ' || {CONFIG['n_latent']} || ' out of range' END AS a, CASE WHEN user_id % 8 NOT BETWEEN 1 AND 5 THEN 'n_layers ' || {CONFIG['n_layers']} || ' out of range' END AS b, CASE WHEN user_id % 5 = 0 THEN 'gene_likelihood ''gauss'' not allowed' END AS g FROM trials)
SELECT trial_id, e IS NULL AS valid, e AS error FROM (SELECT trial_id, nullif(concat_ws('; ', CASE WHEN family = 'error' THEN 'Missing required field: model_type' END, a, b, g), '') AS e FROM c)""")
def validate_configs(s, d):
    t = trials(s, d)
    text = lambda c: c.cast("int").cast("string")
    pairs = F.create_map(F.lit("n_latent"), text(F.col("k")), F.lit("n_layers"), text(F.pmod("user_id", F.lit(8))), F.lit("gene_likelihood"), F.when(F.pmod("user_id", F.lit(5)) == 0, "gauss").otherwise("nb"))
    config = F.when(F.col("family") == "error", pairs).otherwise(F.map_concat(pairs, F.create_map(F.lit("model_type"), F.col("family"))))
    return log.validate_configs(s, t.select("trial_id", config.alias("config")))


@query("contract_check", f"{BASE}, {METRICS} SELECT 'gene_count' AS \"check\", 'error' AS level, (SELECT count(*) FROM genes) BETWEEN 200 AND 2500 AS ok UNION ALL SELECT 'cell_count', 'error', (SELECT count(*) FROM cells) >= 100 UNION ALL SELECT 'max_mito_pct', 'warning', (SELECT max(pct_counts_mito) FROM m) <= 20")
def contract_check(s, d):
    contract = {"qc_params": {"min_genes": 200, "max_genes": 2500, "max_mito_pct": 20, "min_cells": 100}}
    return log.contract_check(expr(s, d), cells(s, d), genes(s, d), contract, metrics(s, d))


@query("fingerprint")
def fingerprint(s, d):
    return log.fingerprint(expr(s, d))


def stages(s, d):
    """An order's lines as the stages of a run."""
    li = table(s, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("run_id"), (F.col("l_linenumber") * 100000 + F.col("l_partkey")).alias("ord"), F.concat(F.lit("s"), "l_linenumber").alias("stage"), F.when(F.col("l_returnflag") == "R", "failed").when(F.col("l_returnflag") == "A", "completed").otherwise("running").alias("status"), F.col("l_quantity").alias("seconds"), F.col("l_suppkey").alias("cells_in"), F.col("l_partkey").alias("cells_out"), F.col("l_shipdate").alias("started"))


STAGES = "stages AS (SELECT l_orderkey AS run_id, l_linenumber * 100000 + l_partkey AS ord, 's' || l_linenumber AS stage, CASE l_returnflag WHEN 'R' THEN 'failed' WHEN 'A' THEN 'completed' ELSE 'running' END AS status, l_quantity AS seconds, l_suppkey AS cells_in, l_partkey AS cells_out, l_shipdate AS started FROM lineitem)"


@query("stage_summary", f"WITH {STAGES} SELECT run_id, count(*) AS n_stages, count(*) FILTER (status = 'completed') AS n_completed, count(*) FILTER (status = 'failed') AS n_failed, sum(seconds) AS seconds, arg_min(cells_in, (ord, cells_in)) AS cells_in, arg_max(cells_out, (ord, cells_out)) AS cells_out, CASE WHEN count(*) FILTER (status = 'failed') > 0 THEN 'failed' WHEN count(*) FILTER (status = 'completed') = count(*) THEN 'completed' ELSE 'running' END AS status FROM stages GROUP BY run_id")
def stage_summary(s, d):
    return log.stage_summary(stages(s, d))


@query("run_list", f"WITH {STAGES} SELECT run_id, min(started) AS started, coalesce(string_agg(stage, ',' ORDER BY ord, stage) FILTER (status = 'completed'), '') AS completed FROM stages GROUP BY run_id")
def run_list(s, d):
    return log.run_list(stages(s, d))
