"""Queries over metadata and labels: regular forms, annotation, votes, ontology, label metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellgrain.functions import metadata
from cellgrain.operators import annotate, metrics, reference_model
from cellgrain.plans.adapter import BASE, CELLS, EXPR, GENES, VOTES, cells, expr, genes, table, votes
from cellgrain.plans.expression import rounded
from cellgrain.plans.registry import query


def strings(s, d):
    """A text of every kind that the patterns know, from the customers."""
    k = F.pmod("c_custkey", F.lit(6))
    name = F.when(k == 0, F.concat(F.lit("Patient_"), "c_custkey", F.lit("_cell_1"))).when(k == 1, F.concat(F.lit("P"), "c_custkey")).when(k == 2, F.concat(F.lit("MM_"), "c_custkey")).when(k == 3, F.concat(F.lit("pm_"), "c_custkey")).when(k == 4, F.col("c_name"))
    status = F.element_at(F.array(*(F.lit(x) for x in STATUS)), (F.pmod("c_custkey", F.lit(len(STATUS))) + 1).cast("int"))
    return table(s, d, "customer").select("c_custkey", name.alias("sample_title"), status.alias("disease_state"), F.concat_ws("-", "c_mktsegment", F.lit("bone marrow")).alias("tissue"), F.when(k == 2, "10x Genomics").when(k == 3, "SmartSeq2").when(k == 4, F.col("c_mktsegment")).alias("technology"), "c_mktsegment")


STATUS = ["SMM", "smoldering myeloma", "smoldering", "MGUS", "Healthy donor", "x", "MM", "Multiple Myeloma", "control"]
STRINGS = f"""st AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'Patient_' || c_custkey || '_cell_1' WHEN 1 THEN 'P' || c_custkey WHEN 2 THEN 'MM_' || c_custkey WHEN 3 THEN 'pm_' || c_custkey WHEN 4 THEN c_name END AS sample_title,
  {STATUS!r}[c_custkey % {len(STATUS)} + 1] AS disease_state, c_mktsegment || '-bone marrow' AS tissue, CASE c_custkey % 6 WHEN 2 THEN '10x Genomics' WHEN 3 THEN 'SmartSeq2' WHEN 4 THEN c_mktsegment END AS technology, c_mktsegment FROM customer)"""
PATIENT = "coalesce(nullif(regexp_extract(sample_title, '[Pp]atient[_-]?(\\d+)', 0), ''), nullif(regexp_extract(sample_title, '[Pp](\\d+)', 0), ''), nullif(regexp_extract(sample_title, '[Mm][Mm]_?(\\d+)', 0), ''), nullif(regexp_extract(sample_title, '[Pp][Mm]_?(\\d+)', 0), ''), 'unknown_' || CAST(('0x' || substr(md5(coalesce(sample_title, '')), 1, 8))::BIGINT % 1000 AS VARCHAR))"
TYPE = "CASE WHEN contains(lower(disease_state), 'mm') OR contains(lower(disease_state), 'myeloma') THEN 'MM' WHEN contains(lower(disease_state), 'smoldering') THEN 'SMM' WHEN contains(lower(disease_state), 'mgus') THEN 'MGUS' WHEN contains(lower(disease_state), 'normal') OR contains(lower(disease_state), 'healthy') OR contains(lower(disease_state), 'control') OR contains(lower(disease_state), 'donor') THEN 'healthy' ELSE 'unknown' END"
TISSUE = "translate(lower(coalesce(tissue, 'bone_marrow')), ' -', '__')"
TECH = "replace(replace(lower(coalesce(technology, 'unknown')), '10x', '10x_genomics'), 'smartseq', 'smart_seq')"


@query("study_id", "SELECT o_orderkey AS cell_id, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'driver') AS study_id FROM orders")
def study_id(s, d):
    x = cells(s, d).select("cell_id", F.when(F.col("batch") != "P", F.col("batch")).alias("study"))
    return x.select("cell_id", metadata.study_id(x, "study", "driver").alias("study_id"))


@query("dataset_study_id", "SELECT coalesce(arg_min(nullif(o_orderstatus, 'P'), o_orderkey) FILTER (o_orderstatus <> 'P'), 'driver') AS study_id FROM orders")
def dataset_study_id(s, d):
    return metadata.first_study(cells(s, d).select("cell_id", F.when(F.col("batch") != "P", F.col("batch")).alias("study")), "study", "cell_id", "driver")


@query("patient_id", f"WITH {STRINGS} SELECT c_custkey, {PATIENT} AS patient_id FROM st")
def patient_id(s, d):
    return strings(s, d).select("c_custkey", metadata.patient_id(F.col("sample_title")).alias("patient_id"))


@query("sample_type", f"WITH {STRINGS} SELECT c_custkey, {TYPE} AS sample_type FROM st")
def sample_type(s, d):
    return strings(s, d).select("c_custkey", metadata.sample_type(F.col("disease_state")).alias("sample_type"))


@query("sample_type_counts", f"WITH {STRINGS} SELECT sample_type, count(*) AS n FROM (SELECT {TYPE} AS sample_type FROM st) GROUP BY 1")
def sample_type_counts(s, d):
    return sample_type(s, d).groupBy("sample_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "sample_type")


@query("tissue_norm", f"WITH {STRINGS} SELECT c_custkey, {TISSUE} AS tissue FROM st")
def tissue_norm(s, d):
    return strings(s, d).select("c_custkey", metadata.tissue(F.col("tissue")).alias("tissue"))


@query("technology_norm", f"WITH {STRINGS} SELECT c_custkey, {TECH} AS technology FROM st")
def technology_norm(s, d):
    return strings(s, d).select("c_custkey", metadata.technology(F.col("technology")).alias("technology"))


@query("batch_annotate", f"WITH {STRINGS} SELECT c_custkey, 'driver' AS study_id, {PATIENT} AS patient_id, {TYPE} AS sample_type, {TISSUE} AS tissue, {TECH} AS technology FROM st")
def batch_annotate(s, d):
    return metadata.annotate(strings(s, d), dataset="driver").select("c_custkey", "study_id", "patient_id", "sample_type", "tissue", "technology")


@query("characteristics", "SELECT c_custkey, concat_ws(' | ', c_mktsegment, n_name, 'tier ' || CAST(c_custkey % 3 AS VARCHAR)) AS characteristics FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def characteristics(s, d):
    n = table(s, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return table(s, d, "customer").join(n, "c_nationkey", "left").select("c_custkey", metadata.characteristics(F.array("c_mktsegment", "n_name", F.concat(F.lit("tier "), F.pmod("c_custkey", F.lit(3))))).alias("characteristics"))


@query("parsed_time", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(epoch_us(ts) AS DOUBLE) WHEN event_id % 3 = 1 THEN value END AS at FROM events")
def parsed_time(s, d):
    e = table(s, d, "events")
    text = F.when(e["event_id"] % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).when(e["event_id"] % 3 == 1, F.col("value").cast("string")).otherwise("never")
    return e.select("event_id", metadata.parsed_time(text).alias("at"))


def brand_markers(s, d):
    """Marker sets from the part brands, in the order of their names."""
    g = genes(s, d).where("size <= 10")
    order = g.select("marker_set").distinct().groupBy().agg(F.array_sort(F.collect_set("marker_set")).alias("o")).select(F.posexplode("o").alias("set_order", "marker_set"))  # 25 brands
    return g.join(F.broadcast(order), "marker_set").select(F.col("marker_set").alias("cell_type"), "set_order", "gene_id")


MARKED = f"WITH {EXPR}, {CELLS}, {GENES}, mk AS (SELECT marker_set AS cell_type, dense_rank() OVER (ORDER BY marker_set) - 1 AS set_order, gene_id FROM genes WHERE size <= 10), sz AS (SELECT cell_type, set_order, count(*) AS size FROM mk GROUP BY ALL), su AS (SELECT cell_id, cell_type, sum(value) AS s FROM expr JOIN mk USING (gene_id) GROUP BY ALL), sc AS (SELECT cell_id, cell_type, set_order, coalesce(s, 0) / size AS score FROM (SELECT cell_id, sz.cell_type, set_order, size FROM cells CROSS JOIN sz) LEFT JOIN su USING (cell_id, cell_type))"


@query("marker_mean", f"{MARKED} SELECT cell_id, cell_type, set_order, round(score, 6) AS score FROM sc")
def marker_mean(s, d):
    return rounded(annotate.marker_scores(expr(s, d), cells(s, d), genes(s, d), brand_markers(s, d)), "score")


CONTROLS = "me AS (SELECT gene_id, coalesce(m, 0) AS m FROM genes LEFT JOIN (SELECT gene_id, sum(value) AS m FROM expr GROUP BY gene_id) USING (gene_id)), bi AS (SELECT gene_id, ntile(25) OVER (ORDER BY m, gene_id) AS bin FROM me), to_ AS (SELECT DISTINCT cell_type, bin FROM mk JOIN bi USING (gene_id)), po AS (SELECT cell_type, gene_id, row_number() OVER (PARTITION BY cell_type, bin ORDER BY md5(concat_ws(':', gene_id, cell_type, '42'))) AS k FROM to_ JOIN bi USING (bin) WHERE NOT EXISTS (SELECT 1 FROM mk WHERE mk.cell_type = to_.cell_type AND mk.gene_id = bi.gene_id)), ch AS (SELECT cell_type, gene_id FROM po WHERE k <= 50), cn AS (SELECT cell_type, count(*) AS cn FROM ch GROUP BY 1), cs AS (SELECT cell_id, cell_type, sum(value) AS cs FROM expr JOIN ch USING (gene_id) GROUP BY ALL)"


@query("marker_score", f"{MARKED}, {CONTROLS} SELECT cell_id, cell_type, set_order, round(score - coalesce(coalesce(cs, 0) / cn, 0), 6) AS score FROM sc LEFT JOIN cs USING (cell_id, cell_type) LEFT JOIN cn USING (cell_type)")
def marker_score(s, d):
    return rounded(annotate.marker_scores(expr(s, d), cells(s, d), genes(s, d), brand_markers(s, d), control=True), "score")


SYMBOLS = sorted({g for genes_of in annotate.MARKERS.values() for g in genes_of})
BUILTIN = f"nm(n, symbol) AS (VALUES {', '.join(f'({i}, {chr(39)}{g}{chr(39)})' for i, g in enumerate(SYMBOLS))}), mk(cell_type, set_order, symbol) AS (VALUES {', '.join(f'({chr(39)}{t}{chr(39)}, {i}, {chr(39)}{g}{chr(39)})' for i, (t, gs) in enumerate(annotate.MARKERS.items()) for g in gs)})"


@query("marker_builtin", f"WITH {EXPR}, {CELLS}, {BUILTIN}, ex AS (SELECT cell_id, symbol, sum(value) AS value FROM expr JOIN nm ON n = gene_id % {len(SYMBOLS)} GROUP BY ALL), su AS (SELECT cell_id, cell_type, sum(value) AS s FROM ex JOIN mk USING (symbol) GROUP BY ALL), sz AS (SELECT cell_type, set_order, count(*) AS size FROM mk GROUP BY ALL), sc AS (SELECT cell_id, cell_type, set_order, round(coalesce(s, 0) / size, 9) AS score FROM (SELECT cell_id, sz.* FROM cells CROSS JOIN sz) LEFT JOIN su USING (cell_id, cell_type)) SELECT cell_id, CASE WHEN score >= 0.5 THEN cell_type ELSE 'Unknown' END AS cell_type_marker, round(score, 6) AS marker_score FROM sc QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY score DESC, set_order) = 1")
def marker_builtin(s, d):
    """The built-in marker sets over genes that bear the markers' names in turn."""
    name = F.element_at(F.array(*(F.lit(g) for g in SYMBOLS)), (F.pmod("gene_id", F.lit(len(SYMBOLS))) + 1).cast("int"))
    x = expr(s, d).groupBy("cell_id", name.alias("gene_id")).agg(F.sum("value").alias("value"))
    scores = annotate.marker_scores(x, cells(s, d), s.createDataFrame([(g,) for g in SYMBOLS], "gene_id string"), annotate.marker_table(s))
    return rounded(annotate.assign(scores.withColumn("score", F.round("score", 9))), "marker_score")


@query("marker_annotate", f"{MARKED}, rk AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY round(score, 9) DESC, set_order) AS k FROM sc) SELECT cell_id, CASE WHEN score >= 0.5 THEN cell_type ELSE 'Unknown' END AS cell_type_marker, round(score, 6) AS marker_score FROM rk WHERE k = 1")
def marker_annotate(s, d):
    scores = annotate.marker_scores(expr(s, d), cells(s, d), genes(s, d), brand_markers(s, d))
    return rounded(annotate.assign(scores.withColumn("score", F.round("score", 9))), "marker_score")


METHODS = ["cell_type_marker", "cell_type_model", "cell_type_neural"]


def tally(blank: bool) -> str:
    keep = "v IS NOT NULL" + ("" if blank else " AND v <> ''")
    return f"""ln AS (SELECT cell_id, unnest([cell_type_marker, cell_type_model, cell_type_neural]) AS v FROM votes), ct AS (SELECT cell_id, v, count(*) AS n FROM ln WHERE {keep} GROUP BY ALL),
bs AS (SELECT cell_id, arg_min(v, (-n, v)) AS best, max(n) AS n, sum(n) AS t FROM ct GROUP BY cell_id),
an AS (SELECT votes.*, coalesce(best, 'Unknown') AS cell_type_consensus, coalesce(n / t, 0) AS consensus_confidence, CAST(coalesce(n, 0) AS INTEGER) AS consensus_agreement, coalesce(n / t, 0) >= 0.5 AS confident FROM votes LEFT JOIN bs USING (cell_id))"""


SHOWN = "cell_id, cell_type_marker, cell_type_model, cell_type_neural, cell_type_consensus, round(consensus_confidence, 6) AS consensus_confidence, consensus_agreement, confident"


@query("consensus_annotate", f"WITH {VOTES}, {tally(False)} SELECT {SHOWN} FROM an")
def consensus_annotate(s, d):
    return rounded(annotate.consensus(votes(s, d), METHODS), "consensus_confidence")


@query("consensus_build", f"WITH {VOTES}, {tally(True)} SELECT {SHOWN} FROM an")
def consensus_build(s, d):
    return rounded(annotate.build_consensus(votes(s, d), METHODS), "consensus_confidence")


@query("uncertain_cells", f"WITH {VOTES}, {tally(False)} SELECT cell_id FROM an WHERE consensus_confidence < 0.6")
def uncertain_cells(s, d):
    return annotate.uncertain(annotate.consensus(votes(s, d), METHODS), 0.6).select("cell_id")


DISAGREE = "consensus_agreement < CAST(cell_type_marker IS NOT NULL AS INT) + CAST(cell_type_model IS NOT NULL AS INT) + CAST(cell_type_neural IS NOT NULL AS INT)"


@query("disagreement_cells", f"WITH {VOTES}, {tally(False)} SELECT cell_id, {DISAGREE} AS differs FROM an WHERE {DISAGREE} + 1")
def disagreement_cells(s, d):
    x = annotate.consensus(votes(s, d), METHODS)
    plain = annotate.disagreement(x).select("cell_id", F.lit(True).alias("differs"))
    return annotate.disagreement(x, compat=True).select("cell_id").join(plain, "cell_id", "left").fillna(False)


def raw_labels(s, d):
    """Labels as found: other case, blanks around, ids, unknown words and nulls."""
    names = F.array(*(F.lit(x) for x in RAW))
    return table(s, d, "orders").select(F.col("o_orderkey").alias("cell_id"), F.get(names, F.pmod("o_custkey", F.lit(len(RAW) + 1)).cast("int")).alias("label"))


RAW = [" b CELL ", "Plasma cell", "CL:0000786", "T cells", "memory t cell", "Memory B cell", "nothing", " odd ", "NK cell", "RBC", ""]
RAWSQL = f"raw AS (SELECT o_orderkey AS cell_id, {RAW!r}[o_custkey % {len(RAW) + 1} + 1] AS label FROM orders)"


def ontology_sql(only: list[str] | None = None) -> str:
    ids = dict(annotate.ONTOLOGY)
    pairs = [(x, ids[x]) for x in only] if only else annotate.ONTOLOGY
    return "onto(label, cl_id, ord) AS (VALUES " + ", ".join(f"('{a}', '{b}', {i})" for i, (a, b) in enumerate(pairs)) + ")"


@query("ontology_map", f"WITH {RAWSQL}, {ontology_sql()}, k AS (SELECT lower(label) AS key, arg_max(cl_id, ord) AS id FROM onto GROUP BY 1) SELECT cell_id, label, coalesce(id, label) AS cl_id FROM raw LEFT JOIN k ON key = lower(trim(label))")
def ontology_map(s, d):
    return annotate.map_labels(raw_labels(s, d), "label", annotate.ontology_table(s)).select("cell_id", "label", "cl_id")


@query("ontology_map_model", f"WITH {RAWSQL}, {ontology_sql(annotate.MODEL_LABELS)} SELECT cell_id, raw.label, coalesce(cl_id, 'CL:0000000') AS cl_id FROM raw LEFT JOIN onto ON onto.label = trim(raw.label)")
def ontology_map_model(s, d):
    return annotate.map_labels(raw_labels(s, d), "label", annotate.ontology_table(s, annotate.MODEL_LABELS), case_sensitive=True, keep_unmapped=False).select("cell_id", "label", "cl_id")


@query("ontology_reverse", f"WITH {RAWSQL}, {ontology_sql()}, u AS (SELECT DISTINCT cl_id FROM onto JOIN raw ON onto.label = raw.label) SELECT cl_id, arg_min(label, ord) AS first_label, arg_max(label, ord) AS last_label FROM onto SEMI JOIN u USING (cl_id) GROUP BY cl_id")
def ontology_reverse(s, d):
    onto = annotate.ontology_table(s)
    used = raw_labels(s, d).join(onto, "label").select("cl_id").distinct()
    return annotate.label_names(onto.join(used, "cl_id", "left_semi"))


@query("ontology_validate", f"WITH {RAWSQL}, {ontology_sql()} SELECT DISTINCT label FROM raw WHERE label IS NOT NULL AND label NOT IN (SELECT cl_id FROM onto)")
def ontology_validate(s, d):
    return annotate.invalid_labels(raw_labels(s, d), "label", annotate.ontology_table(s))


@query("cluster_majority_vote", f"WITH {CELLS}, n AS (SELECT patient_id, cell_type, count(*) AS n FROM cells WHERE cell_type IS NOT NULL GROUP BY ALL), b AS (SELECT patient_id, arg_min(cell_type, (-n, cell_type)) AS majority_label FROM n GROUP BY 1) SELECT cell_id, patient_id, cell_type, majority_label FROM cells LEFT JOIN b USING (patient_id)")
def cluster_majority_vote(s, d):
    return annotate.cluster_majority(cells(s, d).select("cell_id", "patient_id", "cell_type"), "patient_id", "cell_type")


@query("annotation_comparison", f"WITH {VOTES}, l AS (SELECT unnest(['cell_type_marker', 'cell_type_model', 'cell_type_neural']) AS method, unnest([cell_type_marker, cell_type_model, cell_type_neural]) AS label FROM votes) SELECT method, count(DISTINCT CASE WHEN label NOT IN ('', 'Unknown') THEN label END) AS n_types, round(100 * count(*) FILTER (label IS NULL OR label IN ('', 'Unknown')) / count(*), 6) AS pct_unknown FROM l GROUP BY method")
def annotation_comparison(s, d):
    return rounded(annotate.comparison(votes(s, d), METHODS), "pct_unknown")


# Two labels a row for the label metrics: a part's type and its size class.
def label_pairs(s, d):
    return table(s, d, "orders").select(F.col("o_orderpriority").alias("y_true"), F.when(F.col("o_totalprice") > 300000, "5-LOW").when(F.pmod("o_custkey", F.lit(3)) == 0, F.col("o_orderpriority")).otherwise("1-URGENT").alias("y_pred"))


PAIRS = "pr AS (SELECT o_orderpriority AS y_true, CASE WHEN o_totalprice > 300000 THEN '5-LOW' WHEN o_custkey % 3 = 0 THEN o_orderpriority ELSE '1-URGENT' END AS y_pred FROM orders), ct AS (SELECT y_true, y_pred, count(*) AS n FROM pr GROUP BY ALL), ra AS (SELECT y_true, sum(n) AS n FROM ct GROUP BY 1), rb AS (SELECT y_pred, sum(n) AS n FROM ct GROUP BY 1)"


@query("contingency", f"WITH {PAIRS} SELECT y_true, y_pred, n FROM ct")
def contingency(s, d):
    return metrics.contingency(label_pairs(s, d), "y_true", "y_pred")


ARI = "SELECT (pc - pa * pb / pn) / ((pa + pb) / 2 - pa * pb / pn) AS ari FROM (SELECT sum(n * (n - 1) / 2) AS pc, sum(n) * (sum(n) - 1) / 2 AS pn FROM ct), (SELECT sum(n * (n - 1) / 2) AS pa FROM ra), (SELECT sum(n * (n - 1) / 2) AS pb FROM rb)"
NMI = "SELECT (ha + hb - hc) / ((ha + hb) / 2) AS nmi FROM (SELECT ln(sum(n)) - sum(n * ln(n)) / sum(n) AS hc FROM ct), (SELECT ln(sum(n)) - sum(n * ln(n)) / sum(n) AS ha FROM ra), (SELECT ln(sum(n)) - sum(n * ln(n)) / sum(n) AS hb FROM rb)"


@query("ari", f"WITH {PAIRS} SELECT round(ari, 6) AS ari FROM ({ARI})")
def ari(s, d):
    return rounded(metrics.ari(label_pairs(s, d), "y_true", "y_pred"), "ari")


@query("nmi", f"WITH {PAIRS} SELECT round(nmi, 6) AS nmi FROM ({NMI})")
def nmi(s, d):
    return rounded(metrics.nmi(label_pairs(s, d), "y_true", "y_pred"), "nmi")


@query("classification_report", f"WITH {PAIRS}, j AS (SELECT ra.y_true, ra.n AS support, coalesce(ct.n, 0) AS tp, coalesce(rb.n, 0) AS called FROM ra LEFT JOIN ct ON ct.y_true = ra.y_true AND ct.y_pred = ra.y_true LEFT JOIN rb ON rb.y_pred = ra.y_true) SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(tp / support), 6) AS balanced_accuracy, round(sum(2 * tp / (support + called) * support) / sum(support), 6) AS f1_weighted FROM j")
def classification_report(s, d):
    return rounded(metrics.report(label_pairs(s, d), "y_true", "y_pred"), "accuracy", "balanced_accuracy", "f1_weighted")


CLASSES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("confusion_matrix", f"WITH {PAIRS} SELECT y_true, {', '.join(f'''count(*) FILTER (y_pred = '{c}') AS "{c}"''' for c in CLASSES)} FROM pr GROUP BY y_true")
def confusion_matrix(s, d):
    return metrics.confusion(label_pairs(s, d), "y_true", "y_pred", CLASSES)


@query("rare_recall", f"WITH {PAIRS}, ty AS (SELECT unnest(['2-HIGH', '5-LOW', 'absent']) AS cell_type) SELECT cell_type, round(coalesce(avg(CASE WHEN y_true = y_pred THEN 1.0 WHEN y_true IS NOT NULL THEN 0.0 END), 0), 6) AS recall FROM ty LEFT JOIN pr ON y_true = cell_type GROUP BY cell_type")
def rare_recall(s, d):
    types = s.createDataFrame([("2-HIGH",), ("5-LOW",), ("absent",)], "cell_type string")
    return rounded(metrics.rare_recall(label_pairs(s, d), "y_true", "y_pred", types), "recall")


@query("annotation_metrics", f"WITH {PAIRS} SELECT round(ari, 6) AS ari, round(nmi, 6) AS nmi, round(0.5 * ari + 0.5 * nmi, 6) AS score FROM ({ARI}), ({NMI})")
def annotation_metrics(s, d):
    x = label_pairs(s, d)
    both = metrics.ari(x, "y_true", "y_pred").crossJoin(metrics.nmi(x, "y_true", "y_pred"))  # one row each
    return rounded(metrics.composite(both, metrics.ANNOTATION_WEIGHTS), "ari", "nmi", "score")


def model_table(s, d):
    """A linear model of five labels on three quarters of the genes, by a rule from the table of parts."""
    p = table(s, d, "part").where("p_partkey % 4 <> 0").select(F.col("p_partkey").alias("gene_id"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k"))
    weights = p.select(F.concat(F.lit("type"), "k").alias("label"), "gene_id", ((F.pmod(F.col("gene_id") * (F.col("k") + 3), F.lit(11)) - 5) / 100).alias("weight"))
    starts = s.range(5).select(F.concat(F.lit("type"), "id").alias("label"), F.lit(None).cast("long").alias("gene_id"), (F.col("id") / 10).alias("weight"))
    return weights.unionByName(starts)


MODEL = "mw AS (SELECT p_partkey AS gene_id, k, ((p_partkey * (k + 3)) % 11 - 5) / 100 AS weight FROM part, range(5) r(k) WHERE p_partkey % 4 <> 0), ms AS (SELECT cell_id, k, sum(value * weight) AS s FROM expr JOIN mw USING (gene_id) GROUP BY ALL), mp AS (SELECT cell_id, k, coalesce(s, 0) + k / 10 AS score FROM cells CROSS JOIN range(5) r(k) LEFT JOIN ms USING (cell_id, k)), mx AS (SELECT *, exp(score - max(score) OVER (PARTITION BY cell_id)) AS e FROM mp)"


@query("reference_model_scores", f"{BASE}, {MODEL} SELECT cell_id, 'type' || k AS label, round(score, 6) AS score, round(e / sum(e) OVER (PARTITION BY cell_id), 6) AS probability FROM mx")
def reference_model_scores(s, d):
    return rounded(reference_model.probabilities(expr(s, d), cells(s, d), model_table(s, d)), "score", "probability")


@query("reference_model_labels", f"{BASE}, {MODEL} SELECT cell_id, 'type' || arg_min(k, (-round(e, 12), k)) AS predicted FROM mx GROUP BY cell_id")
def reference_model_labels(s, d):
    return reference_model.predict(expr(s, d), cells(s, d), model_table(s, d)).select("cell_id", "predicted")


@query("reference_model_coverage", "SELECT count(*) AS n_model_genes, count(*) AS n_found FROM part WHERE p_partkey % 4 <> 0")
def reference_model_coverage(s, d):
    return reference_model.coverage(genes(s, d), model_table(s, d))
