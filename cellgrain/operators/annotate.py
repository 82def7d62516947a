"""Cell-type annotation: markers, votes, ontology, clusters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cellgrain.model import hash_rank, need, ratio
from cellgrain.operators.joins import lookup, numbered
from cellgrain.sources.layers import checkpoint

#: Marker genes of each cell type, in dictionary order.
MARKERS = {
    "Plasma cells": ["SDC1", "CD138", "TNFRSF17", "BCMA", "XBP1", "IRF4", "PRDM1"],
    "T cells": ["CD3D", "CD3E", "CD4", "CD8A", "CD8B"],
    "NK cells": ["NCAM1", "NKG7", "GNLY", "KLRD1"],
    "Monocytes": ["CD14", "LYZ", "CST3", "FCGR3A"],
    "B cells": ["CD79A", "MS4A1", "CD20", "CD19"],
    "Erythroid": ["HBA1", "HBB", "GYPA"],
    "HSC/progenitors": ["CD34", "KIT", "THY1"],
    "Osteoclasts": ["ACP5", "CTSK", "MMP9"],
    "Mast cells": ["KIT", "CPA3", "TPSAB1"],
}

#: Labels and their cell ontology ids, in the table's order.
ONTOLOGY = [
    ("Plasma cell", "CL:0000786"),
    ("Plasma cells", "CL:0000786"),
    ("Plasmacyte", "CL:0000786"),
    ("B cell", "CL:0000236"),
    ("B cells", "CL:0000236"),
    ("Memory B cell", "CL:0000813"),
    ("Memory B cells", "CL:0000813"),
    ("Naive B cell", "CL:0000817"),
    ("Naive B cells", "CL:0000817"),
    ("Mature B cell", "CL:0000993"),
    ("T cell", "CL:0000084"),
    ("T cells", "CL:0000084"),
    ("CD4+ T cell", "CL:0000624"),
    ("CD4+ T cells", "CL:0000624"),
    ("Helper T cell", "CL:0000624"),
    ("CD8+ T cell", "CL:0000625"),
    ("CD8+ T cells", "CL:0000625"),
    ("Cytotoxic T cell", "CL:0000625"),
    ("Regulatory T cell", "CL:0000819"),
    ("Regulatory T cells", "CL:0000819"),
    ("Naive T cell", "CL:0000898"),
    ("Memory T cell", "CL:0000813"),
    ("NK cell", "CL:0000930"),
    ("NK cells", "CL:0000930"),
    ("Natural killer cell", "CL:0000930"),
    ("Monocyte", "CL:0000576"),
    ("Monocytes", "CL:0000576"),
    ("Macrophage", "CL:0000235"),
    ("Macrophages", "CL:0000235"),
    ("Classical monocyte", "CL:0000860"),
    ("Intermediate monocyte", "CL:0000861"),
    ("Non-classical monocyte", "CL:0000862"),
    ("Dendritic cell", "CL:0000451"),
    ("Dendritic cells", "CL:0000451"),
    ("Myeloid dendritic cell", "CL:0000784"),
    ("Plasmacytoid dendritic cell", "CL:0000785"),
    ("Neutrophil", "CL:0000775"),
    ("Neutrophils", "CL:0000775"),
    ("Eosinophil", "CL:0000771"),
    ("Eosinophils", "CL:0000771"),
    ("Basophil", "CL:0000768"),
    ("Basophils", "CL:0000768"),
    ("Mast cell", "CL:0000097"),
    ("Mast cells", "CL:0000097"),
    ("HSC", "CL:0000037"),
    ("Hematopoietic stem cell", "CL:0000037"),
    ("Hematopoietic progenitor", "CL:0000049"),
    ("Progenitor", "CL:0000049"),
    ("Common myeloid progenitor", "CL:0000050"),
    ("Common lymphoid progenitor", "CL:0000051"),
    ("Erythrocyte", "CL:0000232"),
    ("Erythrocytes", "CL:0000232"),
    ("Red blood cell", "CL:0000232"),
    ("RBC", "CL:0000232"),
    ("Erythroid", "CL:0000762"),
    ("Megakaryocyte", "CL:0000557"),
    ("Megakaryocytes", "CL:0000557"),
    ("Platelet", "CL:0000233"),
    ("Osteoclast", "CL:0000182"),
    ("Osteoclasts", "CL:0000182"),
    ("Osteoblast", "CL:0000185"),
    ("Osteoblasts", "CL:0000185"),
    ("Fibroblast", "CL:0000057"),
    ("Fibroblasts", "CL:0000057"),
    ("Stromal cell", "CL:0000057"),
    ("Endothelial cell", "CL:0000115"),
    ("Endothelial cells", "CL:0000115"),
    ("Unknown", "CL:0000000"),
    ("Unassigned", "CL:0000000"),
]
#: The labels of the reference model, in order; their ids are those of ONTOLOGY.
MODEL_LABELS = [
    "B cell",
    "B cells",
    "T cell",
    "T cells",
    "CD4+ T cell",
    "CD8+ T cell",
    "NK cell",
    "NK cells",
    "Monocyte",
    "Monocytes",
    "Macrophage",
    "Macrophages",
    "Dendritic cell",
    "Dendritic cells",
    "Plasma cell",
    "Plasma cells",
    "Memory B cell",
    "Naive B cell",
    "Regulatory T cell",
    "Naive T cell",
    "Erythrocyte",
    "Megakaryocyte",
    "Neutrophil",
    "Eosinophil",
]
UNKNOWN = "CL:0000000"


def marker_table(spark: SparkSession, markers: dict[str, list[str]] | None = None) -> DataFrame:
    """cell_type, set_order, gene_id."""
    rows = [(t, i, g) for i, (t, genes) in enumerate((markers or MARKERS).items()) for g in genes]
    return spark.createDataFrame(rows, "cell_type string, set_order int, gene_id string")


def ontology_table(spark: SparkSession, only: list[str] | None = None) -> DataFrame:
    """label, cl_id, ord."""
    ids = dict(ONTOLOGY)
    pairs = ONTOLOGY if only is None else [(label, ids[label]) for label in only]
    return spark.createDataFrame([(*p, i) for i, p in enumerate(pairs)], "label string, cl_id string, ord int")


def marker_scores(expr: DataFrame, cells: DataFrame, genes: DataFrame, markers: DataFrame, control: bool = False, n_control: int = 50, n_bins: int = 25) -> DataFrame:
    """cell_id, cell_type, set_order, score: the mean of the set's present genes (zeros count), less that of control
    genes. Controls: up to ``n_control`` other genes from each bin of mean expression that the set touches, in a
    fixed shuffled order. A set without present genes has a null score."""
    present = markers.join(genes.select("gene_id").distinct(), "gene_id", "left_semi")
    sizes = markers.select("cell_type", "set_order").distinct().join(present.groupBy("cell_type").agg(F.count("*").alias("size")), "cell_type", "left")
    sums = expr.join(present, "gene_id").groupBy("cell_id", "cell_type").agg(F.sum("value").alias("s"))
    # The result is this large: every cell by every set.
    out = cells.select("cell_id").crossJoin(F.broadcast(sizes)).join(sums, ["cell_id", "cell_type"], "left")
    score = F.when(F.col("size") > 0, F.coalesce("s", F.lit(0.0)) / F.col("size"))
    out = out.select("cell_id", "cell_type", "set_order", score.alias("score"))
    if not control:
        return out
    mean = genes.select("gene_id").join(expr.groupBy("gene_id").agg(F.sum("value").alias("m")), "gene_id", "left").fillna(0)
    ordered = checkpoint(numbered(mean, ["m", "gene_id"]))
    size, more = divmod(ordered.count(), n_bins)  # the first bins have one gene more
    binned = ordered.withColumn("bin", F.when(F.col("at") < more * (size + 1), F.floor(F.col("at") / (size + 1))).otherwise(F.floor((F.col("at") - more) / max(size, 1))))
    touched = present.join(binned, "gene_id").select("cell_type", "bin").distinct()
    pool = touched.join(binned, "bin").join(present.select("cell_type", "gene_id"), ["cell_type", "gene_id"], "left_anti")
    w = Window.partitionBy("cell_type", "bin").orderBy(hash_rank("gene_id", "cell_type"))
    chosen = checkpoint(pool.withColumn("k", F.row_number().over(w)).where(F.col("k") <= n_control).select("cell_type", "gene_id"))
    n = chosen.groupBy("cell_type").agg(F.count("*").alias("cn"))
    sets = chosen.groupBy("gene_id").agg(F.collect_list("cell_type").alias("_of"))
    back = lookup(expr, sets, ["gene_id"], ["cell_id"], "inner").withColumn("cell_type", F.explode("_of")).groupBy("cell_id", "cell_type").agg(F.sum("value").alias("cs"))
    both = lookup(out.join(back, ["cell_id", "cell_type"], "left"), n, ["cell_type"], ["cell_id"])
    return both.select("cell_id", "cell_type", "set_order", (F.col("score") - F.coalesce(F.coalesce("cs", F.lit(0.0)) / F.col("cn"), F.lit(0.0))).alias("score"))


def assign(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per cell its best set with a score of at least ``threshold``, else Unknown, and the best score. Ties go to the
    first set; null and NaN scores never win."""
    w = Window.partitionBy("cell_id").orderBy(F.desc("score"), "set_order")
    known = F.when(~F.isnan("score"), F.col("score"))
    best = scores.withColumn("score", known).withColumn("k", F.row_number().over(w.orderBy(F.col("score").desc_nulls_last(), "set_order"))).where("k = 1")
    return best.select("cell_id", F.when(F.col("score") >= threshold, F.col("cell_type")).otherwise("Unknown").alias("cell_type_marker"), F.col("score").alias("marker_score"))


def consensus(votes: DataFrame, methods: list[str], threshold: float = 0.5, skip_blank: bool = True) -> DataFrame:
    """Per cell the label with most votes (ties: the first by alphabet), its share of the valid votes, its votes, and
    whether the share reaches the threshold. Nulls don't vote, nor blanks if ``skip_blank``. Works on each row
    alone: no shuffle."""
    need(votes, *methods)
    valid = F.filter(F.array(*methods), lambda x: x.isNotNull() & ((x != "") if skip_blank else F.lit(True)))
    counted = F.transform(F.array_distinct(F.col("_v")), lambda x: F.struct((-F.size(F.filter(F.col("_v"), lambda y: y == x))).alias("n"), x.alias("label")))
    out = votes.withColumn("_v", valid).withColumn("_b", F.array_min(counted))
    n, votes_for = F.size("_v"), -F.col("_b.n")
    share = F.when(n > 0, votes_for / n).otherwise(0.0)
    return out.withColumns({"cell_type_consensus": F.coalesce("_b.label", F.lit("Unknown")), "consensus_confidence": share, "consensus_agreement": F.coalesce(votes_for, F.lit(0)), "confident": share >= threshold}).drop("_v", "_b")


def build_consensus(votes: DataFrame, methods: list[str], threshold: float = 0.5, min_methods: int = 2) -> DataFrame:
    """As consensus(), blanks vote. ValueError for unknown methods or fewer than ``min_methods``."""
    if len(methods) < min_methods:
        raise ValueError(f"{len(methods)} methods; at least {min_methods} are needed")
    return consensus(votes, methods, threshold, skip_blank=False)


def uncertain(annotated: DataFrame, threshold: float = 0.5) -> DataFrame:
    return annotated.where(F.col("consensus_confidence") < threshold)


def disagreement(annotated: DataFrame, methods: list[str] | None = None, compat: bool = False) -> DataFrame:
    """Cells whose agreement is under their number of votes. By default every ``cell_type_`` column is a method but
    the consensus; ``compat`` counts that one, too, as published results do."""
    names = methods or [c for c in annotated.columns if c.startswith("cell_type_") and (compat or c != "cell_type_consensus")]
    given = reduce(lambda a, b: a + b, (F.col(c).isNotNull().cast("int") for c in names))
    return annotated.where(F.col("consensus_agreement") < given)


def map_labels(df: DataFrame, label: str, table: DataFrame, out: str = "cl_id", case_sensitive: bool = False, keep_unmapped: bool = True) -> DataFrame:
    """Adds the ontology id of a trimmed label. Others stay as they are, or become the unknown id."""
    key = F.trim(F.col(label)) if case_sensitive else F.lower(F.trim(F.col(label)))
    side = table.select((F.col("label") if case_sensitive else F.lower("label")).alias("_key"), F.col("cl_id").alias("_id"), "ord")
    side = side.groupBy("_key").agg(F.max_by("_id", "ord").alias("_id"))
    joined = df.withColumn("_key", key).join(F.broadcast(side), "_key", "left")  # a fixed table
    kept = F.col(label) if keep_unmapped else F.lit(UNKNOWN)
    return joined.withColumn(out, F.coalesce("_id", kept)).drop("_key", "_id")


def label_names(table: DataFrame) -> DataFrame:
    """Per id the first and the last of its labels."""
    return table.groupBy("cl_id").agg(F.min_by("label", "ord").alias("first_label"), F.max_by("label", "ord").alias("last_label"))


def invalid_labels(df: DataFrame, label: str, table: DataFrame) -> DataFrame:
    """Distinct labels that are no id of the table."""
    return df.select(F.col(label).alias("label")).where("label is not null").distinct().join(table.select(F.col("cl_id").alias("label")).distinct(), "label", "left_anti")


def cluster_majority(labels: DataFrame, cluster: str, label: str, out: str = "majority_label") -> DataFrame:
    """Adds the most frequent label of the row's cluster (ties: the first by alphabet)."""
    n = labels.where(F.col(label).isNotNull()).groupBy(cluster, label).agg(F.count("*").alias("_n"))
    best = n.groupBy(cluster).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(label).alias("l"))).alias("_b")).select(cluster, F.col("_b.l").alias(out))
    return labels.join(best, cluster, "left")


def comparison(votes: DataFrame, methods: list[str]) -> DataFrame:
    """Per method its distinct labels and the percentage of cells that are Unknown, blank or null."""
    long = votes.select(F.explode(F.array(*(F.struct(F.lit(m).alias("method"), F.col(m).alias("label")) for m in methods))).alias("e")).select("e.*")
    lost = F.col("label").isNull() | F.col("label").isin("", "Unknown")
    return long.groupBy("method").agg(F.count_distinct(F.when(~lost, F.col("label"))).alias("n_types"), (100 * ratio(F.count_if(lost), F.count("*"))).alias("pct_unknown"))
