"""The driver's tables as an expression matrix, embeddings, trials and votes; and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cell is an order, a gene a part, a value the quantity; a part may come twice in an order."""
    x = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene_id"), F.col("l_quantity").alias("value"))
    return x.groupBy("cell_id", "gene_id").agg(F.sum("value").alias("value"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "orders").select(c("o_orderkey").alias("cell_id"), c("o_custkey").alias("patient_id"), c("o_orderpriority").alias("cell_type"), c("o_orderstatus").alias("batch"), c("o_orderdate").alias("ts"), c("o_totalprice").alias("price"))


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "part").select(c("p_partkey").alias("gene_id"), c("p_name").alias("gene_name"), c("p_brand").alias("marker_set"), (c("p_type") == "ECONOMY").alias("mito"), (c("p_type") == "SMALL").alias("ribo"), c("p_size").alias("size"))


def emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "embeddings").select(c("vec_id").alias("cell_id"), c("embedding").cast("array<double>").alias("vec"), c("label"), F.pmod(c("vec_id"), F.lit(2)).cast("int").alias("batch"))


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "events").select(c("event_id").alias("trial_id"), c("value").alias("metric"), c("event_type").alias("family"), F.get_json_object("props", "$.k").cast("double").alias("k"), c("user_id"), c("ts"))


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three labels a cell from its lines: null without lines, blank for one of the flags."""
    li = table(spark, sf_dir, "lineitem")
    per = li.groupBy(F.col("l_orderkey").alias("cell_id")).agg(F.max("l_returnflag").alias("a"), F.min("l_returnflag").alias("b"), F.max(F.when(F.col("l_linestatus") == "O", "A").otherwise("")).alias("c"))
    return cells(spark, sf_dir).select("cell_id").join(per, "cell_id", "left").select("cell_id", F.col("a").alias("cell_type_marker"), F.col("b").alias("cell_type_model"), F.col("c").alias("cell_type_neural"))


#: The same as common table expressions.
EXPR = "expr AS (SELECT l_orderkey AS cell_id, l_partkey AS gene_id, sum(l_quantity) AS value FROM lineitem GROUP BY ALL)"
CELLS = "cells AS (SELECT o_orderkey AS cell_id, o_custkey AS patient_id, o_orderpriority AS cell_type, o_orderstatus AS batch, o_orderdate AS ts, o_totalprice AS price FROM orders)"
GENES = "genes AS (SELECT p_partkey AS gene_id, p_name AS gene_name, p_brand AS marker_set, p_type = 'ECONOMY' AS mito, p_type = 'SMALL' AS ribo, p_size AS size FROM part)"
EMB = "emb AS (SELECT vec_id AS cell_id, CAST(embedding AS DOUBLE[]) AS vec, label, CAST(vec_id % 2 AS INTEGER) AS batch FROM embeddings)"
TRIALS = "trials AS (SELECT event_id AS trial_id, value AS metric, event_type AS family, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, user_id, ts FROM events)"
VOTES = "votes AS (SELECT cells.cell_id, a AS cell_type_marker, b AS cell_type_model, c AS cell_type_neural FROM (SELECT o_orderkey AS cell_id FROM orders) cells LEFT JOIN (SELECT l_orderkey AS cell_id, max(l_returnflag) AS a, min(l_returnflag) AS b, max(CASE WHEN l_linestatus = 'O' THEN 'A' ELSE '' END) AS c FROM lineitem GROUP BY 1) USING (cell_id))"
BASE = f"WITH {EXPR}, {CELLS}, {GENES}"
