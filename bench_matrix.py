"""Times the preprocessing pipeline on a matrix of the published run's shape: 41,157 genes and some 1,672 entries a cell, made by
rule. Cells are an argument: 119,587 are the published run's. Prints one line of JSON."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

GENES, PER_CELL, PUBLISHED_CELLS, PUBLISHED_SECONDS = 41_157, 1_672, 119_587, 300


def main(n_cells: int) -> None:
    from pyspark.sql import SparkSession, functions as F

    from cellgrain.operators import preprocess

    cpus, shared = os.environ.get("BENCH_CPUS", "8"), tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "20g")).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(4 * int(cpus))).config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", shared).getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    # Entry k of a cell is a gene of the k-th stride, so genes are distinct in a cell; low strides have high counts.
    stride, rank = GENES // PER_CELL, F.col("k")
    k = spark.range(n_cells).select(F.col("id").alias("cell_id"), F.explode(F.sequence(F.lit(0), F.lit(PER_CELL - 1))).alias("k"))
    high = F.when(rank < 40, 60).when(rank < 300, 8).otherwise(2)
    k.select("cell_id", (rank * stride + F.pmod(F.xxhash64("cell_id", "k"), F.lit(stride))).alias("gene_id"), (1 + F.pmod(F.xxhash64("k", "cell_id"), high)).cast("double").alias("value")).write.parquet(f"{shared}/expr")
    expr = spark.read.parquet(f"{shared}/expr")
    genes = spark.range(GENES).select(F.col("id").alias("gene_id"), (F.col("id") % 1000 == 0).alias("mito"), (F.col("id") % 500 == 1).alias("ribo"))
    cells = spark.range(n_cells).select(F.col("id").alias("cell_id"), (F.col("id") % 40).alias("patient_id"), (F.col("id") % 2).cast("string").alias("batch"))
    entries, began = expr.count(), time.time()
    tables, report = preprocess.run(expr, cells, genes, {"min_genes": 200, "max_genes": 6000, "max_mito": 20}, min_cells=10)
    parts = {"run": round(time.time() - began, 1)}
    for name in ("counts", "expr", "cells", "genes"):
        at = time.time()
        tables[name].write.format("noop").mode("overwrite").save()
        parts[name] = round(time.time() - at, 1)
    kept, seconds = report.first(), time.time() - began
    published = PUBLISHED_CELLS * PER_CELL / PUBLISHED_SECONDS
    print(json.dumps({"metric": "preprocessing pipeline", "cells": n_cells, "entries": entries, "cells_kept": kept["n_cells_after"], "genes_kept": kept["n_genes_after"], "value": round(seconds, 1), "unit": "sec", "parts": parts, "entries_a_second": round(entries / seconds), "ratio_to_published": round(entries / seconds / published, 2)}))
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 12_000)
