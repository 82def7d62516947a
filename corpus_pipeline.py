"""A training corpus from raw documents: quality classifier, quality rules, near copies, packing.

Every stage takes what its predecessor kept. All but the last return the columns of ``documents``; their decisions
are rows that go. A table without rows stays one without rows; rows that share an id are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cellgrain.llm import hilbert, mcd, simhash, zstdclf
from cellgrain.llm.common import crc_fold, lookup_join, parquet, table

#: A later stage needs scores, learned from labels, and packing: no SQL gives these rows.
ORACLE_SQL = None


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the compression classifier scores at its threshold or above."""
    model = zstdclf.fit(docs, parquet(spark, sf_dir, "labels"), crc_fold(F.col("doc_id"), 5) != 0)
    return zstdclf.score(docs, model, out="_quality").where(F.col("_quality") >= zstdclf.THRESHOLD).select(docs.columns)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and lie inside of their group's ellipsoid. A verdict depends on text, language and
    source alone, so only a digest of the text and both names (nulls told apart) of rejected rows meet the rows again."""
    keys = {"_row_key_1": F.md5(F.coalesce("text", F.lit(""))), "_row_key_2": F.to_json(F.struct("lang", "source"))}
    keyed = docs.withColumns(keys)
    gone = mcd.judge(keyed, [*keys]).where("not kept").select(*keys).distinct()
    return lookup_join(keyed, gone, [*keys], F.monotonically_increasing_id(), "left_anti").select(docs.columns)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: five-word shingles, an exact similarity of 0.8 or more."""
    return simhash.without_copies(docs).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences along the curve."""
    return hilbert.packed_pieces(docs)


STAGES = [("quality classifier", classify), ("quality rules", rules), ("simhash near-dedup", copies), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
