"""Sharding by global prefix sums: rows in a global order, cut at equal targets into contiguous balanced shards.

Rows are range-partitioned by the order, the partitions' totals are summed (one number each), and a running sum in
each partition gives every row the bytes before it in the whole table; a row's shard is where its first byte lies.
So a shard's size is off its target by less than the longest row.

Cases: a null text has no bytes, a null id comes first; equal ids are ordered by checksum and place; repeated rows
keep a slot each; fewer rows than shards leave shards empty; extra columns pass through; an empty table gives an
empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cellgrain.llm.common import prefix_sums


def contiguous_shards(df: DataFrame, order: list[str], size: str, shards: int) -> DataFrame:
    """Adds ``shard`` and ``slot`` (gapless in the shard) for a positive ``size``."""
    ranked, total = prefix_sums(df, order, size, "_start", also="_at")
    cut_at = ranked.withColumn("shard", F.least(F.expr(f"_start * {shards} div {max(total, 1)}"), F.lit(shards - 1)).cast("int"))
    first = cut_at.groupBy("shard").agg(F.min("_at").alias("_first"))  # one row a shard
    return cut_at.join(F.broadcast(first), "shard").withColumn("slot", F.col("_at") - F.col("_first")).drop("_start", "_at", "_first")


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """The contract's rows, in the order of ids."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.monotonically_increasing_id().alias("_row"))
    out = contiguous_shards(rows, ["doc_id", "text_crc32", "_row"], "size", shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def crc32_sql(text: str) -> str:
    """CRC-32 of a text as DuckDB SQL: bytes from hexadecimal digits, reduced four bits at a time. The table follows from the
    polynomial."""

    def entry(n: int) -> int:
        for _ in range(4):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        return n

    table = str([entry(n) for n in range(16)])
    nibble = lambda a, b: f"xor(({a}) >> 4, {table}[(xor({a}, {b}) & 15) + 1])"
    digits = f"list_transform(string_split(hex({text}), ''), lambda c: CAST(instr('0123456789ABCDEF', c) - 1 AS BIGINT))"
    data = f"list_transform(list_zip({digits}[1:-1:2], {digits}[2:-1:2]), lambda z: z[1] * 16 + z[2])"
    return f"xor(CASE WHEN {text} = '' THEN 4294967295 ELSE list_reduce({data}, lambda a, b: {nibble(nibble('a', 'b'), '(b >> 4)')}, 4294967295) END, 4294967295)"


def sql(shards: int = 24) -> str:
    return f"""WITH d AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size, coalesce(text, '') AS text FROM documents),
c AS (SELECT doc_id, size, {crc32_sql('text')} AS text_crc32 FROM d),
r AS (SELECT *, sum(size) OVER w - size AS before, row_number() OVER w AS k FROM c WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32 ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, CAST(least({shards - 1}, before * {shards} // (SELECT sum(size) FROM c)) AS INTEGER) AS shard FROM r)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard, k - min(k) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s"""
