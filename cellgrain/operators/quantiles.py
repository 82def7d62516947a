"""Exact quantiles by distributed selection: many columns, groups and quantiles in the same passes.

A wanted rank has an interval that holds its value, at first from the least to the largest value of its group. A pass
counts the values of all open intervals in BINS bins of equal width, with the least and the largest value of each bin; the
bin with the rank is the next interval, already narrowed to the values in it. A pass divides the rows of an interval by up to
BINS, far outliers lose one bin, and an interval of one value is done, so evenly spread values need as many passes as BINS
must be multiplied to reach their number. Counts by bin are all that is shuffled, so no task holds a column's values, however large a group is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from cellgrain.operators.joins import lookup
from cellgrain.sources.layers import checkpoint, stored

BINS = 4096


def bin_of(x, low, high, bins: int = BINS):
    """0 to bins - 1 in the order of x; the ends are told apart even where they are infinite or not a number."""
    share = (x / 2 - low / 2) / (high / 2 - low / 2)
    inside = F.when(F.isnan(share), 1).otherwise(F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * (bins - 1)))
    return F.when(x == high, bins - 1).when(x == low, 0).otherwise(inside).cast("int")


def exact(df: DataFrame, wanted: dict[str, tuple[str, float]], by: Sequence[str] = (), bins: int = BINS) -> DataFrame:
    """A row a group (one row without groups): for each name of ``wanted`` the quantile of a column, interpolated
    between the nearest ranks. Nulls don't count; a group without values has null. Values are compared as doubles."""
    spark, columns = df.sparkSession, sorted({c for c, _ in wanted.values()})
    key = F.to_json(F.struct(*by)) if by else F.lit("")
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_x")) for c in columns))).alias("_s")
    long = checkpoint(df.select(*by, key.alias("_g"), cells).select(*by, "_g", "_s._c", "_s._x"))
    values = long.where("_x IS NOT NULL").select("_g", "_c", "_x")
    ranges = values.groupBy("_g", "_c").agg(F.count("*").alias("_n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    names = spark.createDataFrame([(name, c, float(p)) for name, (c, p) in wanted.items()], "_name string, _c string, _p double")
    asked = checkpoint(ranges.join(F.broadcast(names), "_c").withColumn("_at", (F.col("_n") - 1) * F.col("_p")))  # a row a name
    ranks = asked.select("_g", "_c", "lo", "hi", F.explode(F.array(F.floor("_at"), F.ceil("_at"))).alias("k")).distinct()
    state = stored(ranks.withColumn("before", F.lit(0).cast("long")))
    open_ = F.col("lo") != F.col("hi")
    while not state.where(open_).isEmpty():
        spans = state.where(open_).groupBy("_g", "_c").agg(F.collect_set(F.struct("lo", "hi")).alias("_spans"))
        inside = F.filter("_spans", lambda s: (F.col("_x") >= s["lo"]) & (F.col("_x") <= s["hi"]))
        met = lookup(values, spans, ["_g", "_c"], ["_x"], "inner").select("_g", "_c", "_x", F.explode(inside).alias("_s")).select("_g", "_c", "_x", "_s.*")
        counted = met.groupBy("_g", "_c", "lo", "hi", bin_of(F.col("_x"), F.col("lo"), F.col("hi"), bins).alias("bin")).agg(F.count("*").alias("m"), F.min("_x").alias("a"), F.max("_x").alias("b"))
        past = Window.partitionBy("_g", "_c", "lo", "hi").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # a row a bin
        counted = counted.withColumn("past", F.coalesce(F.sum("m").over(past), F.lit(0)))
        place = F.col("k") - F.col("before") - F.col("past")
        narrowed = state.where(open_).join(counted, ["_g", "_c", "lo", "hi"]).where((place >= 0) & (place < F.col("m")))
        narrowed = narrowed.select("_g", "_c", F.col("a").alias("lo"), F.col("b").alias("hi"), "k", (F.col("before") + F.col("past")).alias("before"))
        state = stored(state.where(~open_).unionByName(narrowed))
    found = state.select("_g", "_c", "k", F.col("lo").alias("v"))
    ends = asked.withColumns({"_low": F.floor("_at"), "_high": F.ceil("_at")})
    ends = ends.join(found.withColumnsRenamed({"k": "_low", "v": "_v"}), ["_g", "_c", "_low"]).join(found.withColumnsRenamed({"k": "_high", "v": "_w"}), ["_g", "_c", "_high"])
    value = F.when(F.col("_v") == F.col("_w"), F.col("_v")).otherwise((F.col("_high") - F.col("_at")) * F.col("_v") + (F.col("_at") - F.col("_low")) * F.col("_w"))
    wide = ends.groupBy("_g").agg(*(F.max(F.when(F.col("_name") == name, value)).alias(name) for name in wanted))
    if by:
        return long.select(*by, "_g").distinct().join(wide, "_g", "left").select(*by, *wanted)
    return spark.range(1).select(F.lit("").alias("_g")).join(wide, "_g", "left").select(*wanted)
