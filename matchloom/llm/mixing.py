"""Mixing sources to target weights, by Pareto order sampling.

Each document has an expected number of copies. Its whole part is certain; the rest is an inclusion
probability p, and documents are ranked by the random odds u / (1 - u) divided by p / (1 - p). From each
source the first documents of that order are taken until the source's remaining words are reached.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

WORD = r"[^\x20\x09-\x0D]+"
CYCLE, SHARE, LIMIT = (5, 2, 1), 1.5, 2
BUCKETS = 4096


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the key and seed alone; 48 bits of MD5, which other engines have too."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def targets(totals: DataFrame, cycle: tuple[int, ...] = CYCLE, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """Words that each source should give: (source, source_size) to (source, source_size, target).

    Sources in code-point order, null last, weigh as the cycle says, and together get `share` of all
    words. None gets above limit times its size; what that leaves over is shared by weight among the
    others. That is min(limit * size, level * weight) for one level, found over sources sorted by
    size over weight. One row a source, so one small task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(cycle))) + 1).cast("int")))
    weighed = weighed.withColumn("most", limit * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, whole = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0))
    level = left / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    found = weighed.withColumn("level", level).withColumn("at", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", F.col("source").isNull().alias("last"), "source", "level"))).over(whole))
    capped = F.col("at").isNull() | (F.col("ratio") < F.col("at.ratio"))
    return found.select("source", "source_size", F.when(capped, F.col("most").cast("double")).otherwise(F.least(F.col("most").cast("double"), F.col("at.level") * F.col("weight"))).alias("target"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cycle: tuple[int, ...] = CYCLE, share: float = SHARE, limit: int = LIMIT, seed: int = 20, buckets: int = BUCKETS) -> DataFrame:
    """How often the mix takes each document: id, source, size, source_size, target, copies, taken (copies * size).

    size is the number of words (0 for a null text). A source's words come within half a document of its
    target, as far as whole documents allow: in Pareto order a document is taken if at least half of it
    fits. Null sources are a source; rows of equal ids are ranked by size; no words at all give targets 0.
    Other columns are not carried. Reruns agree, because the random numbers are digests of the ids.

    No source is gathered in one task: words are summed by source and slice of the order's range first,
    and only the one slice of each source that holds the limit is ranked row by row.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "mix")
    sized = scratch.cut(df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "sized")
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, share, limit)
    goal = goal.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).withColumn("sure", F.floor("rate").cast("long"))
    goal = goal.withColumn("p", F.col("rate") - F.col("sure")).withColumn("left", F.col("target") - F.col("sure") * F.col("source_size"))
    goal = scratch.cut(goal.withColumnRenamed("source", "goal_source"), "goal")

    odds = F.col("u") / (1 - F.col("u")) / (F.col("p") / (1 - F.col("p")))
    ranked = sized.join(goal, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source").withColumn("u", uniform(F.col("id"), seed))
    ranked = ranked.withColumn("rank_key", F.when(F.col("p") > 0, odds)).withColumn("slice", F.floor(F.col("rank_key") / (1 + F.col("rank_key")) * buckets).cast("int"))

    in_slices = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranked.where("slice is not null").groupBy("source", "slice").agg(F.sum("size").alias("words"), F.max("left").alias("left"))
    sums = sums.withColumn("ahead", F.coalesce(F.sum("words").over(in_slices), F.lit(0)))
    # A document counts if ahead + size / 2 <= left. Before the first slice that may fail, all do; at ahead > left, none.
    edge = sums.where((F.col("ahead") + F.col("words") > F.col("left")) & (F.col("ahead") <= F.col("left"))).groupBy("source").agg(F.min(F.struct("slice", "ahead")).alias("edge")).select(F.col("source").alias("edge_source"), "edge.slice", "edge.ahead").withColumnRenamed("slice", "edge_slice")
    placed = ranked.join(edge, F.col("source").eqNullSafe(F.col("edge_source")), "left").drop("edge_source")
    in_rows = Window.partitionBy("source").orderBy("rank_key", F.col("id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    at_edge = F.col("slice").isNotNull() & (F.col("slice") == F.col("edge_slice"))
    inside = placed.where(at_edge).withColumn("extra", (F.col("ahead") + F.coalesce(F.sum("size").over(in_rows), F.lit(0)) + F.col("size") / 2 <= F.col("left")).cast("long"))
    outside = placed.where(~F.coalesce(at_edge, F.lit(False))).withColumn("extra", F.coalesce(F.col("edge_slice").isNull() | (F.col("slice") < F.col("edge_slice")), F.lit(False)).cast("long") * F.col("slice").isNotNull().cast("long"))
    out = inside.unionByName(outside).withColumn("copies", F.col("sure") + F.col("extra"))
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
