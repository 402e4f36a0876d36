"""From scored pairs to matches: one-to-one assignment, thresholds, and tuning of those."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .evaluate import entity_fbeta, truth_counts

BETA = 0.5
#: 0.30 to 0.95 by 0.025.
TAU_GRID = tuple(round(0.30 + 0.025 * i, 3) for i in range(27))


def one_to_one(scored: DataFrame) -> DataFrame:
    """Each candidate stays with the query that scores it highest, ties with the smaller query id."""
    place = Window.partitionBy("cand_id").orderBy(F.desc("prob"), "s1_id")
    return scored.withColumn("_n", F.row_number().over(place)).where("_n = 1").drop("_n")


def gated(scored: DataFrame, singleton_tau: float | None) -> DataFrame:
    """Pairs of queries whose best pair, before any assignment, reaches singleton_tau."""
    if singleton_tau is None:
        return scored
    return scored.withColumn("_top", F.max("prob").over(Window.partitionBy("s1_id"))).where(F.col("_top") >= singleton_tau).drop("_top")


def matched_lists(kept: DataFrame, universe: DataFrame) -> DataFrame:
    """(s1_id, matched): ids by falling probability, then by id; every query of the universe has a row."""
    lists = kept.groupBy("s1_id").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("prob")).alias("p"), "cand_id"))), lambda x: x["cand_id"]).alias("matched"))
    return universe.select("s1_id").distinct().join(lists, "s1_id", "left").withColumn("matched", F.coalesce("matched", F.array().cast("array<string>")))


def decide_pairs(scored: DataFrame, tau: float, singleton_tau: float | None = None, assign: bool = True) -> DataFrame:
    """Assignment, then the threshold; the gate looks at all pairs of a query, as they were before assignment."""
    top = scored.withColumn("_top", F.max("prob").over(Window.partitionBy("s1_id"))) if singleton_tau is not None else scored
    kept = (one_to_one(top) if assign else top).where(F.col("prob") >= tau)
    return kept.where(F.col("_top") >= singleton_tau).drop("_top") if singleton_tau is not None else kept


def apply_threshold(scored: DataFrame, universe: DataFrame, tau: float, singleton_tau: float | None = None, assign: bool = True) -> DataFrame:
    return matched_lists(decide_pairs(scored, tau, singleton_tau, assign), universe)


def threshold_then_one_to_one(scored: DataFrame, universe: DataFrame, tau: float, singleton_tau: float | None = None) -> DataFrame:
    """The other order: thresholds first, then assignment among what is left."""
    return matched_lists(one_to_one(gated(scored, singleton_tau).where(F.col("prob") >= tau)), universe)


def sweep_thresholds(scored: DataFrame, truth: DataFrame, universe: DataFrame, taus=TAU_GRID, singleton_taus=(None,), assign: bool = True, beta: float = BETA) -> DataFrame:
    """Scores of every (singleton_tau, tau): grid_no, tau, singleton_tau, macro_f05, precision, recall, singleton_f05, non_singleton_f05, mean_pred.

    A pair counts at all grid points up to its probability, so pairs are summed by query and highest grid point
    reached before any is repeated; the grid then multiplies queries, not pairs.
    """
    spark, taus = scored.sparkSession, sorted(taus)
    ladder = F.array(*[F.lit(float(t)) for t in taus])
    queries = truth_counts(truth, universe)
    top = scored.groupBy("s1_id").agg(F.max("prob").alias("top"))
    pairs = (one_to_one(scored) if assign else scored).join(truth.select("s1_id", "cand_id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "cand_id"], "left")
    steps = F.size(F.filter(ladder, lambda t: F.col("prob") >= t))
    reached = pairs.withColumn("steps", steps).where("steps > 0").groupBy("s1_id", "steps").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("hits"))
    held = reached.groupBy("s1_id").agg(F.collect_list(F.struct("steps", "n", "hits")).alias("held"))
    grid = spark.createDataFrame([(i * len(taus) + j, j + 1, float(t), None if s is None else float(s)) for i, s in enumerate(singleton_taus) for j, t in enumerate(taus)], "grid_no int, step int, tau double, singleton_tau double")
    each = queries.join(top, "s1_id", "left").join(held, "s1_id", "left").crossJoin(F.broadcast(grid))
    total = lambda name: F.aggregate(F.coalesce("held", F.array().cast("array<struct<steps:int,n:bigint,hits:bigint>>")), F.lit(0).cast("long"), lambda s, x: s + F.when(x["steps"] >= F.col("step"), x[name]).otherwise(0))
    passed = F.col("singleton_tau").isNull() | (F.coalesce("top", F.lit(float("-inf"))) >= F.col("singleton_tau"))
    counted = each.withColumn("n_pred", F.when(passed, total("n")).otherwise(0)).withColumn("tp", F.when(passed, total("hits")).otherwise(0))
    f = counted.withColumn("f", entity_fbeta(F.col("n_pred"), F.col("n_true"), F.col("tp"), beta))
    return f.groupBy("grid_no", "tau", "singleton_tau").agg(
        F.avg("f").alias("macro_f05"), F.coalesce(F.sum("tp") / F.nullif(F.sum("n_pred"), F.lit(0)), F.lit(0.0)).alias("precision"), F.coalesce(F.sum("tp") / F.nullif(F.sum("n_true"), F.lit(0)), F.lit(0.0)).alias("recall"),
        F.avg(F.when(F.col("n_true") == 0, F.col("f"))).alias("singleton_f05"), F.avg(F.when(F.col("n_true") > 0, F.col("f"))).alias("non_singleton_f05"), F.avg("n_pred").alias("mean_pred"),
    )


def tune_threshold(scored: DataFrame, truth: DataFrame, universe: DataFrame, taus=TAU_GRID, singleton_taus=None, assign: bool = True) -> DataFrame:
    """The grid point with the best macro F; ties to the first, no gate before any, then rising thresholds. One row."""
    grid = sweep_thresholds(scored, truth, universe, taus, (None, *taus) if singleton_taus is None else singleton_taus, assign)
    return grid.withColumn("rounded", F.round("macro_f05", 9)).orderBy(F.desc("rounded"), "grid_no").limit(1).drop("rounded")


def removal_counts(before: DataFrame, after: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: pairs that went, of them true, of them false."""
    gone = before.select("s1_id", "cand_id").join(after, ["s1_id", "cand_id"], "left_anti").join(truth.select("s1_id", "cand_id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "cand_id"], "left")
    return gone.agg(F.count(F.lit(1)).alias("removed"), F.count("hit").alias("removed_true"), F.count_if(F.col("hit").isNull()).alias("removed_false"))


def neighborhood(value: float | None, grid=TAU_GRID, reach: int = 2) -> list[float | None]:
    """Grid values up to `reach` steps from one; for no value, just that."""
    if value is None:
        return [None]
    at = min(range(len(grid)), key=lambda i: abs(grid[i] - value))
    return list(grid[max(0, at - reach) : at + reach + 1])


def fold_stability(scored: DataFrame, truth: DataFrame, folds: DataFrame, tau: float, singleton_tau: float | None = None) -> DataFrame:
    """Macro F of each fold at one threshold pair: (fold, macro_f05), with their mean and population deviation in every row."""
    from .evaluate import entity_scores

    lists = decide_pairs(scored, tau, singleton_tau)
    by = entity_scores(lists, truth, folds.select("s1_id")).join(folds, "s1_id").groupBy("fold").agg(F.avg("f").alias("macro_f05"))
    whole = Window.partitionBy()
    return by.select("fold", "macro_f05", F.avg("macro_f05").over(whole).alias("mean_f05"), F.stddev_pop("macro_f05").over(whole).alias("std_f05"))
