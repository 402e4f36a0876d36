"""Quality of matches and of candidates against known pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .retrieval import BITS


def entity_fbeta(n_pred: Column, n_true: Column, tp: Column, beta: float = 0.5) -> Column:
    """F of one query; without true matches 1 if none is predicted, else 0."""
    p, r, b = tp / n_pred, tp / n_true, beta * beta
    return F.when(n_true == 0, (n_pred == 0).cast("double")).when(tp == 0, 0.0).otherwise((1 + b) * p * r / (b * p + r))


def truth_counts(truth: DataFrame, universe: DataFrame) -> DataFrame:
    """(s1_id, n_true) of every query, 0 for singletons."""
    counts = truth.select("s1_id", "cand_id").distinct().groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_true"))
    return universe.select("s1_id").distinct().join(counts, "s1_id", "left").withColumn("n_true", F.coalesce("n_true", F.lit(0)))


def entity_scores(pred: DataFrame, truth: DataFrame, universe: DataFrame, beta: float = 0.5) -> DataFrame:
    """(s1_id, n_pred, n_true, tp, f) of every query of the universe, from pairs; repeated pairs count once."""
    own = pred.select("s1_id", "cand_id").distinct()
    hits = own.join(truth.select("s1_id", "cand_id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "cand_id"], "left").groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_pred"), F.count("hit").alias("tp"))
    each = truth_counts(truth, universe).join(hits, "s1_id", "left").na.fill(0, ["n_pred", "tp"])
    return each.select("s1_id", "n_pred", "n_true", "tp", entity_fbeta(F.col("n_pred"), F.col("n_true"), F.col("tp"), beta).alias("f"))


def macro_fbeta(pred: DataFrame, truth: DataFrame, universe: DataFrame, beta: float = 0.5) -> DataFrame:
    return entity_scores(pred, truth, universe, beta).agg(F.coalesce(F.avg("f"), F.lit(0.0)).alias("macro_f05"))


def score_report(pred: DataFrame, truth: DataFrame, universe: DataFrame) -> DataFrame:
    """For all queries (grp null) and each country of the universe: n_s1, macro_f05, pair_precision, pair_recall, singleton_f05, non_singleton_f05."""
    each = entity_scores(pred, truth, universe).join(universe.select("s1_id", F.col("country").alias("grp")), "s1_id")
    share = lambda a, b: F.coalesce(F.sum(a) / F.nullif(F.sum(b), F.lit(0)), F.lit(0.0))
    return each.groupingSets([[], ["grp"]], "grp").agg(
        F.count(F.lit(1)).alias("n_s1"), F.avg("f").alias("macro_f05"), share("tp", "n_pred").alias("pair_precision"), share("tp", "n_true").alias("pair_recall"), F.avg(F.when(F.col("n_true") == 0, F.col("f"))).alias("singleton_f05"),
        F.avg(F.when(F.col("n_true") > 0, F.col("f"))).alias("non_singleton_f05"),
    )


def blocking_recall(cands: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: pair_recall, s1_full_recall (both 1 without true pairs), mean_candidates over queries that have any (null if none has)."""
    found = truth.select("s1_id", "cand_id").distinct().join(cands.select("s1_id", "cand_id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "cand_id"], "left")
    by = found.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("h")).agg(F.coalesce(F.sum("h") / F.sum("n"), F.lit(1.0)).alias("pair_recall"), F.coalesce(F.avg((F.col("h") == F.col("n")).cast("double")), F.lit(1.0)).alias("s1_full_recall"))
    sizes = cands.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n")).agg(F.avg("n").alias("mean_candidates"))
    return by.crossJoin(sizes)


def reduction_ratio(n_pairs: Column, n_s1: Column, n_other: Column) -> Column:
    """Share of all possible pairs that needn't be compared; 0 if there are none."""
    return F.when((n_s1 == 0) | (n_other == 0), 0.0).otherwise(1 - n_pairs / (n_s1 * n_other))


def blocking_stats(cands: DataFrame, truth: DataFrame, universe: DataFrame, n_other: int, passes: tuple[str, ...]) -> DataFrame:
    """(metric, value): recall, candidates a query, reduction, and for each pass its pairs, recall and what it alone finds; recall by country."""
    pairs = truth.select("s1_id", "cand_id").distinct().join(cands.select("s1_id", "cand_id", "passes"), ["s1_id", "cand_id"], "left").join(universe.select("s1_id", "country"), "s1_id", "left")
    known = pairs.agg(
        F.avg(F.col("passes").isNotNull().cast("double")).alias("pair_recall"), *(F.avg(F.coalesce(F.col("passes").bitwiseAND(F.lit(BITS[p])) != 0, F.lit(False)).cast("double")).alias(f"recall_{p}") for p in passes), *(F.avg(F.coalesce(F.col("passes") == BITS[p], F.lit(False)).cast("double")).alias(f"unique_{p}") for p in passes)
    )
    full = pairs.groupBy("s1_id").agg(F.every(F.col("passes").isNotNull()).alias("all")).agg(F.avg(F.col("all").cast("double")).alias("s1_full_recall"))
    made = cands.agg(F.count(F.lit(1)).cast("double").alias("n_pairs"), *(F.count_if(F.col("passes").bitwiseAND(F.lit(BITS[p])) != 0).cast("double").alias(f"pairs_{p}") for p in passes))
    most = cands.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").cast("double").alias("max_candidates"))
    size = universe.agg(F.countDistinct("s1_id").alias("n_s1"))
    wide = known.crossJoin(full).crossJoin(made).crossJoin(most).crossJoin(size)
    wide = wide.withColumn("mean_candidates", F.col("n_pairs") / F.col("n_s1")).withColumn("reduction", reduction_ratio(F.col("n_pairs"), F.col("n_s1"), F.lit(n_other))).drop("n_s1")
    long = wide.unpivot([], wide.columns, "metric", "value")
    by_country = pairs.groupBy("country").agg(F.avg(F.col("passes").isNotNull().cast("double")).alias("value")).select(F.concat(F.lit("recall_country_"), "country").alias("metric"), "value")
    return long.unionByName(by_country)


def candidate_stats(cands: DataFrame, universe: DataFrame) -> DataFrame:
    """One row over every query: n_s1, n_pairs, mean_candidates, max_candidates, zero_candidate_s1."""
    return size_stats(cands.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n")), universe)


def size_stats(counts: DataFrame, universe: DataFrame) -> DataFrame:
    """candidate_stats from (s1_id, n), how many candidates a query has."""
    sizes = universe.select("s1_id").distinct().join(counts, "s1_id", "left").na.fill(0, ["n"])
    return sizes.agg(F.count(F.lit(1)).alias("n_s1"), F.sum("n").alias("n_pairs"), F.avg("n").alias("mean_candidates"), F.max("n").alias("max_candidates"), F.count_if(F.col("n") == 0).alias("zero_candidate_s1"))


def true_match_loss(a: DataFrame, b: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: true pairs in a, in b, and in a but not in b."""
    known = truth.select("s1_id", "cand_id").distinct()
    mark = lambda df, name: df.select("s1_id", "cand_id").distinct().withColumn(name, F.lit(1))
    both = known.join(mark(a, "in_a"), ["s1_id", "cand_id"], "left").join(mark(b, "in_b"), ["s1_id", "cand_id"], "left")
    return both.agg(F.count("in_a").alias("true_in_a"), F.count("in_b").alias("true_in_b"), F.count_if(F.col("in_a").isNotNull() & F.col("in_b").isNull()).alias("lost"))


def true_pairs(truth: DataFrame, s1: DataFrame, others: DataFrame) -> DataFrame:
    """Known pairs whose records are both there, with the query's country."""
    return truth.join(s1.select(F.col("entity_id").alias("s1_id"), "country"), "s1_id").join(others.select(F.col("entity_id").alias("cand_id")), "cand_id", "left_semi").select("s1_id", "cand_id", "country")


def source_recall(cands: DataFrame, truth: DataFrame) -> DataFrame:
    """(source, n_true, recall) by the candidate's source."""
    found = truth.join(cands.select("s1_id", "cand_id").distinct().withColumn("hit", F.lit(1)), ["s1_id", "cand_id"], "left")
    return found.groupBy(F.substring_index("cand_id", "-", 1).alias("source")).agg(F.count(F.lit(1)).alias("n_true"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))


def assignment_conflicts(scored: DataFrame) -> DataFrame:
    """One row: candidates, those that several queries want, and the most queries that want one."""
    by = scored.groupBy("cand_id").agg(F.countDistinct("s1_id").alias("n"))
    return by.agg(F.count(F.lit(1)).alias("n_candidates"), F.count_if(F.col("n") > 1).alias("contested"), F.max("n").alias("max_s1"))


def error_budget(cands: DataFrame, scored: DataFrame, kept: DataFrame, final: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: true pairs, and how many are lost to blocking, to the threshold, and to assignment."""
    mark = lambda df, name: df.select("s1_id", "cand_id").distinct().withColumn(name, F.lit(1))
    all_ = truth.select("s1_id", "cand_id").distinct()
    for df, name in ((cands, "c"), (kept, "k"), (final, "f")):
        all_ = all_.join(mark(df, name), ["s1_id", "cand_id"], "left")
    return all_.agg(F.count(F.lit(1)).alias("true_pairs"), F.count_if(F.col("c").isNull()).alias("lost_blocking"), F.count_if(F.col("c").isNotNull() & F.col("k").isNull()).alias("lost_threshold"), F.count_if(F.col("k").isNotNull() & F.col("f").isNull()).alias("lost_assignment"))
