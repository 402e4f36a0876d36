"""Samples, splits and folds that depend on ids and seeds alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


SLICES = 4096


def hash_fraction(id_col: Column, salt: str = "") -> Column:
    """A number in [0, 1) of an id; a smaller limit keeps a part of what a larger one keeps. 48 bits of MD5."""
    digest = F.md5(F.concat(id_col.cast("string"), F.lit(f"#{salt}")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("long"), F.lit(1_000_000)) / 1e6


def subsample(s1: DataFrame, others: DataFrame, truth: DataFrame, fraction: float, salt: str = "42") -> tuple[DataFrame, DataFrame, DataFrame]:
    """A share of the queries with all their matches, and the same share of records that match nothing."""
    kept = s1.where(hash_fraction(F.col("entity_id"), salt) < fraction)
    own = truth.join(kept.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")
    orphan = others.join(truth.select(F.col("cand_id").alias("entity_id")), "entity_id", "left_anti").where(hash_fraction(F.col("entity_id"), salt) < fraction)
    return kept, others.join(own.select(F.col("cand_id").alias("entity_id")), "entity_id", "left_semi").unionByName(orphan), own


def split_queries(universe: DataFrame, truth: DataFrame, share: float = 0.2, salt: str = "42") -> DataFrame:
    """(s1_id, split): `share` of the queries with matches, and of those without, are `valid`, the rest `train`."""
    stratum = universe.select("s1_id").distinct().join(truth.select("s1_id").distinct().withColumn("matched", F.lit(1)), "s1_id", "left")
    dealt = stratum.withColumn("place", hash_fraction(F.col("s1_id"), salt)).withColumn("slice", F.floor(F.col("place") * SLICES))
    # Counts by slice first, so that no task ranks more than a slice.
    counts = dealt.groupBy("matched", "slice").agg(F.count(F.lit(1)).alias("held"))
    run, whole = Window.partitionBy("matched").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("matched")
    counts = counts.select(F.col("matched").alias("_m"), F.col("slice").alias("_s"), F.coalesce(F.sum("held").over(run), F.lit(0)).alias("ahead"), F.round(F.sum("held").over(whole) * share).alias("wanted"))
    placed = dealt.join(counts, F.col("matched").eqNullSafe(F.col("_m")) & (F.col("slice") == F.col("_s")))
    rank = F.col("ahead") + F.row_number().over(Window.partitionBy("matched", "slice").orderBy("place", "s1_id"))
    return placed.select("s1_id", F.when(rank <= F.col("wanted"), "valid").otherwise("train").alias("split"))


def fit_sample(df: DataFrame, most: int = 2_000_000, id_col: str = "entity_id", salt: str = "fit") -> DataFrame:
    """At most `most` rows, those whose ids hash lowest, for fitting what needs no more; all rows if there aren't more. Repeated ids stay or go together, so they may be a few more."""
    total = df.count()
    if total <= most:
        return df
    dealt = df.withColumn("_place", hash_fraction(F.col(id_col), salt))
    run = Window.orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)  # a million places at most
    counts = dealt.groupBy("_place").agg(F.count(F.lit(1)).alias("_n")).withColumn("_ahead", F.coalesce(F.sum("_n").over(run), F.lit(0)))
    edge = counts.where(F.col("_ahead") < most).agg(F.max("_place").alias("_edge")).first()._edge
    return dealt.where(F.col("_place") <= edge).drop("_place")


def group_folds(pairs: DataFrame, n_folds: int = 5, salt: str = "folds") -> DataFrame:
    """(s1_id, fold): all pairs of a query in one fold, by a hash."""
    return pairs.select("s1_id").distinct().withColumn("fold", F.floor(hash_fraction(F.col("s1_id"), salt) * n_folds).cast("int"))


def balanced_folds(sizes: dict[str, int], n_folds: int) -> dict[str, int]:
    """Folds of nearly equal size: groups, largest first, each to the smallest fold so far. For lists of groups that fit the driver."""
    n_folds, totals, out = min(n_folds, len(sizes)), [0] * max(1, min(n_folds, len(sizes))), {}
    if n_folds < 2:
        return dict.fromkeys(sizes, 0)
    for group, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        fold = min(range(n_folds), key=totals.__getitem__)
        out[group], totals[fold] = fold, totals[fold] + size
    return out


def country_split(pairs: DataFrame, s1: DataFrame, others: DataFrame, country: str) -> DataFrame:
    """Adds held_out: whether both records are of the country."""
    a = s1.select(F.col("entity_id").alias("s1_id"), F.col("country").alias("_a"))
    b = others.select(F.col("entity_id").alias("cand_id"), F.col("country").alias("_b"))
    return pairs.join(a, "s1_id").join(b, "cand_id").withColumn("held_out", (F.col("_a") == country) & (F.col("_b") == country)).drop("_a", "_b")


def tile(df: DataFrame, rows: int, have: int, order: list[str]) -> DataFrame:
    """Rows repeated to `rows` in all; the last repetition takes the first ones by `order`."""
    times, rest = divmod(rows, max(1, have))
    whole = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times)))) if times else df.limit(0).withColumn("copy", F.lit(0))
    return whole.unionByName(df.orderBy(*order).limit(rest).withColumn("copy", F.lit(times + 1)))


def distractors(records: DataFrame, fraction: float, exclude: DataFrame, salt: str = "density") -> DataFrame:
    """A share of the records that exclude (entity_id) doesn't name; the filter reaches the scan."""
    return records.where(hash_fraction(F.col("entity_id"), salt) < fraction).join(exclude.select("entity_id"), "entity_id", "left_anti")
