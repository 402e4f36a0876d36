"""How two sets of records or candidates differ, without labels."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import words

NON_ASCII = r"[^\x00-\x7F]"
QUANTILES = {"p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}


def record_covariates(normalized: DataFrame) -> DataFrame:
    """(entity_id, country and 12 covariates) of normalised records."""
    name, address = F.coalesce("business_name", F.lit("")), F.coalesce("business_address", F.lit(""))
    n_words = lambda c: F.size(words(F.col(c)))
    flag = lambda c: c.cast("int")
    return normalized.select(
        "entity_id", "country", F.char_length(name).alias("name_len"), F.char_length(address).alias("addr_len"), flag(name == "").alias("name_missing"), flag(address == "").alias("addr_missing"), n_words("name_norm").alias("name_tokens"), n_words("addr_norm").alias("addr_tokens"),
        n_words("digits").alias("digit_count"), flag(F.col("long_nums") != "").alias("has_long_num"), flag(name.rlike(NON_ASCII)).alias("non_latin_name"), flag(address.rlike(NON_ASCII)).alias("non_latin_addr"), F.char_length("name_core").alias("name_core_len"), F.char_length("addr_norm").alias("addr_norm_len"),
    )


def candidate_covariates(cands: DataFrame, universe: DataFrame) -> DataFrame:
    """(entity_id, n_candidates, top_score): the highest of prob and any score_ column; every query has a row."""
    scores = [c for c in cands.columns if c == "prob" or c.startswith("score_")]
    best = F.greatest(*scores) if len(scores) > 1 else F.col(scores[0]) if scores else F.lit(None).cast("double")
    by = cands.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_candidates"), F.max(best).alias("top_score"))
    return universe.select("s1_id").distinct().join(by, "s1_id", "left").select(F.col("s1_id").alias("entity_id"), F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"), "top_score")


def long_form(df: DataFrame, split: str, columns: list[str]) -> DataFrame:
    """(split, covariate, value) of numeric columns, nulls left out."""
    return df.select(F.col(split).alias("split"), *(F.col(c).cast("double").alias(c) for c in columns)).unpivot(["split"], columns, "covariate", "value").where("value is not null and not isnan(value)")


def quantile_summary(long: DataFrame, quantiles: dict[str, float] = QUANTILES) -> DataFrame:
    """For each split and covariate: n, mean and exact interpolated quantiles."""
    q = F.percentile("value", F.array(*[F.lit(x) for x in quantiles.values()]))
    found = long.groupBy("split", "covariate").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), q.alias("q"))
    return found.select("split", "covariate", "n", "mean", *(F.get("q", i).alias(name) for i, name in enumerate(quantiles)))


def cohens_d(long: DataFrame, a: str = "train", b: str = "test") -> DataFrame:
    """(covariate, cohens_d): mean of a less mean of b, over the pooled deviation; null with fewer than 2 values or no spread."""
    side = lambda s, f: f(F.when(F.col("split") == s, F.col("value")))
    by = long.groupBy("covariate").agg(*(side(s, f).alias(f"{n}_{k}") for k, s in (("a", a), ("b", b)) for n, f in (("m", F.avg), ("v", F.var_samp), ("n", F.count))))
    pooled = F.sqrt(((F.col("n_a") - 1) * F.col("v_a") + (F.col("n_b") - 1) * F.col("v_b")) / (F.col("n_a") + F.col("n_b") - 2))
    return by.select("covariate", F.when((F.col("n_a") > 1) & (F.col("n_b") > 1) & (pooled > 0), (F.col("m_a") - F.col("m_b")) / pooled).alias("cohens_d"))


def effect_bucket(d: Column) -> Column:
    size = F.abs(d)
    return F.when(d.isNull() | F.isnan(d), "n/a").when(size < 0.2, "negligible").when(size < 0.5, "small").when(size < 0.8, "medium").otherwise("large")


def ks_statistic(long: DataFrame, a: str = "train", b: str = "test") -> DataFrame:
    """(covariate, ks, n_a, n_b): largest gap of the two empirical distributions, over distinct values, so ties and hot values are one row each."""
    counts = long.groupBy("covariate", "value").agg(F.count_if(F.col("split") == a).alias("a"), F.count_if(F.col("split") == b).alias("b"))
    run, whole = Window.partitionBy("covariate").orderBy("value"), Window.partitionBy("covariate")
    share = lambda c: F.sum(c).over(run) / F.nullif(F.sum(c).over(whole), F.lit(0))
    gaps = counts.select("covariate", "a", "b", F.abs(share("a") - share("b")).alias("gap"))
    return gaps.groupBy("covariate").agg(F.max("gap").alias("ks"), F.sum("a").alias("n_a"), F.sum("b").alias("n_b"))


def ks_p_value(d: float | None, n: int, m: int) -> float | None:
    """Asymptotic two-sided probability of a gap of d or more."""
    if d is None or not n or not m:
        return None
    x = d * math.sqrt(n * m / (n + m))
    return 1.0 if x < 0.2 else min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * (k * x) ** 2) for k in range(1, 101))))


def ks_p(ks: Column, n: Column, m: Column) -> Column:
    """ks_p_value as a column."""
    x = ks * F.sqrt(n * m / (n + m))
    tail = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda total, k: total + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2 * (k * x) * (k * x)))
    return F.when(x < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * tail)))


def compare_distributions(long: DataFrame, a: str = "train", b: str = "test") -> DataFrame:
    """For each covariate: quantile summaries of both splits, the KS statistic and its p-value, Cohen's d and its bucket."""
    summary, names = quantile_summary(long), ("n", "mean", *QUANTILES)
    of = lambda s: summary.where(F.col("split") == s).select("covariate", *(F.col(n).alias(f"{n}_{s}") for n in names))
    both = of(a).join(of(b), "covariate", "full").join(ks_statistic(long, a, b).select("covariate", "ks", ks_p(F.col("ks"), F.col("n_a"), F.col("n_b")).alias("p_value")), "covariate", "left").join(cohens_d(long, a, b), "covariate", "left")
    return both.withColumn("effect", effect_bucket(F.col("cohens_d")))


def country_share(df: DataFrame, split: str = "split", a: str = "train", b: str = "test") -> DataFrame:
    """(country, share of a, share of b), 0 where a side has none."""
    total = df.groupBy("country").agg(*(F.count_if(F.col(split) == s).alias(s) for s in (a, b)))
    whole = Window.partitionBy()
    return total.select("country", *(F.coalesce(F.col(s) / F.nullif(F.sum(s).over(whole), F.lit(0)), F.lit(0.0)).alias(f"{s}_share") for s in (a, b)))
