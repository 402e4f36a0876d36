"""Where true pairs are lost, and what wrong ones look like."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as fc
from ..functions.lexicon import UNREMARKABLE_NAME_WORDS, HONORIFICS
from ..functions.normalize import legal_forms
from .decide import one_to_one
from .drift import NON_ASCII
from .features import join_records

LOSSES = ("postal_or_long_num_lost", "house_number_lost", "name_token_lost", "address_token_lost", "script_info_lost", "other_normalization_loss")
_FIELDS = ("business_name", "business_address", "name_core", "addr_norm", "landmark", "region", "digits", "house_no", "long_nums", "addr_empty", "country")


def raw_digits(text: Column, least: int = 1) -> Column:
    runs = F.filter(F.regexp_extract_all(text, F.lit(r"(\d+)"), 1), lambda t: F.char_length(t) >= least)
    return F.array_distinct(F.transform(runs, fc.strip_leading_zeros))


def raw_words(text: Column) -> Column:
    """Words of letters of any script, 3 letters or more, in lower case."""
    return F.array_distinct(F.transform(F.filter(F.regexp_extract_all(text, F.lit(r"(\p{L}+)"), 1), lambda t: F.char_length(t) >= 3), F.lower))


def _lost(shared: Column, a: Column, b: Column) -> Column:
    return F.exists(shared, lambda t: ~F.array_contains(a, t) | ~F.array_contains(b, t))


def loss_flags() -> list[Column]:
    """Of joined records, what both raw texts share and normalisation lost: one flag for each of LOSSES."""
    own = lambda s, f: F.coalesce(F.col(f"{s}_{f}"), F.lit(""))
    union = lambda s, *fields: fc.word_set(F.concat_ws(" ", *(own(s, f) for f in fields)))
    numbers = [union(s, "digits", "house_no", "long_nums") for s in "ab"]
    names, places = [union(s, "name_core") for s in "ab"], [union(s, "addr_norm", "landmark", "region") for s in "ab"]
    digits = F.array_intersect(*(raw_digits(F.concat_ws(" ", own(s, "business_name"), own(s, "business_address"))) for s in "ab"))
    skipped = F.array(*[F.lit(w) for w in sorted({*UNREMARKABLE_NAME_WORDS, *HONORIFICS, *legal_forms()})])
    name_words, place_words = [[raw_words(own(s, f)) for s in "ab"] for f in ("business_name", "business_address")]
    shared_name = F.array_except(F.array_intersect(*name_words), skipped)
    both = [F.array_except(F.array_union(n, p), skipped) for n, p in zip(name_words, place_words)]
    kept = F.array_union(F.array_union(F.array_union(*names), F.array_union(*places)), F.array_union(*numbers))
    script = [(own(s, "business_name").rlike(NON_ASCII) | own(s, "business_address").rlike(NON_ASCII)) & (F.trim(own(s, "name_core")) == "") & (F.trim(own(s, "addr_norm")) == "") for s in "ab"]
    found = (
        _lost(F.filter(digits, lambda d: F.char_length(d) >= 4), *numbers), _lost(F.filter(digits, lambda d: F.char_length(d) < 4), *numbers), _lost(shared_name, *names), _lost(F.array_intersect(*place_words), *places), script[0] | script[1],
        F.exists(F.array_intersect(*both), lambda t: ~F.array_contains(kept, t)),
    )
    return [c.alias(n) for c, n in zip(found, LOSSES)]


def classify_true_pairs(truth: DataFrame, cands: DataFrame, scored: DataFrame, pred: DataFrame, tau: float, losses: DataFrame | None = None) -> DataFrame:
    """Each true pair's stage: (s1_id, cand_id, is_candidate, prob, predicted, stage and the loss flags).

    losses: (s1_id, cand_id, LOSSES) of pairs whose records are there; flags are false for candidates.
    """
    mark = lambda df, name: df.select("s1_id", "cand_id").distinct().withColumn(name, F.lit(True))
    key = ["s1_id", "cand_id"]
    all_ = truth.select(*key).distinct().join(mark(cands, "_c"), key, "left").join(scored.groupBy(*key).agg(F.max("prob").alias("prob")), key, "left").join(mark(pred, "_p"), key, "left")
    all_ = all_.join(losses, key, "left") if losses is not None else all_.select("*", *(F.lit(False).alias(n) for n in LOSSES))
    is_candidate = F.coalesce("_c", F.lit(False))
    flags = {n: F.coalesce(F.col(n), F.lit(False)) & ~is_candidate for n in LOSSES}
    stage = F.when(~is_candidate & fc.any_of(list(flags.values())), "representation_failure").when(~is_candidate, "blocking_false_negative").when(F.col("prob").isNull() | (F.col("prob") < tau), "matcher_false_negative").when(F.col("_p").isNull(), "decision_false_negative").otherwise("correct_match")
    return all_.select(*key, is_candidate.alias("is_candidate"), "prob", F.coalesce("_p", F.lit(False)).alias("predicted"), stage.alias("stage"), *(c.alias(n) for n, c in flags.items()))


def true_pair_losses(truth: DataFrame, s1: DataFrame, others: DataFrame) -> DataFrame:
    return join_records(truth.select("s1_id", "cand_id").distinct(), s1, others, _FIELDS).select("s1_id", "cand_id", *loss_flags())


def false_positives(scored: DataFrame, pred: DataFrame, truth: DataFrame) -> DataFrame:
    """Wrong predictions: (s1_id, cand_id, prob, rank among the query's wrong ones, top_wrong)."""
    wrong = pred.select("s1_id", "cand_id").distinct().join(truth, ["s1_id", "cand_id"], "left_anti").join(scored.select("s1_id", "cand_id", "prob"), ["s1_id", "cand_id"], "left")
    return wrong.withColumn("rank", F.rank().over(Window.partitionBy("s1_id").orderBy(F.desc("prob")))).withColumn("top_wrong", F.col("rank") == 1)


def multi_match_report(pred: DataFrame, truth: DataFrame, universe: DataFrame) -> DataFrame:
    """For every query that is known, has true matches or predictions: their numbers and five flags."""
    count = lambda df, name: df.select("s1_id", "cand_id").distinct().groupBy("s1_id").agg(F.count(F.lit(1)).alias(name))
    each = universe.select("s1_id").distinct().join(count(truth, "n_true"), "s1_id", "full").join(count(pred, "n_pred"), "s1_id", "full").na.fill(0, ["n_true", "n_pred"])
    t, p = F.col("n_true"), F.col("n_pred")
    return each.select("s1_id", "n_true", "n_pred", (t == 0).alias("is_singleton"), ((t == 0) & (p > 0)).alias("singleton_false_positive"), (t >= 2).alias("is_multi_match"), ((t >= 2) & (p < t)).alias("multi_underpredicted"), ((t >= 2) & (p > t)).alias("multi_overpredicted"))


def one_to_one_removals(scored: DataFrame, truth: DataFrame) -> DataFrame:
    """True pairs, whether they were scored, and whether a rival took their candidate."""
    mark = lambda df, name: df.select("s1_id", "cand_id").distinct().withColumn(name, F.lit(True))
    both = truth.select("s1_id", "cand_id").distinct().join(mark(scored, "_s"), ["s1_id", "cand_id"], "left").join(mark(one_to_one(scored), "_k"), ["s1_id", "cand_id"], "left")
    return both.select("s1_id", "cand_id", F.col("_s").isNotNull().alias("was_scored"), (F.col("_s").isNotNull() & F.col("_k").isNull()).alias("removed_by_one_to_one"))


def slice_report(classified: DataFrame, cands: DataFrame, s1: DataFrame, others: DataFrame) -> DataFrame:
    """(slice_dim, slice_value, stage, count, share of the slice) over six ways to slice true pairs."""
    sizes = cands.groupBy("s1_id").agg(F.count(F.lit(1)).alias("_n"))
    fields = ("business_name", "business_address", "name_core", "addr_empty", "country")
    side = lambda df, key, s: df.select(F.col("entity_id").alias(key), *(F.col(f).alias(f"{s}_{f}") for f in fields))
    df = classified.join(sizes, "s1_id", "left").join(side(s1, "s1_id", "a"), "s1_id", "left").join(side(others, "cand_id", "b"), "cand_id", "left").na.fill(0, ["_n"])
    n, missing = F.col("_n"), F.coalesce(F.col("a_addr_empty").cast("int"), F.lit(0)) + F.coalesce(F.col("b_addr_empty").cast("int"), F.lit(0))
    foreign = fc.any_of([F.coalesce(F.col(f"{s}_{f}").rlike(NON_ASCII), F.lit(False)) for s in "ab" for f in ("business_name", "business_address")])
    dims = {
        "country": F.coalesce("a_country", F.lit("unknown")), "candidate_bucket": F.when(n == 0, "0").when(n <= 5, "1-5").when(n <= 20, "6-20").when(n <= 50, "21-50").otherwise("50+"),
        "name_quality_bucket": F.when(F.col("a_name_core") == F.col("b_name_core"), "exact_core").otherwise("different_core"), "addr_quality_bucket": F.when(missing == 0, "both_present").when(missing == 1, "one_missing").otherwise("both_missing"),
        "transliteration_bucket": F.when(foreign, "any_non_latin").otherwise("all_latin"), "any_representation_loss": F.when(fc.any_of([F.col(x) for x in LOSSES]), "True").otherwise("False"),
    }
    wide = df.select("stage", *(c.alias(d) for d, c in dims.items()))
    counted = wide.unpivot(["stage"], list(dims), "slice_dim", "slice_value").groupBy("slice_dim", "slice_value", "stage").agg(F.count(F.lit(1)).alias("count"))
    return counted.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy("slice_dim", "slice_value")))


def worst_errors(scored: DataFrame, truth: DataFrame, pred: DataFrame, s1: DataFrame, others: DataFrame, n: int = 50) -> DataFrame:
    """The n surest wrong predictions and the n least sure missed true pairs, with both raw records."""
    hit = truth.select("s1_id", "cand_id").distinct()
    key = ["s1_id", "cand_id"]
    chosen = pred.select(*key).distinct()
    fp = scored.join(chosen, key, "left_semi").join(hit, key, "left_anti").orderBy(F.desc("prob"), *key).limit(n).withColumn("kind", F.lit("false_positive"))
    fn = scored.join(hit, key, "left_semi").join(chosen, key, "left_anti").orderBy("prob", *key).limit(n).withColumn("kind", F.lit("false_negative"))
    return join_records(fp.unionByName(fn).select(*key, "prob", "kind"), s1, others, ("business_name", "business_address", "country"))
