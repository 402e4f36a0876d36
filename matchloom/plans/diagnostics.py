"""Measurements of a linkage set-up: what each part finds, costs and loses. Nothing here writes results.

Each function takes normalised records (s1, others) and known pairs (truth), and returns a small DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as fc
from ..functions.similarity import pair_scores
from ..operators import blocking, decide, drift, errors, evaluate, features, keys, model, retrieval, sampling
from ..operators.blocking import BlockingConfig
from ..sources import tables

GATES = {"candidates": 20, "rejected": 10, "rejected_share": 0.05, "hard_negatives": 10}
STRONG = {"jaccard": 0.5, "jw": 0.9, "token_sort": 0.85, "overlap": 2}
DENSITIES = (0.0, 0.02, 0.1, 0.25)
OPEN_CAP = 5000


def stack(parts: dict[str, DataFrame], name: str) -> DataFrame:
    """All parts under one another, each named in a first column."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.select(F.lit(k).alias(name), "*") for k, df in parts.items()))


def universe_of(s1: DataFrame) -> DataFrame:
    return s1.select(F.col("entity_id").alias("s1_id"), "country")


def candidate_quality(cands: DataFrame, truth: DataFrame, s1: DataFrame) -> DataFrame:
    """One row: recall and candidate counts. The candidates are written first, as they are read three times."""
    cands = tables.cut(cands.select("s1_id", "cand_id"), "candidates")
    return evaluate.blocking_recall(cands, truth).drop("mean_candidates").crossJoin(evaluate.candidate_stats(cands, universe_of(s1)))


def k_variants(base: BlockingConfig = BlockingConfig()) -> dict[str, BlockingConfig]:
    """The set-up itself, each pass at half and at twice its k, and each left out."""
    out = {"base": base}
    for p in base.active():
        for name, k in (("half", max(1, base.k[p] // 2)), ("double", base.k[p] * 2)):
            out[f"{p}_{name}"] = replace(base, k=base.k | {p: k})
    return out


def fix_variants(base: BlockingConfig = BlockingConfig()) -> dict[str, BlockingConfig]:
    """Named set-ups that differ in digit keys, the street pass and the name-and-address pass."""
    five = replace(base, use_street=False, use_tfidf_addr=False, digit_mode="tokens", address_digits="first")
    return {
        "five_passes": five, "address_all_digits": replace(five, address_digits="all"), "digit_runs": replace(five, digit_mode="runs"), "street_pairs": replace(five, use_street=True), "name_address_10": replace(five, use_tfidf_addr=True), "all": base,
        "all_k20": replace(base, k=base.k | {"tfidf_addr": 20}), "no_embeddings": replace(base, use_embeddings=False), "any_country": replace(base, within_country=False),
    }


def ablation(s1: DataFrame, others: DataFrame, truth: DataFrame, variants: dict[str, BlockingConfig] | None = None, encoder=None) -> DataFrame:
    """Candidate quality of each variant."""
    found = {n: candidate_quality(blocking.generate_candidates(s1, others, c, encoder), truth, s1) for n, c in (variants or k_variants()).items()}
    return stack(found, "variant")


def partition_equality(s1: DataFrame, others: DataFrame, counts: tuple[int, ...] = (1, 4, 16), config: BlockingConfig = BlockingConfig()) -> DataFrame:
    """Whether candidates are the same however the input is dealt: differences against the first count."""
    made = {str(n): tables.cut(blocking.generate_candidates(s1.repartition(n), others.repartition(n), config), f"dealt{n}") for n in counts}
    first = made.pop(str(counts[0]))
    found = stack({n: retrieval.candidate_set_diff(first, df) for n, df in made.items()}, "partitions")
    return found.withColumn("status", F.when(F.col("exact_equal"), "PASS").when(F.col("missing") + F.col("extra") <= 10, "INVESTIGATE").otherwise("FAIL"))


def precision_loss(queries: DataFrame, index: DataFrame, truth: DataFrame, k: int = 20, low: str = "float16") -> DataFrame:
    """What dense retrieval at a lower precision changes: set differences and true pairs lost."""
    full, less = retrieval.dense_top_k(queries, index, k), retrieval.dense_top_k(queries, index, k, precision=low)
    return retrieval.candidate_set_diff(full, less).crossJoin(evaluate.true_match_loss(full, less, truth))


def decision_validation(scored: DataFrame, truth: DataFrame, universe: DataFrame, tau: float, singleton_tau: float | None = None) -> DataFrame:
    """Scores with and without assignment, in either order, and at thresholds next to the chosen ones."""
    report = lambda pred: evaluate.score_report(pred, truth, universe).where("grp is null").drop("grp")
    long = lambda lists: lists.select("s1_id", F.explode("matched").alias("cand_id"))
    out = {
        "one_to_one": report(decide.decide_pairs(scored, tau, singleton_tau)), "no_assignment": report(decide.decide_pairs(scored, tau, singleton_tau, assign=False)),
        "threshold_first": report(long(decide.threshold_then_one_to_one(scored, universe, tau, singleton_tau))),
    }
    out |= {f"tau_{t}": report(decide.decide_pairs(scored, t, singleton_tau)) for t in decide.neighborhood(tau) if t != tau}
    out |= {f"singleton_{t}": report(decide.decide_pairs(scored, tau, t)) for t in decide.neighborhood(singleton_tau) if t is not None and t != singleton_tau}
    return stack(out, "setting")


def clean_misses(truth: DataFrame, cands: DataFrame, s1: DataFrame, others: DataFrame) -> DataFrame:
    """True pairs that blocking misses although normalisation lost nothing that both share."""
    missed = evaluate.true_pairs(truth, s1, others).join(cands.select("s1_id", "cand_id"), ["s1_id", "cand_id"], "left_anti")
    flags = errors.true_pair_losses(missed, s1, others)
    return flags.where(~fc.any_of([F.col(f) for f in errors.LOSSES])).select("s1_id", "cand_id")


def miss_attribution(misses: DataFrame, wide: dict[str, DataFrame]) -> DataFrame:
    """For each pass at a wider k (its candidates): how many misses it would find, and how many none but it."""
    key = ["s1_id", "cand_id"]
    marked = reduce(lambda df, p: df.join(wide[p].select(*key).distinct().withColumn(p, F.lit(1)), key, "left"), wide, misses.select(*key).distinct()).na.fill(0, list(wide))
    total = reduce(lambda a, b: a + b, (F.col(p) for p in wide))
    parts = {p: marked.agg(F.sum(p).alias("found"), F.count_if((F.col(p) == 1) & (total == 1)).alias("only_here"), F.count(F.lit(1)).alias("misses")) for p in wide}
    return stack(parts, "pass")


def miss_forensics(misses: DataFrame, s1: DataFrame, others: DataFrame) -> DataFrame:
    """Each missed pair's similarities, which of its fields are strong, and its category."""
    both = features.join_records(misses.select("s1_id", "cand_id"), s1, others)
    wanted = [(f"{f}_{n}", scorer, k) for k, f in enumerate(("name", "addr")) for n, scorer in (("jw", "jw"), ("edit_ratio", "ratio"), ("partial_ratio", "partial"), ("token_sort_ratio", "token_sort"))]
    scored = both.withColumn("s", pair_scores(wanted)("a_name_core", "b_name_core", "a_addr_norm", "b_addr_norm"))
    sets = {f: (fc.word_set(F.col(f"a_{c}")), fc.word_set(F.col(f"b_{c}"))) for f, c in (("name", "name_core"), ("addr", "addr_norm"), ("digit", "digits"))}
    placed = (F.col("a_addr_norm") != "") & (F.col("b_addr_norm") != "")
    known = placed & ~F.col("a_addr_empty") & ~F.col("b_addr_empty")
    detail = scored.select(
        "s1_id", "cand_id", F.col("a_country").alias("country"), (F.col("a_name_norm") == F.col("b_name_norm")).alias("name_exact_norm"), (F.col("a_name_core") == F.col("b_name_core")).alias("name_exact_core"), *(F.when(known | F.lit(n.startswith("name")), F.col(f"s.{n}")).alias(n) for n, _, _ in wanted),
        fc.jaccard(*sets["name"], empty=0.0).alias("name_jaccard"), fc.jaccard(*sets["addr"]).alias("addr_jaccard"), fc.overlap(*sets["name"]).alias("name_overlap"), fc.overlap(*sets["addr"]).alias("addr_overlap"), fc.overlap(*sets["digit"]).alias("digit_shared"), fc.jaccard(*sets["digit"]).alias("digit_jaccard"),
        fc.equal_or_unknown(F.col("a_house_no"), F.col("b_house_no")).alias("house_equal"), fc.equal_or_unknown(F.col("a_region"), F.col("b_region")).alias("region_equal"),
    )
    at_least = lambda c, limit: F.coalesce(F.col(c) >= STRONG[limit], F.lit(False))
    name = F.col("name_exact_norm") | F.col("name_exact_core") | at_least("name_jaccard", "jaccard") | at_least("name_jw", "jw") | at_least("name_token_sort_ratio", "token_sort")
    address = at_least("addr_jaccard", "jaccard") | at_least("addr_jw", "jw") | at_least("addr_token_sort_ratio", "token_sort") | at_least("addr_overlap", "overlap")
    number = F.coalesce(F.col("house_equal") == 1, F.lit(False)) | F.coalesce(F.col("region_equal") == 1, F.lit(False)) | (F.col("digit_shared") >= 1)
    told = detail.withColumn("strong_name_signal", name).withColumn("strong_address_signal", address).withColumn("strong_numeric_signal", number)
    fields = name.cast("int") + address.cast("int") + number.cast("int")
    category = F.when(fields >= 2, "MULTI_FIELD_SIGNAL").when(name, "NAME_SIGNAL").when(address, "ADDRESS_SIGNAL").when(number, "NUMERIC_SIGNAL").otherwise("VERY_LOW_SIGNAL")
    return told.withColumn("signal_field_count", fields).withColumn("forensic_category", category)


def address_forensics(misses: DataFrame, s1: DataFrame, others: DataFrame, config: BlockingConfig = BlockingConfig()) -> DataFrame:
    """Why the address pass misses each pair: no shared key, all shared keys too common, beaten in the top k, or found after all."""
    q, x = blocking.grouped(s1, config.within_country), blocking.grouped(others, config.within_country)
    both = lambda df: df.select("grp", "id", "addr_norm")
    counts = keys.frequencies(both(q).unionByName(both(x)), ["grp"], keys.words(F.col("addr_norm")))
    own = keys.address_keys(keys.block_digits(F.col("addr_norm"), F.col("digits"), config.digit_mode), F.col("rare_words"), config.address_digits)
    qk, xk = (keys.with_street_words(df, counts, ["grp"], "id", F.col("addr_norm")).select("grp", "id", own.alias("keys")) for df in (q, x))
    held = xk.select("grp", F.explode("keys").alias("key")).groupBy("grp", "key").agg(F.count(F.lit(1)).alias("block"))
    pairs = misses.select("s1_id", "cand_id").join(qk.select(F.col("id").alias("s1_id"), "grp", F.col("keys").alias("_q")), "s1_id").join(xk.select(F.col("id").alias("cand_id"), F.col("keys").alias("_x")), "cand_id")
    shared = pairs.select("s1_id", "cand_id", "grp", F.explode_outer(F.array_intersect("_q", "_x")).alias("key")).join(held, ["grp", "key"], "left")
    summed = shared.groupBy("s1_id", "cand_id").agg(F.count("key").alias("shared_keys"), F.min("block").alias("least_block"))
    whole = retrieval.key_pass(qk, xk, 0, config.max_block["address"], truncate=False)
    ranked = whole.withColumn("place", F.row_number().over(Window.partitionBy("s1_id").orderBy(F.desc("score"), "cand_id"))).select("s1_id", "cand_id", "place")
    told = summed.join(ranked, ["s1_id", "cand_id"], "left")
    reason = F.when(F.col("shared_keys") == 0, "NO_SHARED_KEY").when(F.col("least_block") > config.max_block["address"], "FILTERED_BY_MAX_BLOCK").when(F.col("place") <= config.k["address"], "FOUND_IN_TOPK").when(F.col("place").isNotNull(), "LOSES_TOPK").otherwise("OTHER_ISSUE")
    return told.withColumn("reason", reason)


def key_counterfactual(s1: DataFrame, others: DataFrame, truth: DataFrame, schemes: tuple[str, ...] = keys.CF_SCHEMES, k: int = 10, cap: int = 100) -> DataFrame:
    """Recall and cost of each key scheme, at production limits and with open ones: what candidate_quality gives for scheme_pass."""
    q, x = blocking.grouped(s1, True), blocking.grouped(others, True)
    found = {}
    for s in schemes:
        lists = [tables.cut(df, "scheme_keys") for df in blocking.scheme_lists(s, q, x)]
        for n, limits in (("production", (k, cap)), ("open", (OPEN_CAP, OPEN_CAP))):
            counts, hits = retrieval.key_pass_counts(*lists, truth, *limits)
            found[f"{s}/{n}"] = evaluate.blocking_recall(hits, truth).drop("mean_candidates").crossJoin(evaluate.size_stats(counts, universe_of(s1)))
    return stack(found, "scheme")


def counterfactual_pairs(s1: DataFrame, others: DataFrame) -> dict[str, DataFrame]:
    """Pairs of three other ways to block, and of all three together."""
    q, x = blocking.grouped(s1, True), blocking.grouped(others, True)
    text = lambda df: df.select("grp", "id", fc.name_address_text(F.col("name_core"), F.col("addr_norm")).alias("text"))
    found = {"name_addr_tfidf": retrieval.tfidf_pass(text(q), text(x), 10), "street_word_pair": blocking.scheme_pass("street_word_pair", q, x), "all_digit_word": blocking.scheme_pass("all_digit_word", q, x)}
    pairs = {n: df.select("s1_id", "cand_id") for n, df in found.items()}
    return pairs | {"all": reduce(lambda a, b: a.unionByName(b), pairs.values()).distinct()}


def augmented(cands: DataFrame, extra: DataFrame) -> DataFrame:
    """Candidates with further pairs, which no pass found: passes 0 and no score."""
    return cands.unionByName(extra.join(cands.select("s1_id", "cand_id"), ["s1_id", "cand_id"], "left_anti").withColumn("passes", F.lit(0).cast("short")), allowMissingColumns=True)


def density_stress(s1: DataFrame, others: DataFrame, truth: DataFrame, pool: DataFrame, config: BlockingConfig = BlockingConfig(), fractions: tuple[float, ...] = DENSITIES) -> DataFrame:
    """Candidate quality as more and more unrelated records (a share of pool) join the index; smaller shares are parts of larger ones."""
    kept = others.select("entity_id")
    found = {str(f): candidate_quality(blocking.generate_candidates(s1, others.unionByName(sampling.distractors(pool, f, kept).select(*others.columns)), config), truth, s1) for f in fractions}
    return stack(found, "density")


def name_retrieval_ranks(s1: DataFrame, others: DataFrame, truth: DataFrame, limits: tuple[int, ...] = (20, 40, 100, 1000)) -> DataFrame:
    """Share of true pairs within each rank of sparse retrieval, by letter grams and by words, and those never reached."""
    q, x = blocking.grouped(s1, True), blocking.grouped(others, True)
    text = lambda df: df.select("grp", "id", F.col("name_core").alias("text"))
    parts = {}
    for name, grams in (("char_grams", retrieval.char_grams), ("words", retrieval.word_grams)):
        ranks = retrieval.sparse_ranks(text(q), text(x), truth, grams=grams)
        parts[name] = ranks.agg(F.count(F.lit(1)).alias("pairs"), *(F.avg(F.coalesce((F.col("rank") <= n).cast("double"), F.lit(0.0))).alias(f"within_{n}") for n in limits), F.avg(F.col("rank").isNull().cast("double")).alias("unreachable"))
    return stack(parts, "variant")


def feature_audit(labelled: DataFrame, fitted=None) -> DataFrame:
    """Each feature's correlation with the label, its highest with any other feature, and its gain."""
    names = features.feature_columns(labelled)
    pairwise = [F.abs(F.corr(F.col(a).cast("double"), F.col(b).cast("double"))).alias(f"{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i < j]
    first = labelled.agg(*(F.corr(F.col(n).cast("double"), F.col("label").cast("double")).alias(n) for n in names), *pairwise).first()
    best = {n: max((v for i in range(len(names)) if i != k and (v := first[f"{min(i, k)}_{max(i, k)}"]) is not None and v == v), default=None) for k, n in enumerate(names)}
    gains = dict(model.feature_importance(fitted, names)) if fitted is not None else {}
    rows = [(n, None if first[n] is None or first[n] != first[n] else float(first[n]), best[n], bool(best[n] is not None and best[n] >= 0.9), gains.get(n, 0.0)) for n in names]
    return labelled.sparkSession.createDataFrame(rows, "feature string, label_correlation double, max_abs_correlation double, empirically_redundant boolean, gain double")


def hard_negative_gate(scored: DataFrame, classified: DataFrame, tau: float) -> DataFrame:
    """One row: true pairs that are candidates, those the matcher and blocking lose, false pairs at or above tau, four conditions on them, and whether all hold."""
    lost_by = lambda *stages: F.count_if(F.col("stage").isin(*stages))
    counts = classified.agg(lost_by("correct_match", "matcher_false_negative", "decision_false_negative").alias("in_candidates"), lost_by("matcher_false_negative").alias("matcher_lost"), lost_by("blocking_false_negative", "representation_failure").alias("blocking_lost"))
    both = counts.crossJoin(scored.where("label = 0").agg(F.count_if(F.col("prob") >= tau).alias("hard_negatives")))
    lost, inside = F.col("matcher_lost"), F.col("in_candidates")
    rules = {
        "enough_candidates": inside >= GATES["candidates"], "matcher_rejects": (lost >= GATES["rejected"]) & (lost >= GATES["rejected_share"] * inside), "negatives_overlap": F.col("hard_negatives") >= GATES["hard_negatives"], "matcher_is_the_weakness": lost > F.col("blocking_lost"),
    }
    return both.withColumns(rules).withColumn("all_hold", reduce(lambda x, y: x & y, map(F.col, rules)))


def score_quantiles(scored: DataFrame) -> DataFrame:
    """Quantiles of the scores of true and false pairs."""
    long = scored.select(F.col("label").cast("string").alias("split"), F.lit("prob").alias("covariate"), F.col("prob").alias("value"))
    return drift.quantile_summary(long, {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99})


def stage_metrics(run: Callable[[], DataFrame]) -> dict[str, float]:
    """Seconds and rows of a stage that is run to its end; memory, spill and shuffle are in Spark's own stage metrics."""
    import time

    began = time.time()
    rows = run().count()
    return {"seconds": round(time.time() - began, 3), "rows": rows}
