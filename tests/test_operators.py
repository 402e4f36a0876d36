"""Retrieval, decisions and evaluation, by hand-checked cases and brute force."""

import pytest
from pyspark.sql import functions as F

from matchloom.functions.similarity import SCORERS
from matchloom.operators import decide, drift, errors, evaluate, features, keys, retrieval, sampling
from matchloom.sources import paths, tables

PAIRS = "s1_id string, cand_id string"


def one(df):
    return df.first()


def test_key_pass(spark):
    schema = "grp string, id int, keys array<string>"
    q = spark.createDataFrame([("*", 0, ["rare", "common"]), ("*", 1, ["common"]), ("*", 2, [])], schema)
    x = spark.createDataFrame([("*", 0, ["common"]), ("*", 1, ["common"]), ("*", 2, ["common"]), ("*", 3, ["rare", "common"]), ("*", 4, ["rare", None])], schema)
    assert {(r.s1_id, r.cand_id) for r in retrieval.key_pass(q, x, 10, 2).collect()} == {(0, 3), (0, 4)}
    top = {r.s1_id: r.cand_id for r in retrieval.key_pass(q, x, 1, 10).collect()}
    assert top == {0: 3, 1: 0}
    assert retrieval.key_pass(q, x.limit(0), 1, 10).count() == 0


def test_groups_never_cross(spark):
    schema = "grp string, id int, keys array<string>"
    q = spark.createDataFrame([("US", 0, ["k"]), ("France", 1, ["k"]), ("Atlantis", 2, ["k"])], schema)
    x = spark.createDataFrame([("France", 10, ["k"]), ("US", 11, ["k"])], schema)
    assert {(r.s1_id, r.cand_id) for r in retrieval.key_pass(q, x, 10, 10).collect()} == {(0, 11), (1, 10)}


@pytest.mark.parametrize("text, want", [("7712c maple lane", ["7712"]), ("k 38f old fort", ["38"]), ("b c54 3 mill 054", ["54", "3"]), ("tower xy6105 4 wing", ["6105", "4"]), ("no digits", [])])
def test_block_digits(spark, text, want):
    assert one(spark.createDataFrame([(text,)], "t string").select(keys.block_digits(F.col("t")).alias("d"))).d == want


def test_address_and_street_keys(spark):
    df = spark.createDataFrame([(["12", "9"], ["harbour", "quay"], ["amber", "birch", "cedar"])], "d array<string>, w array<string>, s array<string>")
    got = one(df.select(keys.address_keys(F.col("d"), F.col("w"), "first").alias("a"), keys.street_keys(F.col("s")).alias("s"), keys.address_keys(F.lit(None).cast("array<string>"), F.col("w")).alias("n")))
    assert got.a == ["12#9", "12@harbour", "12@quay"] and sorted(got.s) == ["amber+birch", "amber+cedar", "birch+cedar"]
    with pytest.raises(ValueError):
        keys.scheme_keys("nonsense", *[F.col("d")] * 5)


def test_dense_top_k_equals_brute_force(spark):
    import numpy as np

    rnd = np.random.default_rng(0)
    q, x = rnd.normal(size=(30, 8)), rnd.normal(size=(70, 8))
    mk = lambda m: spark.createDataFrame([("*", i, v.tolist()) for i, v in enumerate(m)], "grp string, id int, vec array<double>")
    want = {(i, j) for i, row in enumerate(q @ x.T) for j in np.argsort(-row)[:5].tolist()}
    for block in (4096, 16):
        assert {(r.s1_id, r.cand_id) for r in retrieval.dense_top_k(mk(q), mk(x), 5, block, "float64").collect()} == want
    assert retrieval.dense_top_k(mk(q), mk(x), 500, 16).count() == 30 * 70


def test_union_keeps_provenance(spark):
    mk = lambda rows: spark.createDataFrame(rows, "s1_id string, cand_id string, score double")
    got = {(r.s1_id, r.cand_id): r for r in retrieval.union_passes({"tfidf": mk([("a", "x", 0.5)]), "rare": mk([("a", "x", 2.0), ("a", "y", 1.0)])}).collect()}
    assert got["a", "x"].passes == 5 and (got["a", "x"].score_tfidf, got["a", "x"].score_rare) == (0.5, 2.0)
    assert got["a", "y"].passes == 4 and got["a", "y"].score_tfidf is None


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame([("a", "S2-x", 0.7), ("b", "S2-x", 0.9), ("a", "S3-y", 0.65), ("c", "S3-z", 0.2), ("b", "S3-w", 0.62), ("d", "S2-t", 0.9), ("e", "S2-t", 0.9)], PAIRS + ", prob double")


def test_decisions(spark, scored):
    universe = spark.createDataFrame([(x,) for x in "abcdef"], "s1_id string")
    assert {(r.s1_id, r.cand_id) for r in decide.one_to_one(scored).collect()} >= {("b", "S2-x"), ("d", "S2-t")}
    lists = {r.s1_id: r.matched for r in decide.apply_threshold(scored, universe, 0.6).collect()}
    assert lists == {"a": ["S3-y"], "b": ["S2-x", "S3-w"], "c": [], "d": ["S2-t"], "e": [], "f": []}
    gated = {r.s1_id: r.matched for r in decide.apply_threshold(scored, universe, 0.6, 0.8).collect()}
    assert gated["a"] == [] and gated["b"] == ["S2-x", "S3-w"]
    assert decide.neighborhood(None) == [None] and decide.neighborhood(0.3) == [0.3, 0.325, 0.35] and len(decide.TAU_GRID) == 27
    truth = spark.createDataFrame([("a", "S3-y"), ("b", "S2-x"), ("b", "S3-w"), ("d", "S2-t")], PAIRS)
    best = one(decide.tune_threshold(scored, truth, universe))
    assert best.tau == 0.3 and best.singleton_tau is None and best.macro_f05 == 1.0


def test_fbeta(spark):
    cases = [(2, 3, 2, 10 / 11), (0, 0, 0, 1.0), (1, 0, 0, 0.0), (0, 2, 0, 0.0), (3, 2, 2, 5 / 7)]
    df = spark.createDataFrame([c[:3] for c in cases], "p int, t int, h int").select(evaluate.entity_fbeta(F.col("p"), F.col("t"), F.col("h")).alias("f"))
    assert [r.f for r in df.collect()] == pytest.approx([c[3] for c in cases])


def test_blocking_stats(spark):
    cands = spark.createDataFrame([("S1-1", "S2-1", 1), ("S1-1", "S3-2", 3), ("S1-3", "S2-9", 2)], PAIRS + ", passes short")
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S3-2"), ("S1-2", "S2-5")], PAIRS)
    universe = spark.createDataFrame([("S1-1", "US"), ("S1-2", "FR"), ("S1-3", "US")], "s1_id string, country string")
    got = {r.metric: r.value for r in evaluate.blocking_stats(cands, truth, universe, 10, ("tfidf", "embed")).collect()}
    assert got["pair_recall"] == pytest.approx(2 / 3) and got["s1_full_recall"] == 0.5 and got["mean_candidates"] == 1.0 and got["reduction"] == pytest.approx(0.9)
    assert got["recall_tfidf"] == pytest.approx(2 / 3) and got["unique_tfidf"] == pytest.approx(1 / 3) and got["recall_embed"] == pytest.approx(1 / 3) and got["recall_country_FR"] == 0


def test_context_features(spark):
    df = spark.createDataFrame([("A", "X", 0.9, None), ("B", "X", 0.5, 0.5)], PAIRS + ", name_token_set double, addr_token_set double")
    got = {r.s1_id: r for r in features.context_features(df).collect()}
    assert (got["A"].rank_in_cand, got["B"].rank_in_cand) == (1, 2) and (got["A"].pair_sim, got["B"].pair_sim) == (0.9, 0.5)


def test_error_stages(spark):
    ids = ["1", "2", "3", "4", "5"]
    truth = spark.createDataFrame([(i, f"S2-{i}") for i in ids], PAIRS)
    scored = spark.createDataFrame([("3", "S2-3", 0.2), ("4", "S2-4", 0.9), ("5", "S2-5", 0.9), ("5", "S2-8", 0.8), ("5", "S2-9", 0.95)], PAIRS + ", prob double")
    losses = spark.createDataFrame([(i, f"S2-{i}", i == "1", *[False] * 5) for i in ids], PAIRS + ", " + ", ".join(f"{x} boolean" for x in errors.LOSSES))
    pred = scored.where("cand_id in ('S2-5', 'S2-8', 'S2-9')")
    got = {r.s1_id: r.stage for r in errors.classify_true_pairs(truth, scored, scored, pred, 0.5, losses).collect()}
    assert got == {"1": "representation_failure", "2": "blocking_false_negative", "3": "matcher_false_negative", "4": "decision_false_negative", "5": "correct_match"}
    assert {r.cand_id: r.top_wrong for r in errors.false_positives(scored, pred, truth).collect()} == {"S2-8": False, "S2-9": True}


def test_submission(spark, tmp_path):
    mk = lambda rows: spark.createDataFrame(rows, "s1_id string, ids array<string>")
    universe = spark.createDataFrame([("S1-2", 0), ("S1-1", 1)], "s1_id string, position int")
    valid = spark.createDataFrame([("S2-1",), ("S3-1",)], "entity_id string")
    tables.write_submission(mk([("S1-1", ["S2-1", "S2-1"])]), mk([("S1-1", ["S2-1", "S3-1"])]), universe, valid, str(tmp_path / "good"))
    assert (tmp_path / "good/matches.tsv").read_bytes() == b"source1_entity_id\tmatched_entity_ids\nS1-2\t\nS1-1\tS2-1\n"
    assert (tmp_path / "good/candidates.tsv").read_bytes() == b"source1_entity_id\tcandidate_entity_ids\nS1-2\t\nS1-1\tS2-1,S3-1\n"
    for matches, cands in (([("S1-1", ["S4-1"])], [("S1-1", ["S4-1"])]), ([("S1-1", ["S2-1"])], [("S1-1", ["S3-1"])]), ([("S1-9", ["S2-1"])], [("S1-9", ["S2-1"])]), ([("S1-1", ["S2-7"])], [("S1-1", ["S2-7"])])):
        with pytest.raises(ValueError):
            tables.write_submission(mk(matches), mk(cands), universe, valid, str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists()


def test_tables_and_paths(spark, tmp_path):
    rows = spark.createDataFrame([("S1-1", "a \"b\"", "", "US")], tables.RECORD)
    tables.write_tsv(rows, str(tmp_path / "t"))
    assert sorted(map(tuple, tables.read_tsv(spark, str(tmp_path / "t"), tables.RECORD).collect())) == [("S1-1", 'a "b"', "", "US")]
    made = []
    for _ in range(2):
        df = tables.cached(spark, str(tmp_path), "n", "k", lambda: made.append(1) or rows)
        assert df.count() == 1
    assert made == [1] and tables.cache_key(rows, 1) == tables.cache_key(rows.repartition(3), 1) != tables.cache_key(rows, 2)
    assert tables.file_hash(str(tmp_path / "nothing")) == "missing"
    with pytest.raises(ValueError):
        tables.expect_rows(rows, 2)
    assert paths.parse_root("s3://b/p/q/") == ("b", "p/q") and paths.join_key("a/", "", "/b") == "a/b"
    assert paths.path_of("p/x/y", "/base", "p").as_posix() == "/base/x/y"
    for bad in ("p/x/", "q/x", "p/../x"):
        with pytest.raises(ValueError):
            paths.path_of(bad, "/base", "p")


def test_samples(spark):
    ids = spark.createDataFrame([(f"S1-{i}",) for i in range(200)], "s1_id string")
    truth = spark.createDataFrame([(f"S1-{i}", f"S2-{i}") for i in range(180)], PAIRS)
    split = sampling.split_queries(ids, truth).where("split = 'valid'").join(truth.select("s1_id", F.lit(1).alias("m")), "s1_id", "left")
    assert split.count() == 40 and split.where("m is null").count() == 4
    small, large = ({r.s1_id for r in ids.where(sampling.hash_fraction(F.col("s1_id")) < f).collect()} for f in (0.2, 0.5))
    assert small <= large and 0.1 < len(small) / 200 < 0.3
    assert sampling.balanced_folds({"a": 5, "b": 3, "c": 2, "d": 1}, 2) in ({"a": 0, "b": 1, "c": 1, "d": 0}, {"a": 0, "b": 1, "c": 1, "d": 1}) and sampling.balanced_folds({"a": 1}, 5) == {"a": 0}


def test_drift(spark):
    rows = [("train", float(i)) for i in range(50)] + [("test", float(i + 25)) for i in range(50)] + [("test", None)]
    long = drift.long_form(spark.createDataFrame(rows, "split string, v double"), "split", ["v"])
    got = one(drift.ks_statistic(long))
    assert got.ks == pytest.approx(0.5) and drift.ks_p_value(got.ks, 50, 50) < 1e-4 and drift.ks_p_value(None, 0, 0) is None
    assert one(drift.cohens_d(long)).cohens_d == pytest.approx(-25 / 14.577, abs=1e-3)


def test_scorers_are_symmetric_on_equal_text():
    assert all(f("green traders", "green traders") == 1 for f in SCORERS.values())
