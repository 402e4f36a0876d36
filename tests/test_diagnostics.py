"""Diagnostics and the streaming extension on a small linkage."""

import pytest
from pyspark.sql import functions as F

from matchloom.functions.normalize import normalize_frame
from matchloom.operators.blocking import BlockingConfig
from matchloom.operators import blocking
from matchloom.plans import diagnostics as dg
from matchloom.sources.tables import RECORD, cut
from matchloom.streaming.scoring import block_arriving

from .test_end_to_end import records

FEW = BlockingConfig(use_embeddings=False, use_tfidf_addr=False)


@pytest.fixture(scope="module")
def small(spark):
    s1, others, truth = records(40)
    a, b = (normalize_frame(spark.createDataFrame(x, RECORD)).persist() for x in (s1, others))
    return a, b, spark.createDataFrame(truth, "s1_id string, cand_id string")


def test_ablation_and_equality(small):
    a, b, truth = small
    variants = {"base": FEW, "no_street": BlockingConfig(use_embeddings=False, use_tfidf_addr=False, use_street=False)}
    got = {r.variant: r for r in dg.ablation(a, b, truth, variants).collect()}
    assert got["base"].pair_recall >= got["no_street"].pair_recall > 0.8 and got["base"].n_s1 == 40
    assert {r.status for r in dg.partition_equality(a, b, (1, 3), FEW).collect()} == {"PASS"}
    assert len(dg.k_variants()) == 15 and len(dg.fix_variants()) == 9


def test_misses(small):
    a, b, truth = small
    cands = cut(blocking.generate_candidates(a, b, FEW), "cands")
    half = cands.where(F.crc32(F.col("cand_id").cast("binary")) % 2 == 0)
    misses = dg.clean_misses(truth, half, a, b)
    q, x = blocking.grouped(a, True), blocking.grouped(b, True)
    wide = {"digit": blocking.digit_pass(q, x, 100, 1000), "street": blocking.street_pass(q, x, 100, 1000)}
    got = {r["pass"]: r for r in dg.miss_attribution(misses, wide).collect()}
    assert got["digit"].misses == misses.count() and got["digit"].only_here <= got["digit"].found <= got["digit"].misses
    assert {r.forensic_category for r in dg.miss_forensics(truth, a, b).collect()} <= {"MULTI_FIELD_SIGNAL", "NAME_SIGNAL", "ADDRESS_SIGNAL", "NUMERIC_SIGNAL", "VERY_LOW_SIGNAL"}
    more = dg.augmented(half, cands.select("s1_id", "cand_id"))
    assert more.count() == cands.count() and more.where("passes = 0").count() == cands.count() - half.count()


def test_density(small):
    a, b, truth = small
    pool = b.withColumn("entity_id", F.concat(F.lit("S2-88"), "entity_id"))
    got = {r.density: r for r in dg.density_stress(a, b, truth, pool, FEW, (0.0, 0.5)).collect()}
    assert got["0.5"].n_pairs >= got["0.0"].n_pairs


def test_stream(spark, small, tmp_path):
    a, b, _ = small
    spark.createDataFrame(records(40)[1], RECORD).repartition(2).write.json(str(tmp_path / "in"))
    arriving = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    running = block_arriving(arriving, a, str(tmp_path / "out"), str(tmp_path / "state"))
    running.processAllAvailable()
    running.stop()
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.count() > 0 and set(found.columns) >= {"s1_id", "cand_id", "passes"}
