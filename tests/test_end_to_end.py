"""A synthetic linkage with planted truth, start to end."""

import random

import pytest

from matchloom.operators.blocking import BlockingConfig
from matchloom.operators.model import ModelConfig
from matchloom.plans.linkage import Linkage, RunConfig
from matchloom.sources.tables import RECORD


def records(n: int = 160, seed: int = 3):
    rnd = random.Random(seed)
    stems = "amber birch cedar delta ember fjord grove harbor iris jasper kestrel lumen maple nimbus onyx pearl quartz raven summit tundra umber violet willow xenon yarrow zephyr".split()
    trades = "bakery books clinic foods garage hotels legal motors optics pharmacy stores tools".split()
    roads = "alder beacon chapel denton elgin forest garden hilltop ivy juniper kings lake".split()
    s1, others, truth = [], [], []
    for i in range(n):
        name, number, road, country = f"{rnd.choice(stems)} {rnd.choice(stems)} {rnd.choice(trades)}", rnd.randint(1, 900), f"{rnd.choice(roads)} {rnd.choice(roads)}", rnd.choice(["US", "India"])
        s1.append((f"S1-{i}", f"{name} Ltd", f"{number} {road} Road", country))
        for c in range(0 if i % 16 == 0 else rnd.choice([1, 2, 2, 3])):
            own = name if rnd.random() > 0.25 else name[: (k := rnd.randrange(1, len(name) - 1))] + name[k + 1 :]
            others.append((f"S{2 + c % 2}-{i}{c}", own.upper() if c % 2 else f"-- {own} Private Limited", f"No {number}, {road} Rd" if rnd.random() > 0.05 else "", country))
            truth.append((f"S1-{i}", others[-1][0]))
    for j in range(100):
        others.append((f"S2-9{j:04}", f"{rnd.choice(stems)} {rnd.choice(trades)}", f"{rnd.randint(1, 900)} {rnd.choice(roads)} Road", "US"))
    return s1, others, truth


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    s1, others, truth = records()
    tables = spark.createDataFrame(s1, RECORD), spark.createDataFrame(others, RECORD), spark.createDataFrame(truth, "s1_id string, cand_id string")
    config = RunConfig(BlockingConfig(), ModelConfig(rounds=8, depth=4, step=0.1, least_rows=10), n_folds=2, singleton_taus=(None,))
    return Linkage(str(tmp_path_factory.mktemp("run")), config).valid(*tables)


def test_quality(run):
    blocking = {r.metric: r.value for r in run["blocking"].collect()}
    assert blocking["pair_recall"] >= 0.95
    whole = run["report"].where("grp is null").first()
    assert whole.macro_f05 > 0.85


def test_features_and_errors(run):
    names = [c for c in run["features"].columns if c not in ("s1_id", "cand_id", "label")]
    assert len(names) == 62
    assert run["errors"].where("stage = 'correct_match'").count() > 0.7 * run["errors"].count()
    assert run["slices"].count() > 0 and run["worst"].columns


def test_importance_and_saved_model(run, tmp_path):
    from matchloom.operators import model

    names = [c for c in run["features"].columns if c not in ("s1_id", "cand_id", "label")]
    gains, splits = dict(model.feature_importance(run["model"], names)), dict(model.split_counts(run["model"], names))
    assert set(gains) == set(splits) == set(names) and sum(gains.values()) == pytest.approx(1)
    assert sum(splits.values()) > 0 and all(splits[n] > 0 for n, g in gains.items() if g > 0)
    model.save_model(run["model"], str(tmp_path / "model"))
    again = model.predict(model.load_model(str(tmp_path / "model")), run["features"], names)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, model.predict(run["model"], run["features"], names).collect()))


def test_cache_keys_see_models_settings_and_encoders(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a",)], "x string")
    key = lambda config=RunConfig(), encoder=None: Linkage(str(tmp_path), config, encoder)._key(df)
    encoders = [F.udf(lambda t, n=n: [float(n)] * n, "array<float>") for n in (1, 2)]
    found = [key(), key(RunConfig(n_folds=3)), key(RunConfig(model=ModelConfig(rounds=7))), key(RunConfig(BlockingConfig(use_street=False))), key(encoder=lambda t: t), key(encoder=len), *(key(encoder=e) for e in encoders)]
    assert key() == found[0] and len(set(found[:6])) == 6


def test_commands(spark, tmp_path, capsys):
    import json

    from matchloom.__main__ import main
    from matchloom.sources import tables

    s1, others, truth = records(60, 5)
    put = lambda rows, schema, name: tables.write_tsv(spark.createDataFrame(rows, schema), str(tmp_path / name))
    put(s1, RECORD, "s1"), put(others, RECORD, "others")
    put([(r[0], ",".join(b for a, b in truth if a == r[0])) for r in s1], tables.TRUTH, "truth")
    base = ["--s1", f"{tmp_path}/s1", "--others", f"{tmp_path}/others", "--truth", f"{tmp_path}/truth", "--root", f"{tmp_path}/root", "--no-embeddings", "--folds", "2", "--rounds", "3"]
    assert main(["run", "valid", "--stage", "blocking", "--log", f"{tmp_path}/log", *base]) == 0
    told = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert {r["metric"]: r["value"] for r in told["blocking"]}["pair_recall"] > 0.9
    assert json.loads(spark.read.text(f"{tmp_path}/log").first().value)["stage"] == "blocking"
    assert main(["run", "test", "--test-s1", f"{tmp_path}/s1", "--test-others", f"{tmp_path}/others", "--out", f"{tmp_path}/out", *base]) == 0
    lines = (tmp_path / "out" / "matches.tsv").read_text().splitlines()
    assert len(lines) == 61 and lines[0] == "source1_entity_id\tmatched_entity_ids"
    capsys.readouterr()
    assert main(["diagnose", "convergence", *base]) == 0
    rows = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert [r["variant"] for r in rows] == ["60"] and rows[0]["failure"] is None and 0 <= rows[0]["macro_f05"] <= 1
