"""Command line: python -m matchloom run|diagnose ...; record tables are TSV files or folders that Spark reads."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.normalize import normalize_frame
from .operators.blocking import BlockingConfig
from .operators.model import ModelConfig
from .plans import diagnostics, experiments
from .plans.linkage import Linkage, RunConfig
from .sources import tables

#: Diagnostics of normalised records, and experiments of raw ones.
MEASURES = {
    "blocking-ablation": lambda a, b, t, c: diagnostics.ablation(a, b, t, diagnostics.k_variants(c)),
    "chunk-equality": lambda a, b, t, c: diagnostics.partition_equality(a, b, config=c),
    "name-retrieval-rank": lambda a, b, t, c: diagnostics.name_retrieval_ranks(a, b, t),
    "density-stress": lambda a, b, t, c: diagnostics.density_stress(a, b, t, b, c),
    "density-variants": lambda a, b, t, c: experiments.density_variants(a, b, t, b, {"base": c, **diagnostics.fix_variants(c)}),
}
EXPERIMENTS = {
    "convergence": experiments.convergence, "blocking-k-downstream": experiments.k_downstream, "fix-variants": experiments.fix_downstream, "candidate-augment-downstream": experiments.augment_downstream,
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="matchloom", description=__doc__)
    kinds = out.add_subparsers(dest="command", required=True)
    run, diagnose = kinds.add_parser("run", help="validate on labelled records, or train and predict"), kinds.add_parser("diagnose", help="one diagnostic or experiment")
    run.add_argument("mode", choices=("valid", "test"))
    run.add_argument("--stage", choices=("blocking", "features", "all"), default="all", help="where a validation ends")
    run.add_argument("--test-s1"), run.add_argument("--test-others", nargs="+"), run.add_argument("--out", help="folder of both result files, of the mode test")
    diagnose.add_argument("name", choices=sorted({*MEASURES, *EXPERIMENTS, "loco"}))
    diagnose.add_argument("--country", help="left out by loco")
    for p in (run, diagnose):
        p.add_argument("--s1", required=True), p.add_argument("--others", nargs="+", required=True), p.add_argument("--truth", required=True)
        p.add_argument("--root", required=True, help="folder for tables that later runs read"), p.add_argument("--log", help="folder of the experiment log")
        p.add_argument("--sample", type=float), p.add_argument("--folds", type=int, default=5), p.add_argument("--rounds", type=int, default=ModelConfig.rounds)
        p.add_argument("--no-embeddings", action="store_true"), p.add_argument("--any-country", action="store_true")
    return out


def records(spark: SparkSession, *paths: str) -> DataFrame:
    out = tables.read_tsv(spark, paths[0], tables.RECORD)
    for path in paths[1:]:
        out = out.unionByName(tables.read_tsv(spark, path, tables.RECORD))
    return out


def plain(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("matchloom").getOrCreate()
    config = RunConfig(BlockingConfig(use_embeddings=not args.no_embeddings, within_country=not args.any_country), ModelConfig(rounds=args.rounds), n_folds=args.folds, sample=args.sample)
    s1, others = records(spark, args.s1), records(spark, *args.others)
    truth, _ = tables.truth_pairs(tables.read_tsv(spark, args.truth, tables.TRUTH))
    linkage = Linkage(args.root, config)
    if args.command == "diagnose":
        if args.name in MEASURES:
            told = plain(MEASURES[args.name](linkage.prepare(s1, "s1"), linkage.prepare(others, "others"), truth, config.blocking))
        elif args.name == "loco":
            told = plain(linkage.leave_country_out(s1, others, truth, args.country))
        else:
            told = plain(EXPERIMENTS[args.name](args.root, s1, others, truth, config))
    elif args.mode == "valid":
        out = linkage.valid(s1, others, truth, args.stage)
        told = [{"blocking": plain(out["blocking"]), **({k: out[k] for k in ("tau", "singleton_tau")} | {"report": plain(out["report"]), "slices": plain(out["slices"])} if args.stage == "all" else {})}]
    else:
        targets, pool = records(spark, args.test_s1), records(spark, *args.test_others)
        matches, candidates = linkage.test((s1, others, truth), targets, pool)
        universe = targets.select(F.col("entity_id").alias("s1_id"), F.monotonically_increasing_id().alias("position"))
        tables.write_submission(matches, candidates, universe, pool.unionByName(targets), args.out)
        told = [{"written": args.out, "queries": universe.count()}]
    if args.log:
        tables.log_experiment(spark, {"results": told}, getattr(args, "mode", "diagnose"), getattr(args, "stage", getattr(args, "name", "")), args.log)
    for line in told:
        print(json.dumps(line, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
