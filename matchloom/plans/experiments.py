"""Whole linkage runs of several set-ups, a row of scores for each; a run that fails is a row with its reason."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import sampling
from ..operators.blocking import BlockingConfig
from . import diagnostics
from .linkage import Linkage, RunConfig

SIZES = (2_000, 5_000, 10_000, 25_000)
METRICS = ("variant", "pair_recall", "mean_candidates", "tau", "singleton_tau", "macro_f05", "failure")
ROW = "variant string, pair_recall double, mean_candidates double, tau double, singleton_tau double, macro_f05 double, failure string"


class Augmented(Linkage):
    """A run whose candidates are joined by pairs of other ways to block, with passes 0 and no scores."""

    def candidates(self, s1: DataFrame, others: DataFrame, key: str) -> DataFrame:
        base = super().candidates(s1, others, key)
        return self._kept("augmented", key, lambda: diagnostics.augmented(base, diagnostics.counterfactual_pairs(s1, others)["all"]))


def row(name: str, run: Callable[[], dict]) -> tuple:
    """One run's row of METRICS."""
    try:
        out = run()
        blocking = {r.metric: r.value for r in out["blocking"].collect()}
        whole = out["report"].where("grp is null").first()
        return name, blocking["pair_recall"], blocking["mean_candidates"], out["tau"], out["singleton_tau"], whole.macro_f05, None
    except (PySparkException, ValueError, ArithmeticError) as failed:
        return name, None, None, None, None, None, f"{type(failed).__name__}: {str(failed)[:200]}"


def downstream(root: str, s1: DataFrame, others: DataFrame, truth: DataFrame, configs: dict[str, RunConfig], encoder=None, kind: type[Linkage] = Linkage) -> DataFrame:
    """Runs of raw records to the final report, one a configuration. They share tables that don't depend on it."""
    rows = [row(name, lambda c=config: kind(root, c, encoder).valid(s1, others, truth)) for name, config in configs.items()]
    return s1.sparkSession.createDataFrame(rows, ROW)


def convergence(root: str, s1: DataFrame, others: DataFrame, truth: DataFrame, config: RunConfig = RunConfig(), sizes: tuple[int, ...] = SIZES, encoder=None) -> DataFrame:
    """How scores change with the number of queries: runs of samples of each size, smaller ones being parts of larger ones. Sizes beyond the data run on all of it once."""
    have = s1.count()
    shares = {min(n, have): min(1.0, n / max(1, have)) for n in sizes}
    return downstream(root, s1, others, truth, {str(n): replace(config, sample=share if share < 1 else None) for n, share in shares.items()}, encoder)


def k_downstream(root: str, s1: DataFrame, others: DataFrame, truth: DataFrame, config: RunConfig = RunConfig(), encoder=None) -> DataFrame:
    """What the candidates kept by each pass are worth in the end: half, as set, twice and four times."""
    scaled = lambda f: replace(config, blocking=replace(config.blocking, k={p: max(1, int(k * f)) for p, k in config.blocking.k.items()}))
    return downstream(root, s1, others, truth, {"k_half": scaled(0.5), "k": config, "k_double": scaled(2), "k_fourfold": scaled(4)}, encoder)


def fix_downstream(root: str, s1: DataFrame, others: DataFrame, truth: DataFrame, config: RunConfig = RunConfig(), encoder=None, names: tuple[str, ...] | None = None) -> DataFrame:
    """The named set-ups of diagnostics.fix_variants to the end."""
    variants = diagnostics.fix_variants(config.blocking)
    return downstream(root, s1, others, truth, {n: replace(config, blocking=variants[n]) for n in names or variants}, encoder)


def augment_downstream(root: str, s1: DataFrame, others: DataFrame, truth: DataFrame, config: RunConfig = RunConfig(), encoder=None) -> DataFrame:
    """Runs without and with the counterfactual pairs among the candidates."""
    plain = downstream(root, s1, others, truth, {"base": config}, encoder)
    return plain.unionByName(downstream(root, s1, others, truth, {"augmented": config}, encoder, Augmented))


def density_variants(s1: DataFrame, others: DataFrame, truth: DataFrame, pool: DataFrame, variants: dict[str, BlockingConfig] | None = None, fractions: tuple[float, ...] = diagnostics.DENSITIES) -> DataFrame:
    """Candidate quality of several set-ups, each at several densities of unrelated records (normalised records)."""
    kept = others.select("entity_id")
    parts = {}
    for name, config in (variants or diagnostics.fix_variants()).items():
        parts[name] = diagnostics.density_stress(s1, others, truth, pool, config, fractions)
    return diagnostics.stack(parts, "variant").withColumn("distractors", F.lit(sampling.distractors(pool, max(fractions), kept).count()) * F.col("density").cast("double") / max(fractions))
