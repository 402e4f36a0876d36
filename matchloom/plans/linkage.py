"""The whole linkage run: validate on labelled records, or train and predict."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns, lexicon, normalize, similarity
from ..functions.columns import embedding_text
from ..functions.normalize import normalize_frame
from ..operators import blocking, decide, errors, evaluate, features, keys, model, retrieval, sampling
from ..sources import tables


@dataclass(frozen=True)
class RunConfig:
    blocking: blocking.BlockingConfig = field(default_factory=blocking.BlockingConfig)
    model: model.ModelConfig = field(default_factory=model.ModelConfig)
    n_folds: int = 5
    sample: float | None = None
    singleton_taus: tuple | None = None


#: Modules whose source decides what a run's tables hold.
CODE = (columns, lexicon, normalize, similarity, blocking, decide, errors, evaluate, features, keys, model, retrieval, sampling, tables)


class Linkage:
    """A run whose normalised records, candidates, features and scores are written below `root`, since each is read more than once.

    Lineage ends at those tables, so a lost executor costs tasks only, and a second run on equal content reads them.
    """

    def __init__(self, root: str, config: RunConfig = RunConfig(), encoder=None):
        self.root, self.config, self.encoder = root.rstrip("/"), config, encoder

    def _kept(self, name: str, key: str, make) -> DataFrame:
        return tables.cached(SparkSession.getActiveSession(), self.root, name, key, make)

    def _key(self, *parts) -> str:
        """Key of what comes of these tables and values: also of the library's code, all settings and the encoder."""
        encoder = self.encoder and getattr(self.encoder, "func", self.encoder)
        code = getattr(encoder, "__code__", None)
        named = encoder and (getattr(encoder, "__module__", ""), getattr(encoder, "__qualname__", repr(encoder)), code and (code.co_code, code.co_consts), [repr(c.cell_contents) for c in getattr(encoder, "__closure__", None) or ()], getattr(encoder, "version", ""))
        return tables.cache_key(*parts, self.config, named, tables.code_version(*CODE))

    def prepare(self, records: DataFrame, name: str) -> DataFrame:
        return self._kept(f"norm_{name}", self._key(records), lambda: normalize_frame(records))

    def candidates(self, s1: DataFrame, others: DataFrame, key: str) -> DataFrame:
        return self._kept("candidates", key, lambda: blocking.generate_candidates(s1, others, self.config.blocking, self.encoder))

    def features(self, cands: DataFrame, s1: DataFrame, others: DataFrame, key: str) -> DataFrame:
        def make() -> DataFrame:
            text = embedding_text(F.col("business_name"), F.col("business_address")) if self.config.blocking.use_embeddings else None
            return features.build_features(cands, s1, others, text, self.encoder)

        return self._kept("features", key, make)

    def _block(self, s1: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        a, b = self.prepare(s1, "s1"), self.prepare(others, "others")
        key = self._key(a, b)
        cands = self.candidates(a, b, key)
        return a, b, cands, self.features(cands, a, b, key)

    def fit(self, labelled: DataFrame, truth: DataFrame, universe: DataFrame):
        """Out-of-fold scores, the thresholds that suit them, and a model of all rows: (model, tau, singleton_tau, scored)."""
        names = features.feature_columns(labelled)
        scored, folds = model.train_oof(labelled, self.config.n_folds, self.config.model, names)
        scored = self._kept("oof", self._key(labelled), lambda: scored)
        best = decide.tune_threshold(scored, truth, universe, singleton_taus=self.config.singleton_taus).first()
        rounds = model.full_rounds(folds, self.config.n_folds, self.config.model.rounds)
        return model.train_full(labelled, names, self.config.model, rounds), best.tau, best.singleton_tau, scored

    def valid(self, s1: DataFrame, others: DataFrame, truth: DataFrame, stage: str = "all") -> dict[str, DataFrame | float | None]:
        """Trains on four fifths of the queries and reports on the rest. Stages `blocking` and `features` end there."""
        if self.config.sample is not None:
            s1, others, truth = sampling.subsample(s1, others, truth, self.config.sample)
        a, b, cands, feats = self._block(s1, others)
        universe = s1.select(F.col("entity_id").alias("s1_id"), "country")
        out: dict = {"candidates": cands, "blocking": evaluate.blocking_stats(cands, truth, universe, b.count(), self.config.blocking.active())}
        if stage == "blocking":
            return out
        labelled = features.label_pairs(feats, truth)
        out["features"] = labelled
        if stage == "features":
            return out
        split = sampling.split_queries(universe, truth)
        part = lambda df, s: df.join(split.where(F.col("split") == s).select("s1_id"), "s1_id", "left_semi")
        fitted, tau, gate, _ = self.fit(part(labelled, "train"), part(truth, "train"), part(universe, "train"))
        held = part(universe, "valid")
        own = part(labelled, "valid")
        scored = self._kept("scored", self._key(part(labelled, "train"), own), lambda: model.predict(fitted, own, features.feature_columns(labelled)))
        pred = decide.decide_pairs(scored, tau, gate)
        known = part(truth, "valid")
        classes = errors.classify_true_pairs(known, part(cands, "valid"), scored, pred, tau, errors.true_pair_losses(known, a, b))
        return out | {"model": fitted, "tau": tau, "singleton_tau": gate, "scored": scored, "predicted": pred, "report": evaluate.score_report(pred, known, held), "errors": classes, "slices": errors.slice_report(classes, cands, a, b), "worst": errors.worst_errors(scored, known, pred, a, b)}

    def leave_country_out(self, s1: DataFrame, others: DataFrame, truth: DataFrame, country: str) -> DataFrame:
        """score_report on a country that training never saw: candidates, vectors and features are made of each side's records alone."""
        inside = lambda df: df.where(F.col("country") == country)
        outside = lambda df: df.where(F.col("country") != country)
        _, _, _, train = self._block(outside(s1), outside(others))
        _, _, _, test = self._block(inside(s1), inside(others))
        universe = lambda df: df.select(F.col("entity_id").alias("s1_id"), "country")
        own = lambda df: truth.join(df.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")
        fitted, tau, gate, _ = self.fit(features.label_pairs(train, truth), own(outside(s1)), universe(outside(s1)))
        pred = decide.decide_pairs(model.predict(fitted, test, features.feature_columns(train)), tau, gate)
        return evaluate.score_report(pred, own(inside(s1)), universe(inside(s1)))

    def test(self, train: tuple[DataFrame, DataFrame, DataFrame], s1: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Matches and candidates, as lists, of records without labels; vectors are fitted anew on them."""
        _, _, _, feats = self._block(train[0], train[1])
        labelled = features.label_pairs(feats, train[2])
        fitted, tau, gate, _ = self.fit(labelled, train[2], train[0].select(F.col("entity_id").alias("s1_id")))
        _, _, cands, own = self._block(s1, others)
        scored = self._kept("test_scored", self._key(labelled, own), lambda: model.predict(fitted, own))
        universe = s1.select(F.col("entity_id").alias("s1_id"))
        matches = decide.apply_threshold(scored, universe, tau, gate).withColumnRenamed("matched", "ids")
        return matches, retrieval.candidate_lists(scored, -F.col("prob")).withColumnRenamed("candidates", "ids")
