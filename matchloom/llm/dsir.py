"""Quality classifier by importance resampling.

Hashed word unigrams and bigrams of good text and of all text give two bag-of-n-grams models. A document's
log importance is the sum over its n-grams of the log ratio of the models; adding Gumbel noise and taking the
top k samples documents without replacement in proportion to importance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, lean, slices, text_parts
from .mixing import uniform
from .words import grams, hashed_words

FEATURES, PORTION = 1 << 16, 1 << 20
LABELLED = 20_000
SLICES, RANKED = 4096, 10_000


def features(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the unigrams and bigrams of texts, those of each text together, and their offsets."""
    words, _, _, at = hashed_words(body, offsets)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    pairs = np.append(grams(words, 2), np.uint64(0))
    both = np.stack((words, pairs), axis=1) % np.uint64(FEATURES)
    use = np.ones((len(words), 2), bool)
    use[at[1:][at[1:] > at[:-1]] - 1, 1] = False  # no pair begins with a text's last word
    before = np.concatenate(([0], np.cumsum(use.sum(axis=1))))
    return both[use].astype(np.int64), before[at]


def count_features(df: DataFrame, text_col: str, flag_col: str) -> DataFrame:
    """Feature counts over all texts, and over the flagged: bucket, raw, target. Each task sends one row a bucket at most."""

    def run(batches):
        raw, target = np.zeros(FEATURES, np.int64), np.zeros(FEATURES, np.int64)
        for batch in batches:
            body, at = text_parts(batch.column(0))
            flags = np.array(batch.column(1).fill_null(False).to_pylist(), bool)
            for i, j in slices(at, PORTION):
                found, ends = features(body[at[i] : at[j]], at[i : j + 1] - at[i])
                raw += np.bincount(found, minlength=FEATURES)
                if flags[i:j].any():
                    target += np.bincount(found[np.repeat(flags[i:j], np.diff(ends))], minlength=FEATURES)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], names=["bucket", "raw", "target"])

    counted = df.select(F.col(text_col), F.col(flag_col)).mapInArrow(lean(run), "bucket long, raw long, target long")
    return counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, weight: float = 4096.0) -> np.ndarray:
    """Log of target over raw probability for each bucket; at most FEATURES rows reach the driver.

    The raw model is smoothed by 1 a bucket, the target model by `weight` n-grams of the raw model.
    """
    raw, target = np.ones(FEATURES), np.zeros(FEATURES)
    for r in counts.collect():
        raw[r.bucket] += r.raw
        target[r.bucket] += r.target
    raw /= raw.sum()
    return np.log((target + weight * raw) / (target.sum() + weight)) - np.log(raw)


def log_importance(df: DataFrame, ratios: np.ndarray, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Log importance of every whole text: id, n_features, log_weight."""
    schema = df.select(F.col(id_col)).schema.add("n_features", "long").add("log_weight", "double")
    scaled = np.rint(ratios * (1 << 32)).astype(np.int64)  # whole numbers, so that sums don't depend on their order

    def run(batches):
        for batch in batches:
            body, at = text_parts(batch.column(1))
            sums, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, j in slices(at, PORTION):
                found, ends = features(body[at[i] : at[j]], at[i : j + 1] - at[i])
                total = np.concatenate(([0], np.cumsum(scaled.take(found))))
                sums.append(total[ends[1:]] - total[ends[:-1]])
                counts.append(np.diff(ends))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(counts)), pa.array(np.concatenate(sums) / float(1 << 32))], names=[f.name for f in schema])

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(lean(run), schema)


def top_fraction(scored: DataFrame, key: str, fraction: float, tie: str) -> DataFrame:
    """Adds `selected`: whether a row is among the round(fraction * rows) highest keys, ties to the smaller `tie`.

    Rows are counted by slices of the key's range, and the slice that holds the limit by its own slices, until it has
    RANKED rows at most or can't be divided; only its rows are ranked.
    """
    span = scored.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).first()
    wanted = round(fraction * span.n)
    if not span.n or not wanted or wanted >= span.n:
        return scored.withColumn("selected", F.lit(bool(span.n and wanted >= span.n)))
    low, high, chosen = span.low, span.high, F.lit(None).cast("boolean")
    while True:
        width = (high - low) / SLICES
        if not width or low + width == low:
            break
        slice_no = F.least(F.lit(SLICES - 1), F.floor((F.col(key) - F.lit(low)) / F.lit(width))).cast("int")
        counts = scored.where(chosen.isNull()).groupBy(slice_no.alias("slice")).count().orderBy(F.desc("slice")).collect()  # SLICES rows at most
        for r in counts:
            edge, inside = r.slice, r["count"]
            if inside >= wanted:
                break
            wanted -= inside
        chosen = F.when(chosen.isNotNull(), chosen).when(slice_no != edge, slice_no > edge)
        low, high = low + edge * width, low + (edge + 1) * width
        if inside <= RANKED:
            break
    placed = scored.withColumn("chosen", chosen)
    at_edge = placed.where("chosen is null").withColumn("selected", F.row_number().over(Window.orderBy(F.desc(key), F.col(tie).asc_nulls_last())) <= wanted)
    return at_edge.unionByName(placed.where("chosen is not null").withColumn("selected", F.col("chosen"))).drop("chosen")


def resample(df: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality", good: int = 1, fraction: float = 0.5, labelled: int = LABELLED, seed: int = 8) -> DataFrame:
    """Importance of every document and a sample by it: id, n_features, log_weight, quality, gumbel_key, selected.

    quality is the logistic of the mean log ratio of the document's n-grams, scaled by the mean's typical spread
    (0.5: as likely in good text as in all). selected marks the round(fraction * documents) highest of log_weight
    plus Gumbel noise, which depends on the id and seed alone.

    The model of all text counts every document; that of good text counts documents labelled `good`, `labelled`
    of them at most, chosen by a hash of their ids. Texts without words have weight 0 and quality 0.5. Null ids
    and labels label nothing; contradictory labels of a document count as good. Rows keep their number.
    """
    scratch = Scratch(df.sparkSession, "dsir")
    chosen = labels.where((F.col(label_col) == good) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("good_id")).distinct()
    chosen = chosen.orderBy(F.xxhash64("good_id"), "good_id").limit(labelled).withColumn("flag", F.lit(True))
    flagged = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("good_id"), "left").select("text", "flag")
    ratios = log_ratios(count_features(flagged, "text", "flag"))
    scored = log_importance(df, ratios, text_col, id_col)
    noise = -F.log(-F.log(uniform(F.col(id_col), seed)))
    scored = scored.withColumn("quality", 1 / (1 + F.exp(-F.lit(8.0) * F.col("log_weight") / F.greatest(F.col("n_features"), F.lit(1))))).withColumn("gumbel_key", F.col("log_weight") + noise)
    return top_fraction(scratch.cut(scored, "scored"), "gumbel_key", fraction, id_col)
