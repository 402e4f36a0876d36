"""The registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audio, balltree, bpe, chains, dac, dsir, langid, mixing, simhash, warc
from .common import Scratch


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return os.environ.get("MATCHLOOM_VOCABULARY") or public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives a record per page and reads them back. A null id is kept, null html is empty, repeated rows are copies; no pages give no rows."""
    path = f"{Scratch(spark, 'warc').root}/archive"
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.parse_records(warc.read_archive(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between passages of documents, with their classes. Null ids and texts take no part; documents without a shared passage have no row."""
    return chains.shared_passages(table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from documents that aren't held out. Null texts are `und`, null ids aren't held out and teach nothing; every row has one row."""
    docs = table(spark, sf_dir, "documents")
    net = langid.learn(docs.where(~langid.held_out("doc_id")))
    return langid.predict(docs, net).select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document. Null and empty texts have fingerprint zero; every row has one row."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best others of each queried vector. Vectors that are null or have a null or non-finite component take no part."""
    return balltree.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: F.pmod(vec_id, F.lit(50)) == 0)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and words taken of every document. A null text has size 0, null sources are one source."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, size and checksum of every document's ids, from the written codes. A null text has the end id only, a null id comes first."""
    written = Scratch(spark, "dac").cut(dac.write_segments(table(spark, sf_dir, "documents"), vocabulary()), "segments")
    return dac.read_segments(written)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance of every document and whether it is sampled. A null text has weight 0."""
    return dsir.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's ids and of what they decode to. A null text has no ids."""
    return bpe.bpe_round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op10_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every text's stored recording holds, and its PCM at 16 kHz. A null text is 64 zero bytes."""
    stored = Scratch(spark, "audio").cut(audio.store_media(table(spark, sf_dir, "documents")), "media")
    return audio.media_features(stored)


QUERIES = {f.__name__: f for f in (op1_warc, op2_passages, op3_language, op4_simhash, op5_top_k, op6_mixing, op7_token_ids, op8_quality, op9_bpe, op10_audio)}
