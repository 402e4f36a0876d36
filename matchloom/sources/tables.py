"""Record tables, truth and results: schemas, TSV and Parquet, validation, caches and reports."""

from __future__ import annotations

import hashlib
import inspect
import json
import platform
import shutil
import tempfile
import uuid
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import format_ids, parse_ids

RECORD = StructType([StructField(c, StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = StructType([StructField(c, StringType()) for c in ("source1_entity_id", "matched_entity_ids")])
FORBIDDEN = "[,\\t\\n\\r\"' ]"


class Catalog:
    """Named paths of the sources of a split, read when asked for."""

    def __init__(self, spark: SparkSession, paths: dict[str, dict[str, str]]):
        self.spark, self.paths = spark, paths

    def source(self, split: str, key: str) -> DataFrame:
        return read_tsv(self.spark, self.paths[split][key], TRUTH if key == "truth" else RECORD)

    def split(self, split: str) -> dict[str, DataFrame]:
        return {key: self.source(split, key) for key in self.paths[split]}


def read_tsv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All columns as strings; an empty cell is an empty string, never null."""
    reader = spark.read.option("sep", "\t").option("header", True).option("escape", '"').option("multiLine", True)
    return (reader.schema(schema) if schema else reader).csv(path).na.fill("")


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("sep", "\t").option("header", True).option("emptyValue", "").option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def truth_pairs(truth: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (s1_id, cand_id) and the universe (s1_id) of a truth table; queries without matches are in the universe alone."""
    universe = truth.select(F.trim("source1_entity_id").alias("s1_id")).distinct()
    return truth.select(F.trim("source1_entity_id").alias("s1_id"), F.explode(parse_ids(F.col("matched_entity_ids"))).alias("cand_id")), universe


def list_findings(lists: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """(category, s1_id, value) of every fault in (s1_id, ids array): not an S2 or S3 id, a forbidden character, an unknown id."""
    long = lists.select("s1_id", F.explode_outer("ids").alias("raw")).withColumn("value", F.trim("raw"))
    bad = [("not_a_string", F.col("raw").isNull() & F.col("s1_id").isNull()), ("wrong_prefix", ~F.col("value").rlike("^S[23]-")), ("forbidden_character", F.col("value").rlike(FORBIDDEN))]
    out = None
    for name, condition in bad:
        own = long.where(condition).select(F.lit(name).alias("category"), "s1_id", "value")
        out = own if out is None else out.unionByName(own)
    if valid is not None:
        known = valid.select(F.col("entity_id").alias("value"))
        out = out.unionByName(long.where("value is not null").join(known, "value", "left_anti").select(F.lit("unknown_id").alias("category"), "s1_id", "value"))
    return out


def submission_findings(matches: DataFrame, candidates: DataFrame, universe: DataFrame, valid: DataFrame) -> DataFrame:
    """All faults of a result: list_findings of both, repeated or misnamed or unknown queries, matches that aren't candidates."""
    both = list_findings(matches, valid).unionByName(list_findings(candidates, valid))
    row = lambda df, name: df.select(F.lit(name).alias("category"), "s1_id", F.lit(None).cast("string").alias("value"))
    repeated = row(universe.groupBy("s1_id").count().where("count > 1"), "repeated_s1")
    misnamed = row(universe.where(~F.col("s1_id").startswith("S1-")), "wrong_s1_prefix")
    unknown = row(matches.select("s1_id").unionByName(candidates.select("s1_id")).distinct().join(universe, "s1_id", "left_anti"), "unknown_s1")
    outside = matches.join(candidates.withColumnRenamed("ids", "cand_ids"), "s1_id", "left").select("s1_id", F.explode(F.array_except(F.transform("ids", lambda x: F.trim(x)), F.coalesce(F.transform("cand_ids", lambda x: F.trim(x)), F.array().cast("array<string>")))).alias("value")).select(F.lit("match_not_candidate").alias("category"), "s1_id", "value")
    return both.unionByName(repeated).unionByName(misnamed).unionByName(unknown).unionByName(outside)


def write_submission(matches: DataFrame, candidates: DataFrame, universe: DataFrame, valid: DataFrame, out_dir: str) -> None:
    """Both result files, a line for each query in the universe's order (column `position`), or ValueError and no file at all.

    Lines leave Spark in order through an iterator, so the driver holds one partition at a time.
    """
    faults = submission_findings(matches, candidates, universe.select("s1_id"), valid)
    if found := faults.groupBy("category").count().orderBy("category").collect():
        raise ValueError("; ".join(f"{r.category}: {r['count']}" for r in found))
    target = Path(out_dir)
    target.mkdir(parents=True, exist_ok=True)
    for name, lists, header in (("matches.tsv", matches, "matched_entity_ids"), ("candidates.tsv", candidates, "candidate_entity_ids")):
        lines = universe.join(lists, "s1_id", "left").orderBy("position").select("s1_id", F.coalesce(format_ids(F.transform("ids", lambda x: F.trim(x))), F.lit("")).alias("ids"))
        with open(target / f".{name}", "w", encoding="utf-8", newline="\n") as f:
            f.write(f"source1_entity_id\t{header}\n")
            f.writelines(f"{r.s1_id}\t{r.ids}\n" for r in lines.toLocalIterator())
    for name in ("matches.tsv", "candidates.tsv"):
        (target / f".{name}").replace(target / name)


def validate_lists(lines: DataFrame, universe: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """(category, offenders, examples) of a written result, from (s1_id, ids text): findings with up to five examples each."""
    rows = lines.select("s1_id", parse_ids(F.col("ids")).alias("ids"))
    long = rows.select("s1_id", F.explode("ids").alias("value"))
    row = lambda df, name, value="s1_id": df.select(F.lit(name).alias("category"), F.col(value).alias("example"))
    parts = [
        row(lines.groupBy("s1_id").count().where("count > 1"), "duplicate_s1"), row(long.groupBy("s1_id", "value").count().where("count > 1"), "duplicate_in_list", "value"), row(long.where(F.col("value").startswith("S1-")), "s1_in_list", "value"),
        row(long.where(~F.col("value").rlike("^S[123]-")), "wrong_prefix", "value"), row(universe.join(lines, "s1_id", "left_anti"), "missing_s1"), row(lines.join(universe, "s1_id", "left_anti"), "extra_s1"),
    ]
    if valid is not None:
        parts.append(row(long.join(valid.select(F.col("entity_id").alias("value")), "value", "left_anti"), "unknown_id", "value"))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("category").agg(F.count(F.lit(1)).alias("offenders"), F.slice(F.array_sort(F.collect_set("example")), 1, 5).alias("examples"))


def frame_fingerprint(df: DataFrame) -> DataFrame:
    """One row: rows, and a digest of their content that doesn't depend on their order."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("digest"))


def cache_key(*parts) -> str:
    """Digest of tables (by content) and settings (by their text)."""
    digest = hashlib.sha1()
    for p in parts:
        digest.update(str(tuple(frame_fingerprint(p).first()) if isinstance(p, DataFrame) else p).encode())
    return digest.hexdigest()[:16]


def code_version(*modules) -> str:
    """Digest of the modules' source, line ends apart."""
    return hashlib.sha1("".join(inspect.getsource(m).replace("\r\n", "\n") for m in modules).encode()).hexdigest()[:12]


def cached(spark: SparkSession, root: str, name: str, key: str, make: Callable[[], DataFrame], use: bool = True) -> DataFrame:
    """The Parquet table name_key under root, made if it isn't there."""
    path = f"{root}/{name}_{key}.parquet"
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not (use and where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def shared_root(spark: SparkSession) -> str:
    """The folder that the session's spark.checkpoint.dir names; a local one is set only where none is and the master is local."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="matchloom-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """The table, written once to the shared folder and read back: for results that a plan reads several times."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def expect_rows(df: DataFrame, n: int) -> DataFrame:
    if (found := df.count()) != n:
        raise ValueError(f"{found} rows where {n} were expected")
    return df


def save_json(value, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, indent=2, default=str))


def log_experiment(spark: SparkSession, metrics: dict, mode: str, stage: str, path: str) -> None:
    """Appends a run's figures as one JSON line."""
    row = json.dumps({"time": datetime.now(UTC).isoformat(), "mode": mode, "stage": stage, **metrics}, default=str)
    spark.createDataFrame([(row,)], "value string").write.mode("append").text(path)


def file_hash(path: str) -> str:
    """SHA-256 of a file, or `missing`."""
    try:
        with open(path, "rb") as f:
            return hashlib.file_digest(f, "sha256").hexdigest()
    except FileNotFoundError:
        return "missing"


def environment() -> dict[str, str]:
    import numpy
    import pandas
    import pyarrow
    import pyspark

    return {"python": platform.python_version(), "platform": platform.platform(), **{m.__name__: m.__version__ for m in (pyspark, pandas, numpy, pyarrow)}}


def disk_usage(path: str) -> dict[str, int]:
    return shutil.disk_usage(path)._asdict()


def copy_table(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """To any store that Spark writes (s3a:// and others); an existing table stays unless overwrite says otherwise."""
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def ids_valid(ids: Column) -> Column:
    return F.forall(ids, lambda x: x.rlike("^S[23]-") & ~x.rlike(FORBIDDEN))
