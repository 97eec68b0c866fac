"""Writing tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions.text import shard_of


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines with nulls spelled out."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def write_parquet(df: DataFrame, path: str, compression: str = "zstd") -> None:
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write(df: DataFrame, path: str, fmt: str = "jsonl", compression: str = "zstd") -> None:
    """parquet, or JSON lines for any other format."""
    write_parquet(df, path, compression) if fmt == "parquet" else write_jsonl(df, path)


def write_text(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").text(path)


def scratch(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share. A machine's own folder is taken only in local mode."""
    sc = spark.sparkContext
    shared = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="loomline-")
    return f"{shared.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def shard_path(path: str, shard: int, shards: int) -> str:
    if shards <= 1:
        return path
    root, dot, ext = path.rpartition(".")
    return f"{root}.shard{shard:02d}.{ext}" if dot else f"{path}.shard{shard:02d}"


def write_sharded(df: DataFrame, path: str, shards: int, key: str = "source_id") -> None:
    """One folder a shard of the key, so that a later read of one shard prunes the rest."""
    df.withColumn("shard", F.expr(shard_of(key, shards))).write.mode("overwrite").partitionBy("shard").option("ignoreNullFields", "false").json(path)
