"""Landed files: rows written in the shape of a feed, to a folder that all executors share, and read back by a source."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session without that setting gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def land(df: DataFrame, kind: str, name: str, **options: object) -> str:
    """Writes ``df`` as ``kind`` (json, csv, xml, text) to a new folder and returns its path."""
    path = fresh(df.sparkSession, name)
    df.write.options(**options).format(kind).save(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table, for steps that read it more than once."""
    return df.sparkSession.read.schema(df.schema).parquet(land(df, "parquet", name))
