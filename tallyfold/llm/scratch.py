"""Written tables that cut lineage, kept in the shared checkpoint folder.

A written table survives lost executors: later jobs read files instead of
recomputing.  The folder is the session's ``spark.checkpoint.dir``; only a
local session without that setting gets a temporary one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """The written tables of one run of an operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        self.paths: dict[int, str] = {}

    def write(self, df: DataFrame, compression: str | None = None) -> DataFrame:
        self.count += 1
        path = f"{self.base}/{self.count}"
        df.write.parquet(path, compression=compression)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def free(self, df: DataFrame) -> None:
        """Deletes a written table that no later step reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df)))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
