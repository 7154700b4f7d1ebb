"""Keyed merges whose result does not depend on the order of arrival in the cluster.

Order-sensitive picks go by ``seq``, a column or struct that orders the rows of
a key totally; where ties are possible pass a struct of all columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .keyed import Conflict, create_once, file_system


def first_value(c: str, seq: str) -> Column:
    """First non-null value in order of ``seq``."""
    return F.min_by(c, F.when(F.col(c).isNotNull(), F.col(seq)))


def last_value(c: str, seq: str) -> Column:
    return F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq)))


def evidence(observations: DataFrame, key: list[str], seq: str, *, identity: list[str], attributes: list[str], reliability: str, status: str, temporal: str, day: str, approximate: str, confirmed: str = "confirmed") -> DataFrame:
    """One event per key from its observations.

    Reliability is the highest, attributes and the day are the first known ones,
    the confirmed status absorbs all others, the temporal status is the last
    known one, and whether the day is approximate follows the first known day.
    """
    aggs = [F.min_by(c, seq).alias(c) for c in identity]
    aggs += [first_value(c, seq).alias(c) for c in [*attributes, day]]
    single = F.count(F.lit(1)) == 1
    aggs.append(F.when(single, F.max(reliability)).otherwise(F.max(F.coalesce(F.col(reliability), F.lit(0)))).alias(reliability))
    aggs.append(F.when(F.bool_or(F.col(status) == confirmed), F.lit(confirmed)).otherwise(F.min_by(status, seq)).alias(status))
    aggs.append(last_value(temporal, seq).alias(temporal))
    dated = F.min_by(approximate, F.when(F.col(day).isNotNull(), F.col(seq)))
    aggs.append(F.when(single, F.max(approximate)).when(F.count(day) > 0, F.coalesce(dated, F.lit(False))).otherwise(F.max(F.coalesce(F.col(approximate), F.lit(False)))).alias(approximate))
    return observations.groupBy(*key).agg(*aggs)


def source_set(sources: DataFrame, key: str, url: str, seq: str) -> DataFrame:
    """First row of each source of each event."""
    rest = [c for c in sources.columns if c not in (key, url)]
    picked = sources.groupBy(key, url).agg(F.min_by(F.struct(*rest), seq).alias("_r"))
    return picked.select(key, url, *[F.col("_r")[c].alias(c) for c in rest])


def last_write_wins(rows: DataFrame, key: list[str], seq: str, keep_first: list[str] = []) -> DataFrame:  # noqa: B006
    """Last row of each key; columns of ``keep_first`` are the first row's."""
    rest = [c for c in rows.columns if c not in key and c not in keep_first]
    aggs = [F.max_by(F.struct(*rest), seq).alias("_r"), *[F.min_by(c, seq).alias(c) for c in keep_first]]
    return rows.groupBy(*key).agg(*aggs).select(*key, *keep_first, *[F.col("_r")[c].alias(c) for c in rest])


def signal_merge(rows: DataFrame, key: list[str], seq: str, *, last_known: list[str], last: list[str], highest: list[str]) -> DataFrame:
    """Review records: last known, last and highest values per key."""
    aggs = [last_value(c, seq).alias(c) for c in last_known] + [F.max_by(c, seq).alias(c) for c in last] + [F.max(c).alias(c) for c in highest]
    return rows.groupBy(*key).agg(*aggs)


def best_per_key(rows: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """First row of each key in ``order``, which must leave no ties."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


class VersionedTable:
    """A table as folders with a pointer, for writers that replace all of it.

    A new version is written beside the one that is read, under a name of its
    own; then the pointer of that version is created, which only one writer
    can do.  The other gets an error, so nothing is lost in silence, and
    readers never see half a version.  :class:`tallyfold.operators.keyed.KeyedTable`
    has writes by key.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        fs, where = file_system(self.spark, f"{self.path}/current")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(where) if s.getPath().getName().isdigit()) if fs.exists(where) else []

    def version(self) -> int:
        return max(self.versions(), default=0)

    def read(self) -> DataFrame | None:
        v = max(self.versions(), default=0)
        if not v:
            return None
        folder = self.spark.read.text(f"{self.path}/current/{v:012d}").first()[0]
        return self.spark.read.parquet(f"{self.path}/{folder}")

    def write(self, df: DataFrame, partition_by: list[str] = []) -> int:  # noqa: B006
        v = self.version() + 1
        folder = f"v{v}-{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(f"{self.path}/{folder}")
        fs, where = file_system(self.spark, f"{self.path}/current")
        fs.mkdirs(where)
        if not create_once(self.spark, f"{self.path}/current/{v:012d}", folder):
            raise Conflict(f"another writer made version {v} of {self.path} first")
        return v


def replace_slice(df: DataFrame, path: str, column: str) -> None:
    """Replaces the slices of a partitioned table that ``df`` has rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
