"""Keyed tables on plain files: upsert, insert and delete by key, with optimistic commits.

A table is divided into buckets by its key's hash.  A version is a small file
that names, for each bucket, the folder with its rows.  A write reads and
rewrites the buckets of the keys that it touches and no others, then creates
the next version's file, which only one writer can do.  A writer that comes
second looks at what the first has changed: if none of its own buckets is
among that, it commits on top; else it starts again from the new version, or
fails with :class:`Conflict` when its attempts are used up.  Readers see whole
versions only.

A deleted row stays as a tombstone, so that a batch which is delivered again
does not bring it back, until :meth:`KeyedTable.purge`.  A batch that has a
source and a number is applied once, whatever happens between.

Null keys are keys like others.  What goes through the driver is one name per
bucket; their number is the table's, not the data's.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.landing import written

GONE, BUCKET = "_gone", "_bucket"


class Conflict(RuntimeError):
    """Another writer has changed the same buckets."""


def file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Creates a small file with all its content in one step; false if there is one of that name.

    The content goes to a file of another name, which then gets the name if it
    is free: by a link on a local disk, elsewhere by a rename that does not overwrite.
    """
    jvm = spark._jvm
    fs, final = file_system(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(content.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            local = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(local(final), local(draft))
        else:
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(draft, final, options)
        return True
    except Exception:
        if fs.exists(final):
            return False
        raise
    finally:
        fs.delete(draft, False)


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    # ---- versions

    def versions(self) -> list[int]:
        fs, where = file_system(self.spark, f"{self.path}/versions")
        if not fs.exists(where):
            return []
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(where) if s.getPath().getName().isdigit())

    def state(self, version: int | None = None) -> dict:
        """What a version's file says; that of the latest without ``version``."""
        version = max(self.versions(), default=0) if version is None else version
        if not version:
            return {"version": 0, "key": self.key, "count": self.buckets, "schema": None, "buckets": {}, "applied": {}}
        fs, where = file_system(self.spark, f"{self.path}/versions/{version:012d}")
        stream = fs.open(where)
        try:
            found = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        if (found["key"], found["count"]) != (self.key, self.buckets):
            raise ValueError(f"{self.path} has the key {found['key']} in {found['count']} buckets")
        return found

    def version(self) -> int:
        return max(self.versions(), default=0)

    # ---- reading

    def rows(self, state: dict, buckets: list[str] | None = None) -> DataFrame | None:
        """The rows of some buckets, all without ``buckets``, tombstones included; null for a table without a version."""
        if state["schema"] is None:
            return None
        schema = T.StructType.fromJson(state["schema"])
        paths = [f"{self.path}/data/{folder}/{BUCKET}={b}" for b, folder in state["buckets"].items() if buckets is None or b in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame | None:
        found = self.rows(self.state(version))
        return None if found is None else found.filter(f"not {GONE}").drop(GONE)

    def deleted(self, version: int | None = None) -> DataFrame | None:
        """Keys of the tombstones."""
        found = self.rows(self.state(version))
        return None if found is None else found.filter(GONE).select(*self.key)

    def changes(self, since: int, until: int | None = None) -> DataFrame:
        """(key, change, ...) between two versions: inserted, updated or deleted; only buckets that were rewritten are read."""
        old, new = self.state(since), self.state(until)
        touched = [b for b, folder in new["buckets"].items() if old["buckets"].get(b) != folder]
        after = self.rows(new, touched)
        data = [c for c in after.columns if c not in (*self.key, GONE)]
        before = self.rows(old, touched) if old["schema"] else after.limit(0)
        live = lambda df, name: df.filter(f"not {GONE}").select(*self.key, F.struct(F.lit(1).alias("_there"), *[F.col(c) for c in data if c in df.columns]).alias(name))
        same = F.lit(True)
        a, b = live(before, "_old").alias("a"), live(after, "_new").alias("b")
        for k in self.key:
            same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        both = a.join(b, same, "full_outer")
        change = F.when(F.col("_old").isNull(), "inserted").when(F.col("_new").isNull(), "deleted").when(~F.to_json("_old").eqNullSafe(F.to_json("_new")), "updated")
        keys = [F.when(F.col("_new").isNotNull(), F.col(f"b.{k}")).otherwise(F.col(f"a.{k}")).alias(k) for k in self.key]
        return both.select(*keys, change.alias("change"), *[F.col(f"_new.{c}").alias(c) for c in data]).filter("change is not null")

    # ---- writing

    def upsert(self, rows: DataFrame, seq: str, keep_first: list[str] = [], **commit) -> int:  # noqa: B006
        """Of each key the row with the largest ``seq``, of those there and those that come; columns of ``keep_first`` stay as they came first.

        ``seq`` is a column of the table, so batches may come in any order.  A
        deleted key comes back if a row comes that is newer than its last.
        """

        def combine(old: DataFrame, new: DataFrame) -> DataFrame:
            rest = [c for c in new.columns if c not in self.key and c not in keep_first and c != GONE]
            both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
            # of rows with one seq the one that is there stays, and is not taken for a newer one
            aggs = [F.max_by(F.struct(*rest, GONE), F.struct(F.col(seq), (-F.col("_new")).alias("old"))).alias("_r"), *[F.min_by(c, F.struct(F.col("_new"), F.col(seq))).alias(c) for c in keep_first]]
            return both.groupBy(*self.key).agg(*aggs).select(*self.key, *keep_first, "_r.*")

        return self.commit(rows, combine, **commit)

    def insert(self, rows: DataFrame, seq: str, **commit) -> int:
        """Adds the rows of keys that the table lacks, of several the one with the smallest ``seq``; deleted keys stay deleted."""

        def combine(old: DataFrame, new: DataFrame) -> DataFrame:
            rest = [c for c in new.columns if c not in self.key]
            both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
            return both.groupBy(*self.key).agg(F.min_by(F.struct(*rest), F.struct(F.col("_new"), F.col(seq))).alias("_r")).select(*self.key, "_r.*")

        return self.commit(rows, combine, **commit)

    def delete(self, keys: DataFrame, **commit) -> int:
        """Puts tombstones in place of the rows with these keys; keys that the table lacks change nothing."""

        def combine(old: DataFrame, new: DataFrame) -> DataFrame:
            wanted = new.select(*[F.col(k).alias(f"_k_{k}") for k in self.key]).distinct()
            same = F.lit(True)
            for k in self.key:
                same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
            hit = F.col("_hit").isNotNull()
            met = old.join(wanted.withColumn("_hit", F.lit(1)).hint("merge"), same, "left")
            return met.withColumn(GONE, F.col(GONE) | hit).drop("_hit", *wanted.columns)

        return self.commit(keys.select(*self.key), combine, partial=True, **commit)

    def purge(self, **commit) -> int:
        """Removes all tombstones."""
        found = self.deleted()
        return self.version() if found is None else self.commit(found, lambda old, new: old.filter(f"not {GONE}"), partial=True, **commit)

    def commit(self, rows: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], *, partial: bool = False, source: str | None = None, batch: int = 0, attempts: int = 3) -> int:
        """The version after ``combine`` (rows of the touched buckets, rows that come) has taken their place; ``partial`` rows have keys only."""
        base = self.state()
        if base["schema"] is not None:
            kinds = {f.name: f.dataType for f in T.StructType.fromJson(base["schema"])}
            rows = rows.select(*[F.col(c).cast(kinds[c]) if c in kinds else F.col(c) for c in rows.columns])
        # written once: all attempts see the same rows, and hashes are of the table's own types
        coming = written(rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")), "keyed-rows")
        touched = [str(r[0]) for r in coming.select(BUCKET).distinct().collect()]
        coming = coming.drop(BUCKET)
        for _ in range(attempts):
            if source is not None and base["applied"].get(source, -1) >= batch:
                return base["version"]
            if base["schema"] is None and partial or not touched:
                return base["version"]
            new = coming if partial else coming.withColumn(GONE, F.lit(False))
            old = self.rows(base, touched)
            schema = new.schema if old is None else old.schema
            if not partial and set(new.columns) != set(schema.names):
                raise ValueError(f"the table has the columns {schema.names}, the rows {new.columns}")
            old = self.spark.createDataFrame([], schema) if old is None else old
            folder = self.write_buckets(combine(old, new).select(*schema.names))
            there = self.folders(folder)
            while True:
                mine = {b: folder for b in touched if b in there}
                kept = {b: f for b, f in base["buckets"].items() if b not in touched}
                applied = base["applied"] | ({source: batch} if source is not None else {})
                state = {"version": base["version"] + 1, "key": self.key, "count": self.buckets, "schema": json.loads(schema.json()), "buckets": kept | mine, "applied": applied}
                file_system(self.spark, self.path)[0].mkdirs(file_system(self.spark, f"{self.path}/versions")[1])
                if create_once(self.spark, f"{self.path}/versions/{state['version']:012d}", json.dumps(state)):
                    return state["version"]
                latest = self.state()
                if source is not None and latest["applied"].get(source, -1) >= batch:
                    return latest["version"]
                clash = any(latest["buckets"].get(b) != base["buckets"].get(b) for b in touched)
                base = latest
                if clash:
                    break
        raise Conflict(f"{self.path} has been changed by others {attempts} times in buckets that this write touches")

    def write_buckets(self, rows: DataFrame) -> str:
        folder = uuid.uuid4().hex
        out = rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))
        out.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{folder}")
        return folder

    def folders(self, folder: str) -> set[str]:
        """Buckets that a written folder has rows of."""
        fs, where = file_system(self.spark, f"{self.path}/data/{folder}")
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return {n.partition("=")[2] for n in names if n.startswith(f"{BUCKET}=")}

    def vacuum(self, keep: int = 2, older_than_s: float = 3600) -> int:
        """Deletes all versions but the last ``keep``, and folders that none of these names; newer folders may belong to a writer and stay."""
        import time

        known = self.versions()
        live = {f for v in known[-keep:] for f in self.state(v)["buckets"].values()}
        fs, where = file_system(self.spark, f"{self.path}/data")
        gone = 0
        for v in known[:-keep]:
            fs.delete(file_system(self.spark, f"{self.path}/versions/{v:012d}")[1], False)
        for s in fs.listStatus(where) if fs.exists(where) else []:
            if s.getPath().getName() not in live and s.getModificationTime() / 1000 <= time.time() - older_than_s:
                gone += int(fs.delete(s.getPath(), True))
        return gone
