"""Incremental forms of the batch jobs; each ends where its batch twin does on the same input."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def once_per_url(stream: DataFrame, time: str, delay: str, url: str = "url") -> DataFrame:
    """Each URL once among those within ``delay`` of each other; state is dropped after it."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([url])


class BatchLog:
    """An append-only table whose rows come in numbered batches; a batch that is written again replaces itself alone."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self, before: int | None = None) -> DataFrame | None:
        """The rows, with ``batch``, of all batches or of those before one."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return None
        rows = self.spark.read.parquet(self.path)
        return rows if before is None else rows.filter(F.col("batch") < before)

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.drop("batch").write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")


def first_seen(stream: DataFrame, url: str = "url") -> DataFrame:
    """Each URL once over the whole stream, and every row without one.

    The URLs that were seen are the query's state, kept by their hash's
    partition, so a batch costs what it brings and no history is read.
    :func:`once_per_url` forgets them after a delay.
    """
    blank = F.trim(F.coalesce(F.col(url), F.lit(""))) == ""
    return stream.filter(~blank).dropDuplicates([url]).unionByName(stream.filter(blank))


def log_to(log: BatchLog) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that logs each batch under its number."""
    return log.write


def merge_to(stream: DataFrame, merge: Callable[[DataFrame], DataFrame], events: BatchLog, checkpoint: str) -> StreamingQuery:
    """Logs, batch by batch, the events that new observations change, merged over all observations so far.

    ``merge`` is an aggregation by key that does not depend on the order of its
    rows and takes a repeated row once; its partial results are the query's
    state, so a batch costs what it brings.  :func:`latest` reads the events.
    """
    return run_once(merge(stream), log_to(events), checkpoint, "update")


def latest(events: BatchLog, key: list[str]) -> DataFrame:
    """Of each key the row of the last batch that has it."""
    rows = events.read()
    rest = [c for c in rows.columns if c not in (*key, "batch")]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select(*key, "_r.*")


def run_once(stream: DataFrame, function: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    query = stream.writeStream.outputMode(mode).foreachBatch(function).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def missing_streaks(presence: DataFrame, key: str, revision: str, present: str) -> DataFrame:
    """Streaming form of the missing counter: (key, revision, missing) for a row per point and revision, revisions in order.

    State per point is whether it was seen and the count.
    """
    out = f"{key} {dict(presence.dtypes)[key]}, {revision} {dict(presence.dtypes)[revision]}, missing long"

    def step(k: tuple, batches: Iterator, state) -> Iterator:
        import pandas

        seen, missing = state.get if state.exists else (False, 0)
        rows = pandas.concat(list(batches)).sort_values(revision)
        counts = []
        for there in rows[present]:
            missing = 0 if there else missing + int(seen)
            seen = seen or bool(there)
            counts.append(missing)
        state.update((seen, missing))
        yield pandas.DataFrame({key: [k[0]] * len(rows), revision: rows[revision].to_numpy(), "missing": counts})

    schema = T.StructType([T.StructField("seen", T.BooleanType()), T.StructField("missing", T.LongType())])
    return presence.groupBy(key).applyInPandasWithState(step, out, schema, "append", "NoTimeout")


def read_files(spark: SparkSession, path: str, schema: str, per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)
