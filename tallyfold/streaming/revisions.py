"""Presence of points by day, as a stream: what is new, missing, confirmed missing and back, with state per point and timers.

A day is judged when the watermark has passed its end, so rows may come out of
order until then, and a point that no row speaks of any more is judged by its
timer.  A point that is missing on two days in a row is confirmed missing.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from .incremental import BatchLog

DAY_MS = 86_400_000
CONFIRMED_AFTER = 2
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Presence(StatefulProcessor):
    """State of a point: the last day that is judged, days in a row that it is missing, whether it has been judged at all, and days seen that are not judged yet."""

    def __init__(self, day: str = "day_number"):
        self.day = day

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.point = handle.getValueState("point", "judged long, missing long, known boolean, waiting array<long>")

    def handleInputRows(self, key: tuple, rows: Iterator, timerValues) -> Iterator:
        days = {int(d) for part in rows for d in part[self.day]}
        judged, missing, known, waiting = self.point.get() if self.point.exists() else (min(days) - 1, 0, False, [])
        if not known:
            judged = min(judged, min(days) - 1)
        return self.judge(key, judged, missing, known, days | set(waiting or []), timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator:
        if not self.point.exists():
            return iter(())
        judged, missing, known, waiting = self.point.get()
        return self.judge(key, judged, missing, known, set(waiting or []), timerValues.getCurrentWatermarkInMs())

    def judge(self, key: tuple, judged: int, missing: int, known: bool, waiting: set[int], watermark: int) -> Iterator:
        """Judges the days that have ended and sets the timer for the end of the next."""
        import pandas

        out = []
        while (judged + 2) * DAY_MS <= watermark:
            judged += 1
            if judged in waiting:
                change = "new" if not known else "returned" if missing else "seen"
                missing = 0
            else:
                missing += 1
                change = "missing" if missing < CONFIRMED_AFTER else "confirmed" if missing == CONFIRMED_AFTER else "gone"
            known = True
            out.append((key[0], judged, missing, change))
        self.point.update((judged, missing, known, sorted(d for d in waiting if d > judged)))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer((judged + 2) * DAY_MS)
        if out:
            yield pandas.DataFrame(out, columns=["key", "day", "missing", "change"])


def presence(stream: DataFrame, key: str, time: str, delay: str = "0 seconds") -> DataFrame:
    """(key, day, missing, change) of each day from a point's first on, once the day has ended by the watermark."""
    kind = dict(stream.dtypes)[key]
    rows = stream.select(key, time, F.unix_date(F.to_date(time)).cast("long").alias("day_number")).withWatermark(time, delay)
    out = rows.groupBy(key).transformWithStateInPandas(Presence(), f"key {kind}, day long, missing long, change string", "append", "eventTime")
    return out.select(F.col("key").alias(key), F.date_from_unix_date(F.col("day").cast("int")).alias("day"), "missing", "change")


def run(stream: DataFrame, key: str, time: str, log: BatchLog, checkpoint: str, delay: str = "0 seconds") -> StreamingQuery:
    """Logs what is judged by all that has come; started again with the same checkpoint it goes on where it stopped."""
    spark = stream.sparkSession
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)  # the one that has timers
    try:
        query = presence(stream, key, time, delay).writeStream.outputMode("append").foreachBatch(log.write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    query.awaitTermination()
    return query
