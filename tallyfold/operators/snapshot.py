"""Networks of points by revision: differences, disappearances, replacements, service cut-offs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def diff(before: DataFrame, after: DataFrame, key: str, state: list[str]) -> DataFrame:
    """(key, change): inserted, missing, changed or same."""
    pack = lambda df, name: df.select(key, F.struct(*state).alias(name))
    both = pack(before, "_b").join(pack(after, "_a"), key, "full_outer")
    change = F.when(F.col("_b").isNull(), "inserted").when(F.col("_a").isNull(), "missing").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed").otherwise("same")
    return both.select(key, change.alias("change"))


def new_keys(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    return after.select(key).distinct().join(before.select(key), key, "left_anti")


def missing_streak(presence: DataFrame, key: str, revision: str, present: str) -> DataFrame:
    """``presence`` with the number of revisions in a row, this one included, that a point seen before is missing."""
    by = Window.partitionBy(key).orderBy(revision)
    island = presence.withColumn("_island", F.sum(F.col(present).cast("int")).over(by))
    within = Window.partitionBy(key, "_island").orderBy(revision)
    return island.withColumn("missing", F.sum(F.when(F.col("_island") > 0, 1 - F.col(present).cast("int")).otherwise(F.lit(0))).over(within)).drop("_island")


def confirmed_missing(streaks: DataFrame, after: int = 2) -> DataFrame:
    return streaks.filter(F.col("missing") >= after)


def history(states: DataFrame, key: str, revision: str, state: list[str]) -> DataFrame:
    """Rows whose state differs from the point's revision before, and its first."""
    w = Window.partitionBy(key).orderBy(revision)
    packed = states.withColumn("_s", F.struct(*state))
    return packed.withColumn("_p", F.lag("_s").over(w)).filter(F.col("_p").isNull() | ~F.col("_s").eqNullSafe(F.col("_p"))).drop("_s", "_p")


def replacement(missing: DataFrame, candidates: DataFrame, key: str, on: list[str]) -> DataFrame:
    """(key, replaced_by): candidates that agree in any of ``on``, where exactly one does."""
    # what agrees is folded to its least and greatest key, so that no pair of points is a row
    met = None
    for c in on:
        few = candidates.filter(F.col(c).isNotNull()).groupBy(c).agg(F.min(key).alias("_low"), F.max(key).alias("_high"), F.bool_or(F.col(key).isNull()).alias("_gap"))
        part = missing.select(key, c).join(few.hint("merge"), c).select(key, "_low", "_high", "_gap")
        met = part if met is None else met.union(part)
    found = met.groupBy(key).agg(F.min("_low").alias("replaced_by"), F.max("_high").alias("_high"), F.bool_or("_gap").alias("_gap"))
    return found.filter(F.col("replaced_by").eqNullSafe(F.col("_high")) & (F.col("replaced_by").isNull() | ~F.col("_gap"))).select(key, "replaced_by")


def unique_point(events: DataFrame, points: DataFrame, code: str, point: str, full: str, dated: Column) -> DataFrame:
    """Events with the point of their municipality: its one full office, or its one partner if the event is dated."""
    per = points.groupBy(code).agg(
        F.count_if(full).alias("_f"), F.min(F.when(F.col(full), F.col(point))).alias("_full"), F.count_if(~F.col(full)).alias("_p"), F.min(F.when(~F.col(full), F.col(point))).alias("_partner")
    )
    joined = events.join(per, code, "left")
    return joined.withColumn(point, F.when(F.col("_f") == 1, F.col("_full")).when((F.col("_p") == 1) & dated, F.col("_partner"))).drop("_f", "_full", "_p", "_partner")


def reuse_id(observed: DataFrame, events: DataFrame, code: str, new_id: Column) -> DataFrame:
    """``observed`` with the id of the only event of their municipality, or else ``new_id``."""
    per = events.groupBy(code).agg(F.count(F.lit(1)).alias("_n"), F.min("event_id").alias("_id"))
    return observed.join(per, code, "left").withColumn("event_id", F.when(F.col("_n") == 1, F.col("_id")).otherwise(new_id)).drop("_n", "_id")


def service_cutoff(days: DataFrame, point: str, day: str, is_open: str, least_closed: int = 10) -> DataFrame:
    """(point, cutoff): first closed weekday after the last open day, if ``least_closed`` follow; none for points never open."""
    w = Window.partitionBy(point)
    last = F.max(F.when(F.col(is_open), F.col(day))).over(w)
    after = days.withColumn("_last", last).filter((F.col(day) > F.col("_last")) & (F.weekday(day) < 5) & ~F.col(is_open))
    return after.groupBy(point).agg(F.count(F.lit(1)).alias("_n"), F.min(day).alias("cutoff")).filter(F.col("_n") >= least_closed).select(point, "cutoff")
