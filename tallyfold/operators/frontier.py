"""Searches that go on from what they find, pass by pass."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.landing import fresh


def passes(seeds: DataFrame, expand: Callable[[DataFrame], DataFrame], key: list[str], most_rounds: int | None = None, budget: int | None = None) -> DataFrame:
    """``seeds`` and all that is found from them, with ``round``: 0 for the seeds, then the pass that found a row first.

    ``expand`` takes the rows of one pass and returns rows of the same columns.
    Of these the ones with keys that no pass has had are the next pass; each
    pass is written before the next begins, so that a pass is worked out once
    and survives lost executors.  The search ends when a pass finds nothing
    new, after ``most_rounds`` passes, or before the pass that follows
    ``budget`` rows.  Of rows with one key in a pass the least is kept; null
    keys are keys like others.
    """
    spark = seeds.sparkSession
    path = fresh(spark, "passes")
    rest = [c for c in seeds.columns if c not in key]

    def once(rows: DataFrame) -> DataFrame:
        if not rest:
            return rows.select(*key).distinct()
        return rows.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_r")).select(*key, "_r.*")

    def add(rows: DataFrame, number: int) -> DataFrame:
        rows.write.parquet(f"{path}/round={number}")
        return spark.read.schema(seeds.schema).parquet(f"{path}/round={number}")

    last = add(once(seeds).select(*seeds.columns), 0)
    total, number = last.count(), 0
    while (most_rounds is None or number < most_rounds) and (budget is None or total < budget):
        number += 1
        seen = spark.read.schema(seeds.schema).parquet(*[f"{path}/round={i}" for i in range(number)]).select(*[F.col(k).alias(f"_s_{k}") for k in key])
        same = F.lit(True)
        for k in key:
            same = same & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
        new = once(expand(last).select(*seeds.columns)).join(seen.hint("merge"), same, "left_anti")
        last = add(new.select(*seeds.columns), number)
        found = last.count()
        total += found
        if not found:
            break
    parts = [spark.read.schema(seeds.schema).parquet(f"{path}/round={i}").withColumn("round", F.lit(i)) for i in range(number + 1)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
