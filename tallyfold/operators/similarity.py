"""Near-duplicate names: containment, or a sequence ratio of at least RATIO."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATIO = 0.84
SHORTEST = 5


def bigrams(names: DataFrame, key: str) -> DataFrame:
    """(key, size, gram) of each distinct name; the n-th occurrence of a bigram is an element of its own."""
    n = F.length(key)
    grams = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substr(F.col(key), i, F.lit(2)))
    numbered = F.transform(grams, lambda g, i: F.concat(g, F.lit("#"), F.size(F.filter(F.slice(grams, F.lit(1), i + 1), lambda x: x == g)).cast("string")))
    return names.select(key, n.alias("size")).select(key, "size", F.explode(numbered).alias("gram"))


def candidates(names: DataFrame, key: str, ratio: float = RATIO) -> DataFrame:
    """(a, b) of distinct names, a < b, that may be near: none that are is left out.

    Two names of ratio r share at least (r - 1/2 - (1 - r)/2) (|a| + |b|) - 1
    bigrams, so with the rarest bigrams first each name needs only a prefix of
    them as index entries.
    """
    grams = bigrams(names, key)
    df = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    listed = grams.join(df.hint("merge"), "gram").groupBy(key, "size").agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("g"))
    share = ratio / 2 - (1 - ratio)  # of |a| + |b|, in common bigrams
    least_other = ratio / (2 - ratio)  # shorter to longer at least
    needed = F.greatest(F.lit(1), F.ceil(F.lit(share * (1 + least_other)) * F.col("size") - 1).cast("int"))
    prefix = listed.select(key, "size", F.explode(F.slice("g", F.lit(1), F.greatest(F.lit(1), F.size("g") - needed + 1))).alias("x")).select(key, "size", "x.gram")
    right = prefix.select(F.col(key).alias("b"), F.col("size").alias("sb"), "gram")
    near = prefix.select(F.col(key).alias("a"), F.col("size").alias("sa"), "gram").join(right.hint("merge"), "gram").filter(f"a < b and least(sa, sb) >= {least_other} * greatest(sa, sb) - 1e-9").select("a", "b")
    rarest = listed.select(F.col(key).alias("short"), F.col("size").alias("ss"), F.get("g", 0)["gram"].alias("gram"))
    inside = rarest.join(grams.select(F.col(key).alias("long"), F.col("size").alias("sl"), "gram").hint("merge"), "gram").filter("sl > ss and contains(long, short)").select(F.least("short", "long").alias("a"), F.greatest("short", "long").alias("b"))
    return near.union(inside).distinct()


def sequence_ratio(a: str, b: str) -> Column:
    """Ratio of the matching parts of two columns, by Arrow batches.  The function is local, so that workers need no import of this package."""

    def ratio(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        from difflib import SequenceMatcher

        import pandas

        for x, y in pairs:
            yield pandas.Series([SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y, strict=True)], dtype="float64")

    return F.pandas_udf(ratio, T.DoubleType())(a, b)


def near_names(rows: DataFrame, key: str, ratio: float = RATIO) -> DataFrame:
    """(a, b, score) of distinct names of at least SHORTEST characters that contain each other or reach ``ratio``.

    The ratio is taken with the smaller name first, as it depends on the order.
    """
    names = rows.select(key).filter(F.length(key) >= SHORTEST).distinct()
    scored = candidates(names, key, ratio).withColumn("score", F.when(F.contains("a", "b") | F.contains("b", "a"), F.lit(1.0)).otherwise(sequence_ratio("a", "b")))
    return scored.filter(F.col("score") >= ratio)


assert math.isclose(RATIO / 2 - (1 - RATIO), 0.26)
