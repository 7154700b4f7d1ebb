"""Facets, counts and roll-ups of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import fold


def facet(df: DataFrame, *, equal: dict[str, object] = {}, least: dict[str, float] = {}, words: tuple[list[str], str] | None = None, period: tuple[str, Column, Column] | None = None) -> DataFrame:  # noqa: B006
    """Rows that agree with all facets that are set.

    ``words`` are columns and a text that one of them holds, folded; ``period``
    is a day column with its bounds, which rows without a day pass.
    """
    for c, v in equal.items():
        if v not in (None, ""):
            df = df.filter(F.col(c) == v)
    for c, v in least.items():
        if v is not None:
            df = df.filter(F.col(c) >= v)
    if words and words[1]:
        df = df.filter(F.contains(fold(F.concat_ws(" ", *words[0])), fold(F.lit(words[1]))))
    if period:
        c, lo, hi = period
        df = df.filter(F.col(c).isNull() | F.col(c).between(lo, hi))
    return df


def zero_filled(dimension: DataFrame, key: str, counts: DataFrame, value: str = "n") -> DataFrame:
    return dimension.join(counts, key, "left").withColumn(value, F.coalesce(value, F.lit(0)))


def articles(n_sources: str) -> Column:
    return F.sum(F.greatest(F.lit(1), F.col(n_sources)))


def by_region(events: DataFrame, region: str, department: str, kind: str, n_sources: str, counted: list[str]) -> DataFrame:
    """Per region its articles, events of each kind, kinds and departments; the most articles first."""
    aggs = [F.count_if(F.col(kind) == k).alias(f"n_{k}") for k in counted]
    out = events.filter(F.col(region).isNotNull()).groupBy(region).agg(articles(n_sources).cast("long").alias("n_articles"), *aggs, F.array_join(F.sort_array(F.collect_set(kind)), ",").alias("kinds"), F.count_distinct(department).alias("n_departments"))
    return out.orderBy(F.desc("n_articles"), region)


def sort_regions(regions: DataFrame, mode: str, name: str = "region") -> DataFrame:
    keys = {"most": [F.desc("n_articles")], "fewest": [F.asc("n_articles")], "departments": [F.desc("n_departments")], "name": []}
    return regions.orderBy(*keys[mode], name)


def drill(events: DataFrame, levels: list[str], n_sources: str) -> DataFrame:
    """All levels of a hierarchy at once, with the level's depth."""
    return events.rollup(*levels).agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n_events"), articles(n_sources).cast("long").alias("n_articles")).withColumn("depth", (F.lit(len(levels)) - F.bit_count("gid")).cast("int")).drop("gid")


def kpi(events: DataFrame, *, confirmed: Column, project: Column, fusion: Column, rumour: Column, department: str) -> DataFrame:
    return events.agg(F.count_if(confirmed & ~fusion).alias("n_confirmed"), F.count_if(project).alias("n_projects"), F.count_if(fusion).alias("n_fusions"), F.count_if(rumour).alias("n_rumours"), F.count_distinct(department).alias("n_departments"))


def added_in_month(events: DataFrame, created: str, department: str, month: Column) -> DataFrame:
    """Events added in a month, and departments whose first event is of that month."""
    per = events.groupBy(department).agg(F.min(created).alias("_first"), F.count_if(F.trunc(created, "MM") == month).alias("_n"))
    return per.agg(F.sum("_n").alias("n_added"), F.count_if(F.trunc("_first", "MM") == month).alias("n_new_departments"))


def top(df: DataFrame, key: str, k: int) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), key).limit(k)


def months(df: DataFrame, day: str) -> DataFrame:
    return df.filter(F.col(day).isNotNull()).groupBy(F.date_format(day, "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))


def rolling_period(df: DataFrame, day: str, n_months: int) -> DataFrame:
    """Rows of the ``n_months`` months that end with the latest row's."""
    latest = df.agg(F.max(day).cast("date").alias("_m"))
    lo, hi = F.add_months(F.trunc("_m", "MM"), 1 - n_months), F.last_day("_m")
    return df.crossJoin(F.broadcast(latest)).filter(F.col(day).cast("date").between(lo, hi)).drop("_m")  # one row


def bounding_box(df: DataFrame, lon: str, lat: str) -> DataFrame:
    return df.agg(F.min(lon).alias("west"), F.min(lat).alias("south"), F.max(lon).alias("east"), F.max(lat).alias("north"))


def department_estimate(precise: DataFrame, unlocated: DataFrame, announced: DataFrame, signals: DataFrame) -> DataFrame:
    """Per department: precise, unlocated, announced and lone signals, and their sum.

    precise (department, lat, lon), unlocated (department, bank_key, place_key),
    announced (department, n), signals (department, bank_key, place_key, order
    seq): a signal counts once per bank and place, if no unlocated row has them.
    """
    count = F.count(F.lit(1))
    a = precise.groupBy("department").agg(F.count_if(F.col("lat").isNotNull() & F.col("lon").isNotNull()).alias("n_precise"))
    b = unlocated.groupBy("department").agg(count.alias("n_unlocated"))
    c = announced.groupBy("department").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n_announced"))
    lone = signals.join(unlocated.select("bank_key", "place_key").distinct(), ["bank_key", "place_key"], "left_anti").groupBy("bank_key", "place_key").agg(F.min_by("department", "seq").alias("department"))
    d = lone.groupBy("department").agg(count.alias("n_signals"))
    names = ["n_precise", "n_unlocated", "n_announced", "n_signals"]
    tiers = [x.select("department", *[(F.col(n) if n in x.columns else F.lit(0)).cast("long").alias(n) for n in names]) for x in (a, b, c, d)]
    out = tiers[0]
    for t in tiers[1:]:
        out = out.union(t)
    out = out.groupBy("department").agg(*[F.sum(n).alias(n) for n in names])
    return out.withColumn("estimate", sum((F.col(n) for n in names[1:]), F.col(names[0])))


TIERS = {"precise": "n_precise", "unlocated": "n_unlocated", "announced": "n_announced", "signal": "n_signals"}


def facet_estimates(evidence: DataFrame, facet: Column | None = None) -> DataFrame:
    """(department, is_total, n_precise, n_unlocated, n_announced, n_signals, estimate) of the evidence that a facet leaves; one row has the national total.

    ``evidence`` has a row for each fact: tier (one of TIERS), department,
    bank_key, place_key, n, seq, lat and lon, and what facets ask for.  The
    facet is one predicate over all tiers, so it reaches each tier's scan.  As
    in :func:`department_estimate` a precise row counts with coordinates, an
    announced one for its ``n``, and signals once per bank and place where no
    unlocated row has them; facets come first, so a row that a facet leaves
    out hides nothing.  A null department is one of its own.
    """
    rows = evidence if facet is None else evidence.filter(F.coalesce(facet, F.lit(False)))
    is_tier = lambda t: F.col("tier") == t
    named = rows.filter(F.col("tier").isin("unlocated", "signal")).groupBy("bank_key", "place_key")
    lone = named.agg(F.bool_or(is_tier("unlocated")).alias("_known"), F.min_by(F.struct("department"), F.when(is_tier("signal"), F.col("seq"))).alias("_s"))
    lone = lone.filter("not _known and _s is not null").select("_s.department", F.lit("signal").alias("tier"), F.lit(1).cast("long").alias("w"))
    weight = F.when(is_tier("announced"), F.coalesce("n", F.lit(0))).when(is_tier("precise"), (F.col("lat").isNotNull() & F.col("lon").isNotNull()).cast("int")).otherwise(1).cast("long")
    both = rows.filter(~is_tier("signal")).select("department", "tier", weight.alias("w")).unionByName(lone)
    counts = [F.coalesce(F.sum(F.when(is_tier(t), F.col("w"))), F.lit(0)).alias(n) for t, n in TIERS.items()]
    out = both.rollup("department").agg(F.grouping("department").cast("boolean").alias("is_total"), *counts)
    return out.select("department", "is_total", *TIERS.values(), sum((F.col(n) for n in list(TIERS.values())[1:]), F.col("n_precise")).alias("estimate"))


def nested_sources(sources: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, sources as a JSON list in order of the fields, n_sources)."""
    return sources.groupBy(key).agg(F.to_json(F.sort_array(F.collect_list(F.struct(*fields)))).alias("sources"), F.count(F.lit(1)).alias("n_sources"))


def latest(df: DataFrame, k: int, day: str, *ties: str) -> DataFrame:
    return df.filter(F.col(day).isNotNull()).orderBy(F.desc(day), *ties).limit(k)


def completeness(*known: Column) -> Column:
    """Number of the conditions that hold."""
    total = F.lit(0)
    for c in known:
        total = total + F.coalesce(c.cast("int"), F.lit(0))
    return total


def per_department(branches: DataFrame, department: str = "department") -> DataFrame:
    """(department, n_branches) of a reference list; branches without a department do not count."""
    return branches.filter(F.col(department).isNotNull()).groupBy(department).agg(F.count(F.lit(1)).alias("n_branches"))


def with_control(events: DataFrame, controls: DataFrame, key: str = "event_id") -> DataFrame:
    """Events with the control row that there is for them, if any, as one struct; of several the smallest."""
    one = controls.groupBy(key).agg(F.min(F.struct("status", "register_id", "source")).alias("control"))
    return events.join(one, key, "left")


def first_and_last(events: DataFrame, day: str, *by: str) -> DataFrame:
    return events.groupBy(*by).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
