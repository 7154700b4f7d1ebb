"""Review queues and their reconciliation with published events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import loose_key, text
from ..functions.lexicon import DEPARTMENTS
from ..functions.names import canonical_name
from ..functions.terms import folded


def plain_key(name: str) -> str:
    """:func:`loose_key` of a fixed name."""
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in folded(name)).split())


LOCATIONS = ("place", "original_place", "branch")


def department_key(c: Column | str, departments: dict[str, str] = DEPARTMENTS) -> Column:
    """Code of a department given by code or name, its loose key if neither is known, null if it is blank."""
    given = F.trim(F.coalesce(text(c), F.lit("")))
    names = F.create_map(*[F.lit(x) for code, name in departments.items() for x in (plain_key(name), code)]) if departments else F.create_map(F.lit(""), F.lit(""))
    return F.when(F.upper(given).isin(list(departments)), F.upper(given)).otherwise(F.coalesce(F.try_element_at(names, loose_key(given)), F.nullif(loose_key(given), F.lit(""))))


def keyed(rows: DataFrame, aliases: DataFrame | None, departments: dict[str, str]) -> DataFrame:
    """``rows`` with _bank, by the vocabulary of brands if given, and _department."""
    named = rows.withColumn("_name", F.col("bank")) if aliases is None else canonical_name(rows, "bank", aliases, "_name")
    return named.withColumn("_bank", loose_key(F.coalesce("_name", F.lit("")))).withColumn("_department", department_key("department", departments)).drop("_name")


def located(events: DataFrame, aliases: DataFrame | None, departments: dict[str, str]) -> DataFrame:
    """(event_id, _bank, _e, _kind, _place, reliability, created_at) for each distinct location of each event that is on the map."""
    places = F.array_distinct(F.filter(F.array(*[loose_key(F.coalesce(F.col(c), F.lit(""))) for c in LOCATIONS]), lambda x: x != ""))
    there = keyed(events.filter("lat is not null and lon is not null and code is not null"), aliases, departments)
    return there.select("event_id", "_bank", F.col("_department").alias("_e"), F.coalesce("kind", F.lit("closure")).alias("_kind"), F.explode(places).alias("_place"), "reliability", "created_at")


def best_event(met: DataFrame) -> DataFrame:
    """(id, event_id): the most reliable event, the oldest of equals, then the smallest id."""
    best = met.groupBy("id").agg(F.min(F.struct((-F.col("reliability")).alias("r"), "created_at", "event_id")).alias("_b"))
    return best.select("id", F.col("_b.event_id").alias("event_id"))


def resolved_quarantine(quarantine: DataFrame, events: DataFrame, aliases: DataFrame | None = None, departments: dict[str, str] = DEPARTMENTS) -> DataFrame:
    """(id, event_id) of unresolved rows that an event settles.

    Brand, type and one of the event's locations (place, original place,
    branch) agree, and so do the departments where both are known, each given
    by code or name.  ``aliases`` (alias, canonical) is the vocabulary of brands.
    Events are folded to the best of each name, and of each name and department,
    before rows meet them, so that namesakes are no pairs.
    """
    rows = keyed(quarantine.filter("resolved is null"), aliases, departments).select("id", "_bank", F.coalesce("kind", F.lit("closure")).alias("_kind"), loose_key(F.coalesce("place", F.lit(""))).alias("_place"), F.col("_department").alias("_d"))
    best = F.min(F.struct((-F.col("reliability")).alias("r"), "created_at", "event_id"))
    there = events.filter("lat is not null and lon is not null and code is not null")
    spelled = there.groupBy("bank", "kind", "department", *LOCATIONS).agg(best.alias("_b")).select("*", "_b.*", *[F.lit(1).alias(c) for c in ("lat", "lon", "code")])  # spellings become keys once
    name = ["_bank", "_kind", "_place"]
    at = located(spelled.withColumn("reliability", -F.col("r")), aliases, departments).groupBy(*name, "_e").agg(best.alias("_b"))
    any_ = at.groupBy(*name).agg(F.min("_b").alias("_all"), F.min(F.when(F.col("_e").isNull(), F.col("_b"))).alias("_open"))
    met = rows.join(any_.hint("merge"), name).join(at.filter("_e is not null").select(*name, F.col("_e").alias("_d"), "_b").hint("merge"), [*name, "_d"], "left")
    found = met.withColumn("_b", F.when(F.col("_d").isNull(), F.col("_all")).otherwise(F.least("_open", "_b"))).filter("_b is not null")
    return found.groupBy("id").agg(F.min("_b").alias("_b")).select("id", F.col("_b.event_id").alias("event_id"))


def source_url(c: Column | str) -> Column:
    return F.rtrim(F.trim(F.coalesce(text(c), F.lit(""))), F.lit("/"))


def resolved_signals(signals: DataFrame, events: DataFrame, sources: DataFrame, aliases: DataFrame | None = None, departments: dict[str, str] = DEPARTMENTS) -> DataFrame:
    """(id, event_id) of unresolved review records (id, bank, department, title, excerpt, reason, url) that an event on the map settles.

    The record's URL is one of the event's ``sources`` (event_id, url), brands
    agree, departments do where both are known, and the record's text names a
    location of the event as a run of whole words.  Runs meet by equality: a
    location by its first two words, or its only one, with brand and URL; the
    rest of a longer location is then compared in place.
    """
    words = F.split(loose_key(F.concat_ws(" ", "title", "excerpt", "reason")), " ")
    rows = keyed(signals.filter("resolved is null"), aliases, departments).select("id", "_bank", F.col("_department").alias("_d"), source_url("url").alias("_url"), words.alias("_words")).filter("_url <> ''")
    n = F.size("_words")
    pairs = F.when(n > 1, F.zip_with(F.slice("_words", F.lit(1), n - 1), F.slice("_words", F.lit(2), n - 1), lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))
    text_of = F.concat(F.lit(" "), F.array_join("_words", " "), F.lit(" ")).alias("_text")
    runs = rows.select("id", "_bank", "_d", "_url", text_of, F.explode(F.array_distinct(F.concat("_words", pairs))).alias("_head"))
    by_url = sources.select("event_id", source_url("url").alias("_url")).filter("_url <> ''").distinct()
    found = located(events, aliases, departments).join(by_url.hint("merge"), "event_id")
    found = found.select("event_id", "_bank", "_e", "_url", F.concat(F.lit(" "), "_place", F.lit(" ")).alias("_run"), F.substring_index("_place", " ", 2).alias("_head"), "reliability", "created_at")
    met = runs.join(found.hint("merge"), ["_bank", "_url", "_head"]).filter("(_d is null or _e is null or _d = _e) and contains(_text, _run)")
    return best_event(met)


def due_for_review(records: DataFrame, reviews: DataFrame, today: Column, cooldown_days: int) -> DataFrame:
    """Records never reviewed, or not for ``cooldown_days``."""
    last = reviews.groupBy("id").agg(F.max("reviewed_at").alias("_last"))
    joined = records.join(last, "id", "left")
    return joined.filter(F.col("_last").isNull() | (F.datediff(today, F.col("_last")) >= cooldown_days)).drop("_last")


def priority(score: Column, *, local: Column, legal: Column, closure: Column, plan: Column, place: Column) -> Column:
    bonus = lambda c, n: F.when(c, F.lit(n)).otherwise(F.lit(0))
    return 10 * score + bonus(local, 50) + bonus(legal, -40) + bonus(closure, 45) + bonus(plan, 30) + bonus(place, 20)


def review_queue(records: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` records; ``order`` must leave no ties."""
    return records.orderBy(*order).limit(k)


def requeue(seen: DataFrame, *urls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(URLs to take again, what then is seen): those of any list that are seen."""
    wanted = urls[0].select("url")
    for u in urls[1:]:
        wanted = wanted.union(u.select("url"))
    again = wanted.distinct().join(seen.select("url").distinct(), "url")
    return again, seen.join(again, "url", "left_anti")


def retry_state(requests: DataFrame, cache: DataFrame, key: list[str], now: Column, most: int = 3) -> DataFrame:
    """``requests`` with ``state``: hit, none (a cached absence), blocked (errors exhausted or too recent) or process."""
    known = cache.select(*key, F.col("status").alias("_status"), F.col("attempts").alias("_attempts"), F.col("retry_after").alias("_after"))
    joined = requests.join(known, key, "left")
    blocked = (F.col("_attempts") >= most) | F.coalesce(now < F.col("_after"), F.lit(False))
    state = F.when(F.col("_status") == "closure", "hit").when(F.col("_status") == "none", "none").when((F.col("_status") == "error") & blocked, "blocked").otherwise("process")
    return joined.withColumn("state", state).drop("_status", "_attempts", "_after")


def retry_after(now: Column, attempts: Column, base_minutes: int = 60) -> Column:
    """When to try again after ``attempts`` failures: base, doubled with each."""
    return F.timestamp_seconds(F.unix_seconds(now.cast("timestamp")) + 60 * base_minutes * F.pow(F.lit(2.0), attempts - 1).cast("long"))


def within_budget(calls: DataFrame, key: str, seq: list[str], cost: str, budget: float) -> DataFrame:
    """``calls`` with the running cost of their key and whether it is within the budget."""
    w = Window.partitionBy(key).orderBy(*seq).rowsBetween(Window.unboundedPreceding, 0)
    return calls.withColumn("running_cost", F.sum(cost).over(w)).withColumn("admitted", F.col("running_cost") <= budget)


# What the postal backlog's texts hold.
POSTAL_TERMS = ["bureau de poste", "banque postale"]


def postal_backlog(signals: DataFrame, brand: str) -> DataFrame:
    """Unresolved review records (resolved, bank, title, text, ...) of the postal brand or whose text speaks of it, as articles."""
    said = F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("text", F.lit(""))))
    hit = F.col("bank") == brand
    for t in POSTAL_TERMS:
        hit = hit | said.contains(t)
    return signals.filter(F.col("resolved").isNull() & F.coalesce(hit, F.lit(False))).withColumns({"title": F.coalesce("title", F.lit("")), "text": F.coalesce("text", F.lit(""))})


def run_summary(before: DataFrame, after: DataFrame, in_window: Column, *by: str) -> DataFrame:
    """Per brand (or other columns): events that the run added, events in the window, and all."""
    old = before.select("event_id").distinct().withColumn("_old", F.lit(True))
    return after.join(old, "event_id", "left").groupBy(*by).agg(F.count_if(F.col("_old").isNull()).alias("new_this_run"), F.count_if(in_window).alias("total_in_window"), F.count(F.lit(1)).alias("total_all"))
