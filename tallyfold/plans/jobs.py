"""Jobs: what a user calls, as compositions of the operators.  All are lazy but for tables that several results read, which are written; nothing is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import web
from ..functions.keys import article_id, canonical, event_id, fold, loose_key
from ..functions.lexicon import DEPARTMENTS, Lexicon
from ..functions.names import department_code
from ..operators import coverage, frontier, guard, merge, reconcile, resolve, rollup, select, signals, similarity, snapshot, titles, triage
from ..sources import articles as sources
from ..sources.landing import written


def triage_articles(landed: list[DataFrame], seen: DataFrame, texts: DataFrame, lex: Lexicon | None = None, floor: str | None = None, threshold: int = -2) -> DataFrame:
    """Articles of all sources, each URL once, unseen ones only, with texts, score and outcome."""
    lex = lex or Lexicon()
    rows = triage.with_full_text(triage.unseen(triage.union_first(landed), seen), texts)
    return triage.route(triage.analyse(rows, lex), floor, threshold).withColumn("id", article_id("url", "title", "date"))


def publish(events: DataFrame, articles: DataFrame, gazetteer: DataFrame, departments: dict[str, str] = DEPARTMENTS) -> tuple[DataFrame, DataFrame]:
    """(published, quarantined) of events (event_id, url, bank, place, label, department, ...).

    A department that is missing is the source's if it supports one; places are
    resolved, with and without the department; the guard and then the rules of
    publication give the reason of quarantine.
    """
    source = articles.select("url", F.col("title").alias("_title"), canonical(F.concat_ws(" ", "title", "text")).alias("_source"), triage.departments_of(F.concat_ws(" ", "title", "text"), departments).alias("_supported"))
    df = events.join(source, "url", "left")
    claimed = resolve.fill_department(F.col("department"), F.coalesce("_supported", F.array().cast("array<string>")), guard.valid_department(F.col("department"), departments))
    df = df.withColumn("department", claimed).withColumn("_lead", guard.leading_place(F.coalesce("_title", F.lit(""))))
    asked = df.select(F.struct("event_id", "url").alias("id"), F.col("place").alias("name"), "department").dropDuplicates(["id"])
    scoped = resolve.resolve_variants(asked, gazetteer, "id").select("id", "resolved_code", "resolved_department", "ambiguous")
    open_ = resolve.resolve(asked.withColumn("department", F.lit("")), gazetteer).select("id", F.col("ambiguous").alias("_open"))
    lead = resolve.resolve(df.select(F.struct("event_id", "url").alias("id"), F.coalesce("_lead", F.lit("")).alias("name"), F.lit("").alias("department")).dropDuplicates(["id"]), gazetteer).select("id", F.col("resolved_code").alias("_lead_code"))
    df = df.withColumn("id", F.struct("event_id", "url")).join(scoped, "id", "left").join(open_, "id", "left").join(lead, "id", "left")
    from ..functions.lexicon import POSTAL_BRAND

    against = guard.guard_reason(
        source=F.coalesce("_source", F.lit("")), place=F.col("place"), label=F.coalesce("label", F.lit("")), ambiguous=F.col("ambiguous"), brand_is_postal=F.col("bank") == POSTAL_BRAND, source_departments=F.coalesce("_supported", F.array().cast("array<string>")),
        resolved_department=F.col("resolved_department"), unscoped_ambiguous=F.col("_open"), leading_code=F.col("_lead_code"), resolved_code=F.col("resolved_code"), approximate=F.coalesce("approximate", F.lit(False)), day=F.col("closed_on"),
    )
    rules = guard.publishable_reason(F.col("place"), F.col("resolved_code").isNotNull() | F.col("ambiguous"), F.col("ambiguous"), F.col("department"), F.col("resolved_department"), F.col("resolved_code"), departments)
    judged = df.withColumn("reason", F.coalesce(against, rules))
    keep = [*events.columns, "resolved_code", "resolved_department"]
    return judged.filter("reason is null").select(*keep), judged.filter("reason is not null").select(*keep, "reason")


def fallback(articles: DataFrame, gazetteer: DataFrame, signals: DataFrame, lex: Lexicon | None = None, floor: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(events of explicit titles that are retained, the review records that remain)."""
    found = titles.events_of_titles(articles, gazetteer, lex)
    found = found.filter(titles.retained(F.col("temporal_status"), F.col("closed_on"), floor))
    return found, signals.join(found.select("url").distinct(), "url", "left_anti")


def weak_signals(articles: DataFrame, lex: Lexicon | None = None) -> DataFrame:
    lex = lex or Lexicon()
    whole = fold(F.concat_ws(" ", "title", "text"))
    return triage.weak_signal(articles.filter(triage.relevant(whole, lex)), lex).withColumn("id", article_id("url", "title", "date"))


def review(records: DataFrame, reviews: DataFrame, results: DataFrame, gazetteer: DataFrame, today: Column, k: int, cooldown_days: int = 7, lex: Lexicon | None = None) -> tuple[DataFrame, DataFrame]:
    """(best new events, reviews): the first ``k`` due records, by landed search results (id, url, title, text, date) that answer them."""
    due = reconcile.due_for_review(records, reviews, today, cooldown_days)
    t = fold(F.coalesce("title", F.lit("")))
    flag = lambda c: F.coalesce(c, F.lit(False))
    p = reconcile.priority(F.col("score"), local=web.source_tier("url") == "B", legal=F.lit(False), closure=flag(titles.closure_of_branch(t, lex or Lexicon())), plan=flag(triage.plan_of_several(t)), place=F.size(triage.places_of(F.coalesce("title", F.lit("")))) > 0)
    queue = reconcile.review_queue(due.withColumn("priority", p), k, F.desc("priority"), F.desc("score"), F.desc("date"), F.col("id"))
    answers = results.join(queue.select("id"), "id", "left_semi")
    events = titles.events_of_titles(answers, gazetteer, lex)
    best = merge.best_per_key(events, ["bank", "place", "kind", "label"], F.desc("reliability"), F.col("url"))
    log = queue.join(events.select("url").distinct().join(results.select("id", "url").hint("merge"), "url").groupBy("id").agg(F.count(F.lit(1)).alias("n_events")), "id", "left")
    return best, log.select("id", today.cast("timestamp").alias("reviewed_at"), F.coalesce("n_events", F.lit(0)).alias("n_events"))


def official_vigilance(articles: DataFrame, source: str, reason: str, lex: Lexicon | None = None) -> DataFrame:
    """Review records of the relevant articles of an official source, with why they are there."""
    return weak_signals(articles.filter(F.col("source") == source), lex).withColumn("reason", F.lit(reason))


def drill_down(articles: DataFrame, entries: DataFrame, pages: DataFrame, gazetteer: DataFrame, domains: list[str], lex: Lexicon | None = None, most_places: int = 8, most_rounds: int | None = 3, budget: int | None = None) -> DataFrame:
    """(url, title, text, round): articles on plans for several branches, and what searches for their places find, pass by pass.

    Of each plan's article (url, title, text) the candidate places that the
    gazetteer has are searched for, one query for each with the plan's brand,
    among the landed ``entries`` of the ``domains`` (see ``select.site_search``).
    The ``pages`` (url, title, text) behind the answers are the next pass, and
    those of them that are plans are searched on.
    """
    lex = lex or Lexicon()
    columns = ["url", "title", "text"]

    def expand(found: DataFrame) -> DataFrame:
        whole = fold(F.concat_ws(" ", "title", "text"))
        plans = found.filter(triage.plan_of_several(whole)).withColumn("bank", triage.first_brand(fold(F.coalesce("title", F.lit(""))), whole, lex)).filter("bank is not null").withColumn("_names", triage.candidate_places(F.concat_ws("\n", "title", "text")))
        places = resolve.valid_candidates(plans, gazetteer, "url", "_names", most_places)
        asked = plans.select("url", "bank").join(places.hint("merge"), "url").select("bank", F.explode("places").alias("place")).distinct()
        queries = asked.select(F.struct("bank", "place").alias("query_id"), F.concat_ws(" ", "bank", F.lit("fermeture agence"), "place").alias("query"))
        answers = select.site_search(queries, entries, domains).select("url").distinct()
        return pages.join(answers.hint("merge"), "url", "left_semi").select(*columns)

    seeds = articles.filter(triage.plan_of_several(fold(F.concat_ws(" ", "title", "text")))).select(*columns)
    return frontier.passes(seeds, expand, ["url"], most_rounds, budget)


def curated_events(rows: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Confirmed events of curated targets (url, bank, place, department, closed_on), whose place resolves."""
    asked = rows.withColumn("request_id", event_id("bank", "place", F.lit("closure"))).dropDuplicates(["request_id"])
    found = resolve.resolve(asked.withColumn("name", F.col("place")), gazetteer)
    return found.filter("resolved_code is not null").withColumns({"event_id": F.col("request_id"), "status": F.lit("confirmed"), "reliability": F.lit(4), "kind": F.lit("closure")}).drop("request_id", "name", "candidates", "ambiguous")


def curated_stages(articles: DataFrame, targets: DataFrame, results: DataFrame, gazetteer: DataFrame, lex: Lexicon | None = None) -> dict[str, DataFrame]:
    """What settles each curated article (url, title, text, date), by a chain of stages of which each takes what those before it left.

    ``targets`` (url, bank, place, department, label, closed_on) come from the
    curated list, ``results`` (url, result as JSON) from extraction.  Several
    targets settle an article by themselves; else the closures of its result
    do, if it has any that count; else its only target; else its result's
    signals; an article that none of them settles is ``absent``.

    ``stages`` is (url, stage); ``events`` has those of the stage that settled
    their article, with ``reason`` where the place is not found; ``signals`` is
    (url, field, bank, evidence) of the results that were asked.
    """
    lex = lex or Lexicon()
    usable = targets.filter((F.trim(F.coalesce("bank", F.lit(""))) != "") & (F.trim(F.coalesce("place", F.lit(""))) != ""))
    several = targets.groupBy("url").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").join(usable.select("url").distinct().hint("merge"), "url", "left_semi")
    asked = articles.select("url").join(several.select("url").hint("merge"), "url", "left_anti")
    checked = signals.validated(results.join(asked.hint("merge"), "url", "left_semi"), "result")
    read = written(articles.select("url", "title", "text", "date").join(checked.select("url", "parsed", "valid").hint("merge"), "url"), "curated-results")
    found = titles.structured_events(read, lex)
    of = lambda field: F.transform(f"parsed.{field}", lambda x: F.struct(F.lit(field).alias("field"), x["bank"].alias("bank"), x["evidence"].alias("evidence")))
    told = read.filter("valid").select("url", F.inline(F.concat(of("department_signals"), of("vague_signals"))))
    stages = coverage.first_rule(articles.select("url").distinct(), "url", (several, "targets"), (found, "extracted"), (usable, "single target"), (told, "signals"))
    stages = written(stages.withColumnRenamed("status", "stage"), "curated-stages")

    own = usable.select("url", F.col("bank"), F.trim("place").alias("place"), "department", "label", F.col("closed_on"), F.lit("confirmed").alias("status"), F.lit(4).alias("reliability"))
    read_ = found.select("url", "bank", "place", "department", "label", "closed_on", "status", F.lit(3).alias("reliability"))
    both = own.join(stages.filter("stage in ('targets', 'single target')").hint("merge"), "url").unionByName(read_.join(stages.filter("stage = 'extracted'").hint("merge"), "url"))
    both = both.withColumn("event_id", event_id("bank", "place", F.lit("closure"), "label")).dropDuplicates(["url", "event_id"])
    placed = resolve.resolve(both.withColumn("name", F.col("place")), gazetteer).drop("name", "candidates")
    reason = F.when(F.col("ambiguous"), "place ambiguous without department").when(F.col("resolved_code").isNull(), "place not found")
    return {"stages": stages, "events": placed.withColumn("reason", reason).drop("ambiguous"), "signals": told}


def reclassify(records: DataFrame, reviews: DataFrame, lex: Lexicon | None = None) -> tuple[DataFrame, DataFrame]:
    """(review records with those on postal closures under the postal brand, reviews without those of the records that changed).

    A record whose review is gone is due again at once (``reconcile.due_for_review``).
    """
    changed = titles.reclassified(records, lex)
    again = changed.filter("reopened").select("id").distinct()
    return changed.drop("reopened"), reviews.join(again.hint("merge"), "id", "left_anti")


STATE = ["label", "characteristic", "address", "postal_code", "locality", "code", "department", "lat", "lon", "active"]


def network_revision(before: DataFrame, after: DataFrame, full_office: Column) -> dict[str, DataFrame]:
    """Changes of a network from one revision to the next: diff, downgrades, missing offices and their only replacements.

    The first revision, with nothing before it, is a baseline: everything is inserted.
    """
    state = [c for c in STATE if c in before.columns and c in after.columns]
    was = before.filter(full_office)
    missing = was.join(after.select("point_id"), "point_id", "left_anti")
    new = after.filter(~full_office).join(before.select("point_id"), "point_id", "left_anti")
    down = was.select("point_id").join(after.filter(~full_office), "point_id")
    same_place = missing.withColumn("_place", loose_key("locality"))
    return {
        "diff": snapshot.diff(before, after, "point_id", state),
        "downgraded": down,
        "missing": missing,
        "replaced": snapshot.replacement(same_place, new.withColumn("_place", loose_key("locality")), "point_id", ["code", "_place"]),
    }


def enrich_with_network(events: DataFrame, points: DataFrame, days: DataFrame, least_closed: int = 10) -> DataFrame:
    """Events with the only point of their municipality and the cut-off of its services."""
    joined = snapshot.unique_point(events, points, "code", "point_id", "is_full", F.col("closed_on").isNotNull())
    return joined.join(snapshot.service_cutoff(days, "point_id", "day", "is_open", least_closed), "point_id", "left")


def audit(events: DataFrame, today: Column, terms: list[str], old_days: int = 120) -> DataFrame:
    """Findings (severity, kind, event_id, message): not publishable, suspicious evidence, old without a date, near names of one bank and department."""
    finding = lambda df, severity, kind, message: df.select(F.lit(severity).alias("severity"), F.lit(kind).alias("kind"), "event_id", message.alias("message"))
    a = finding(events.filter(~guard.publishable_name(F.col("place"))), "high", "not_publishable", F.coalesce("place", F.lit("")))
    b = finding(events.filter(guard.suspicious(F.coalesce("evidence", F.lit("")), terms)), "medium", "suspicious_evidence", F.col("evidence"))
    c = finding(events.filter(F.col("closed_on").isNull() & (F.datediff(today, F.col("created_at")) >= old_days)), "low", "missing_date", F.lit("no date"))
    keyed = events.withColumn("_k", loose_key("place"))
    pairs = similarity.near_names(keyed.select("_k"), "_k")
    left = pairs.join(keyed.select("event_id", "bank", "department", F.col("_k").alias("a")).hint("merge"), "a")
    right = keyed.select(F.col("bank").alias("_bank"), F.col("department").alias("_dep"), F.col("_k").alias("b")).distinct()
    near = left.join(right.hint("merge"), "b").filter("bank = _bank and department = _dep")
    d = finding(near, "low", "near_name", F.concat_ws(" ~ ", "a", "b"))
    return a.unionByName(b).unionByName(c).unionByName(d)


def export_sections(events: DataFrame, event_sources: DataFrame, quarantine: DataFrame, signals: DataFrame, regions: DataFrame) -> dict[str, DataFrame]:
    """Sections of the export: events with tiered sources, what remains to review, departments and regions."""
    tiered = event_sources.withColumn("tier", web.source_tier("url"))
    nested = rollup.nested_sources(tiered, "event_id", ["url", "name", "tier"])
    full = events.join(nested, "event_id", "left").withColumn("n_sources", F.coalesce("n_sources", F.lit(0))).join(F.broadcast(regions), "department", "left")
    settled = reconcile.resolved_quarantine(quarantine, events)
    keyed = lambda df: df.withColumns({"bank_key": loose_key("bank"), "place_key": loose_key("place")})
    open_rows = written(quarantine.join(settled.select("id").hint("merge"), "id", "left_anti"), "export-quarantine")
    estimate = rollup.department_estimate(events, keyed(open_rows.filter(guard.countable(F.col("reason")))), signals.filter("n is not null").select("department", "n"), keyed(signals.filter("n is null")).withColumn("seq", F.struct(-F.col("score"), "id")))
    estimate = written(estimate, "export-estimates")
    return {"events": full, "quarantine": open_rows, "signals": signals, "departments": estimate, "regions": rollup.by_region(full, "region", "department", "kind", "n_sources", ["closure", "project", "fusion"])}


def export_payload(*, events: DataFrame, event_sources: DataFrame, controls: DataFrame, quarantine: DataFrame, signals: DataFrame, department_signals: DataFrame, vague_signals: DataFrame, plans: DataFrame, branches: DataFrame, departments: DataFrame, brands: list[str], now: Column) -> dict[str, DataFrame]:
    """The eleven sections of the export, each a table.

    ``departments`` (department, name, region) is a dimension; sections of open
    records come best or newest first.
    """
    spark = events.sparkSession
    regions = departments.select("department", "region")
    base = export_sections(events, event_sources, quarantine, signals, regions)
    full = rollup.with_control(base["events"], controls)
    counted = events.groupBy("department").agg(F.count(F.lit(1)).alias("n_events"))
    dim = departments.join(counted, "department", "left").join(rollup.per_department(branches), "department", "left").join(base["departments"].select("department", "n_precise", "n_unlocated", "estimate"), "department", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return {
        "generated_at": spark.range(1).select(now.alias("generated_at")),
        "brands": spark.createDataFrame([(b,) for b in sorted(set(brands))], "brand string"),
        "departments": dim.select("department", "name", "region", *[zero(c) for c in ("n_events", "n_branches", "n_precise", "n_unlocated", "estimate")]),
        "department_estimates": base["departments"],
        "regions": base["regions"],
        "events": full,
        "quarantine": base["quarantine"].orderBy(F.desc("created_at"), "id"),
        "department_signals": department_signals.orderBy(F.desc("date"), "id"),
        "vague_signals": vague_signals.orderBy(F.desc("date"), "id"),
        "signals": signals.orderBy(F.desc("score"), F.desc("date"), "id"),
        "plans": plans,
    }


def coverage_report(expected: DataFrame, events: DataFrame, signals: DataFrame, statuses: DataFrame) -> tuple[DataFrame, DataFrame]:
    found = coverage.expected_status(expected, events, signals)
    return found, coverage.summary(found, statuses)


def archive_selection(indexes: DataFrame, domains: DataFrame, captures: DataFrame, keep: str, drop: str, *, n_indexes: int, n_domains: int, turn: int, per_domain: int, most: int) -> DataFrame:
    """Captures to read in one run: evenly spaced indexes, this turn's domains, caps per domain and in all."""
    chosen = select.evenly_spaced(indexes, [F.desc("index_id")], n_indexes).select("index_id")
    batch = select.rotating_batch(domains, "position", n_domains, turn).select("domain")
    rows = captures.join(F.broadcast(chosen), "index_id", "left_semi").join(F.broadcast(batch), "domain", "left_semi")  # both are bounded by parameters
    return sources.captures(rows, keep, drop, per_domain).orderBy(F.desc("timestamp"), "urlkey").limit(most)


def department_column(insee: str, postal: str) -> Column:
    return department_code(insee, postal)


def full_run(landed: list[DataFrame], seen: DataFrame, texts: DataFrame, gazetteer: DataFrame, signals: DataFrame, lex: Lexicon | None = None, floor: str | None = None) -> dict[str, DataFrame]:
    """Triage, events of titles and plans, publication and weak signals of one run."""
    routed = written(triage_articles(landed, seen, texts, lex, floor), "run-routed")
    extract = routed.filter("outcome = 'extract'")
    found, rest = fallback(extract, gazetteer, signals, lex)
    found = written(found, "run-found")
    plans = titles.events_of_plans(extract, gazetteer, lex)
    both = found.unionByName(plans, allowMissingColumns=True).withColumn("department", F.lit(None).cast("string"))
    published, quarantined = publish(both, extract, gazetteer)
    weak = weak_signals(routed.filter("outcome = 'weak_signal'"), lex)
    return {"routed": routed, "published": published, "quarantined": quarantined, "weak": weak, "open_signals": rest, "recap": triage.recap(routed), "new_seen": routed.select("url")}
