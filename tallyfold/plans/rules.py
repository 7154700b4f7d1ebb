"""Queries over rules of titles, classes, overrides, exports and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, display, keys, names, wordrules
from ..operators import coverage, guard, reconcile, rollup, signals, titles, triage
from ..sources import sinks
from .common import query, quote, sql_rule, sql_says, sql_words, table

PLACES = ["Poitiers", "Tulle", "Brest", "Vannes", "Bourgneuf", "Reuilly", "Bourges", "Brest", "Nantes", "Paris", "Colmar", "Rennes", "Lille", "Lyon", "Dinan", "Bagneux", "Tulle", "Metz", "Lens", "Albi"]


def pick(values: list[str], key: str) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values)).cast("int"))


def sql_pick(values: list[str], key: str) -> str:
    return f"[{', '.join(map(quote, values))}][1 + {key} % {len(values)}]"


# Titles as local papers write them, put together from what each order is: who (segment), what (priority), when (status and day), where (nation and customer).
WHO = {"AUTOMOBILE": "l'agence LCL", "BUILDING": "le bureau de poste", "FURNITURE": "trois agences LCL", "HOUSEHOLD": "le guichet automatique", "MACHINERY": "la banque LCL"}
WHAT = {"1-URGENT": "va fermer", "2-HIGH": "est fermée", "3-MEDIUM": "ne fermera pas", "4-NOT SPECIFIED": "ferme temporairement", "5-LOW": "annonce un plan de fermeture"}
_CASE = lambda c, table: f"case {c} " + " ".join(f"when {quote(k)} then {quote(v)}" for k, v in table.items()) + " end"
_MONTH_LIST = f"[{', '.join(map(quote, dates.MONTHS))}]"
TITLED = f"""titled as (select *, {sql_pick(PLACES, "n_nationkey")} as p1, {sql_pick(PLACES, "c_custkey")} as p2, o_orderdate::date as day from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey),
told as (select *, p1 || case when o_orderstatus = 'P' then '. ' else ' : ' end || {_CASE("c_mktsegment", WHO)} || case when o_totalprice > 200000 then ' de ' || p2 else '' end || ' ' || {_CASE("o_orderpriority", WHAT)} || case o_orderstatus when 'F' then ' pour travaux' when 'O' then ' le ' || day(day) || ' ' || {_MONTH_LIST}[month(day)] else ' pendant deux semaines' end as title from titled),
folded as (select *, strip_accents(lower(title)) as f, {sql_words("strip_accents(lower(title))")} as w from told)"""


def order_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer and nation, two places, the day and the title that is put together from them."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(table(spark, sf_dir, "nation")), F.col("n_nationkey") == F.col("c_nationkey"))  # 25 nations
    o = o.withColumns({"p1": pick(PLACES, "n_nationkey"), "p2": pick(PLACES, "c_custkey"), "day": F.to_date("o_orderdate")})
    month = F.get(F.array(*[F.lit(m) for m in dates.MONTHS]), F.month("day") - 1)
    when = F.when(F.col("o_orderstatus") == "F", F.lit(" pour travaux")).when(F.col("o_orderstatus") == "O", F.concat(F.lit(" le "), F.day("day").cast("string"), F.lit(" "), month)).otherwise(F.lit(" pendant deux semaines"))
    said = lambda c, words: names.lookup(F.col(c), words)
    title = F.concat("p1", F.when(F.col("o_orderstatus") == "P", ". ").otherwise(" : "), said("c_mktsegment", WHO), F.when(F.col("o_totalprice") > 200000, F.concat(F.lit(" de "), "p2")).otherwise(F.lit("")), F.lit(" "), said("o_orderpriority", WHAT), when)
    return o.withColumn("title", title)


@query(f"""with {TITLED}, m as (select *, {sql_says("w", titles.EXCLUDED, titles.WORDS)} as excluded, replace(replace(w, ' ' || lower(p1) || ' ', ' @place '), ' lcl ', ' @brand ') as marked from folded)
select o_orderkey, excluded, {sql_says("w", titles.FUTURE, titles.WORDS)} as future, {sql_says("w", titles.PAST, titles.WORDS)} as past, not excluded and {sql_says("marked", titles.ONE_BRANCH, titles.WORDS)} as one_branch from m""")
def title_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the title of each order tells: an exclusion, a future or past closure, one branch."""
    t = keys.fold("title")
    says = lambda rules: wordrules.says(t, rules, titles.WORDS)
    return order_titles(spark, sf_dir).select("o_orderkey", titles.excluded(t).alias("excluded"), says(titles.FUTURE).alias("future"), says(titles.PAST).alias("past"), titles.names_one_branch(F.col("title"), F.lit("LCL"), F.col("p1")).alias("one_branch"))


@query(f"""with {TITLED}, h as (select *, regexp_extract(title, '^([^.:!?]{{2,60}})[.:]', 1) as head, case when o_totalprice > 200000 and c_mktsegment = 'BUILDING' then p2 end as office, list_distinct({sorted(set(PLACES))!r}) as places from folded),
c as (select *, list_filter(places, lambda x: contains(title, x)) as found, list_filter(places, lambda x: contains(lower(head), lower(x))) as ahead from h)
select o_orderkey, array_to_string(list_sort(case when len(ahead) > 0 then ahead when list_contains(found, office) then [office] else found end), ',') as places, {sql_says("w", triage.PLANS, triage.PLAN_WORDS)} as is_plan from c""")
def title_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the places in each order's title it is about, and whether it tells of a plan for several branches."""
    d = order_titles(spark, sf_dir)
    found = F.filter(F.array(*[F.lit(p) for p in sorted(set(PLACES))]), lambda x: F.contains(F.col("title"), x))
    return d.select("o_orderkey", F.array_join(F.sort_array(titles.preferred_places(F.col("title"), found)), ",").alias("places"), triage.plan_of_several(keys.fold("title")).alias("is_plan"))


@query(f"""with {TITLED}, s as (select *, w || case when o_orderstatus = 'P' then '(' || case when n_nationkey % 2 = 0 then '86' else '17' end || ')' else '' end as src, case when o_totalprice < 60000 then p2 else p1 end as place, case when o_orderstatus = 'P' then case when n_nationkey % 2 = 0 then '86' else '17' end else '' end as dep,
  list_position({_MONTH_LIST}, regexp_extract(w, {quote(sql_rule(guard.CLOSING_MONTH, guard.WORDS))}, 1)) as mo, case when o_orderstatus <> 'P' then p1 end as lead from folded)
select o_orderkey, case when {sql_says("w", guard.DENIALS, guard.WORDS)} then 'closure denied' when c_mktsegment = 'BUILDING' and {sql_says("w", guard.PASSING, guard.WORDS)} then 'temporary closure' when dep <> '' and dep <> '86' then 'department contradicts the source'
  when dep = '' and c_acctbal < 0 then 'namesake without support' when not regexp_matches(f, '(^|[^a-z0-9_-])' || lower(place) || '([^a-z0-9_]|$)') then 'place not mentioned' when lead <> place then 'the title leads with another place' when mo > 0 and mo <> month(case when c_acctbal > 5000 then day + interval 1 month else day end) then 'month differs' end as reason from s""")
def guard_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The guard over the title of each order; customers in debt stand for names that have namesakes."""
    d = order_titles(spark, sf_dir)
    place, dep = F.when(F.col("o_totalprice") < 60000, F.col("p2")).otherwise(F.col("p1")), F.when(F.col("n_nationkey") % 2 == 0, "86").otherwise("17")
    d = d.withColumns({"place": place, "dep": dep, "lead": guard.leading_place(F.col("title"))}).withColumn("src", keys.canonical(F.concat("title", F.when(F.col("o_orderstatus") == "P", F.concat(F.lit(" ("), "dep", F.lit(")"))).otherwise(F.lit("")))))
    day = F.when(F.col("c_acctbal") > 5000, F.add_months("day", 1)).otherwise(F.col("day"))
    reason = guard.guard_reason(
        source=F.col("src"), place=F.col("place"), label=F.lit(""), ambiguous=F.lit(False), brand_is_postal=F.col("c_mktsegment") == "BUILDING", source_departments=F.when(F.col("o_orderstatus") == "P", F.array("dep")).otherwise(F.array().cast("array<string>")), resolved_department=F.lit("86"),
        unscoped_ambiguous=F.col("c_acctbal") < 0, leading_code=F.col("lead"), resolved_code=F.col("place"), approximate=F.lit(True), day=day,
    )
    return d.select("o_orderkey", reason.alias("reason"))


NEWS = ["Ouest-France", "Légifrance", "Google News", "Le Progrès", "Le Bien Public", "blog", "Journal officiel", "La Dépêche", "L'Est Républicain", ""]
MESSAGES = ["À compter du mardi 7 juillet 2026 l'agence de Lens (02378) transfère son activité vers l'agence de Arras (02369).", "Fermeture définitive le 03/09/2026.", "Ouvert le samedi", "Votre agence sera rattachée à Lille", "transfert de votre agence le 12 août 2026 vers l’agence de Lyon Centre.", ""]


@query(f"""with d as (select doc_id, {sql_pick(NEWS, "doc_id")} as s, {sql_pick(MESSAGES, "doc_id")} as m from documents), f as (select *, strip_accents(lower(s)) as fs, strip_accents(lower(m)) as fm from d)
select doc_id, case when fs in ('legifrance') then 'legal' when fs in ('ouest-france', 'google news', 'le progres', 'le bien public', 'la depeche', 'l''est republicain', 'journal officiel') then 'local' end as class, doc_id % {len(MESSAGES)} in (0, 1, 3, 4) as transfer,
  [ '2026-07-07', '2026-09-03', null, null, '2026-08-12', null][1 + doc_id % {len(MESSAGES)}] as day, case when doc_id % {len(MESSAGES)} = 0 then '02378' end as branch_code, case doc_id % {len(MESSAGES)} when 0 then 'Arras' when 4 then 'Lyon Centre' end as destination from f""")
def source_and_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", pick(NEWS, "doc_id").alias("s"), pick(MESSAGES, "doc_id").alias("m"))
    told = display.locator_message(F.col("m"))
    return d.select("doc_id", display.source_class(F.col("s")).alias("class"), display.future_transfer(F.col("m")).alias("transfer"), told["day"].cast("string").alias("day"), told["branch_code"].alias("branch_code"), told["destination"].alias("destination"))


POINTS = ["Bureau de poste", "BUREAU CENTRE", "Agence postale communale", "Relais Poste", "Point partenaire", "Kiosque"]
KIND_NAMES, STATUS_NAMES = [*display.KINDS, "other"], [*display.STATUSES, "other"]


@query(f"""with o as (select o_orderkey, o_orderdate::date as day, o_orderstatus, {sql_pick(KIND_NAMES, "o_custkey")} as k, {sql_pick(STATUS_NAMES, "o_orderkey")} as st, {sql_pick(POINTS, "o_custkey")} as pt, o_orderpriority from orders),
m as (select *, case when k in ('regroupement', 'merge') then 'fusion' else 'closure' end as kind, case st when 'confirmed' then 'confirmed' when 'announced' then 'project' else 'rumour' end as status, case when o_orderstatus <> 'P' then day end as d from o)
select o_orderkey, kind, status, case when kind = 'fusion' then 'fusion' else status end as class, case when d >= date '1997-01-01' then 'upcoming' when d is not null then 'closed' when o_orderpriority = '5-LOW' then 'upcoming' else 'unknown' end as effective, lower(pt) in ('bureau de poste', 'bureau centre') as full_office, lower(pt) in ('agence postale communale', 'relais poste', 'point partenaire') as partner,
  case when pt like 'Agence postale%' then 'Conversion en agence postale communale' when pt in ('Relais Poste', 'Point partenaire') then 'Conversion en relais Poste' else 'Services Banque Postale supprimés' end as impact, d is null or o_orderpriority = '1-URGENT' or status <> 'confirmed' or k = 'other' as to_verify, strftime(coalesce(d, day), '%Y-%m') as month, date_diff('day', day, date '1998-01-01') >= 365 as deep from m""")
def event_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes, labels and flags of orders as events."""
    o = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    o = o.withColumns({"k": pick(KIND_NAMES, "o_custkey"), "pt": pick(POINTS, "o_custkey"), "d": F.when(F.col("o_orderstatus") != "P", F.col("day")), "status": display.event_status(pick(STATUS_NAMES, "o_orderkey"))}).withColumn("kind", display.event_kind(F.col("k")))
    day = lambda s: F.lit(s).cast("date")
    review = display.needs_review(F.when(F.col("k") != "other", F.col("k")), F.col("d"), F.when(F.col("o_orderpriority") == "1-URGENT", 3).otherwise(4), F.col("status"))
    return o.select(
        "o_orderkey", "kind", "status", display.event_class(F.col("kind"), F.col("status")).alias("class"), display.effective_status(F.col("d"), F.when(F.col("o_orderpriority") == "5-LOW", "upcoming"), day("1997-01-01")).alias("effective"), display.is_full_office(F.col("pt")).alias("full_office"), display.is_partner(F.col("pt")).alias("partner"),
        display.impact_label(display.impact_class(F.col("pt"))).alias("impact"), review.alias("to_verify"), F.date_format(display.display_date(F.col("d"), F.col("day")), "yyyy-MM").alias("month"), display.deep_window(F.col("day"), day("1998-01-01"), 365).alias("deep"),
    )


BRANDS = ["La Banque Postale", "BNP Paribas", "Caisse d'Epargne", "Crédit Mutuel", "LCL"]
SAYINGS = ["la banque postale ferme", "BNP s'en va", "caisse épargne de Lens", "le CMB reste", "LCLA n'est pas elle", "rien"]


@query(f"""with d as (select doc_id, {sql_pick(SAYINGS, "doc_id")} as s from documents)
select doc_id, doc_id % 6 = 0 as said_postal, doc_id % 6 = 1 as said_bnp, doc_id % 6 = 2 as said_caisse, doc_id % 6 = 3 as said_mutuel, false as said_lcl from d""")
def brand_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", pick(SAYINGS, "doc_id").alias("s"))
    return d.select("doc_id", *[display.brand_said(F.col("s"), b).alias(n) for n, b in zip(["said_postal", "said_bnp", "said_caisse", "said_mutuel", "said_lcl"], BRANDS, strict=True)])


_ORDERS = "e as (select o_orderkey as event_id, c_mktsegment as bank, c_name as place, n_name as department, o_orderstatus, o_orderpriority, o_orderdate::date as day, o_custkey from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as events: the market segment is the bank, the customer the place, the nation the department."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    j = o.join(c, F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(n), F.col("n_nationkey") == F.col("c_nationkey"))  # 25 nations
    return j.select(F.col("o_orderkey").alias("event_id"), F.col("c_mktsegment").alias("bank"), F.col("c_name").alias("place"), F.col("n_name").alias("department"), "o_orderstatus", "o_orderpriority", F.to_date("o_orderdate").alias("day"), "o_custkey")


@query("""select substr(sha256('laposte-missing|' || c_custkey || '|2026-02-01T00'), 1, 16) as id, n_name as department, 'Disparition à confirmer du bureau de poste ' || c_name as title, 'https://points.example.org?point=' || c_custkey || '%20' || c_nationkey as url, '2026-02-01' as date, 5 as score from customer join nation on n_nationkey = c_nationkey where c_acctbal < 0""".replace("|| c_custkey || '|2026", "|| c_custkey || ' ' || c_nationkey || '|2026"))
def missing_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in debt are missing from the last revision."""
    c = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("n_nationkey") == F.col("c_nationkey"))  # 25 nations
    gone = c.filter("c_acctbal < 0").select(F.concat_ws(" ", F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")).alias("point_id"), F.col("c_name").alias("label"), F.col("n_name").alias("department"))
    return signals.missing_point(gone, F.lit("2026-02-01T00"), "La Banque Postale", "https://points.example.org").select("id", "department", "title", "url", "date", "score")


@query("""select n_name as department, count(*)::bigint as n_branches from customer join nation on n_nationkey = c_nationkey where c_acctbal > 0 group by 1""")
def branches_per_department(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("n_nationkey") == F.col("c_nationkey"))  # 25 nations
    return rollup.per_department(c.withColumn("department", F.when(F.col("c_acctbal") > 0, F.col("n_name"))))


@query("""with c as (select l_orderkey, min({'s': l_returnflag, 'r': l_suppkey::varchar, 'o': l_linestatus}) as c from lineitem where l_tax > 0.04 group by 1) select o_orderkey as event_id, c.s as control_status, c.r as control_id from orders left join c on l_orderkey = o_orderkey""")
def control_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    controls = table(spark, sf_dir, "lineitem").filter("l_tax > 0.04").select(F.col("l_orderkey").alias("event_id"), F.col("l_returnflag").alias("status"), F.col("l_suppkey").cast("string").alias("register_id"), F.col("l_linestatus").alias("source"))
    return rollup.with_control(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id")), controls).select("event_id", F.col("control.status").alias("control_status"), F.col("control.register_id").alias("control_id"))


@query("""select o_orderstatus, min(o_orderdate)::date::varchar as first_day, max(o_orderdate)::date::varchar as last_day from orders group by 1""")
def first_and_last_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rollup.first_and_last(table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate")), "day", "o_orderstatus")
    return out.withColumns({c: F.col(c).cast("string") for c in ("first_day", "last_day")})


@query("""with r as (select case when l_quantity < 5 then 'denied' when l_discount > 0.08 then 'temporary' when l_tax > 0.06 then 'elsewhere' end as reason from lineitem) select reason, count(*)::bigint as n from r where reason is not null group by 1""")
def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = guard.first_reason((F.col("l_quantity") < 5, "denied"), (F.col("l_discount") > 0.08, "temporary"), (F.col("l_tax") > 0.06, "elsewhere"))
    return guard.reasons(table(spark, sf_dir, "lineitem").select(reason.alias("reason")).filter("reason is not null"))


@query("""with u as (select event_id, event_type as bank, props as title, case when value > 20 then 'x' end as resolved, case user_id % 3 when 0 then 'Le bureau de poste' when 1 then 'la BANQUE POSTALE' else 'autre' end as text from events)
select event_id, text from u where resolved is null and (bank = 'signup' or contains(lower(text), 'bureau de poste') or contains(lower(text), 'banque postale'))""")
def postal_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.when(F.col("user_id") % 3 == 0, "Le bureau de poste").when(F.col("user_id") % 3 == 1, "la BANQUE POSTALE").otherwise("autre")
    rows = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("bank"), F.col("props").alias("title"), F.when(F.col("value") > 20, "x").alias("resolved"), said.alias("text"))
    return reconcile.postal_backlog(rows, "signup").select("event_id", "text")


@query(f"""with {_ORDERS} select bank, count(*) filter (where o_orderstatus <> 'F')::bigint as new_this_run, count(*) filter (where day >= date '1997-01-01')::bigint as total_in_window, count(*)::bigint as total_all from e group by 1""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders were there before the run."""
    e = events(spark, sf_dir)
    return reconcile.run_summary(e.filter("o_orderstatus = 'F'"), e, F.col("day") >= F.lit("1997-01-01").cast("date"), "bank")


@query(f"""with {_ORDERS}, r as (select * from (values (1, 'BUILDING', 'FRANCE', '', 'present', null, 'high'), (2, 'BUILDING', 'FRANCE', '5-low', 'rejected', 'twice', null), (3, 'MACHINERY', 'CHINA', '', null, 'unseen', null), (4, 'BUILDING', 'FRANCE', '', null, null, 'low')) t(rule_pos, bank, department, label, status, missing_reason, reliability)),
n as (select distinct n_name from nation), j as (select event_id, arg_max(r.status, rule_pos) filter (where r.status is not null) as status, arg_max(missing_reason, rule_pos) filter (where missing_reason is not null) as missing_reason, arg_max(reliability, rule_pos) filter (where reliability is not null) as reliability
  from e join r on e.bank = r.bank and replace(e.department, 'NATION_02', 'FRANCE') = r.department and (label = '' or label = lower(o_orderpriority)) group by 1)
select event_id, coalesce(j.status, 'needs_research') as status, j.missing_reason, coalesce(j.reliability, case when o_orderstatus = 'F' then 'medium' else 'low' end) as reliability from e left join j using (event_id)""")
def row_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row rules by bank, department and, where a rule has one, priority; then the reliability of what no rule sets."""
    none = F.lit(None).cast("string")
    rows = events(spark, sf_dir).select("event_id", F.col("bank").alias("bank_key"), F.replace(F.col("department"), F.lit("NATION_02"), F.lit("FRANCE")).alias("place_key"), F.lower("o_orderpriority").alias("label_key"), F.lit("needs_research").alias("status"), none.alias("missing_reason"), none.alias("reliability"), F.when(F.col("o_orderstatus") == "F", "https://x").alias("url"))
    rules = spark.createDataFrame([("BUILDING", "FRANCE", "", 1, "present", None, "high"), ("BUILDING", "FRANCE", "5-low", 2, "rejected", "twice", None), ("MACHINERY", "CHINA", "", 3, None, "unseen", None), ("BUILDING", "FRANCE", "", 4, None, None, "low")], "bank_key string, place_key string, label_key string, rule_pos int, status string, missing_reason string, reliability string")
    out = coverage.override_rows(rows, "event_id", rules, ["status", "missing_reason", "reliability"])
    return out.select("event_id", "status", "missing_reason", coverage.default_reliability(F.col("reliability"), F.col("url")).alias("reliability"))


def full_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = events(spark, sf_dir)
    done = F.col("o_orderstatus") == "F"
    none = F.lit(None).cast("string")
    full = e.select(
        F.col("event_id").cast("string").alias("event_id"), "bank", F.when(F.col("o_orderpriority") == "5-LOW", "Inconnue").otherwise(F.col("place")).alias("place"), "department", none.alias("region"), F.lit("closure").alias("kind"), F.when(done, "confirmed").otherwise("project").alias("status"), F.when(done, "closed").when(F.col("o_orderstatus") == "O", "upcoming").alias("temporal_status"), none.alias("service_impact"), none.alias("point_before"), none.alias("point_after"), none.alias("evidence_level"),
        none.alias("announced_on"), F.when(done, F.col("day")).alias("closed_on"), F.when(F.col("o_orderpriority") == "1-URGENT", 3).otherwise(4).alias("reliability"), F.concat(F.lit(" cited "), F.col("o_custkey").cast("string")).alias("evidence"), F.lit(1.5).alias("lat"), F.lit(None).cast("double").alias("lon"), none.alias("code"),
        F.when(done, F.struct(F.lit("A").alias("status"), F.col("o_custkey").cast("string").alias("register_id"), none.alias("source"))).alias("control"),
    )
    s = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("event_id"), F.concat_ws("/", F.lit("u"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0"), F.lpad(F.col("l_linenumber").cast("string"), 2, "0")).alias("url"), F.when(F.col("l_returnflag") != "R", F.concat(F.lit("n"), F.col("l_suppkey").cast("string"))).alias("name"), F.concat(F.lit("t"), F.col("l_linenumber").cast("string")).alias("title"))
    return full, s


_SOURCES = """s as (select l_orderkey, 'u/' || lpad(l_suppkey::varchar, 6, '0') || '/' || lpad(l_linenumber::varchar, 2, '0') as url, case when l_returnflag <> 'R' then 'n' || l_suppkey end as name, 't' || l_linenumber as title from lineitem),
f as (select l_orderkey, min(url) as url, arg_min(coalesce(name, ''), {'u': url, 'n': coalesce(name, '')}) as name, string_agg(coalesce(name, 'source') || ': ' || title || ' ' || url, chr(10) order by url, coalesce(name, 'source') || ': ' || title) as all_sources from s group by 1)"""


@query(f"""with {_ORDERS}, {_SOURCES} select bank as "Banque", case when o_orderpriority = '5-LOW' then 'Inconnue' else place end as "Commune", department as "Département", '' as "Région", 'closure' as "Type d'information", case o_orderstatus when 'F' then 'Déjà fermée' when 'O' then 'À venir' else 'Inconnu' end as "Temporalité", '' as "Impact Banque Postale", '' as "Point postal avant", '' as "Point postal après",
  '' as "Niveau de preuve", '' as "Date annonce", case when o_orderstatus = 'F' then day::varchar else '' end as "Date fermeture", coalesce(f.name, '') as "Source", coalesce(f.url, '') as "URL", case when o_orderpriority = '1-URGENT' then '3' else '4' end as "Fiabilité", case when o_orderstatus <> 'F' or o_orderpriority = '1-URGENT' then 'oui' else 'non' end as "À vérifier", 'cited ' || o_custkey as "Citation" from e left join f on l_orderkey = event_id""")
def reader_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.reader_list(*full_events(spark, sf_dir))


@query(f"""with {_ORDERS}, {_SOURCES} select bank, case when o_orderpriority = '5-LOW' then 'Non renseignée' else place end as place, department || ' - ' || department as department, coalesce(r_name, 'Non renseignée') as region, 'closure' as kind, case when o_orderstatus = 'F' then 'confirmed' else 'project' end as status, case when o_orderpriority = '1-URGENT' then 3 else 4 end as reliability,
  case when o_orderpriority in ('5-LOW', '1-URGENT') or o_orderstatus <> 'F' then 'oui' else 'non' end as to_verify, case when o_orderstatus = 'F' then day::varchar else '' end as closed_on, '' as announced_on, coalesce(f.name, '') as source, coalesce(f.url, '') as url, 'cited ' || o_custkey as evidence, 1.5::double as lat, null::double as lon, '' as code, event_id::varchar as event_id, coalesce(all_sources, '') as sources, case when o_orderstatus = 'F' then 'A ' || o_custkey else '' end as control
from e left join f on l_orderkey = event_id left join nation on n_name = department left join region on r_regionkey = n_regionkey""")
def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, s = full_events(spark, sf_dir)
    dim = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("n_name").alias("code"), F.col("n_name").alias("name"), F.col("r_name").alias("region"))
    return sinks.export_rows(e, s, dim)


_EXPECTED = "x as (select c_custkey as expected_id, c_mktsegment as bank, c_nationkey::varchar as place, case when c_acctbal < 2000 then (c_custkey % 25)::varchar else '' end as label, c_acctbal > 9000 as is_plan from customer)"


@query(f"""with {_EXPECTED}, ev as (select o_orderkey as seq, c_mktsegment as bank, 'n' || (o_custkey % 40) as place, case when o_orderpriority = '5-LOW' then 'n' || c_nationkey end as label, case when o_orderstatus = 'F' then 'dated' else 'undated' end as ds from orders join customer on c_custkey = o_custkey where o_totalprice > 300000),
y as (select expected_id, bank, 'n' || place as place, case when label <> '' then 'n' || label else '' end as label, is_plan from x), m as (select expected_id, seq, case when ev.place = y.place then 0 else 1 end as how, ds from y join ev using (bank) where ev.place = y.place or (y.label <> '' and ev.label = y.label)),
d as (select expected_id, arg_min(ds, {{'s': seq, 'h': how}}) as ds from m group by 1), lp as (select distinct expected_id from y join ev using (bank) where y.label <> '' and ev.place = y.label),
sg as (select distinct event_type, case event_type when 'view' then 'BUILDING' when 'click' then 'MACHINERY' else 'FURNITURE' end as bank, event_type = 'click' as plan_like, 'over n' || (user_id % 10) || ' now' as t from events),
pl as (select distinct expected_id from y join sg using (bank) where is_plan and plan_like), sd as (select distinct expected_id from y join sg using (bank) where contains(t, y.place) or (y.label <> '' and contains(t, y.label)))
select expected_id, case when ds is not null then ds when lp.expected_id is not null then 'label_as_place' when pl.expected_id is not null then 'plan' when sd.expected_id is not null then 'mentioned' else 'absent' end as status from y left join d using (expected_id) left join lp using (expected_id) left join pl using (expected_id) left join sd using (expected_id)""")
def expected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as expected events, large orders as known ones, log entries as signals."""
    name = lambda c: F.concat(F.lit("n"), c.cast("string"))
    c = table(spark, sf_dir, "customer")
    expected = c.select(F.col("c_custkey").alias("expected_id"), F.col("c_mktsegment").alias("bank_key"), name(F.col("c_nationkey")).alias("place_key"), F.when(F.col("c_acctbal") < 2000, name(F.col("c_custkey") % 25)).otherwise("").alias("label_key"), (F.col("c_acctbal") > 9000).alias("is_plan"))
    known = table(spark, sf_dir, "orders").filter("o_totalprice > 300000").join(c, F.col("c_custkey") == F.col("o_custkey"))
    known = known.select(F.col("o_orderkey").alias("event_seq"), F.col("c_mktsegment").alias("bank_key"), name(F.col("o_custkey") % 40).alias("place_key"), F.when(F.col("o_orderpriority") == "5-LOW", name(F.col("c_nationkey"))).alias("label_key"), F.when(F.col("o_orderstatus") == "F", "dated").otherwise("undated").alias("date_status"))
    bank = F.when(F.col("event_type") == "view", "BUILDING").when(F.col("event_type") == "click", "MACHINERY").otherwise("FURNITURE")
    said = table(spark, sf_dir, "events").select(bank.alias("bank_key"), F.concat_ws(" ", F.lit("over"), name(F.col("user_id") % 10), F.lit("now")).alias("text_key"), (F.col("event_type") == "click").alias("plan_like")).distinct()
    return coverage.expected_status(expected, known, said)
