"""Queries over orders, lines, customers and nations: events, merges, facets, roll-ups, audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys, numbers
from ..operators import coverage, geo, guard, merge, reconcile, resolve, rollup, select, similarity, triage
from .common import query, table


@query("""select o_orderkey, o_custkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)""")
def seen_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("url"), "o_orderkey", "o_custkey")
    seen = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("url"))
    return triage.unseen(o, seen).select("o_orderkey", "o_custkey")




@query("""with g as (select p_name as name, p_type as department, p_partkey as rank, p_partkey::varchar as code from part),
q as (select c_custkey as request_id, p_name as name, case when c_custkey % 3 = 0 then '' when c_custkey % 3 = 1 then 'ECONOMY' else p_type end as department from customer join part on p_partkey = c_custkey % 997),
j as (select q.*, g.rank, g.code, g.department as gd from q left join g on g.name = q.name),
a as (select request_id, name, department, arg_min(code, rank) filter (where department = '' or gd = department) as hit, arg_min(gd, rank) filter (where department = '' or gd = department) as hd, count(distinct code) as n from j group by 1, 2, 3)
select request_id, case when not (department = '' and n > 1) then hit end as resolved_code, case when not (department = '' and n > 1) then hd end as resolved_department, department = '' and n > 1 as ambiguous, case when department = '' and n > 1 then n else 0 end::int as n_candidates from a""")
def gazetteer_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    gazetteer = part.select(F.col("p_name").alias("name"), F.col("p_type").alias("department"), F.col("p_partkey").cast("string").alias("code"), F.col("p_partkey").alias("rank"))
    asked = table(spark, sf_dir, "customer").join(part, F.col("p_partkey") == F.col("c_custkey") % 997)
    asked = asked.select(F.col("c_custkey").alias("request_id"), F.col("p_name").alias("name"), F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 3 == 1, "ECONOMY").otherwise(F.col("p_type")).alias("department"))
    out = resolve.resolve(asked, gazetteer, listed=False)  # a name's codes are as many as its places
    return out.select("request_id", "resolved_code", "resolved_department", "ambiguous", "n_candidates")


def orders_as_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their nation as department and their customer as place."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    dim = F.broadcast(n)  # 25 nations
    return o.join(c, F.col("c_custkey") == F.col("o_custkey")).join(dim, F.col("n_nationkey") == F.col("c_nationkey"))


_O = "o as (select * from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey)"


@query(f"""with {_O} select o_orderkey, case when c_mktsegment = 'MACHINERY' then 'place missing or generic' when o_orderpriority = '1-URGENT' then 'place ambiguous without department' when c_acctbal < 0 then 'place not found'
  when c_nationkey % 5 <> o_orderkey % 5 and o_orderkey % 5 <> 0 then 'departments differ' when o_orderstatus = 'P' then 'no municipality code' end as reason from o""")
def publishable_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = orders_as_events(spark, sf_dir)
    code = lambda c: F.lpad((c % 5).cast("string"), 2, "0")
    claimed = F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(code(F.col("o_orderkey")))
    found = ~(F.col("c_acctbal") < 0)
    name = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("Plusieurs communes")).otherwise(F.col("c_name"))
    resolved = code(F.col("c_nationkey"))
    reason = guard.publishable_reason(name, found, F.col("o_orderpriority") == "1-URGENT", claimed, resolved, F.when(F.col("o_orderstatus") != "P", resolved), {f"0{i}": f"0{i}" for i in range(5)})
    return e.select("o_orderkey", reason.alias("reason"))


_LINE = "{'d': l_shipdate, 'o': l_orderkey, 'n': l_linenumber, 'q': l_quantity, 'e': l_extendedprice, 'x': l_discount, 't': l_tax, 'r': l_returnflag, 's': l_linestatus, 'p': l_partkey, 'u': l_suppkey}"
_SEQ = ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_partkey", "l_suppkey"]


@query(f"""with j as (select o_orderkey, l_quantity < 5 as denied, l_discount > 0.08 as temp, {_LINE} as seq from orders join lineitem on l_orderkey = o_orderkey),
r as (select o_orderkey, case when denied then 'denied' when temp then 'temporary' end as reason, seq from j),
a as (select o_orderkey, bool_or(reason is null) as ok, arg_min(reason, seq) as reason from r group by 1)
select o_orderkey, reason from a where not ok""")
def guard_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    reason = guard.first_reason((F.col("l_quantity") < 5, "denied"), (F.col("l_discount") > 0.08, "temporary"))
    judged = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.struct(*_SEQ).alias("source_pos"), reason.alias("reason"))
    return guard.quarantine(o, judged)[1].select(F.col("id").alias("o_orderkey"), "reason")


@query(f"""with l as (select l_partkey, l_suppkey, {_LINE} as seq, l_quantity::int % 6 as rel, nullif(l_returnflag, 'N') as flag, nullif(l_tax, 0.0) as tax, case l_linestatus when 'F' then 'confirmed' else 'project' end as status,
  case when l_discount > 0.05 then l_returnflag end as temporal, case when l_quantity > 10 then l_shipdate::date end as day, l_tax > 0.04 as approx from lineitem)
select l_partkey, l_suppkey, case when count(*) = 1 then max(rel) else max(coalesce(rel, 0)) end::int as rel, arg_min(flag, seq) filter (where flag is not null) as flag, arg_min(tax, seq) filter (where tax is not null) as tax,
  case when bool_or(status = 'confirmed') then 'confirmed' else arg_min(status, seq) end as status, arg_max(temporal, seq) filter (where temporal is not null) as temporal, (arg_min(day, seq) filter (where day is not null))::varchar as day,
  case when count(*) = 1 then bool_or(approx) when count(day) > 0 then coalesce(arg_min(approx, seq) filter (where day is not null), false) else bool_or(coalesce(approx, false)) end as approx from l group by 1, 2""")
def evidence_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", F.struct(*_SEQ).alias("seq"), (F.col("l_quantity").cast("int") % 6).alias("rel"), F.nullif("l_returnflag", F.lit("N")).alias("flag"), F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        F.when(F.col("l_linestatus") == "F", "confirmed").otherwise("project").alias("status"), F.when(F.col("l_discount") > 0.05, F.col("l_returnflag")).alias("temporal"), F.when(F.col("l_quantity") > 10, F.to_date("l_shipdate")).alias("day"), (F.col("l_tax") > 0.04).alias("approx"),
    )
    out = merge.evidence(line, ["l_partkey", "l_suppkey"], "seq", identity=[], attributes=["flag", "tax"], reliability="rel", status="status", temporal="temporal", day="day", approximate="approx")
    return out.withColumn("day", F.col("day").cast("string"))


@query("""with s as (select l_orderkey, l_suppkey, min(l_linenumber) as line from lineitem group by 1, 2)
select l_orderkey, string_agg(l_suppkey || ':' || line, ',' order by l_suppkey) as sources, count(*)::bigint as n_sources from s group by 1""")
def sources_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    first = merge.source_set(line.withColumn("seq", F.col("l_linenumber")), "l_orderkey", "l_suppkey", "seq")
    nested = rollup.nested_sources(first, "l_orderkey", ["l_suppkey", "l_linenumber"])
    items = F.from_json("sources", "array<struct<l_suppkey:int,l_linenumber:int>>")
    return nested.select("l_orderkey", F.array_join(F.transform(items, lambda x: F.concat_ws(":", x["l_suppkey"], x["l_linenumber"])), ",").alias("sources"), "n_sources")


@query("""select user_id, arg_max(event_type, {'t': ts, 'e': event_id}) as event_type, arg_max(value, {'t': ts, 'e': event_id}) as value, min(event_id) as first_id from events group by 1""")
def last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "value", F.col("event_id").alias("first_id"), F.struct("ts", "event_id").alias("seq"))
    return merge.last_write_wins(e, ["user_id"], "seq", ["first_id"]).select("user_id", "event_type", "value", "first_id")


@query("""select user_id, arg_max(event_type, {'t': ts, 'e': event_id}) filter (where event_type <> 'view') as bank, arg_max(props, {'t': ts, 'e': event_id}) as text, max(value) as score from events group by 1""")
def signal_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.nullif("event_type", F.lit("view")).alias("bank"), F.col("props").alias("text"), F.col("value").alias("score"), F.struct("ts", "event_id").alias("seq"))
    return merge.signal_merge(e, ["user_id"], "seq", last_known=["bank"], last=["text"], highest=["score"])


@query("""select o_custkey, o_orderpriority, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey, o_orderpriority order by o_totalprice desc, o_orderkey) as rn from orders) where rn = 1""")
def best_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.best_per_key(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"], F.desc("o_totalprice"), F.col("o_orderkey")).select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")


@query(f"""with {_O}, p as (select n_name as department, count(*) filter (where o_orderstatus = 'F')::bigint as n_precise from o where o_orderstatus <> 'O' group by 1),
u as (select n_name as department, c_mktsegment as b, c_name as pl from o where o_orderstatus = 'O' and o_orderpriority = '1-URGENT'), un as (select department, count(*)::bigint as n_unlocated from u group by 1),
an as (select n_name as department, sum(month(o_orderdate))::bigint as n_announced from o where o_orderstatus = 'O' and o_orderpriority = '5-LOW' group by 1),
s as (select n_name as department, c_mktsegment as b, c_name as pl, o_orderkey as seq from o where o_orderstatus = 'O' and o_orderpriority not in ('1-URGENT', '5-LOW')),
lone as (select b, pl, arg_min(department, seq) as department from s where not exists (select 1 from u where u.b = s.b and u.pl = s.pl) group by 1, 2), ln as (select department, count(*)::bigint as n_signals from lone group by 1),
k as (select department from p union select department from un union select department from an union select department from ln)
select department, coalesce(n_precise, 0) as n_precise, coalesce(n_unlocated, 0) as n_unlocated, coalesce(n_announced, 0) as n_announced, coalesce(n_signals, 0) as n_signals, coalesce(n_precise, 0) + coalesce(n_unlocated, 0) + coalesce(n_announced, 0) + coalesce(n_signals, 0) as estimate
from k left join p using (department) left join un using (department) left join an using (department) left join ln using (department)""")
def tiered_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order has a tier: settled ones are located or not, open ones by their priority."""
    e = orders_as_events(spark, sf_dir).select(F.col("n_name").alias("department"), F.col("c_mktsegment").alias("bank_key"), F.col("c_name").alias("place_key"), "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    located = F.when(F.col("o_orderstatus") == "F", F.lit(1.0))
    precise = e.filter("o_orderstatus <> 'O'").select("department", located.alias("lat"), located.alias("lon"))
    open_ = e.filter("o_orderstatus = 'O'")
    announced = open_.filter("o_orderpriority = '5-LOW'").select("department", F.month("o_orderdate").alias("n"))
    signals = open_.filter("o_orderpriority not in ('1-URGENT', '5-LOW')").withColumn("seq", F.col("o_orderkey"))
    return rollup.department_estimate(precise, open_.filter("o_orderpriority = '1-URGENT'"), announced, signals)


def events_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_sources"))
    region = F.broadcast(table(spark, sf_dir, "region"))  # 5 regions
    return orders_as_events(spark, sf_dir).join(region, F.col("r_regionkey") == F.col("n_regionkey")).join(lines, "o_orderkey", "left").withColumn("n_sources", F.coalesce("n_sources", F.lit(0)))


_R = f"{_O}, ls as (select l_orderkey, count(*) as n from lineitem group by 1), e as (select o.*, r_name, coalesce(ls.n, 0) as n_sources from o join region on r_regionkey = n_regionkey left join ls on l_orderkey = o_orderkey)"


@query(f"""with {_R} select r_name, sum(greatest(1, n_sources))::bigint as n_articles, count(*) filter (where o_orderstatus = 'F')::bigint as "n_F", count(*) filter (where o_orderstatus = 'O')::bigint as "n_O", count(*) filter (where o_orderstatus = 'P')::bigint as "n_P",
  array_to_string(list_sort(list(distinct o_orderstatus)), ',') as kinds, count(distinct n_name)::bigint as n_departments from e group by 1""")
def region_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.by_region(events_by_region(spark, sf_dir), "r_name", "n_name", "o_orderstatus", "n_sources", ["F", "O", "P"])


@query(f"""with {_R} select r_name, n_name, c_mktsegment, count(*)::bigint as n_events, sum(greatest(1, n_sources))::bigint as n_articles, (3 - bit_count(grouping_id(r_name, n_name, c_mktsegment)))::int as depth from e group by rollup (r_name, n_name, c_mktsegment)""")
def hierarchy_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.drill(events_by_region(spark, sf_dir), ["r_name", "n_name", "c_mktsegment"], "n_sources")


@query(f"""with {_O}, f as (select * from o where c_mktsegment = 'BUILDING' and o_totalprice >= 50000 and contains(strip_accents(lower(c_name || ' ' || n_name)), 'nation') and (o_orderdate is null or o_orderdate::date between date '1995-01-01' and date '1998-12-31'))
select count(*) filter (where o_orderstatus = 'F' and o_orderpriority <> '5-LOW')::bigint as n_confirmed, count(*) filter (where o_orderstatus = 'P')::bigint as n_projects, count(*) filter (where o_orderpriority = '5-LOW')::bigint as n_fusions, count(*) filter (where o_orderstatus = 'O')::bigint as n_rumours, count(distinct n_name)::bigint as n_departments from f""")
def kpi_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = orders_as_events(spark, sf_dir).withColumn("day", F.to_date("o_orderdate"))
    f = rollup.facet(e, equal={"c_mktsegment": "BUILDING", "o_orderstatus": None}, least={"o_totalprice": 50000}, words=(["c_name", "n_name"], "Nâtion"), period=("day", F.lit("1995-01-01").cast("date"), F.lit("1998-12-31").cast("date")))
    return rollup.kpi(f, confirmed=F.col("o_orderstatus") == "F", project=F.col("o_orderstatus") == "P", fusion=F.col("o_orderpriority") == "5-LOW", rumour=F.col("o_orderstatus") == "O", department="n_name")


@query(f"""with {_O}, p as (select n_name, min(o_orderdate) as f, count(*) filter (where date_trunc('month', o_orderdate) = date '1995-01-01') as n from o group by 1)
select sum(n)::bigint as n_added, count(*) filter (where date_trunc('month', f) = date '1995-01-01')::bigint as n_new_departments from p""")
def added_this_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.added_in_month(orders_as_events(spark, sf_dir), "o_orderdate", "n_name", F.lit("1995-01-01").cast("date"))


@query("""select strftime(o_orderdate, '%Y-%m') as month, count(*)::bigint as n from orders group by 1""")
def month_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.months(table(spark, sf_dir, "orders"), "o_orderdate")


@query("""with m as (select max(o_orderdate)::date as m from orders) select o_orderpriority, count(*)::bigint as n from orders, m where o_orderdate::date between (date_trunc('month', m) - interval 5 month)::date and last_day(m) group by 1""")
def rolling_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.rolling_period(table(spark, sf_dir, "orders"), "o_orderdate", 6).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("""select c_mktsegment, count(*)::bigint as n from customer group by 1 order by n desc, c_mktsegment limit 3""")
def top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.top(table(spark, sf_dir, "customer"), "c_mktsegment", 3)


@query(f"""with {_R} select r_name, n_name, count(o_orderkey)::bigint as n from region join nation on n_regionkey = r_regionkey left join (select n_nationkey as k, o_orderkey from e where o_orderpriority = '1-URGENT' and o_totalprice > 400000) u on u.k = n_nationkey group by 1, 2""")
def zero_filled_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = orders_as_events(spark, sf_dir).filter("o_orderpriority = '1-URGENT' and o_totalprice > 400000").groupBy("n_nationkey").agg(F.count(F.lit(1)).alias("n"))
    dim = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    return rollup.zero_filled(dim, "n_nationkey", e).select("r_name", "n_name", "n")


@query("""with d as (select event_id, user_id, ts, event_type, value from events),
l as (select user_id, max(ts) as last from d where event_type = 'signup' group by 1),
r as (select d.*, l.last from d left join l using (user_id) where l.last is null or date_diff('day', l.last::date, date '2024-02-10') >= 14)
select event_id, user_id, 10 * value + case when event_type = 'purchase' then 50 else 0 end - case when event_type = 'error' then 40 else 0 end + case when value > 20 then 45 else 0 end as priority from r order by priority desc, ts desc, event_id limit 25""")
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    reviews = e.filter("event_type = 'signup'").select(F.col("user_id").alias("id"), F.col("ts").alias("reviewed_at"))
    due = reconcile.due_for_review(e.withColumn("id", F.col("user_id")), reviews, F.lit("2024-02-10").cast("date"), 14)
    none = F.lit(False)
    p = reconcile.priority(F.col("value"), local=F.col("event_type") == "purchase", legal=F.col("event_type") == "error", closure=F.col("value") > 20, plan=none, place=none)
    return reconcile.review_queue(due.withColumn("priority", p), 25, F.desc("priority"), F.desc("ts"), F.col("event_id")).select("event_id", "user_id", "priority")


@query(f"""with {_O}, ev as (select o_orderkey as event_id, c_mktsegment as bank, o_orderpriority as kind, lower(c_name) as p1, lower(c_mktsegment) as p2, n_name as dep, (o_totalprice / 100000)::int as rel, o_orderdate as created from o where c_acctbal > 0 and o_orderstatus = 'F'),
lo as (select event_id, bank, kind, p1 as pl, dep, rel, created from ev union all select event_id, bank, kind, p2, dep, rel, created from ev where p1 <> p2),
qr as (select o_orderkey as id, c_mktsegment as bank, o_orderpriority as kind, lower(c_name) as pl, case when o_totalprice > 100000 then n_name end as dep from o where o_orderstatus <> 'F'),
j as (select id, event_id, row_number() over (partition by id order by rel desc, created, event_id) as rn from qr join lo on qr.bank = lo.bank and qr.kind = lo.kind and trim(regexp_replace(qr.pl, '[^a-z0-9]+', ' ', 'g')) = trim(regexp_replace(lo.pl, '[^a-z0-9]+', ' ', 'g')) where qr.dep is null or lo.dep is null or qr.dep = lo.dep)
select id, event_id from j where rn = 1""")
def reconcile_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = orders_as_events(spark, sf_dir)
    events = e.filter("c_acctbal > 0 and o_orderstatus = 'F'").select(F.col("o_orderkey").alias("event_id"), F.col("c_mktsegment").alias("bank"), F.col("o_orderpriority").alias("kind"), F.col("c_name").alias("place"), F.lit(None).cast("string").alias("original_place"), F.col("c_mktsegment").alias("branch"), F.col("n_name").alias("department"), F.lit(1.0).alias("lat"), F.lit(1.0).alias("lon"), F.lit("x").alias("code"), F.round(F.col("o_totalprice") / 100000).cast("int").alias("reliability"), F.col("o_orderdate").alias("created_at"))
    rows = e.filter("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("id"), F.col("c_mktsegment").alias("bank"), F.col("o_orderpriority").alias("kind"), F.col("c_name").alias("place"), F.when(F.col("o_totalprice") > 100000, F.col("n_name")).alias("department"), F.lit(None).cast("string").alias("resolved"))
    return reconcile.resolved_quarantine(rows, events)


@query("""with p as (select c_nationkey, c_custkey, s_suppkey, radians(c_custkey % 80) as a, radians(c_custkey % 170) as b, radians(s_suppkey % 80) as c, radians(s_suppkey % 170) as d from customer join supplier on s_nationkey = c_nationkey),
m as (select *, 2 * 6371000 * asin(sqrt(least(1.0, pow(sin((c - a) / 2), 2) + cos(a) * cos(c) * pow(sin((d - b) / 2), 2)))) as m from p)
select c_custkey, count(*)::bigint as n_near, round(min(m), 3) as nearest_m from m where m < 3000000 group by 1""")
def geo_distance_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("k"), (F.col("c_custkey") % 80).alias("lat1"), (F.col("c_custkey") % 170).alias("lon1"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("k"), (F.col("s_suppkey") % 80).alias("lat2"), (F.col("s_suppkey") % 170).alias("lon2"))
    m = geo.near_points(c, s, 3_000_000, ("lat1", "lon1"), ("lat2", "lon2"), on=["k"], out="m")
    return m.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n_near"), F.round(F.min("m"), 3).alias("nearest_m"))


@query()
def near_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.near_names(table(spark, sf_dir, "part").select("p_name"), "p_name")


@query("""with n as (select distinct p_name from part where length(p_name) >= 5) select least(a.p_name, b.p_name) as a, greatest(a.p_name, b.p_name) as b from n a join n b on a.p_name <> b.p_name and contains(a.p_name, b.p_name)""")
def contained_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select("p_name").filter(F.length("p_name") >= 5).distinct()
    return similarity.candidates(names, "p_name").filter("contains(a, b) or contains(b, a)")


@query("""with b as (select distinct p_brand as brand from part), n as (select n_name as place from nation), t as (select unnest(['"{brand}" {place} fermeture', '{brand} agence {place}', 'site:example.org {brand} {place}']) as pattern, unnest([0, 1, 0]) as pos, unnest([0, 0, 1]) as is_site),
q as (select brand, place, replace(replace(pattern, '{brand}', brand), '{place}', place) as query, 2 * pos + is_site as rank from b, n, t)
select brand, place, query, rank::int as rank from (select *, row_number() over (partition by brand, place order by rank, query) as rn from q) where rn <= 2""")
def query_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand")).distinct()
    nations = F.broadcast(table(spark, sf_dir, "nation").select(F.col("n_name").alias("place")))  # 25 nations
    templates = spark.createDataFrame([('"{brand}" {place} fermeture', 0, False), ("{brand} agence {place}", 1, False), ("site:example.org {brand} {place}", 0, True)], "pattern string, pos int, is_site boolean")
    return select.queries_of(brands.crossJoin(nations), ["brand", "place"], templates, 2)


@query(f"""with {_O}, l as (select l_orderkey, max(l_tax) as t, count(*) as n from lineitem group by 1)
select 'high' as severity, 'not_publishable' as kind, count(*)::bigint as n from o where c_acctbal < 0 union all
select 'medium', 'no_source', count(*)::bigint from o left join l on l_orderkey = o_orderkey where n is null union all
select 'low', 'suspicious', count(*)::bigint from o join l on l_orderkey = o_orderkey where t >= 0.08""")
def audit_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = orders_as_events(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_tax").alias("t"), F.count(F.lit(1)).alias("n"))
    j = e.join(lines, "o_orderkey", "left")
    kinds = F.array_compact(F.array(F.when(F.col("c_acctbal") < 0, F.struct(F.lit("high").alias("severity"), F.lit("not_publishable").alias("kind"))), F.when(F.col("n").isNull(), F.struct(F.lit("medium").alias("severity"), F.lit("no_source").alias("kind"))), F.when(F.col("t") >= 0.08, F.struct(F.lit("low").alias("severity"), F.lit("suspicious").alias("kind")))))
    return j.select(F.inline(kinds)).groupBy("severity", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("""with r as (select unnest(['5-low', 'urgent', 'medium']) as pattern, unnest([1, 2, 3]) as pos, unnest(['low', null, 'mid']) as rel, unnest(['site', 'press', null]) as flag)
select o_orderkey, coalesce((select arg_max(rel, pos) from r where rel is not null and contains(lower(o_orderpriority), pattern)), 'high') as rel, (select arg_max(flag, pos) from r where flag is not null and contains(lower(o_orderpriority), pattern)) as flag from orders""")
def override_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame([("5-LOW", 1, "low", "site"), ("urgent", 2, None, "press"), ("Medium", 3, "mid", None)], "pattern string, rule_pos int, rel string, flag string")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return coverage.override(o, "o_orderkey", "o_orderpriority", rules, {"rel": "high", "flag": None}).select("o_orderkey", "rel", "flag")


@query("""select c_custkey, substr(sha256(coalesce(c_name, '') || '|' || coalesce(c_mktsegment, '')), 1, 16) as id, greatest(0, least(5, round_even(c_acctbal / 10000 * 5, 0)::int)) as reliability from customer""")
def content_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", keys.content_id("c_name", "c_mktsegment").alias("id"), numbers.reliability(F.col("c_acctbal") / 10000).alias("reliability"))


@query("""select distinct c_mktsegment as facet from customer order by 1""")
def facet_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("facet")).distinct().orderBy("facet")


@query("""select min(c_custkey % 170)::bigint as west, min(c_custkey % 80)::bigint as south, max(c_custkey % 170)::bigint as east, max(c_custkey % 80)::bigint as north from customer where c_acctbal > 0""")
def bounding_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select((F.col("c_custkey") % 170).alias("lon"), (F.col("c_custkey") % 80).alias("lat"))
    return rollup.bounding_box(c, "lon", "lat")


@query("""select o_orderkey, o_orderdate::varchar as day from (select o_orderkey, o_orderdate::date as o_orderdate from orders where o_orderstatus <> 'P') order by o_orderdate desc, o_orderkey limit 10""")
def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("day"))
    return rollup.latest(o, 10, "day", "o_orderkey").withColumn("day", F.col("day").cast("string"))


@query("""select o_custkey, count(*)::bigint as n, (o_totalprice_max)::double as top_price, best::bigint as best_key from (select o_custkey, max(o_totalprice) as o_totalprice_max, arg_min(o_orderkey, {'c': -((o_orderstatus = 'F')::int + (o_totalprice > 100000)::int + (o_orderpriority <> '5-LOW')::int), 'k': o_orderkey}) as best, count(*) as c from orders group by 1) s join orders using (o_custkey) group by all""")
def most_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    score = rollup.completeness(F.col("o_orderstatus") == "F", F.col("o_totalprice") > 100000, F.col("o_orderpriority") != "5-LOW")
    first = merge.best_per_key(o.withColumn("score", score), ["o_custkey"], F.desc("score"), F.col("o_orderkey")).select("o_custkey", F.col("o_orderkey").alias("best_key"))
    return o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top_price")).join(first, "o_custkey").select("o_custkey", "n", "top_price", "best_key")


@query("""with r as (select greatest(date '1995-01-20', m::date) as lo, least((m + interval 1 month)::date, date '1995-06-11') as hi from (select unnest(generate_series(timestamp '1995-01-01', timestamp '1995-06-10', interval 1 month)) as m))
select lo::varchar as lo, hi::varchar as hi, count(o_orderkey)::bigint as n from r left join orders on o_orderdate >= lo and o_orderdate < hi group by 1, 2""")
def orders_per_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.dates import month_ranges

    ranges = month_ranges(spark, "1995-01-20", "1995-06-10").withColumn("m", F.trunc("lo", "MM"))
    o = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"), "o_orderkey").withColumn("m", F.trunc("d", "MM"))
    met = ranges.join(o, "m", "left").withColumn("inside", (F.col("d") >= F.col("lo")) & (F.col("d") < F.col("hi")))
    return met.groupBy(F.col("lo").cast("string").alias("lo"), F.col("hi").cast("string").alias("hi")).agg(F.count_if("inside").alias("n"))


@query("""select c_custkey, case when substr(p, 1, 2) in ('97', '98') then substr(p, 1, 3) when substr(p, 1, 2) = '20' then null else substr(p, 1, 2) end as department from (select c_custkey, lpad((c_custkey * 7919 % 99000)::varchar, 5, '0') as p from customer)""")
def postal_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.names import department_code

    p = F.lpad((F.col("c_custkey") * 7919 % 99000).cast("string"), 5, "0")
    return table(spark, sf_dir, "customer").select("c_custkey", department_code(None, p).alias("department"))


@query(f"""with {_R} select count(*)::bigint as n_regions, sum(n)::bigint as n_articles, max(d)::bigint as most_departments from (select r_name, sum(greatest(1, n_sources)) as n, count(distinct n_name) as d from e group by 1)""")
def article_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = rollup.by_region(events_by_region(spark, sf_dir), "r_name", "n_name", "o_orderstatus", "n_sources", [])
    return rollup.sort_regions(regions, "name", "r_name").agg(F.count(F.lit(1)).alias("n_regions"), F.sum("n_articles").alias("n_articles"), F.max("n_departments").alias("most_departments"))


@query("""with r as (select c_custkey, c_name as bank, c_mktsegment as place from customer), g as (select s_name, s_nationkey, s_suppkey from supplier)
select c_custkey, case when n = 0 then 'unknown' else s end as register_status from (select c_custkey, count(s_suppkey) as n, arg_min(s_suppkey::varchar, s_suppkey) as s from r left join g on lower(g.s_name) = replace(lower(r.bank), 'customer', 'supplier') group by 1)""")
def register_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.networks import administrative_status

    asked = table(spark, sf_dir, "customer").select("c_custkey", F.replace(F.lower("c_name"), F.lit("customer"), F.lit("supplier")).alias("bank"), F.lit("x").alias("place"))
    register = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.lit("X").alias("place"), F.col("s_suppkey").cast("string").alias("status"), F.col("s_suppkey").alias("rank"))
    return administrative_status(asked, register).select("c_custkey", "register_status")
