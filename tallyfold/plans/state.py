"""Queries over tables that are written by key, streams with state, searches in passes, and what is reconciled with the map."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators import coverage, frontier, reconcile, rollup, select, signals
from ..operators.keyed import KeyedTable
from ..sources.landing import fresh, written
from ..streaming import incremental, revisions
from ..functions.lexicon import Lexicon
from . import jobs
from .common import query, table


@query("""with l as (select o_custkey, arg_max(o_orderkey, s) as last_order, arg_max(o_totalprice, s) as last_price, arg_min(o_orderkey, {'b': case o_orderstatus when 'O' then 0 when 'F' then 1 else 2 end, 's': s}) as first_order from (select *, strftime(o_orderdate, '%Y%m%d') || lpad(o_orderkey::varchar, 12, '0') as s from orders) group by 1)
select c_custkey as custkey, last_order, last_price, first_order from customer left join l on o_custkey = c_custkey where c_acctbal >= 0""")
def keyed_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' last orders and the first that came: upserts in three batches that come in no order, inserts of the other customers, deletes of those in debt, and a batch that comes twice."""
    t = KeyedTable(spark, fresh(spark, "customers"), ["custkey"], buckets=16)
    o = table(spark, sf_dir, "orders").withColumn("seq", F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")))
    o = o.select(F.col("o_custkey").alias("custkey"), "seq", F.col("o_orderkey").alias("last_order"), F.col("o_totalprice").alias("last_price"), F.col("o_orderkey").alias("first_order"), "o_orderstatus")
    batches = [o.filter(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in ("O", "F", "P")]
    for i, rows in enumerate(batches):
        t.upsert(rows, "seq", keep_first=["first_order"], source="orders", batch=i)
    c = table(spark, sf_dir, "customer")
    none = F.lit(None)
    t.insert(c.select(F.col("c_custkey").alias("custkey"), F.lit("").alias("seq"), none.cast("long").alias("last_order"), none.cast("double").alias("last_price"), none.cast("long").alias("first_order")), "seq")
    t.delete(c.filter("c_acctbal < 0").select(F.col("c_custkey").alias("custkey")))
    t.upsert(batches[0], "seq", keep_first=["first_order"], source="orders", batch=0)  # known by its number
    t.upsert(batches[0], "seq", keep_first=["first_order"])  # not known, but no row of it is newer than what is there
    return t.read().drop("seq")


@query("""with d as (select distinct user_id, ts::date as day from events), f as (select user_id, min(day) as first, (select max(day) from d) as last from d group by 1),
g as (select user_id, first, unnest(generate_series(first, last - interval 1 day, interval 1 day))::date as day from f where first < last),
p as (select g.*, d.day is not null as there from g left join d on d.user_id = g.user_id and d.day = g.day),
i as (select *, sum(there::int) over (partition by user_id order by day) as island from p),
m as (select *, sum(1 - there::int) over (partition by user_id, island order by day)::bigint as missing from i),
b as (select *, lag(missing) over (partition by user_id order by day) as before from m)
select user_id, day, missing, case when day = first then 'new' when there and before > 0 then 'returned' when there then 'seen' when missing = 1 then 'missing' when missing = 2 then 'confirmed' else 'gone' end as change from b""")
def stream_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days on which each user is seen, as a stream in two parts with a restart between them."""
    e = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    mid = e.agg((F.min(F.unix_seconds("ts")) + (F.max(F.unix_seconds("ts")) - F.min(F.unix_seconds("ts"))) / 2).cast("long")).first()[0]
    path, checkpoint, log = fresh(spark, "days"), fresh(spark, "cp"), incremental.BatchLog(spark, fresh(spark, "revisions"))
    for early in (True, False):
        e.filter((F.unix_seconds("ts") < mid) == early).write.mode("append").parquet(path)
        revisions.run(incremental.read_files(spark, path, "user_id long, ts timestamp", per_batch=1000), "user_id", "ts", log, checkpoint)
    return log.read().select("user_id", "day", "missing", "change")


@query("""with recursive w as (
  select o_orderkey, o_custkey, o_orderdate, 0 as round from orders where o_orderpriority = '1-URGENT'
  union select b.o_orderkey, b.o_custkey, b.o_orderdate, w.round + 1 from w join orders b on b.o_custkey = w.o_custkey and b.o_orderdate > w.o_orderdate and b.o_orderdate <= w.o_orderdate + interval 60 day)
select o_orderkey, min(round)::int as round from w group by 1""")
def search_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From urgent orders to what the same customer orders within 60 days after, and on from there, until a pass finds nothing new."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    later = o.select(F.col("o_orderkey").alias("k"), "o_custkey", F.col("o_orderdate").alias("d"))

    def expand(found: DataFrame) -> DataFrame:
        met = found.drop("o_orderkey").join(later.hint("merge"), "o_custkey").filter("d > o_orderdate and d <= o_orderdate + interval 60 days")
        return met.select(F.col("k").alias("o_orderkey"), "o_custkey", F.col("d").alias("o_orderdate"))

    seeds = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(*o.columns)
    return frontier.passes(seeds, expand, ["o_orderkey"]).select("o_orderkey", "round")


_MAP = """l as (select c_custkey as id, c_mktsegment as bank, replace(lower(c_name), '#', ' ') as place, case when c_acctbal > 3000 then lower(c_mktsegment) || ' ' || substr(c_name, 16) end as label, n_name as dep, (c_custkey % 800)::double / 10 - 40 as lat, (c_custkey % 1700)::double / 10 - 85 as lon from customer join nation on n_nationkey = c_nationkey),
e as (select o_orderkey as seq, c_mktsegment as bank, case when o_orderpriority = '1-URGENT' then replace(lower(c_name), '#', ' ') else '' end as place, case when o_orderpriority = '2-HIGH' then replace(lower(c_name), '#', ' ') else '' end as original,
  case o_orderpriority when '3-MEDIUM' then 'branch ' || lower(c_mktsegment) || ' ' || substr(c_name, 16) || ' centre' when '4-NOT SPECIFIED' then substr(c_name, 15) else '' end as label, case when o_orderstatus <> 'O' then (c_custkey % 800)::double / 10 - 40 end as lat, case when o_orderstatus <> 'O' then (c_custkey % 1700)::double / 10 - 85 + case when o_orderstatus = 'P' then 1 else 0 end end as lon, o_orderdate
  from orders join customer on c_custkey = o_custkey where o_totalprice > 300000)"""


@query(f"""with {_MAP}, s as (select distinct bank, dep from l where lat > 35), j as (
  select l.*, e.seq, e.lat as elat, e.lon as elon, row_number() over (partition by l.id order by seq) as rn from l join e on l.bank = e.bank and (e.place = l.place or e.original = l.place or (e.label <> '' and e.label = coalesce(l.label, '')) or (length(e.label) >= 8 and coalesce(l.label, '') <> '' and (contains(e.label, l.label) or contains(l.label, e.label)))))
select l.id as listed_id, j.seq as event_seq, case when j.id is not null and elat is null then 'present_unlocated' when j.id is not null and 2 * 6371000 * asin(sqrt(least(1.0, pow(sin(radians(elat - l.lat) / 2), 2) + cos(radians(l.lat)) * cos(radians(elat)) * pow(sin(radians(elon - l.lon) / 2), 2)))) < 500 then 'exact' when j.id is not null then 'present_on_map'
  when s.bank is not null then 'present_department' else 'needs_research' end as status from l left join j on j.id = l.id and rn = 1 left join s on s.bank = l.bank and s.dep = l.dep""")
def map_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as listed branches held against large orders as events, by place, original place and label, and within 500 m."""
    c = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("n_nationkey") == F.col("c_nationkey"))  # 25 nations
    name, number = F.replace(F.lower("c_name"), F.lit("#"), F.lit(" ")), F.substr("c_name", F.lit(16))
    label = F.concat_ws(" ", F.lower("c_mktsegment"), number)
    lat, lon = (F.col("c_custkey") % 800).cast("double") / 10 - 40, (F.col("c_custkey") % 1700).cast("double") / 10 - 85
    listed = c.select(F.col("c_custkey").alias("listed_id"), F.col("c_mktsegment").alias("bank_key"), name.alias("place_key"), F.when(F.col("c_acctbal") > 3000, label).otherwise(F.lit("")).alias("label_key"), F.col("n_name").alias("department"), lat.alias("lat"), lon.alias("lon"))
    o = table(spark, sf_dir, "orders").filter("o_totalprice > 300000").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    p, there = F.col("o_orderpriority"), F.col("o_orderstatus") != "O"
    its = F.when(p == "3-MEDIUM", F.concat_ws(" ", F.lit("branch"), label, F.lit("centre"))).when(p == "4-NOT SPECIFIED", F.substr("c_name", F.lit(15))).otherwise(F.lit(""))
    events = written(o.select(F.col("o_orderkey").alias("event_seq"), F.col("c_mktsegment").alias("bank_key"), F.when(p == "1-URGENT", name).otherwise(F.lit("")).alias("e_place"), F.when(p == "2-HIGH", name).otherwise(F.lit("")).alias("e_original"), its.alias("e_label"), F.when(there, lat).alias("e_lat"), F.when(there, lon + F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("e_lon")), "map-events")
    return coverage.on_map(listed, events, listed.filter("lat > 35").select("bank_key", "department"))


_DEPARTMENTS = {"01": "NATION_0", "02": "NATION_1", "2A": "Nation_2", "04": "nation-3"}
_DEP = "case regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g') when 'nation 0' then '01' when 'nation 1' then '02' when 'nation 2' then '2A' when 'nation 3' then '04' else case when upper({0}) in ('01', '02', '2A', '04') then upper({0}) else regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g') end end"


@query(f"""with o as (select *, o_custkey // 3 as page from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey),
ev as (select o_orderkey as event_id, lower(c_mktsegment) as bank, {_DEP.format('n_name')} as dep, regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g') as place, case when o_totalprice > 200000 then 'agence ' || lower(c_mktsegment) || ' ' || n_nationkey end as branch, (o_totalprice / 100000)::int as rel, o_orderdate as created, page from o where o_orderstatus = 'F' and c_acctbal > 0),
lo as (select *, place as loc from ev union select *, branch as loc from ev where branch is not null),
sg as (select o_orderkey as id, lower(c_mktsegment) as bank, case when o_totalprice < 150000 then {_DEP.format("case when n_nationkey = 2 then '2a' else n_name end")} end as dep, page, ' ' || trim(regexp_replace(lower('Fermeture: ' || c_name || ', ' || 'l''Agence ' || c_mktsegment || ' ' || n_nationkey || ' ' || o_orderpriority), '[^a-z0-9]+', ' ', 'g')) || ' ' as t from o where o_orderstatus <> 'F'),
j as (select id, event_id, row_number() over (partition by id order by rel desc, created, event_id) as rn from sg join lo on sg.bank = lo.bank and sg.page = lo.page where (sg.dep is null or lo.dep is null or sg.dep = lo.dep) and contains(t, ' ' || loc || ' '))
select id, event_id from j where rn = 1""")
def reconcile_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders as review records, settled by finished ones that share a page, a brand under any of its names, a department by code or name, and a place or branch that the text names."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(table(spark, sf_dir, "nation")), F.col("n_nationkey") == F.col("c_nationkey"))  # 25 nations
    o = written(o.withColumn("url", F.concat(F.lit("https://press.example/"), F.floor(F.col("o_custkey") / 3).cast("string"))), "reconcile-orders")
    aliases = names.alias_table(spark, {"AUTOMOBILE": ["cars", "automobile"], "BUILDING": ["building"], "FURNITURE": ["furniture"], "HOUSEHOLD": ["household"], "MACHINERY": ["machinery"]})
    number, one = F.col("n_nationkey").cast("string"), F.lit(1.0)
    branch = F.when(F.col("o_totalprice") > 200000, F.concat_ws(" ", F.lit("Agence"), "c_mktsegment", number))
    done = o.filter("o_orderstatus = 'F'").withColumn("event_id", F.col("o_orderkey"))
    events = done.select("event_id", F.col("c_mktsegment").alias("bank"), F.col("n_name").alias("department"), F.lit("closure").alias("kind"), F.col("c_name").alias("place"), F.lit(None).cast("string").alias("original_place"), branch.alias("branch"), F.when(F.col("c_acctbal") > 0, one).alias("lat"), one.alias("lon"), F.lit("x").alias("code"), F.round(F.col("o_totalprice") / 100000).cast("int").alias("reliability"), F.col("o_orderdate").alias("created_at"))
    open_ = o.filter("o_orderstatus <> 'F'")
    bank = F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Cars").otherwise(F.initcap("c_mktsegment"))
    department = F.when(F.col("o_totalprice") < 150000, F.when(F.col("n_nationkey") == 2, "2a").otherwise(F.col("n_name")))
    signals = open_.select(F.col("o_orderkey").alias("id"), bank.alias("bank"), department.alias("department"), F.concat(F.lit("Fermeture: "), "c_name").alias("title"), F.concat(F.lit(", l'Agence "), "c_mktsegment", F.lit(" "), number).alias("excerpt"), F.col("o_orderpriority").alias("reason"), F.concat("url", F.lit("/")).alias("url"), F.lit(None).cast("long").alias("resolved"))
    return reconcile.resolved_signals(signals, events, done.select("event_id", "url"), aliases, _DEPARTMENTS)


@query("""with l as (select l_orderkey, l_discount, (l_linenumber = 6)::int as r1, (l_returnflag = 'R')::int as r2, (l_discount * 11 > 1)::int as r3 from lineitem),
n as (select l_orderkey, count(*) filter (where r1 + r2 + r3 = 0) as good, coalesce(sum(l_discount * 11) filter (where r1 + r2 + r3 = 0), 0) as conf, count(*) filter (where r1 + r2 + r3 > 0) as bad, sum(r1 + r2 + r3) as reasons from l group by 1)
select o_orderkey, (o_orderstatus <> 'P' and o_orderpriority <> '5-LOW' and o_totalprice <= 400000) as valid, o_orderstatus = 'P' as corrupt, case when o_orderstatus = 'P' then 0 else good end::bigint as n_closures, round(case when o_orderstatus = 'P' then 0 else conf end, 4) as confidence, case when o_orderstatus = 'P' then 0 else bad end::bigint as n_rejected,
  case when o_orderstatus = 'P' then 1 else reasons + (o_orderpriority = '5-LOW')::int + (o_totalprice > 400000)::int end::bigint as n_reasons from orders join n on l_orderkey = o_orderkey""")
def validated_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as extraction results in JSON, their lines as closures: what each keeps, rejects and why; pending orders are cut off and no JSON."""
    line = F.struct(F.when(F.col("l_linenumber") != 6, F.concat(F.lit("B"), F.col("l_suppkey").cast("string"))).alias("bank"), F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("commune"), names.lookup(F.col("l_returnflag"), {"A": "announced", "N": "confirmed", "R": "gone"}).alias("status"), names.lookup(F.col("l_linestatus"), {"F": "closure", "O": "transfer"}).alias("closure_type"), (F.col("l_discount") * 11).alias("confidence"))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("closures"))  # a handful of lines an order
    o = table(spark, sf_dir, "orders").join(lines.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    whole = F.to_json(F.struct(F.when(F.col("o_orderpriority") == "5-LOW", "other").otherwise("list_closures").alias("article_type"), (F.col("o_totalprice") / 400000).alias("confidence"), "closures"))
    o = o.withColumn("result", F.when(F.col("o_orderstatus") == "P", F.substr(whole, F.lit(1), F.length(whole) - 2)).otherwise(whole))
    checked = signals.validated(o.select("o_orderkey", "result"), "result")
    rejected = F.size(F.filter("rejected", lambda x: x["field"].isNotNull())).cast("long")
    reasons = F.aggregate("rejected", F.lit(0).cast("long"), lambda a, x: a + F.size(x["reasons"]))
    total = F.aggregate("parsed.closures", F.lit(0.0), lambda a, x: a + x["confidence"])
    return checked.select("o_orderkey", "valid", F.col("corrupt").isNotNull().alias("corrupt"), F.size("parsed.closures").cast("long").alias("n_closures"), F.round(total, 4).alias("confidence"), rejected.alias("n_rejected"), reasons.alias("n_reasons"))


def _facet_sql(name: str, condition: str) -> str:
    return f"""select '{name}' as facet, department, grouping(department) = 1 as is_total, coalesce(sum(w) filter (where tier = 'precise'), 0)::bigint as n_precise, coalesce(sum(w) filter (where tier = 'unlocated'), 0)::bigint as n_unlocated, coalesce(sum(w) filter (where tier = 'announced'), 0)::bigint as n_announced, coalesce(sum(w) filter (where tier = 'signal'), 0)::bigint as n_signals, coalesce(sum(w), 0)::bigint as estimate
  from (select department, tier, case tier when 'announced' then n when 'precise' then located else 1 end as w from ev where tier <> 'signal' and {condition}
    union all select arg_min(department, seq), 'signal', 1 from ev where tier = 'signal' and {condition} and not exists (select 1 from ev as u where u.tier = 'unlocated' and u.bank = ev.bank and u.place = ev.place and u.{condition}) group by bank, place) group by rollup (department)"""


_FACETS = {"all": "seq >= 0", "bank": "bank = 'MACHINERY'", "since": "day >= date '1997-01-01'"}


@query(f"""with ev as (select case when o_orderstatus <> 'O' then 'precise' when o_orderpriority = '1-URGENT' then 'unlocated' when o_orderpriority = '5-LOW' then 'announced' else 'signal' end as tier, n_name as department, c_mktsegment as bank, c_name as place, month(o_orderdate) as n, o_orderkey as seq, (o_orderstatus = 'F')::int as located, o_orderdate::date as day from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey)
{" union all ".join(_facet_sql(k, c) for k, c in _FACETS.items())}""")
def facet_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates by department with the national total, for all orders, one segment, and orders since a day."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(table(spark, sf_dir, "nation")), F.col("n_nationkey") == F.col("c_nationkey"))  # 25 nations
    tier = F.when(F.col("o_orderstatus") != "O", "precise").when(F.col("o_orderpriority") == "1-URGENT", "unlocated").when(F.col("o_orderpriority") == "5-LOW", "announced").otherwise("signal")
    at = F.when(F.col("o_orderstatus") == "F", F.lit(1.0))
    evidence = o.select(tier.alias("tier"), F.col("n_name").alias("department"), F.col("c_mktsegment").alias("bank_key"), F.col("c_name").alias("place_key"), F.month("o_orderdate").alias("n"), F.col("o_orderkey").alias("seq"), at.alias("lat"), at.alias("lon"), F.to_date("o_orderdate").alias("day"))
    evidence = written(evidence, "evidence")  # three facets read it
    facets = {"all": None, "bank": F.col("bank_key") == "MACHINERY", "since": F.col("day") >= F.lit("1997-01-01").cast("date")}
    out = None
    for name, facet in facets.items():
        part = rollup.facet_estimates(evidence, facet).withColumn("facet", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


_STOPS = "[" + ", ".join(f"'{w}'" for w in select.STOP_WORDS) + "]"


@query(f"""with p as (select page_id, url, regexp_extract(url, '://([^/?#]*)', 1) as host, regexp_extract(url, '://[^/]*/([a-z]*)', 1) as path, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) as title from pages),
q as (select host, arg_min(title, page_id) as title from p group by 1), f as (select min(host) as d from p),
a as (select host, host as domain, 0 as d, list_filter(string_split(trim(regexp_replace(strip_accents(lower(title)), '[^a-z0-9]+', ' ', 'g')), ' '), lambda t: length(t) >= 3 and not list_contains({_STOPS}, t)) as tokens from q),
b as (select * from a union all select host, f.d, 1, tokens from a, f where f.d <> host),
e as (select *, trim(regexp_replace(strip_accents(lower(url || ' ' || title)), '[^a-z0-9]+', ' ', 'g')) as k, row_number() over (partition by host, path order by page_id, url) as pos from p),
m as (select b.host, e.url, min({{'d': b.d, 'path': e.path, 'pos': e.page_id, 'u': e.url}}) as place from b join e on e.host = b.domain where e.pos <= 50 and len(tokens) > 0 and len(list_filter(tokens, lambda t: contains(k, t))) / len(tokens)::double >= 0.6 group by 1, 2),
r as (select host, url, row_number() over (partition by host order by place) as rank from m)
select host as query_id, rank::int as rank, url from r where rank <= 5""")
def site_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each host a search on it and on the first host of all for the words of its first page's title; paths are the pages' languages."""
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    p = written(table(spark, sf_dir, "pages").select("page_id", "url", F.regexp_extract("url", "://([^/?#]*)", 1).alias("domain"), F.regexp_extract("url", "://[^/]*/([a-z]*)", 1).alias("path"), F.col("page_id").alias("pos"), title.alias("title")), "entries")
    queries = p.groupBy(F.col("domain").alias("query_id")).agg(F.min_by("title", "page_id").alias("_t"))
    queries = queries.select("query_id", F.concat(F.lit("site:"), "query_id", F.lit(" "), "_t").alias("query"))
    first = p.agg(F.min("domain")).first()[0]
    return select.site_search(queries, p, [first] if first is not None else [], per_path=50, k=5)


@query("""with o as (select *, 'https://list.example/' || c_custkey as url from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey),
t as (select url, count(*) as n from o where o_orderpriority = '1-URGENT' and o_orderstatus = 'F' group by 1),
r as (select url, any_value(c_acctbal) as bal, count(*) filter (where o_orderpriority = '2-HIGH') as closures, count(*) filter (where o_orderpriority = '5-LOW') as told from o where o_orderstatus = 'O' group by 1),
s as (select 'https://list.example/' || c_custkey as url, c_nationkey, case when t.n > 1 then 'targets' when r.closures > 0 and r.bal >= 0 then 'extracted' when t.n = 1 then 'single target' when r.told > 0 and r.bal >= 0 then 'signals' else 'absent' end as stage from customer left join t on t.url = 'https://list.example/' || c_custkey left join r on r.url = 'https://list.example/' || c_custkey),
e as (select s.url, stage, 'x' || o_orderkey as label, n_nationkey from s join o using (url) where (stage in ('targets', 'single target') and o_orderpriority = '1-URGENT' and o_orderstatus = 'F') or (stage = 'extracted' and o_orderpriority = '2-HIGH' and o_orderstatus = 'O'))
select s.url, s.stage, count(distinct label)::bigint as n_events, count(distinct label) filter (where n_nationkey >= 20)::bigint as n_not_found from s left join e on e.url = s.url group by 1, 2""")
def curated_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as curated articles: urgent finished orders are their targets, open ones the results of extraction (in debt: no valid one); which stage settles each, and its events."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(table(spark, sf_dir, "nation")), F.col("n_nationkey") == F.col("c_nationkey"))  # 25 nations
    url = F.concat(F.lit("https://list.example/"), F.col("c_custkey").cast("string"))
    o = written(o.withColumn("url", url).withColumn("label", F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))), "curated-orders")
    articles = table(spark, sf_dir, "customer").select(url.alias("url"), F.col("c_name").alias("title"), F.lit("").alias("text"), F.lit("2026-01-01").alias("date"))
    targets = o.filter("o_orderpriority = '1-URGENT' and o_orderstatus = 'F'").select("url", F.col("c_mktsegment").alias("bank"), F.col("n_name").alias("place"), F.lit(None).cast("string").alias("department"), "label", F.to_date("o_orderdate").alias("closed_on"))
    closure = F.when(F.col("o_orderpriority") == "2-HIGH", F.struct(F.col("c_mktsegment").alias("bank"), F.col("label").alias("agency_label"), F.col("n_name").alias("commune"), F.lit("announced").alias("status"), F.lit("closure").alias("closure_type"), F.lit(0.5).alias("confidence")))
    signal = F.when(F.col("o_orderpriority") == "5-LOW", F.struct(F.col("c_mktsegment").alias("bank"), F.col("o_orderpriority").alias("evidence")))
    per = o.filter("o_orderstatus = 'O'").groupBy("url").agg(F.min("c_acctbal").alias("_bal"), F.collect_list(closure).alias("closures"), F.collect_list(signal).alias("department_signals"))
    kind = F.when(F.col("_bal") >= 0, "list_closures").otherwise("nothing of the kind")
    results = per.select("url", F.to_json(F.struct(kind.alias("article_type"), "closures", "department_signals")).alias("result"))
    gazetteer = table(spark, sf_dir, "nation").filter("n_nationkey < 20").select(F.col("n_name").alias("name"), F.lit("").alias("department"), F.col("n_name").alias("code"), F.lit(0).alias("rank"))
    lex = Lexicon(brands={s: [s] for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")})
    out = jobs.curated_stages(articles, targets, results, gazetteer, lex)
    n = out["events"].groupBy("url").agg(F.count(F.lit(1)).alias("_n"), F.count("reason").alias("_r"))
    return out["stages"].join(n.hint("merge"), "url", "left").select("url", "stage", F.coalesce("_n", F.lit(0)).alias("n_events"), F.coalesce("_r", F.lit(0)).alias("n_not_found"))
