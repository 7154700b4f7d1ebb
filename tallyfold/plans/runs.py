"""Queries over jobs and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge
from ..sources import sinks
from ..sources.landing import fresh, land, written
from ..streaming import incremental
from . import jobs
from .common import query, table


@query("select distinct regexp_replace(url, '^https?://', '') as url from pages")
def stream_once_per_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages come in three files; each address is logged once."""
    p = table(spark, sf_dir, "pages").select(F.regexp_replace("url", "^https?://", "").alias("url"), "page_id")
    log = incremental.BatchLog(spark, fresh(spark, "seen"))
    stream = incremental.read_files(spark, land(p.repartition(3), "parquet", "pages"), p.schema.simpleString()[7:-1].replace(":", " "))
    incremental.run_once(incremental.first_seen(stream), incremental.log_to(log), fresh(spark, "cp"))
    return log.read().select("url")


@query("""select user_id, arg_max(event_type, {'t': ts, 'e': event_id}) filter (where event_type <> 'view') as bank, arg_max(props, {'t': ts, 'e': event_id}) as text, max(value) as score from events group by 1""")
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log comes in three files, in no order; signals of each user are merged as they come."""
    e = table(spark, sf_dir, "events").select("user_id", F.nullif("event_type", F.lit("view")).alias("bank"), F.col("props").alias("text"), F.col("value").alias("score"), "ts", "event_id")

    def fold(df: DataFrame) -> DataFrame:
        return merge.signal_merge(df.withColumn("seq", F.struct("ts", "event_id")), ["user_id"], "seq", last_known=["bank"], last=["text"], highest=["score"])

    events = incremental.BatchLog(spark, fresh(spark, "events"))
    path = land(e.repartition(3), "parquet", "log")
    schema = "user_id long, bank string, text string, score double, ts timestamp_ntz, event_id long" if dict(e.dtypes)["ts"] == "timestamp_ntz" else "user_id long, bank string, text string, score double, ts timestamp, event_id long"
    incremental.merge_to(incremental.read_files(spark, path, schema), fold, events, fresh(spark, "cp"))
    return incremental.latest(events, ["user_id"]).select("user_id", "bank", "text", "score")


_O = "o as (select * from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey)"


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return o.join(c, F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(n), F.col("n_nationkey") == F.col("c_nationkey"))  # 25 nations


@query(f"""with {_O} select 'high' as severity, 'not_publishable' as kind, count(*)::bigint as n from o where c_mktsegment = 'MACHINERY' union all select 'medium', 'suspicious_evidence', count(*)::bigint from o where o_orderpriority = '1-URGENT' union all select 'low', 'missing_date', count(*)::bigint from o where o_orderstatus = 'O' and date_diff('day', o_orderdate::date, date '1998-01-01') >= 120""")
def audit_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of orders as events; its near names are left to ``near_names``."""
    e = orders(spark, sf_dir).select(F.col("o_orderkey").alias("event_id"), F.col("c_mktsegment").alias("bank"), F.when(F.col("c_mktsegment") == "MACHINERY", "Plusieurs communes").otherwise(F.col("n_name")).alias("place"), F.col("n_name").alias("department"), F.col("o_orderpriority").alias("evidence"), F.when(F.col("o_orderstatus") != "O", F.to_date("o_orderdate")).alias("closed_on"), F.col("o_orderdate").alias("created_at"))
    found = jobs.audit(e, F.lit("1998-01-01").cast("date"), ["urgent"])
    return found.filter("kind <> 'near_name'").groupBy("severity", "kind").agg(F.count(F.lit(1)).alias("n"))


def payload(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Finished orders are events, urgent open ones not located (settled where the customer has an event), the other open ones signals."""
    o = orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"), F.col("c_mktsegment").alias("bank"), F.col("c_name").alias("place"), F.col("n_name").alias("department"), F.lit("closure").alias("kind"), F.col("o_orderdate").alias("created_at"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), "o_orderstatus", "o_orderpriority")
    o = written(o, "payload-orders")  # most sections read it
    one = F.lit(1.0)
    open_ = o.filter("o_orderstatus = 'O'")
    none = F.lit(None).cast("string")
    events = o.filter("o_orderstatus = 'F'").select(F.col("id").alias("event_id"), "bank", "place", "department", "kind", F.lit(4).alias("reliability"), none.alias("original_place"), none.alias("branch"), one.alias("lat"), one.alias("lon"), F.lit("x").alias("code"), "created_at")
    quarantine = open_.filter("o_orderpriority = '1-URGENT'").select("id", F.concat("bank", F.lit("?")).alias("bank"), "kind", "place", "department", none.alias("resolved"), F.lit("place not found").alias("reason"), "created_at")
    signals = open_.filter("o_orderpriority <> '1-URGENT'").select("id", "bank", "place", "department", F.when(F.col("o_orderpriority") == "5-LOW", 2).alias("n"), F.lit(3).alias("score"), "date")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("event_id"), F.concat(F.lit("https://actu.fr/"), F.col("l_suppkey").cast("string")).alias("url"), F.lit("n").alias("name"), F.lit("t").alias("title"), F.col("l_returnflag").alias("status"), F.col("l_suppkey").cast("string").alias("register_id"), F.lit("s").alias("source"), "l_tax")
    vague = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("bank"), F.lit("2026-01-01").alias("date"))
    dim = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("n_name").alias("department"), F.col("n_name").alias("name"), F.col("r_name").alias("region"))
    branches = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("n_name").alias("department"))  # 25 nations
    return jobs.export_payload(
        events=events, event_sources=lines.select("event_id", "url", "name", "title"), controls=lines.filter("l_tax > 0.04").select("event_id", "status", "register_id", "source"), quarantine=quarantine, signals=signals, department_signals=signals.filter("n is not null"), vague_signals=vague, plans=vague.select("bank").distinct(), branches=branches, departments=dim, brands=["LCL", "CIC", "LCL"], now=F.lit("2026-01-01"),
    )


@query(f"""with {_O}, q as (select o_orderkey as id, c_mktsegment as b, c_name as p from o where o_orderstatus = 'O' and o_orderpriority = '1-URGENT' and c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')), d as (select distinct n_name from nation)
select 'events' as section, count(*)::bigint as n from o where o_orderstatus = 'F' union all select 'quarantine', count(*)::bigint from q union all select 'signals', count(*)::bigint from o where o_orderstatus = 'O' and o_orderpriority <> '1-URGENT' union all select 'department_signals', count(*)::bigint from o where o_orderstatus = 'O' and o_orderpriority = '5-LOW'
  union all select 'vague_signals', count(*)::bigint from customer where c_acctbal < 0 union all select 'plans', count(distinct c_mktsegment)::bigint from customer where c_acctbal < 0 union all select 'departments', count(*)::bigint from d union all select 'regions', count(distinct n_regionkey)::bigint from o where o_orderstatus = 'F' union all select 'brands', 2 union all select 'generated_at', 1
  union all select 'department_estimates', count(distinct n_name)::bigint from o where o_orderstatus in ('F', 'O')""")
def export_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sections written as JSON, one folder each, and counted from there."""
    path = fresh(spark, "payload")
    sections = payload(spark, sf_dir)
    sinks.write_sections(sections, path)
    out = None
    for name, df in sections.items():
        n = spark.read.schema(df.schema).json(f"{path}/{name}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("section"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@query(f"""with {_O} select n_name as department, r_name as region, (count(*) filter (where o_orderstatus = 'F'))::bigint as n_events, (select count(*) from customer c2 where c2.c_nationkey = o.c_nationkey)::bigint as n_branches, (count(*) filter (where o_orderstatus = 'O' and o_orderpriority = '1-URGENT' and c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')))::bigint as n_unlocated from o join region on r_regionkey = n_regionkey group by 1, 2, o.c_nationkey""")
def export_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload(spark, sf_dir)["departments"].select("department", "region", "n_events", "n_branches", "n_unlocated")
