"""Queries over the event log as a network by revision: differences, streaks, cut-offs, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import select, snapshot
from .common import query, table


def halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The state of buyers and new users on the first day of the log and after it."""
    e = table(spark, sf_dir, "events")
    state = lambda df: df.groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type")).alias("s"), F.round(F.avg("value"), 0).alias("level")).select("user_id", F.col("s.event_type").alias("kind"), "level")
    told = e.filter("event_type in ('purchase', 'signup')")
    return state(told.filter("ts < '2024-01-02'")), state(told.filter("ts >= '2024-01-02'"))


_H = """b as (select user_id, arg_max(event_type, {'t': ts, 'e': event_id}) as kind, round(avg(value), 0) as level from events where ts < timestamp '2024-01-02' and event_type in ('purchase', 'signup') group by 1),
a as (select user_id, arg_max(event_type, {'t': ts, 'e': event_id}) as kind, round(avg(value), 0) as level from events where ts >= timestamp '2024-01-02' and event_type in ('purchase', 'signup') group by 1)"""


@query(f"""with {_H} select coalesce(a.user_id, b.user_id) as user_id, case when b.user_id is null then 'inserted' when a.user_id is null then 'missing' when a.kind is distinct from b.kind or a.level is distinct from b.level then 'changed' else 'same' end as change from b full join a using (user_id)""")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.diff(*halves(spark, sf_dir), "user_id", ["kind", "level"])


@query(f"""with {_H} select user_id from a where user_id not in (select user_id from b)""")
def new_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.new_keys(*halves(spark, sf_dir), "user_id")


def presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user on each day, present if an event says so."""
    e = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), (F.col("event_type") == "purchase").alias("p"))
    days = F.explode(F.sequence(F.lit("2024-01-01").cast("date"), F.lit("2024-01-30").cast("date"))).alias("day")
    users = e.select("user_id").distinct().select("user_id", days)
    seen = e.groupBy("user_id", "day").agg(F.bool_or("p").alias("present"))
    return users.join(seen.hint("merge"), ["user_id", "day"], "left").withColumn("present", F.coalesce("present", F.lit(False)))


_P = """d as (select user_id, day::date as day from (select distinct user_id from events), (select unnest(generate_series(timestamp '2024-01-01', timestamp '2024-01-30', interval 1 day)) as day)),
s as (select user_id, ts::date as day, bool_or(event_type = 'purchase') as present from events group by 1, 2),
p as (select user_id, day, coalesce(present, false) as present from d left join s using (user_id, day))"""


@query(f"""with {_P}, i as (select *, sum(present::int) over (partition by user_id order by day) as island from p)
select user_id, day::varchar as day, sum(case when island > 0 then 1 - present::int else 0 end) over (partition by user_id, island order by day)::bigint as missing from i""")
def missing_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.missing_streak(presence(spark, sf_dir), "user_id", "day", "present").select("user_id", F.col("day").cast("string").alias("day"), "missing")


@query("""with s as (select user_id, ts::date as day, arg_max(event_type, {'t': ts, 'e': event_id}) as kind, max(value) > 20 as high from events group by 1, 2),
l as (select *, lag(kind) over w as pk, lag(high) over w as ph, row_number() over w as rn from s window w as (partition by user_id order by day))
select user_id, day::varchar as day, kind, high from l where rn = 1 or kind is distinct from pk or high is distinct from ph""")
def change_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max(F.struct("ts", "event_id", "event_type")).alias("s"), (F.max("value") > 20).alias("high"))
    return snapshot.history(e.select("user_id", "day", F.col("s.event_type").alias("kind"), "high"), "user_id", "day", ["kind", "high"]).withColumn("day", F.col("day").cast("string"))


@query(f"""with {_P}, l as (select user_id, max(day) as last from p where present group by 1)
select user_id, min(day)::varchar as cutoff from p join l using (user_id) where day > last and isodow(day) < 6 and not present group by user_id having count(*) >= 3""")
def service_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.service_cutoff(presence(spark, sf_dir), "user_id", "day", "present", 3).withColumn("cutoff", F.col("cutoff").cast("string"))


#: Nation and balance to the hundred: what a supplier and a customer can have in common.
_AREA = "{0}_nationkey::varchar || '/' || floor({0}_acctbal / 100)::int::varchar"


def area(prefix: str) -> Column:
    return F.concat_ws("/", F.col(f"{prefix}_nationkey").cast("string"), F.floor(F.col(f"{prefix}_acctbal") / 100).cast("int").cast("string"))


@query(f"""with m as (select s_suppkey as id, {_AREA.format('s')} as code, substr(s_name, 9) as place from supplier), c as (select c_custkey as id, {_AREA.format('c')} as code, case when c_mktsegment = 'BUILDING' then substr(c_name, 9) end as place from customer),
j as (select m.id, c.id as new from m join c on m.code = c.code union select m.id, c.id from m join c on m.place = c.place)
select id, min(new) as replaced_by from j group by id having count(*) = 1""")
def replacement_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("id"), area("s").alias("code"), F.substr(F.col("s_name"), F.lit(9)).alias("place"))
    place = F.when(F.col("c_mktsegment") == "BUILDING", F.substr(F.col("c_name"), F.lit(9)))
    new = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), area("c").alias("code"), place.alias("place"))
    return snapshot.replacement(gone, new, "id", ["code", "place"])


_UP = f"p as (select {_AREA.format('c')} as code, count(*) filter (where c_mktsegment = 'BUILDING') as f, min(c_custkey) filter (where c_mktsegment = 'BUILDING') as fid, count(*) filter (where c_mktsegment <> 'BUILDING') as n, min(c_custkey) filter (where c_mktsegment <> 'BUILDING') as pid from customer group by 1)"


@query(f"""with {_UP} select s_suppkey, case when f = 1 then fid when n = 1 and s_acctbal > 0 then pid end as point_id from supplier left join p on code = {_AREA.format('s')}""")
def unique_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "customer").select(area("c").alias("code"), F.col("c_custkey").alias("point_id"), (F.col("c_mktsegment") == "BUILDING").alias("full"))
    events = table(spark, sf_dir, "supplier").select("s_suppkey", area("s").alias("code"), "s_acctbal")
    return snapshot.unique_point(events, points, "code", "point_id", "full", F.col("s_acctbal") > 0).select("s_suppkey", "point_id")


@query("""with d as (select distinct ts::date as day from events), r as (select day, row_number() over (order by day desc) - 1 as i, count(*) over () as n from d)
select day::varchar as day from r where n <= 7 or list_contains(list_transform(range(0, 7), lambda k: round_even(k * (n - 1) / 6.0, 0)::int), i::int)""")
def even_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).distinct()
    return select.evenly_spaced(days, [F.desc("day")], 7).withColumn("day", F.col("day").cast("string"))


@query("""with n as (select count(*) as n from customer) select c_custkey, c_name from customer, n where ((c_custkey - (7 * 107259) % n) % n + n) % n < 7""")
def rotating_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.rotating_batch(table(spark, sf_dir, "customer"), "c_custkey", 7, select.week_turn(2023, 40)).select("c_custkey", "c_name")


@query("""with h as (select page_id, regexp_extract(url, '^https?://([^/]+)', 1) as host from pages), r as (select *, row_number() over (partition by host order by page_id desc) as rn from h) select host, page_id from r where rn <= 3""")
def group_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"))
    return select.cap(p, ["host"], [F.desc("page_id")], 3).select("host", "page_id")
