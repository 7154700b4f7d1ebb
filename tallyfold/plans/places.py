"""Queries over what titles, names, addresses and departments of orders say, and over what is kept of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, keys, names, terms, web
from ..functions.lexicon import DEPARTMENTS, POSTAL_BRAND, Lexicon
from ..operators import coverage, merge, resolve, signals, snapshot, titles, triage
from ..sources.landing import fresh
from .common import query, quote, sql_says, table
from .rules import PLACES, TITLED, order_titles, pick, sql_pick

CODES = list(DEPARTMENTS)
_LEX = Lexicon()
_HAS = lambda c, words: f"regexp_matches({c}, {quote(terms.alternation(words))})"
_POSTAL = f"({_HAS('f', _LEX.points)} and {_HAS('f', _LEX.closure)})"


@query(f"""with {TITLED}, s as (select *, {sql_pick(CODES, "n_nationkey * 4")} as d1, {sql_pick(list(DEPARTMENTS.values()), "n_nationkey * 4")} as n1, {sql_pick(CODES, "c_custkey")} as d2, day + (o_orderkey % 20)::int as pub, {sql_says("w", titles.FUTURE, titles.WORDS)} as fut, {sql_says("w", titles.PAST, titles.WORDS)} as past from folded)
select o_orderkey, array_to_string(list_distinct([d1]) || list_filter([d2], lambda x: x <> d1), ',') as departments, case when p2 = 'Paris' then '00' else p2 end as hint, case when {_POSTAL} then {quote(POSTAL_BRAND)} when contains(f, 'lcl') then 'LCL' end as brand,
  case when o_orderstatus = 'O' then 'confirmed' when fut then 'project' when past then 'confirmed' else 'rumour' end as status, case when o_orderstatus = 'O' then 'closed' when fut then 'upcoming' when past then 'closed' else 'unknown' end as temporal, case when o_orderstatus = 'O' then day when not fut and past then pub end::date as closed_on from s""")
def titles_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each order's title and text: departments by name and number, the name to search for, the brand, and what and when it tells."""
    d = order_titles(spark, sf_dir).withColumns({"d1": F.get(F.array(*[F.lit(x) for x in DEPARTMENTS.values()]), (F.col("n_nationkey") * 4 % len(CODES)).cast("int")), "d2": pick(CODES, "c_custkey")})
    said = F.concat(F.lit("Une annonce ("), "d2", F.lit(") pour "), "d1")
    hint = titles.search_hint(F.concat(F.lit("Ce jour, dans "), "p2", F.lit(", "), "title"), F.lit("00"))
    published = F.date_add("day", (F.col("o_orderkey") % 20).cast("int"))
    d = d.withColumns({"_told": titles.state(F.col("title"), published), "_t": keys.fold("title")})  # read more than once
    told, t = F.col("_told"), F.col("_t")
    return d.select("o_orderkey", F.array_join(triage.departments_of(said, DEPARTMENTS), ",").alias("departments"), hint.alias("hint"), triage.first_brand(t, t, _LEX).alias("brand"), told["status"].alias("status"), told["temporal_status"].alias("temporal"), told["day"].alias("closed_on"))


@query(f"""with {TITLED}, c as (select *, {sql_pick(PLACES, "o_orderkey")} as p3 from told)
select o_orderkey, array_to_string(list_distinct([p1]) || list_filter([p2], lambda x: x <> p1) || case when p3 not in (p1, p2) then [p3] else [] end, ',') as candidates, array_to_string(case when p1 <> p2 then [p1, p2] else [p1] end, ',') as known, array_to_string([p1, p2], ',') as offices from c""")
def candidate_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names listed after cues in a text on each order, those of them that a gazetteer has, and the offices that a plural title names."""
    d = order_titles(spark, sf_dir).withColumn("p3", pick(PLACES, "o_orderkey"))
    month = F.get(F.array(*[F.lit(m) for m in dates.MONTHS]), F.month("day") - 1)
    said = F.concat(F.lit("LCL ferme les agences de "), "p1", F.lit(", "), "p2", F.lit(" et 3 autres le "), F.day("day").cast("string"), F.lit(" "), month, F.lit(" ; reste le site de "), "p3", F.lit(".\nÀ "), "p1", F.lit(" rien d'autre, dit-on"))
    d = d.withColumns({"names": triage.candidate_places(said), "offices": titles.office_labels(F.concat(F.lit("Bureaux de poste "), "p1", F.lit(" et "), "p2"))})
    near = d.select(F.struct("o_orderkey", "p1", "p2", F.array_join("names", ",").alias("candidates"), F.array_join("offices", ",").alias("offices")).alias("row"), "names")
    # the gazetteer of each order is the whole list; names that are only its third are taken out by what the row asks for
    gazetteer = spark.createDataFrame([(p,) for p in sorted(set(PLACES))], "name string")
    valid = resolve.valid_candidates(near, gazetteer, "row", "names", 8).select("row.*", "places")
    return valid.select("o_orderkey", "candidates", "offices", F.array_join(F.filter("places", lambda x: x.isin(F.col("p1"), F.col("p2"))), ",").alias("known"))


@query(f"""with {TITLED}, n as (select *, case o_orderstatus when 'F' then p1 || ' / Centre' when 'O' then p1 || ' – Sud' else p1 || '-sur-Mer' end as name from told)
select o_orderkey, p1 as matched_name, 'c' || lower(p1) as resolved_code, p1 as place, name as original_place from n""")
def place_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with additions, found by what comes before these, and events moved to the place that is found."""
    d = order_titles(spark, sf_dir)
    name = F.when(F.col("o_orderstatus") == "F", F.concat("p1", F.lit(" / Centre"))).when(F.col("o_orderstatus") == "O", F.concat("p1", F.lit(" – Sud"))).otherwise(F.concat("p1", F.lit("-sur-Mer")))
    asked = d.select(F.col("o_orderkey").alias("request_id"), name.alias("name"), F.lit("").alias("department"))
    gazetteer = spark.createDataFrame([(p, "", f"c{p.lower()}", 0) for p in sorted(set(PLACES))], "name string, department string, code string, rank int")
    found = resolve.resolve_variants(asked, gazetteer).withColumn("place", F.col("name"))
    return resolve.reattach(found, "matched_name").select(F.col("request_id").alias("o_orderkey"), "matched_name", "resolved_code", "place", "original_place")


@query("""with a as (select c_custkey, lower(c_mktsegment) || ' street ' || c_nationkey as k, c_acctbal from customer), t as (select k, arg_min(c_custkey, {'b': c_acctbal, 'k': c_custkey::varchar}) as first from a group by 1)
select o_orderkey, first::varchar as resolved_code from orders join a on c_custkey = o_custkey join t on t.k = a.k""")
def addresses_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' addresses, written otherwise, held against the customers' with the lowest balance first."""
    c = table(spark, sf_dir, "customer").withColumn("address", F.concat_ws(" ", "c_mktsegment", F.lit("Street"), F.col("c_nationkey").cast("string")))
    addresses = c.select("address", F.col("c_acctbal").alias("rank"), F.col("c_custkey").cast("string").alias("code"), F.lit(1.0).alias("lat"), F.lit(1.0).alias("lon"))
    asked = table(spark, sf_dir, "orders").join(c, F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", F.concat(F.lit("  "), F.initcap(F.replace("address", F.lit(" "), F.lit("  ")))).alias("address"))
    return resolve.by_address(asked, addresses).select("o_orderkey", "resolved_code")


@query("""with e as (select o_custkey, count(*) as n, min(o_orderkey) as id from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'F' group by 1)
select o_orderkey, case when n = 1 then 'e' || id else 'new' || o_orderkey end as event_id from orders left join e using (o_custkey) where o_orderstatus = 'O'""")
def reused_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders under the id of the customer's only urgent finished one, or else a new one."""
    o = table(spark, sf_dir, "orders")
    events = o.filter("o_orderpriority = '1-URGENT' and o_orderstatus = 'F'").select("o_custkey", F.concat(F.lit("e"), F.col("o_orderkey").cast("string")).alias("event_id"))
    return snapshot.reuse_id(o.filter("o_orderstatus = 'O'").select("o_orderkey", "o_custkey"), events, "o_custkey", F.concat(F.lit("new"), F.col("o_orderkey").cast("string"))).select("o_orderkey", "event_id")


@query("""with d as (select lpad(n_nationkey::varchar, 2, '0') as code, n_name, r_name from nation join region on r_regionkey = n_regionkey), g as (select c_custkey, case when c_acctbal < 0 then null when c_acctbal < 3000 then n_name else lpad(c_nationkey::varchar, 2, '0') end as given, lpad(c_nationkey::varchar, 2, '0') as own, c_acctbal from customer join nation on n_nationkey = c_nationkey)
select c_custkey, d.code as department_code, d.r_name as region, case when d.code is not null then d.code when c_acctbal < -500 then own end as filled from g left join d on d.code = g.given or d.n_name = g.given""")
def departments_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departments given by code or name, their regions, and what a source fills in where none is given."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    code = lambda c: F.lpad(F.col(c).cast("string"), 2, "0")
    dim = nation.select(code("n_nationkey").alias("code"), F.col("n_name").alias("name"), keys.place_key("n_name").alias("key"))
    regions = nation.join(F.broadcast(region), F.col("r_regionkey") == F.col("n_regionkey")).select(code("n_nationkey").alias("department"), F.col("r_name").alias("region"))  # 5 regions
    c = table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("n_nationkey") == F.col("c_nationkey"))  # 25 nations
    given = F.when(F.col("c_acctbal") < 0, F.lit(None)).when(F.col("c_acctbal") < 3000, F.initcap("n_name")).otherwise(code("c_nationkey"))
    c = names.region_of(names.to_department(c.withColumn("given", given), "given", dim), "department_code", regions)
    supported = F.when(F.col("c_acctbal") < -500, F.array(code("c_nationkey"))).when(F.col("c_acctbal") < -200, F.array(code("c_nationkey"), F.lit("99"))).otherwise(F.array().cast("array<string>"))
    filled = resolve.fill_department(F.col("department_code"), supported, F.col("department_code").isNotNull())
    return c.select("c_custkey", "department_code", "region", filled.alias("filled"))


@query("""select doc_id, case when n_chars > 1000 and text is not null then md5(substring(coalesce(lang || chr(10), '') || text, 1, 20000)) else md5(coalesce(lang, '')) end as text_md5 from documents""")
def full_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with the landed text of their address appended, where there is one."""
    d = table(spark, sf_dir, "documents")
    url = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    articles = d.select("doc_id", url.alias("url"), F.col("lang").alias("text"))
    landed = d.select(url.alias("url"), F.col("text").alias("full_text"), F.when(F.col("n_chars") > 1000, "ok").otherwise("empty").alias("status"))
    return triage.with_full_text(articles, landed).select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"))


@query("""with o as (select *, case when o_orderstatus <> 'P' then o_orderdate::date end as day, case o_orderpriority when '1-URGENT' then 'confirmed' when '2-HIGH' then 'project' else 'rumour' end as status from orders),
t as (select *, case when day >= date '1998-06-01' then 'upcoming' when day is not null then 'closed' when status = 'project' then 'upcoming' when status = 'confirmed' then 'closed' else 'unknown' end as temporal from o)
select o_orderkey, temporal, temporal = 'upcoming' or coalesce(day >= date '1996-01-01', false) as retained from t""")
def retained_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What orders are on a day, and which of them stay above a floor."""
    day = lambda s: F.lit(s).cast("date")
    status = F.when(F.col("o_orderpriority") == "1-URGENT", "confirmed").when(F.col("o_orderpriority") == "2-HIGH", "project").otherwise("rumour")
    o = table(spark, sf_dir, "orders").withColumns({"day": F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")), "status": status})
    o = o.withColumn("temporal", dates.temporal_status(F.col("day"), F.col("status"), day("1998-06-01")))
    return o.select("o_orderkey", "temporal", titles.retained(F.col("temporal"), F.col("day"), day("1996-01-01")).alias("retained"))


@query("""with l as (select l_orderkey, count(*) filter (where l_discount <= 0.05) as n from lineitem group by 1), o as (select o_orderkey, o_totalprice / 500000 as confidence, case when o_orderpriority = '1-URGENT' then 'ambiguous' when o_orderpriority = '5-LOW' then 'single_closure' else 'social_hr' end as kind, o_orderstatus = 'P' as review, coalesce(n, 0) as n from orders join l on l_orderkey = o_orderkey)
select o_orderkey, review or kind = 'ambiguous' or least(confidence, 1) < 0.5 as again from o""")
def second_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which results of extraction are read a second time."""
    closure = F.when(F.col("l_discount") <= 0.05, F.struct(F.lit("B").alias("bank"), F.lit("P").alias("commune"), F.lit("announced").alias("status"), F.lit("closure").alias("closure_type"), F.lit(1.0).alias("confidence")))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(closure).alias("closures"))
    o = table(spark, sf_dir, "orders").join(lines.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "ambiguous").when(F.col("o_orderpriority") == "5-LOW", "single_closure").otherwise("social_hr")
    result = F.to_json(F.struct(kind.alias("article_type"), F.least(F.col("o_totalprice") / 500000, F.lit(1.0)).alias("confidence"), (F.col("o_orderstatus") == "P").alias("needs_review"), "closures"))
    checked = signals.validated(o.select("o_orderkey", result.alias("result")), "result")
    return checked.select("o_orderkey", signals.needs_second_pass(F.col("parsed")).alias("again"))


def _unescaped(c: str) -> str:
    for k, v in web.REFERENCES.items():
        c = f"replace({c}, {quote(k)}, {quote(v)})"
    return c


@query(f"""with p as (select page_id, url || ' <b>' || regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) || '</b> - Le Journal' as t from pages), a as (select page_id, regexp_replace(regexp_replace({_unescaped('t')}, '<[^>]+>', '. ', 'g'), 'https?://\\S+', ' ', 'g') as t from p)
select page_id, trim(regexp_replace(t, ' - [^-]{{2,60}}$', '')) as cleaned from a""")
def cleaned_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of pages with address, tags and publisher, without these."""
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    return table(spark, sf_dir, "pages").select("page_id", web.clean_text(F.concat("url", F.lit(" <b>"), title, F.lit("</b> - Le Journal"))).alias("cleaned"))


@query(f"""with {TITLED}, s as (select *, {_POSTAL} as postal, contains(f, 'lcl') as lcl, {_HAS('f', _LEX.closure)} as closure, {sql_says("w", triage.PLANS, triage.PLAN_WORDS)} as plan from folded)
select 'u' || o_orderkey as url, case when postal then {quote(POSTAL_BRAND)} when lcl then 'LCL' end as bank, substring(title, 1, 500) as excerpt, least(5, 1 + (postal or lcl)::int + closure::int + plan::int)::int as score from s""")
def weak_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' titles as review records of weak signals."""
    a = order_titles(spark, sf_dir).select(F.concat(F.lit("u"), F.col("o_orderkey").cast("string")).alias("url"), "title", F.col("title").alias("text"), F.col("o_orderdate").cast("string").alias("date"))
    return triage.weak_signal(a, _LEX).select("url", "bank", "excerpt", "score")


@query("""select o_orderkey, o_orderstatus, case when o_orderstatus = 'O' then o_totalprice * 2 else o_totalprice end as price from orders where o_orderstatus <> 'O' or o_orderpriority <> '5-LOW'""")
def replaced_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status, of which the open ones are replaced by others."""
    path = fresh(spark, "slices")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("price"), "o_orderpriority")
    merge.replace_slice(o.drop("o_orderpriority"), path, "o_orderstatus")
    merge.replace_slice(o.filter("o_orderstatus = 'O' and o_orderpriority <> '5-LOW'").withColumn("price", F.col("price") * 2).drop("o_orderpriority"), path, "o_orderstatus")
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "price")


@query("""with s as (select distinct c_mktsegment, c_nationkey from customer join orders on o_custkey = c_custkey where o_totalprice > 490000) select c_custkey from customer join s using (c_mktsegment, c_nationkey)""")
def with_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of whose segment and nation there is a very large order."""
    c = table(spark, sf_dir, "customer")
    large = table(spark, sf_dir, "orders").filter("o_totalprice > 490000").join(c, F.col("c_custkey") == F.col("o_custkey")).select("c_mktsegment", "c_nationkey")
    return coverage.has_evidence(c, large, ["c_mktsegment", "c_nationkey"]).select("c_custkey")


@query("""with o as (select 'u' || o_custkey as url, c_mktsegment as bank, o_orderpriority as departement, o_orderkey % 1000 as n from orders join customer on c_custkey = o_custkey where o_orderstatus = 'O')
select url, bank, departement, n::int as "count", substr(sha256(url || '|' || bank || '|' || departement), 1, 16) as id from o""")
def exploded_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The signals of each customer's result as rows with an id."""
    o = table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    one = F.struct(F.col("c_mktsegment").alias("bank"), F.col("o_orderpriority").alias("departement"), (F.col("o_orderkey") % 1000).alias("count"))
    per = o.groupBy("o_custkey").agg(F.collect_list(one).alias("department_signals"))
    result = F.to_json(F.struct(F.lit("department_signal").alias("article_type"), "department_signals"))
    checked = signals.validated(per.select(F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("url"), result.alias("result")), "result")
    return signals.explode_signals(checked, "department_signals", ["bank", "departement"]).select("url", "bank", "departement", "count", "id")
