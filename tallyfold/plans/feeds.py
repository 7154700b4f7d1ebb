"""Queries over sources and sinks: the given tables are landed in the shape of each feed and read back by its source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..sources import articles, networks, sinks
from ..sources.landing import fresh, land
from .common import query, table


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as articles: a title, a text, a URL and a day each."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    return o.select(F.concat(F.lit("order "), key, F.lit(" "), "o_orderpriority").alias("title"), F.concat_ws(" ", F.lit("status"), "o_orderstatus").alias("text"), F.concat(F.lit("https://feed.example.org/"), key).alias("url"), F.to_date("o_orderdate").alias("day"), F.col("o_custkey").alias("k"))


_F = "f as (select 'order ' || o_orderkey || ' ' || o_orderpriority as title, 'status ' || o_orderstatus as text, 'https://feed.example.org/' || o_orderkey as url, o_orderdate::date as day, o_custkey as k from orders)"


@query(f"with {_F} select title, text, url, strftime(day, '%a, %d %b %Y') || ' 08:00:00 GMT' as date, 'feed' as source, day::varchar as article_day from f")
def rss_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = orders(spark, sf_dir).select("title", F.col("url").alias("link"), F.concat(F.date_format("day", "EEE, dd MMM yyyy"), F.lit(" 08:00:00 GMT")).alias("pubDate"), F.col("text").alias("description"))
    found = articles.rss(spark, land(items, "xml", "rss", rowTag="item", rootTag="channel"), "feed")
    return found.select("title", "text", "url", "date", "source", dates.article_date("date").cast("string").alias("article_day"))


@query(f"with {_F} select url, case when text = 'status F' then title end as title, day::varchar as date from f")
def sitemap_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed items of finished orders, sitemap entries of the others."""
    o = orders(spark, sf_dir)
    base = fresh(spark, "sitemap")
    o.filter("text <> 'status F'").select(F.col("url").alias("loc"), F.col("day").cast("string").alias("lastmod")).write.format("xml").options(rowTag="url", rootTag="urlset").save(f"{base}/a")
    o.filter("text = 'status F'").select(F.col("url").alias("link"), "title", F.col("day").cast("string").alias("pubDate")).write.format("xml").options(rowTag="item", rootTag="channel").save(f"{base}/b")
    return articles.sitemap(spark, f"{base}/*")


def answers(rows: DataFrame, item: Column, name: str) -> str:
    """Lands one answer for each customer, with its items under ``name``, as JSON lines."""
    inner, *outer = name.split(".")[::-1]
    answer = rows.groupBy("k").agg(F.collect_list(item).alias(inner))
    for o in outer:
        answer = answer.select(F.struct(inner).alias(o))
    return land(answer.drop("k"), "json", "answers")


@query(f"with {_F} select title, '' as text, url, day::varchar as date, 'd' || k as source from f")
def news_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct("title", "url", F.concat(F.date_format("day", "yyyyMMdd"), F.lit("T080000Z")).alias("seendate"), F.concat(F.lit("d"), F.col("k").cast("string")).alias("domain"))
    return articles.news_list(spark, answers(orders(spark, sf_dir), item, "articles"), False).select("title", "text", "url", "date", "source")


@query(f"with {_F} select title, text, url, day::varchar as date, case when k % 3 = 0 then 'uri' else 'press' end as source from f")
def registry_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.struct(F.when(F.col("k") % 3 != 0, "press").alias("title"), F.lit("uri").alias("uri"))
    item = F.struct("title", F.col("text").alias("body"), "url", F.when(F.col("k") % 2 == 0, F.col("day").cast("string")).alias("dateTime"), F.col("day").cast("string").alias("date"), source.alias("source"))
    return articles.registry_list(spark, answers(orders(spark, sf_dir), item, "articles.results"), False).select("title", "text", "url", "date", "source")


@query(f"with {_F} select title, case when k % 2 = 0 then text else '' end as text, url, day::varchar as date, 'media' as source from f")
def story_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("k") % 2 == 0
    rows = orders(spark, sf_dir).select(F.when(even, F.col("title")).alias("title"), F.col("title").alias("name"), F.when(even, F.col("text")).alias("text"), F.when(even, F.col("url")).alias("url"), F.col("url").alias("guid"), F.col("day").cast("string").alias("indexed_date"), F.lit("media").alias("media_name"))
    return articles.stories(spark, land(rows, "json", "stories"), False).select("title", "text", "url", "date", "source")


@query(f"with {_F} select title, case when k % 2 = 0 then text || ' one' else 'one two' end as text, case when k % 2 = 0 then url else 'https://law.example.org/' || k end as url, day::varchar as date from f")
def legal_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two shapes: a title and a text, or titles with sections of extracts; both with tags."""
    even = F.col("k") % 2 == 0
    key = F.col("k").cast("string")
    titles = F.when(~even, F.array(F.struct(key.alias("id"), F.concat(F.lit("<b>"), "title", F.lit("</b>")).alias("title"))))
    sections = F.when(~even, F.array(F.struct(F.array(F.struct(F.array(F.lit("one <i>two</i>")).alias("values"))).alias("extracts"))))
    item = F.struct(F.when(even, F.col("title")).alias("title"), F.when(even, F.col("url")).alias("url"), F.col("day").cast("string").alias("publicationDate"), F.when(even, F.col("text")).alias("text"), F.when(even, F.lit("<p>one</p>")).alias("content"), titles.alias("titles"), sections.alias("sections"))
    return articles.legal_results(spark, answers(orders(spark, sf_dir), item, "results"), "https://law.example.org/", False).select("title", "text", "url", "date")


@query("""with r as (select c_name, c_mktsegment, lpad((c_custkey * 7919 % 99000)::varchar, 5, '0') as cp, case when c_acctbal < 0 then 'Radié' when c_acctbal < 1000 then 'Cessation d''activité' else 'Actif' end as statut from customer)
select c_name || ' - ' || statut || ' (' || c_mktsegment || ')' as title, c_name || ', ' || cp || ' ' || c_mktsegment || ' : ' || statut as text, substr(cp, 1, 2) as department, 'register' as source, 'r:' || substr(sha256(c_name || ' - ' || statut || ' (' || c_mktsegment || ')'), 1, 16) as url from r where statut <> 'Actif'""")
def register_withdrawals(spark: SparkSession, sf_dir: str) -> DataFrame:
    postal = F.lpad((F.col("c_custkey") * 7919 % 99000).cast("string"), 5, "0")
    status = F.when(F.col("c_acctbal") < 0, "Radié").when(F.col("c_acctbal") < 1000, "Cessation d'activité").otherwise("Actif")
    rows = table(spark, sf_dir, "customer").select(F.col("c_name").alias("denomination"), F.col("c_mktsegment").alias("commune"), postal.alias("code_postal"), status.alias("statut"))
    return articles.register_csv(spark, land(rows, "csv", "register", header=True), "r:").select("title", "text", "department", "source", "url")


_BRANCHES = "b as (select *, lpad((c_custkey * 7919 % 99000)::varchar, 5, '0') as cp, c_custkey % 80 as lat, c_custkey % 170 as lon from customer)"
_DEP = "case when substr({0}, 1, 2) in ('97', '98') then substr({0}, 1, 3) when substr({0}, 1, 2) = '20' then null else substr({0}, 1, 2) end"


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.withColumns({"cp": F.lpad((F.col("c_custkey") * 7919 % 99000).cast("string"), 5, "0"), "lat": (F.col("c_custkey") % 80).cast("double"), "lon": (F.col("c_custkey") % 170).cast("double")})


@query(f"""with {_BRANCHES} select case when c_nationkey < 12 then 'way/' else 'node/' end || c_custkey as branch_id, case when c_mktsegment = 'MACHINERY' then c_name else 'B' || c_nationkey end as bank, c_name as name, c_nationkey || ' rue' as address, cp as postal_code, c_mktsegment as place, lat::double as lat, lon::double as lon, {_DEP.format("cp")} as department from b where c_nationkey <> 3 or c_mktsegment = 'MACHINERY'""")
def osm_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    way = F.col("c_nationkey") < 12
    brand = F.when(F.col("c_mktsegment") != "MACHINERY", F.concat(F.lit("B"), F.col("c_nationkey").cast("string")))
    tags = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in {"brand": brand, "name": F.col("c_name"), "addr:housenumber": F.col("c_nationkey").cast("string"), "addr:street": F.lit("rue"), "addr:postcode": F.col("cp"), "addr:city": F.col("c_mktsegment")}.items()]), lambda e: e["value"].isNotNull()))
    none = F.lit(None).cast("double")
    element = F.struct(F.when(way, "way").otherwise("node").alias("type"), F.col("c_custkey").alias("id"), F.when(way, none).otherwise(F.col("lat")).alias("lat"), F.when(way, none).otherwise(F.col("lon")).alias("lon"), F.when(way, F.struct("lat", "lon")).alias("center"), tags.alias("tags"))
    path = answers(branches(spark, sf_dir).withColumn("k", F.col("c_nationkey") * 1000 + F.col("c_custkey") % 1000), element, "elements")
    return networks.osm_branches(spark, path, ["b3"], False).select("branch_id", "bank", "name", "address", "postal_code", "place", "lat", "lon", "department")


@query(f"""with {_BRANCHES} select c_custkey::varchar as branch_id, c_name as name, c_mktsegment as place, cp as postal_code, {_DEP.format("cp")} as department, lat + 0.5 as lat, lon + 0.25 as lon from b""")
def branch_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file with semicolons, decimal commas and postal codes without their leading zeros."""
    comma = lambda c: F.replace(c.cast("string"), F.lit("."), F.lit(","))
    rows = branches(spark, sf_dir).select(F.col("c_custkey").alias("Identifiant"), F.col("c_name").alias("Libellé"), F.col("c_mktsegment").alias("Localité"), F.col("cp").cast("int").alias("Code postal"), comma(F.col("lat") + 0.5).alias("Latitude"), comma(F.col("lon") + 0.25).alias("Longitude"))
    return networks.branch_csv(spark, land(rows, "csv", "branches", header=True, sep=";"), "Bank").select("branch_id", "name", "place", "postal_code", "department", "lat", "lon")


@query(f"""with {_BRANCHES}, r as (select c_custkey::varchar as point_id, c_name as label, c_mktsegment as characteristic, cp as postal_code, {_DEP.format("cp")} as department, unnest(['2024-01', '2024-02']) as revision, c_acctbal from b),
l as (select *, row_number() over (partition by point_id order by revision desc) as rn from r where revision = '2024-01' or c_acctbal > 0) select point_id, label, characteristic, postal_code, department, revision from l where rn = 1""")
def network_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last revision of each point; points with debts are in the first only."""
    rows = branches(spark, sf_dir).select(F.col("c_custkey").cast("string").alias("identifiant_a"), F.col("c_name").alias("libelle_du_site"), F.col("c_mktsegment").alias("caracteristique_du_site"), F.col("cp").alias("code_postal"), "c_acctbal")
    both = [networks.points(spark, land(part.drop("c_acctbal"), "json", "points"), r) for part, r in ((rows, "2024-01"), (rows.filter("c_acctbal > 0"), "2024-02"))]
    return networks.latest_points(both[0].unionByName(both[1])).select("point_id", "label", "characteristic", "postal_code", "department", "revision")


@query("""select o_custkey::varchar as point_id, o_orderdate::date::varchar as day, o_orderstatus = 'O' or o_totalprice > 200000 as is_open from orders where o_custkey in (select c_custkey from customer where c_acctbal > 0)""")
def calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    rows = o.select(F.col("o_custkey").cast("string").alias("identifiant"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm").alias("date_calendrier"), F.when(F.col("o_orderstatus") == "O", "9h-12h").otherwise("Fermé").alias("bp_plage_horaire_1"), F.when(F.col("o_totalprice") > 200000, "14h-17h").otherwise(" ").alias("bp_plage_horaire_2"))
    wanted = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("point_id"))
    return networks.calendar(spark, land(rows, "json", "calendar"), wanted).withColumn("day", F.col("day").cast("string"))


@query(f"""with {_BRANCHES} select c_custkey::varchar as branch_id, c_name as name, c_mktsegment as place, '2026-03-' || lpad((1 + c_custkey % 28)::varchar, 2, '0') as closed_on, 'Ville' || c_nationkey as destination, {_DEP.format("cp")} as department from b where c_acctbal <= 5000""")
def locator_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches that tell when they close and where their customers go; the others say that they stay."""
    told = F.format_string("Fermeture le %02d/03/2026, rendez-vous à l'agence de Ville%d.", (1 + F.col("c_custkey") % 28).cast("int"), F.col("c_nationkey"))
    rows = branches(spark, sf_dir).select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("city"), F.col("cp").alias("postal_code"), F.when(F.col("c_acctbal") <= 5000, told).otherwise("Ouvert").alias("message"))
    return networks.locator(spark, land(rows, "json", "locator"), False).select("branch_id", "name", "place", F.col("closed_on").cast("string").alias("closed_on"), "destination", "department")


@query("""with c as (select page_id, url, regexp_replace(regexp_replace(lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)), '^www\\.', ''), '^\\.+', '') as host, lpad((page_id * 7919 % 1000000)::varchar, 6, '0') as timestamp, case when length(html) > 3000 then '200' else '404' end as status from pages),
k as (select *, row_number() over (partition by url order by timestamp desc) as u from c where status = '200' and not regexp_matches(url, '/fr/')), r as (select *, row_number() over (partition by host order by timestamp desc, url) as rn from k where u = 1)
select url, timestamp from r where rn <= 2""")
def archive_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of pages: two of each host, none of French pages, none that failed (short ones)."""
    p = table(spark, sf_dir, "pages")
    stamp = F.lpad((F.col("page_id") * 7919 % 1_000_000).cast("string"), 6, "0")
    index = p.select(F.col("url").alias("urlkey"), "url", stamp.alias("timestamp"), F.when(F.length("html") > 3000, "200").otherwise("404").alias("status"), F.lit("text/html").alias("mime"), F.lit("f").alias("filename"), F.lit("0").alias("offset"))
    return articles.captures(index, "^http", "/fr/", 2).select("url", "timestamp")


@query("""with k as (select *, row_number() over (partition by url order by html desc) as rn from pages), w as (select url, html from k where rn = 1)
select url, case when url like 'http://%' then 'error' else 'ok' end as status from w where url not like '%?%'""")
def full_text_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose URL has a query are known; those of plain http cannot be had."""
    p = table(spark, sf_dir, "pages").select("url", "html")
    known = p.filter("url like '%?%'").select("url", F.lit("ok").alias("status")).distinct()
    return articles.full_texts(p, p.filter("url not like 'http://%'"), known).select("url", "status")


@query("""select 'Bank' || c_nationkey as bank, c_mktsegment as place, case when c_acctbal > 0 then c_name end as label, 'https://x.example.org/' || c_custkey as url, '2026-01-' || lpad((1 + c_custkey % 28)::varchar, 2, '0') as closed_on from customer""")
def curated_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list with human headings, as CSV."""
    c = table(spark, sf_dir, "customer")
    rows = c.select(F.concat(F.lit("Bank"), F.col("c_nationkey").cast("string")).alias("Banque"), F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("Agence / localisation"), F.col("c_mktsegment").alias("Commune"), F.format_string("2026-01-%02d", (1 + F.col("c_custkey") % 28).cast("int")).alias("Date de fermeture"), F.concat(F.lit("https://x.example.org/"), F.col("c_custkey").cast("string")).alias("Lien source"))
    return articles.curated(spark, land(rows, "csv", "curated", header=True)).select("bank", "place", "label", "url", "closed_on")


@query("""select 'https://x.example.org/' || c_custkey as url from customer where c_acctbal > 0""")
def url_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    said = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("see https://x.example.org/"), F.col("c_custkey").cast("string"), F.lit(").,"))).otherwise("no link here")
    return articles.url_list(spark, land(c.select(said.alias("value")), "text", "urls")).select("url")


@query(f"with {_F} select title, text, url, day::varchar as date, 'search' as source from f")
def search_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select(F.col("title").alias("name"), F.lit(" ").alias("snippet"), F.col("text").alias("description"), F.col("url").alias("link"), F.col("day").cast("string").alias("age"))
    back = spark.read.schema(rows.schema).json(land(rows, "json", "search"))
    return articles.search_results(back, "search").select("title", "text", "url", "date", "source")


def list_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders")
    done = F.col("o_orderstatus") == "F"
    e = o.select(F.col("o_orderkey").cast("string").alias("event_id"), F.concat(F.lit("Bank"), (F.col("o_custkey") % 7).cast("string")).alias("bank"), F.col("o_custkey").cast("string").alias("place"), F.lit(None).cast("string").alias("department"), F.lit(" ").alias("address"), F.lit("").alias("label"), F.when(done, F.to_date("o_orderdate")).alias("closed_on"), F.when(done, "closed").when(F.col("o_orderstatus") == "O", "upcoming").otherwise("x").alias("temporal_status"), (F.col("o_orderpriority") == "5-LOW").alias("approximate"), F.when(F.col("o_orderpriority") == "1-URGENT", 2).otherwise(4).alias("reliability"))
    s = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("event_id"), F.concat(F.lit("u"), F.lpad(F.col("l_suppkey").cast("string"), 6, "0")).alias("url"), F.concat(F.lit("n"), F.col("l_suppkey").cast("string")).alias("name"))
    return e, s


@query("""with s as (select l_orderkey, string_agg(u, chr(10) order by u) as sources, min(u) as first_url, 'n' || min(l_suppkey) as first_source from (select distinct l_orderkey, l_suppkey, 'u' || lpad(l_suppkey::varchar, 6, '0') as u from lineitem) group by 1)
select o_orderkey::varchar as event_id, 'Bank' || (o_custkey % 7) as bank, o_custkey::varchar as place, 'Non renseignée' as address, case o_orderstatus when 'F' then 'Fermée' when 'O' then 'À venir' else 'Inconnu' end as temporal_status, first_url, first_source, coalesce(sources, '') as sources, case when o_orderstatus = 'F' then o_orderdate::date::varchar else 'Non renseignée' end as closed_on,
  o_orderpriority = '1-URGENT' or o_orderstatus <> 'F' or o_orderpriority = '5-LOW' as to_verify from orders left join s on l_orderkey = o_orderkey""")
def exported_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The human list, written as JSON sections and read back."""
    rows = sinks.event_rows(*list_events(spark, sf_dir)).select("event_id", "bank", "place", "address", "temporal_status", "first_url", "first_source", "sources", "closed_on", "to_verify")
    path = fresh(spark, "export")
    sinks.write_sections({"events": rows}, path)
    return spark.read.schema(rows.schema).json(f"{path}/events")


@query("""select o_orderstatus as status, count(*)::bigint as n from orders group by 1""")
def exported_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of counts, written with its findings as JSON and CSV and read back from the CSV."""
    o = table(spark, sf_dir, "orders")
    path = fresh(spark, "report")
    sinks.write_report(o.select("o_orderkey", F.col("o_orderstatus").alias("status")), o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.csv(f"{path}/findings_csv", header=True, schema="o_orderkey long, status string").groupBy("status").agg(F.count(F.lit(1)).alias("n"))
