"""Landed files to articles (title, text, url, date, source, department).

JSON answers are one a file, or one a line with ``whole_files=False``, which lets large files be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import web
from ..functions.keys import fold, header_key
from ..functions.names import department_code

COLUMNS = ["title", "text", "url", "date", "source", "department"]


def as_articles(df: DataFrame, **columns: Column) -> DataFrame:
    """The article columns, null where not given."""
    return df.select(*[columns.get(c, F.lit(None)).cast("string").alias(c) for c in COLUMNS])


def first_of(df: DataFrame, *names: str) -> Column:
    """First non-blank of the columns that there are."""
    found = [F.nullif(F.trim(F.col(n).cast("string")), F.lit("")) for n in names if n.split(".")[0] in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def rss(spark: SparkSession, path: str, label: str) -> DataFrame:
    """Items of RSS feeds."""
    schema = "title string, link string, pubDate string, updated string, description string, summary string"
    df = spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)
    return as_articles(df, title=F.col("title"), text=F.coalesce("description", "summary"), url=F.col("link"), date=F.coalesce("pubDate", "updated"), source=F.lit(label))


def sitemap(spark: SparkSession, path: str) -> DataFrame:
    """(url, title, date) of sitemaps, or of feeds."""
    schema = "loc string, link string, title string, lastmod string, pubDate string"
    parts = [spark.read.format("xml").option("rowTag", tag).schema(schema).load(path) for tag in ("url", "item")]
    both = parts[0].unionByName(parts[1])
    return both.select(F.trim(F.coalesce("loc", "link")).alias("url"), "title", F.coalesce("lastmod", "pubDate").alias("date")).filter("url <> ''")


def news_list(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """A list ``articles`` of title, url, seendate (20260112T080000Z) and domain; the text is empty."""
    df = spark.read.schema("articles array<struct<title:string, url:string, seendate:string, domain:string>>").json(path, multiLine=whole_files).select(F.inline("articles"))
    day = F.regexp_replace("seendate", r"^(\d{4})(\d{2})(\d{2}).*$", "$1-$2-$3")
    return as_articles(df, title=F.col("title"), text=F.lit(""), url=F.col("url"), date=day, source=F.col("domain"))


def registry_list(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """``articles.results`` with title, body, url, date and publisher; results without a URL go."""
    schema = "articles struct<results: array<struct<title:string, body:string, url:string, dateTime:string, date:string, source:struct<title:string, uri:string>>>>"
    df = spark.read.schema(schema).json(path, multiLine=whole_files).select(F.inline("articles.results")).filter("trim(url) <> ''")
    return as_articles(df, title=F.col("title"), text=F.col("body"), url=F.col("url"), date=F.coalesce("dateTime", "date"), source=F.coalesce("source.title", "source.uri"))


def stories(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    schema = "title string, name string, text string, url string, guid string, publish_date string, indexed_date string, media_name string, media_url string"
    df = spark.read.schema(schema).json(path, multiLine=whole_files)
    url = F.coalesce("url", "guid")
    return as_articles(df, title=F.coalesce("title", "name"), text=F.coalesce("text", F.lit("")), url=url, date=F.coalesce("publish_date", "indexed_date"), source=F.coalesce("media_name", "media_url")).filter("trim(url) <> ''")


def legal_results(spark: SparkSession, path: str, url_prefix: str, whole_files: bool = True) -> DataFrame:
    """Legal search results in their several shapes; text from whichever fields there are, without tags."""
    schema = """results array<struct<id:string, title:string, url:string, date:string, publicationDate:string, text:string, content:string, resume:string,
      titles:array<struct<id:string, title:string>>, sections:array<struct<extracts:array<struct<values:array<string>>>>>>>"""
    df = spark.read.schema(schema).json(path, multiLine=whole_files).select(F.inline("results"))
    extracts = F.array_join(F.flatten(F.flatten(F.transform("sections", lambda s: F.transform(s["extracts"], lambda e: e["values"])))), " ")
    text = F.trim(F.regexp_replace(F.regexp_replace(F.concat_ws(" ", "text", "content", "resume", extracts), r"<[^>]+>", " "), r"\s+", " "))
    title = F.coalesce(F.get("titles", 0)["title"], F.col("title"))
    key = F.coalesce("id", F.get("titles", 0)["id"])
    return as_articles(df, title=F.regexp_replace(title, r"<[^>]+>", ""), text=text, url=F.coalesce("url", F.concat(F.lit(url_prefix), key)), date=F.coalesce("date", "publicationDate"), source=F.lit("legal"))


def register_csv(spark: SparkSession, path: str, url_prefix: str) -> DataFrame:
    """Rows of an official register whose status is a withdrawal, as articles."""
    df = spark.read.csv(path, header=True, schema="denomination string, commune string, code_postal string, statut string")
    gone = df.filter(fold("statut").rlike("radie|cessation"))
    title = F.format_string("%s - %s (%s)", "denomination", "statut", "commune")
    return as_articles(gone, title=title, text=F.format_string("%s, %s %s : %s", "denomination", "code_postal", "commune", "statut"), url=F.concat(F.lit(url_prefix), F.substring(F.sha2(title, 256), 1, 16)), source=F.lit("register"), department=F.substring("code_postal", 1, 2))


def search_results(df: DataFrame, source: str) -> DataFrame:
    """Landed search results, whatever their fields are called."""
    return as_articles(df, title=first_of(df, "title", "name"), text=first_of(df, "snippet", "description"), url=first_of(df, "url", "link"), date=first_of(df, "date", "age", "datePublished"), source=F.lit(source))


def captures(index: DataFrame, keep: str, drop: str, per_domain: int) -> DataFrame:
    """Captures of an archive index worth reading: status 200, HTML, URL wanted and not unwanted, the newest of each URL, ``per_domain`` of each host."""
    ok = index.filter((F.col("status") == "200") & F.col("mime").contains("html") & F.col("url").rlike(keep) & ~F.col("url").rlike(drop))
    once = ok.groupBy("urlkey").agg(F.max_by(F.struct(*[c for c in index.columns if c != "urlkey"]), F.struct("timestamp", "url", "filename", "offset")).alias("_c")).select("urlkey", "_c.*")
    w = Window.partitionBy(web.host("url")).orderBy(F.desc("timestamp"), "urlkey")
    return once.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= per_domain).drop("_rn")


def page_articles(pages: DataFrame) -> DataFrame:
    """Archived pages (url, html, timestamp) as articles."""
    day = F.regexp_replace(F.substring("timestamp", 1, 8), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return as_articles(pages, title=web.page_title("html"), text=web.page_text("html"), url=F.col("url"), date=day, source=web.host("url"))


def full_texts(wanted: DataFrame, pages: DataFrame, known: DataFrame) -> DataFrame:
    """Full texts of wanted URLs that are not known with status ok; status ok, empty or error (no page)."""
    todo = wanted.select("url").distinct().join(known.filter("status = 'ok'").select("url"), "url", "left_anti")
    got = todo.join(pages.groupBy("url").agg(F.max("html").alias("html")), "url", "left").withColumn("full_text", web.page_text("html"))
    status = F.when(F.col("html").isNull(), "error").when(F.length("full_text") > 0, "ok").otherwise("empty")
    return got.select("url", web.host("url").alias("domain"), status.alias("status"), "full_text", F.substring(F.sha2(F.coalesce("full_text", F.lit("")), 256), 1, 16).alias("text_hash"))


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """URLs of a text file, one a line, without punctuation after them."""
    df = spark.read.text(path)
    url = F.rtrim(F.regexp_extract("value", r"https?://\S+", 0), F.lit(".,;)"))
    return as_articles(df, url=url).filter("url <> ''")


def by_headings(spark: SparkSession, path: str, aliases: dict[str, list[str]], sep: str = ",") -> DataFrame:
    """A CSV with human headings: each column of ``aliases`` is the first of its headings that there is, by key."""
    raw = spark.read.csv(path, header=True, sep=sep)
    return rename_by(raw, aliases)


def heading_keys(spark: SparkSession, names: list[str]) -> list[str]:
    row = spark.range(1).select(F.array(*[header_key(F.lit(n)) for n in names]).alias("k")).first()
    return row.k


def rename_by(raw: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    keys = heading_keys(raw.sparkSession, raw.columns) if raw.columns else []
    places = dict(zip(reversed(keys), reversed(raw.columns), strict=True))
    return raw.select(*[F.trim(F.coalesce(*[F.col(f"`{places[a]}`") for a in names if a in places], F.lit(None).cast("string"))).alias(c) for c, names in aliases.items()])


# Headings of curated lists, as keys.
CURATED = {"bank": ["banque", "enseigne"], "label": ["agence_/_localisation", "agence", "agence_localisation"], "place": ["commune", "ville"], "department": ["departement"], "closed_on": ["date_de_fermeture", "date_fermeture"], "name": ["source"], "url": ["lien_source", "url", "lien"], "text": ["elements_retenus", "texte", "extrait"], "plan": ["plan"]}


def curated(spark: SparkSession, path: str) -> DataFrame:
    """A curated list of events with their sources."""
    return by_headings(spark, path, CURATED).filter("coalesce(url, bank, place, '') <> ''")


def positional(spark: SparkSession, path: str, columns: dict[str, int]) -> DataFrame:
    """A list read by the columns' positions, without its heading and blank rows."""
    raw = spark.read.csv(path, header=True)
    df = raw.select(*[F.trim(F.col(f"`{raw.columns[i]}`")).alias(c) for c, i in columns.items() if i < len(raw.columns)])
    return df.filter(F.length(F.concat_ws("", *df.columns)) > 0)


def department_of(postal: Column) -> Column:
    return department_code(None, postal)
