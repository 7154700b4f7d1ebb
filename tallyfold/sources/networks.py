"""Landed networks, registers, calendars and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import canonical, text_hash
from ..functions.names import department_code
from .articles import rename_by

# Headings of branch files, as keys, and their delimiters.
BRANCH_HEADINGS = {"branch_id": ["identifiant", "id", "code"], "name": ["libelle", "nom", "libelle_du_site"], "address": ["adresse"], "postal_code": ["code_postal", "cp"], "place": ["localite", "commune", "ville"], "lat": ["latitude", "lat"], "lon": ["longitude", "lon", "lng"], "both": ["coordonnees", "latlong", "geo_point_2d"]}
DELIMITERS = [";", "\t", ","]


def osm_branches(spark: SparkSession, path: str, excluded: list[str] = [], whole_files: bool = True) -> DataFrame:  # noqa: B006
    """Branches of an OSM extract; ways have their centre's coordinates."""
    schema = "elements array<struct<type:string, id:bigint, lat:double, lon:double, center:struct<lat:double, lon:double>, tags:map<string,string>>>"
    e = spark.read.schema(schema).json(path, multiLine=whole_files).select(F.inline("elements"))
    tag = lambda k: F.nullif(F.trim(F.try_element_at("tags", F.lit(k))), F.lit(""))
    df = e.select(F.concat_ws("/", "type", "id").alias("branch_id"), F.coalesce(tag("operator"), tag("brand"), tag("name")).alias("bank"), tag("name").alias("name"), F.concat_ws(" ", tag("addr:housenumber"), tag("addr:street")).alias("address"), tag("addr:postcode").alias("postal_code"), tag("addr:city").alias("place"), F.coalesce("lat", "center.lat").alias("lat"), F.coalesce("lon", "center.lon").alias("lon"))
    out = df.withColumn("department", department_code(None, "postal_code")).filter("bank is not null")
    return out.filter(~canonical("bank").isin(excluded)) if excluded else out


def delimiter(spark: SparkSession, path: str) -> str:
    """The delimiter that a file's heading has most of."""
    head = spark.read.text(path).limit(1).first()
    line = head.value if head else ""
    return max(DELIMITERS, key=lambda d: (line.count(d), -DELIMITERS.index(d)))


def branch_csv(spark: SparkSession, path: str, bank: str) -> DataFrame:
    """Branches of a CSV with any of the usual delimiters and headings, decimal commas, or both coordinates in one cell."""
    raw = spark.read.csv(path, header=True, sep=delimiter(spark, path))
    df = rename_by(raw, BRANCH_HEADINGS)
    number = lambda c: F.translate(F.trim(c), ",", ".").try_cast("double")
    parts = F.split("both", r"\s*,\s*")
    df = df.withColumns({"lat": F.coalesce(number(F.col("lat")), F.get(parts, 0).try_cast("double")), "lon": F.coalesce(number(F.col("lon")), F.get(parts, 1).try_cast("double")), "postal_code": F.lpad("postal_code", 5, "0")})
    key = F.concat_ws("|", "name", "address", "postal_code", "place")
    df = df.withColumn("branch_id", F.coalesce(F.nullif("branch_id", F.lit("")), text_hash(key))).filter(F.length(F.concat_ws("", "name", "address", "place")) > 0)
    return df.withColumn("bank", F.lit(bank)).withColumn("department", department_code(None, "postal_code")).drop("both")


def points(spark: SparkSession, path: str, revision: str) -> DataFrame:
    """Points of a network at a revision."""
    schema = "identifiant_a string, identifiant string, libelle_du_site string, caracteristique_du_site string, adresse string, code_postal string, localite string, code_insee string, latitude double, longitude double"
    df = spark.read.schema(schema).json(path)
    postal = F.lpad(F.trim("code_postal"), 5, "0")
    out = df.select(F.trim(F.coalesce("identifiant_a", "identifiant")).alias("point_id"), F.trim("libelle_du_site").alias("label"), F.trim("caracteristique_du_site").alias("characteristic"), F.trim("adresse").alias("address"), postal.alias("postal_code"), F.trim("localite").alias("locality"), F.trim("code_insee").alias("code"), department_code("code_insee", postal).alias("department"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    return out.filter("point_id <> ''").withColumn("revision", F.lit(revision))


def calendar(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """(point_id, day, is_open): open if a slot has a value other than closed."""
    df = spark.read.schema("identifiant string, date_calendrier string, bp_plage_horaire_1 string, bp_plage_horaire_2 string").json(path)
    used = lambda c: F.coalesce((F.trim(c) != "") & (canonical(c) != "ferme"), F.lit(False))
    out = df.select(F.col("identifiant").alias("point_id"), F.try_to_date(F.substring("date_calendrier", 1, 10)).alias("day"), (used(F.col("bp_plage_horaire_1")) | used(F.col("bp_plage_horaire_2"))).alias("is_open"))
    return out if wanted is None else out.join(wanted.select("point_id").distinct(), "point_id", "left_semi")


def locator(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """Events of a locator crawl that have a place and a date; the message gives both the date and where customers go."""
    df = spark.read.schema("id string, name string, city string, postal_code string, address string, message string").json(path, multiLine=whole_files)
    day = F.try_to_date(F.regexp_extract("message", r"(\d{2}/\d{2}/\d{4})", 1), "dd/MM/yyyy")
    to = F.nullif(F.regexp_extract("message", r"(?i)agence\s+(?:de\s+)?([^.,;]+)", 1), F.lit(""))
    out = df.select(F.col("id").alias("branch_id"), "name", F.col("city").alias("place"), "address", day.alias("closed_on"), F.trim(to).alias("destination"), department_code(None, "postal_code").alias("department"))
    return out.filter("place is not null and closed_on is not null")


def administrative_status(requests: DataFrame, register: DataFrame) -> DataFrame:
    """``requests`` (bank, place) with the status of the first ranked entry of their names in a landed register (name, place, status, rank)."""
    known = register.select(canonical("name").alias("_n"), canonical("place").alias("_p"), F.struct("rank", "status").alias("_s")).groupBy("_n", "_p").agg(F.min("_s").alias("_s"))
    keyed = requests.withColumns({"_n": canonical("bank"), "_p": canonical("place")})
    return keyed.join(known, ["_n", "_p"], "left").select(*requests.columns, F.coalesce("_s.status", F.lit("unknown")).alias("register_status"))


def override_rules(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(source rules, row rules) of a rules file, each with its position."""
    fields = "source_reliability:string, source_flag:string, next_action:string, note:string"
    schema = f"sources array<struct<match_source:string, require_no_url:boolean, default_status_if_uncovered:string, default_next_action:string, {fields}>>, rows array<struct<match:struct<banque:string, commune:string, agence_localisation:string>, status:string, missing_reason:string, {fields}>>"
    df = spark.read.schema(schema).json(path, multiLine=True)
    numbered = lambda c: df.select(F.posexplode(c).alias("rule_pos", "r")).select("rule_pos", "r.*")
    return numbered("sources"), numbered("rows")


def polygons(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """(code, name, geometry as JSON) of a GeoJSON collection."""
    schema = "features array<struct<properties:struct<code:string, nom:string>, geometry:struct<type:string, coordinates:string>>>"
    f = spark.read.schema(schema).json(path, multiLine=whole_files).select(F.inline("features"))
    return f.select(F.col("properties.code").alias("code"), F.col("properties.nom").alias("name"), F.to_json("geometry").alias("geometry"))


def announced_plans(spark: SparkSession, plans: list[tuple[str, int, str, str]]) -> DataFrame:
    """A hand-kept list of announced plans without named branches."""
    return spark.createDataFrame(plans, "bank string, n int, period string, url string")


def latest_points(history: DataFrame) -> DataFrame:
    """The last revision of each point."""
    w = Window.partitionBy("point_id").orderBy(F.desc("revision"))
    return history.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
