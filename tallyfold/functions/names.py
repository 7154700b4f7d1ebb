"""Names of brands, places and departments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lexicon
from .keys import canonical, loose_key, place_key, text

#: What stands for "not given"; a fixed list.
BLANKS = ["", "null", "none", ".", "-", "?", "inconnu", "inconnue", "non renseigne", "non renseignee", "non precise", "non precisee"]


def meaningful(c: Column | str) -> Column:
    return ~F.coalesce(canonical(c), F.lit("")).isin(BLANKS)


def alias_table(spark: SparkSession, brands: dict[str, list[str]] | None = None) -> DataFrame:
    """(alias, canonical) of a vocabulary; its size is that of the vocabulary."""
    rows = [(a, name) for name, spellings in (brands or lexicon.BRANDS).items() for a in spellings]
    return spark.createDataFrame(rows, "alias string, canonical string")


def canonical_name(df: DataFrame, name: str, aliases: DataFrame, out: str = "canonical_name", key=loose_key) -> DataFrame:
    """``df`` with the canonical form of ``name``.

    An alias with the same key gives it; else the longest canonical name that
    the key starts with, followed by a space; else the trimmed name itself.
    ``aliases`` (alias, canonical) is a vocabulary, small by nature.
    """
    exact = aliases.select(key("alias").alias("_key"), F.col("canonical").alias("_exact")).groupBy("_key").agg(F.min("_exact").alias("_exact"))
    prefixes = aliases.select(key("canonical").alias("p"), "canonical").filter("p <> ''").distinct()
    table = prefixes.agg(F.sort_array(F.collect_list(F.struct((-F.length("p")).alias("l"), "p", "canonical"))).alias("_prefixes"))
    keyed = df.withColumn("_key", key(F.coalesce(F.col(name), F.lit(""))))
    found = keyed.join(F.broadcast(exact), "_key", "left").crossJoin(F.broadcast(table))  # one row
    longest = F.get(F.filter("_prefixes", lambda x: (F.col("_key") == x["p"]) | F.startswith(F.col("_key"), F.concat(x["p"], F.lit(" ")))), 0)["canonical"]
    return found.withColumn(out, F.coalesce("_exact", longest, F.trim(F.coalesce(F.col(name), F.lit(""))))).drop("_key", "_exact", "_prefixes")


def is_known(c: Column | str, brands: dict[str, list[str]] | None = None) -> Column:
    return text(c).isin(list(brands or lexicon.BRANDS))


def department_code(insee: Column | str | None, postal: Column | str | None = None) -> Column:
    """Department of a municipality code, or else of a postal code.

    Overseas codes have three digits, Corsica's letters; a Corsican postal code
    alone does not say which of the two departments it is.
    """

    def of(c: Column, letters: bool) -> Column:
        c = F.upper(F.trim(c))
        island = F.when(F.substring(c, 1, 2).isin("2A", "2B"), F.substring(c, 1, 2)) if letters else F.lit(None).cast("string")
        overseas = F.when(F.substring(c, 1, 2).isin("97", "98"), F.substring(c, 1, 3))
        plain = F.when(c.rlike("^[0-9]{5}$") & ~F.startswith(c, F.lit("20")), F.substring(c, 1, 2))
        return F.coalesce(island, overseas, plain)

    parts = [of(text(c), letters) for c, letters in ((insee, True), (postal, False)) if c is not None]
    return F.coalesce(*parts)


def department_table(spark: SparkSession, departments: dict[str, str] | None = None) -> DataFrame:
    rows = list((departments or lexicon.DEPARTMENTS).items())
    return spark.createDataFrame(rows, "code string, name string").withColumn("key", place_key("name"))


def to_department(df: DataFrame, c: str, departments: DataFrame, out: str = "department_code") -> DataFrame:
    """Code of a department given by code or name, null if neither is known; ``departments`` is a dimension."""
    codes = departments.select(F.col("code").alias("_code"), F.col("code").alias("_by_code"))
    names = departments.select(F.col("key").alias("_name"), F.col("code").alias("_by_name"))
    keyed = df.withColumn("_code", F.upper(F.trim(F.col(c)))).withColumn("_name", place_key(c))
    return keyed.join(F.broadcast(codes), "_code", "left").join(F.broadcast(names), "_name", "left").withColumn(out, F.coalesce("_by_code", "_by_name")).drop("_code", "_name", "_by_code", "_by_name")


def region_of(df: DataFrame, department: str, regions: DataFrame, out: str = "region") -> DataFrame:
    """Region of a department; ``regions`` (department, region) is a dimension."""
    dim = regions.select(F.col("department").alias("_department"), F.col("region").alias(out))
    return df.join(F.broadcast(dim), F.col(department) == F.col("_department"), "left").drop("_department")


def lookup(c: Column, table: dict[str, str], default: str | None = None) -> Column:
    """Value of a small fixed mapping, by folded key."""
    out = F.lit(default)
    for k, v in reversed(table.items()):
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out
