"""Names to places of a gazetteer (key, department, code, rank, ...), by equi-joins on keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import canonical, place_key
from .select import among


def resolve(requests: DataFrame, gazetteer: DataFrame, name: str = "name", department: str = "department", listed: bool = True) -> DataFrame:
    """``requests`` with resolved_code, resolved_department, ambiguous and candidates, or n_candidates if they are not to be ``listed``.

    With a department the first ranked feature in it counts.  Without one, the
    first of all, unless features of exactly that name have several codes: then
    the request is ambiguous, with the codes as candidates, and resolves to
    nothing.  Features of one name and rank are told apart by code.
    """
    features = gazetteer.select(place_key("name").alias("_key"), F.struct("rank", "code", F.col("department").alias("department")).alias("_f"))
    # the gazetteer is folded first, so that requests stay one row each however many namesakes there are
    codes = F.sort_array(F.collect_set(F.when(F.col("_f.code") != "", F.col("_f.code"))))
    n_codes = F.count_distinct(F.when(F.col("_f.code") != "", F.col("_f.code")))
    of_name = features.groupBy("_key").agg(F.min("_f").alias("_any"), n_codes.cast("int").alias("_n"), *([codes.alias("_codes")] if listed else []))
    of_both = features.groupBy("_key", F.col("_f.department").alias("_wanted")).agg(F.min("_f").alias("_own"))
    asked = requests.withColumn("_key", place_key(name)).withColumn("_wanted", F.coalesce(F.col(department), F.lit("")))
    # the lists of codes come last, so that no request takes one through a shuffle
    out = asked.join(of_both.hint("merge"), ["_key", "_wanted"], "left").join(of_name.hint("merge"), "_key", "left")
    out = out.withColumn("_hit", F.when(F.col("_wanted") == "", F.col("_any")).otherwise(F.col("_own")))
    vague = (F.col("_wanted") == "") & (F.coalesce("_n", F.lit(0)) > 1)
    pick = lambda f: F.when(~vague, F.col(f"_hit.{f}"))
    found = F.when(vague, F.col("_codes")).otherwise(F.array().cast("array<string>")).alias("candidates") if listed else F.when(vague, F.col("_n")).otherwise(F.lit(0)).alias("n_candidates")
    return out.select(*requests.columns, pick("code").alias("resolved_code"), pick("department").alias("resolved_department"), vague.alias("ambiguous"), found)


def variants(name: Column) -> Column:
    """A name and what it may stand for: the part before " / " or a dash, and a capitalised first part of four letters before a hyphen."""
    before = lambda sep: F.trim(F.split(name, sep)[0])
    head = F.split(name, "-")[0]
    parts = F.array(F.trim(name), before(" / "), before(" – "), F.when(head.rlike(r"(?U)^\p{Lu}[\p{L}']{3,}$"), head))
    return F.array_distinct(F.filter(F.array_compact(parts), lambda x: x != ""))


def resolve_variants(requests: DataFrame, gazetteer: DataFrame, request: str = "request_id", name: str = "name", department: str = "department") -> DataFrame:
    """As :func:`resolve` with the variants of a name in turn: the name itself if found or ambiguous, else the first variant with a code."""
    rows = requests.select("*", F.posexplode(variants(F.col(name))).alias("_pos", "_variant"))
    asked = rows.select(F.struct(request, "_pos").alias("_id"), F.col("_variant").alias("name"), F.col(department).alias("department"))
    hits = resolve(asked, gazetteer, "name", "department").filter("resolved_code is not null or (_id._pos = 0 and ambiguous)")
    best = hits.groupBy(F.col(f"_id.{request}").alias(request)).agg(F.min_by(F.struct(F.col("name").alias("matched_name"), "resolved_code", "resolved_department", "ambiguous"), "_id._pos").alias("_b"))
    return requests.join(best.hint("merge"), request, "left").select(*requests.columns, "_b.matched_name", "_b.resolved_code", "_b.resolved_department", F.coalesce("_b.ambiguous", F.lit(False)).alias("ambiguous"))


def by_address(requests: DataFrame, addresses: DataFrame, address: str = "address") -> DataFrame:
    """Requests with the features of the same address, by its key; the first ranked one."""
    table = addresses.select(canonical("address").alias("_key"), F.struct("rank", "code", "lat", "lon").alias("_f")).groupBy("_key").agg(F.min("_f").alias("_f"))
    return requests.withColumn("_key", canonical(address)).join(table, "_key", "left").select(*requests.columns, F.col("_f.code").alias("resolved_code"), "_f.lat", "_f.lon")


def valid_candidates(rows: DataFrame, gazetteer: DataFrame, row: str, names: str, most: int) -> DataFrame:
    """(row, places): the candidate names that are in the gazetteer, distinct and in order, ``most`` at most."""
    items = rows.select(row, F.posexplode(names).alias("_pos", "_name")).withColumn("_key", place_key("_name"))
    known = gazetteer.select(place_key("name").alias("_key")).distinct()
    # names are as many as a text lists, so they are told apart in their row: one shuffle, and none by names that many rows have
    found = among(items, "_key", known).groupBy(row).agg(F.sort_array(F.collect_list(F.struct("_pos", "_name", "_key"))).alias("_f"))
    found = found.withColumn("_keys", F.transform("_f", lambda x: x["_key"]))
    first = F.filter("_f", lambda x, i: F.array_position(F.col("_keys"), x["_key"]) == i + 1)
    return found.select(row, F.transform(F.slice(first, 1, most), lambda x: x["_name"]).alias("places"))


def reattach(events: DataFrame, official: str, place: str = "place", original: str = "original_place") -> DataFrame:
    """Events under their official place, with the name they came with kept where it differs."""
    moved = place_key(official) != place_key(place)
    return events.withColumn(original, F.when(moved, F.col(place))).withColumn(place, F.when(moved, F.col(official)).otherwise(F.col(place)))


def fill_department(c: Column, supported: Column, valid: Column) -> Column:
    """A department that is not valid is that of the source, where it supports exactly one."""
    return F.when(valid, c).when(F.size(supported) == 1, F.get(supported, 0)).otherwise(c)
