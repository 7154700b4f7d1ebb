"""Structured extraction results to events and tiered signals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import content_id

RESULT = """struct<article_type:string, source_reliability:string,
closures:array<struct<bank:string, agency_label:string, commune:string, departement:string, address:string, closure_date:string, date_precision:string, status:string, closure_type:string, is_physical_agency:boolean, confidence:double, evidence:string>>,
department_signals:array<struct<bank:string, departement:string, count:int, confidence:double, evidence:string>>,
vague_signals:array<struct<bank:string, scope:string, count:int, confidence:double, evidence:string>>,
confidence:double, needs_review:boolean, reason:string>"""


def parse(rows: DataFrame, c: str, schema: str = RESULT, checks: dict[str, list[str]] = {}, unit: list[str] = ["confidence"]) -> DataFrame:  # noqa: B006
    """``rows`` with ``parsed`` and ``valid``: enumerations hold one of their values, numbers of ``unit`` are from 0 to 1."""
    out = rows.withColumn("parsed", F.from_json(c, schema))
    ok = F.col("parsed").isNotNull()
    for f, values in checks.items():
        ok = ok & F.coalesce(F.col(f"parsed.{f}").isin(values), F.lit(False))
    for f in unit:
        ok = ok & F.coalesce(F.col(f"parsed.{f}").between(0, 1), F.lit(True))
    return out.withColumn("valid", ok)


@dataclass(frozen=True)
class Field:
    """A field of a result: its type, what stands for a missing value, and what a value must be."""

    name: str
    kind: str = "string"
    default: object = None
    required: bool = False
    values: tuple[str, ...] = ()
    between: tuple[float, float] | None = None

    def reasons(self, v: Column) -> list[Column]:
        """A column for each rule, with its reason where the value breaks it, else null."""
        out = []
        if self.required:
            out.append(F.when(v.isNull(), F.lit(f"{self.name} missing")))
        if self.values:
            out.append(F.when(~v.isin(*self.values), F.lit(f"{self.name} unknown")))
        if self.between:
            out.append(F.when(~v.between(*self.between), F.lit(f"{self.name} out of range")))
        return out

    def value(self, v: Column) -> Column:
        if self.default is None:
            return v.alias(self.name)
        empty = F.array().cast(self.kind) if self.default == [] else F.lit(self.default)
        return F.coalesce(v, empty).alias(self.name)


_CONFIDENCE = Field("confidence", "double", 0.0, between=(0, 1))
# The fields of an extraction result, their values and defaults.
ARTICLE = [
    Field("article_type", required=True, values=("single_closure", "list_closures", "department_signal", "regional_signal", "national_signal", "social_hr", "out_of_scope", "ambiguous")),
    Field("source_reliability", default="weak", values=("primary", "local_press", "national_press", "aggregator", "weak")),
    _CONFIDENCE,
    Field("needs_review", "boolean", False),
    Field("reason", default=""),
]
ITEMS: dict[str, list[Field]] = {
    "closures": [
        Field("bank", required=True), Field("agency_label", default=""), Field("commune", required=True), Field("departement"), Field("region"), Field("address", default=""), Field("closure_date"),
        Field("date_precision", default="unknown", values=("exact", "month", "year", "approximate", "unknown")), Field("status", required=True, values=("confirmed", "announced", "contested", "threatened", "unclear")),
        Field("closure_type", required=True, values=("closure", "regroupement", "transfer", "merge", "threatened_closure")), Field("is_physical_agency", "boolean", True), Field("confidence", "double", required=True, between=(0, 1)), Field("evidence", default=""),
    ],
    "department_signals": [Field("bank", required=True), Field("departement"), Field("count", "int"), Field("communes_mentioned", "array<string>", []), _CONFIDENCE, Field("evidence", default="")],
    "vague_signals": [Field("bank", default=""), Field("scope", default="unknown", values=("regional", "national", "unknown")), Field("count", "int"), _CONFIDENCE, Field("evidence", default="")],
}


def _record(fields: list[Field]) -> str:
    return ", ".join(f"{f.name}:{f.kind}" for f in fields)


def validated(rows: DataFrame, c: str, top: list[Field] = ARTICLE, items: dict[str, list[Field]] = ITEMS) -> DataFrame:
    """``rows`` with ``parsed``, ``valid``, ``rejected`` and ``corrupt``, from the JSON in ``c``.

    Each element of each array is judged and completed by itself: those that
    break no rule are in ``parsed``, with defaults for what is missing, the
    others in ``rejected``, an array of (field, position from 0, reasons).
    Rules that the result itself breaks are there with a null position, and it
    is not ``valid``.  ``corrupt`` has the text of what is no JSON of this
    shape, which is not valid either; its values, and those of another type, count
    as missing.
    A null array is an empty one, a null element is rejected as one without
    any value, a null text is corrupt without a text.
    """
    shape = ", ".join(f"{name}:array<struct<{_record(f)}>>" for name, f in items.items())
    read = F.from_json(F.col(c), f"struct<{_record(top)}, {shape}, _corrupt:string>", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    df = rows.withColumn("_read", read)
    compact = lambda found: F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")

    def judged(name: str, fields: list[Field]) -> Column:
        each = lambda e, i: F.struct(F.lit(name).alias("field"), i.cast("int").alias("position"), compact([r for f in fields for r in f.reasons(e[f.name])]).alias("reasons"), F.struct(*[f.value(e[f.name]) for f in fields]).alias("value"))
        return F.coalesce(F.transform(F.col(f"_read.{name}"), each), F.array().cast(f"array<struct<field:string, position:int, reasons:array<string>, value:struct<{_record(fields)}>>>"))

    df = df.withColumns({f"_{name}": judged(name, fields) for name, fields in items.items()})
    own = compact([r for f in top for r in f.reasons(F.col(f"_read.{f.name}"))])
    good = {name: F.transform(F.filter(f"_{name}", lambda x: F.size(x["reasons"]) == 0), lambda x: x["value"]).alias(name) for name in items}
    bad = [F.transform(F.filter(f"_{name}", lambda x: F.size(x["reasons"]) > 0), lambda x: F.struct(x["field"].alias("field"), x["position"].alias("position"), x["reasons"].alias("reasons"))) for name in items]
    itself = F.when(F.size("_own") > 0, F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("int").alias("position"), F.col("_own").alias("reasons")))).otherwise(F.array().cast("array<struct<field:string, position:int, reasons:array<string>>>"))
    df = df.withColumn("_own", own)
    out = df.withColumns({
        "parsed": F.struct(*[f.value(F.col(f"_read.{f.name}")) for f in top], *good.values()),
        "rejected": F.concat(itself, *bad),
        "corrupt": F.when(F.col(c).isNull() | F.col("_read").isNull(), F.col(c)).otherwise(F.col("_read._corrupt")),
        "valid": F.col(c).isNotNull() & F.col("_read").isNotNull() & F.col("_read._corrupt").isNull() & (F.size("_own") == 0),
    })
    return out.drop("_read", "_own", *[f"_{name}" for name in items])


def ledger(checked: DataFrame, *key: str) -> DataFrame:
    """(key, field, position, reason): every reason for which :func:`validated` rejected something."""
    one = checked.select(*key, F.inline("rejected"))
    return one.select(*key, "field", "position", F.explode("reasons").alias("reason"))


def needs_second_pass(parsed: Column, least: float = 0.5) -> Column:
    return F.coalesce(parsed["needs_review"], F.lit(False)) | (parsed["article_type"] == "ambiguous") | (F.coalesce(parsed["confidence"], F.lit(0.0)) < least) | ((F.size(F.coalesce(parsed["closures"], F.array())) == 0) & (parsed["article_type"] == "closure"))


def explode_signals(rows: DataFrame, field: str, key: list[str]) -> DataFrame:
    """One row per signal with an id of the URL and the key's values."""
    out = rows.select("url", F.inline(f"parsed.{field}"))
    return out.withColumn("id", content_id("url", *key))


def one_signal(rows: DataFrame, items: str, most: int = 500) -> DataFrame:
    """One weak signal per article: first bank and department, joined evidence, highest score."""
    a = F.col(items)
    pick = lambda f: F.try_element_at(F.filter(F.transform(a, lambda x: x[f]), lambda x: x.isNotNull() & (x != "")), F.lit(1))
    texts = F.filter(F.transform(a, lambda x: x["evidence"]), lambda x: x.isNotNull() & (x != ""))
    return rows.select("url", pick("bank").alias("bank"), pick("department").alias("department"), F.substring(F.array_join(texts, " | "), 1, most).alias("evidence"), F.array_max(F.transform(a, lambda x: x["score"])).alias("score"))


def per_place(rows: DataFrame, places: str, *keep: str) -> DataFrame:
    """One row per place of a plan, with its position."""
    return rows.select(*keep, F.posexplode(places).alias("place_pos", "place"))


def by_url(rows: DataFrame, url: str, seq: str, texts: list[str], lists: list[str]) -> DataFrame:
    """Curated rows of one URL as one: texts joined and values listed, each once, in order."""
    ordered = lambda c: F.array_distinct(F.filter(F.transform(F.sort_array(F.collect_list(F.struct(F.col(seq).alias("s"), F.col(c).alias("v")))), lambda x: x["v"]), lambda v: v.isNotNull() & (v != "")))
    return rows.groupBy(url).agg(*[F.array_join(ordered(c), " ").alias(c) for c in texts], *[ordered(c).alias(c) for c in lists])


def feature(lon: Column, lat: Column, properties: Column) -> Column:
    """GeoJSON of a point, null where a coordinate is missing."""
    point = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"), properties.alias("properties"))
    return F.when(lon.isNotNull() & lat.isNotNull(), F.to_json(point))


def missing_point(points: DataFrame, revision: Column, brand: str, page: str, score: int = 5) -> DataFrame:
    """Review records of points (point_id, label, department) that a revision no longer has."""
    quoted = F.replace(F.url_encode(F.coalesce("point_id", F.lit(""))), F.lit("+"), F.lit("%20"))
    return points.select(
        content_id(F.lit("laposte-missing"), "point_id", revision).alias("id"), F.lit(brand).alias("bank"), "department", F.concat(F.lit("Disparition à confirmer du bureau de poste "), "label").alias("title"),
        F.concat(F.lit(page + "?point="), quoted).alias("url"), F.substring(revision, 1, 10).alias("date"), F.lit(score).alias("score"),
    )
