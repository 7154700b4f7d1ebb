"""Exports: sections as JSON, lists as CSV, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import display

# Labels of the exports.
TEMPORAL_LABELS = {"closed": "Fermée", "upcoming": "À venir", "unknown": "Inconnu"}
NOT_GIVEN = "Non renseignée"


def label(c: Column, labels: dict[str, str], default: str) -> Column:
    out = F.lit(default)
    for k, v in reversed(labels.items()):
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def write_sections(sections: dict[str, DataFrame], path: str) -> None:
    """One folder of JSON lines per section."""
    for name, df in sections.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def event_rows(events: DataFrame, sources: DataFrame) -> DataFrame:
    """The human list: an event a row, its first source, labels, and whether it is to be verified."""
    first = sources.groupBy("event_id").agg(F.min_by(F.struct("url", "name"), "url").alias("_s"), F.array_join(F.sort_array(F.collect_set("url")), "\n").alias("sources"))
    review = F.coalesce(F.col("reliability") < 3, F.lit(True)) | F.col("closed_on").isNull() | F.coalesce(F.col("approximate"), F.lit(False))
    filled = lambda c: F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit(NOT_GIVEN)).alias(c)
    out = events.join(first, "event_id", "left")
    return out.select("event_id", *[filled(c) for c in ("bank", "place", "department", "address", "label", "closed_on")], label(F.col("temporal_status"), TEMPORAL_LABELS, "Inconnu").alias("temporal_status"), F.col("_s.url").alias("first_url"), F.col("_s.name").alias("first_source"), F.coalesce("sources", F.lit("")).alias("sources"), review.alias("to_verify"))


def _text(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))


# Headings of the list for readers, with the event's columns.
READERS = {
    "Banque": "bank", "Commune": "place", "Département": "department", "Région": "region", "Type d'information": "kind", "Temporalité": "temporal_status", "Impact Banque Postale": "service_impact", "Point postal avant": "point_before", "Point postal après": "point_after",
    "Niveau de preuve": "evidence_level", "Date annonce": "announced_on", "Date fermeture": "closed_on", "Source": "first_source", "URL": "first_url", "Fiabilité": "reliability", "À vérifier": "to_verify", "Citation": "evidence",
}
READER_LABELS = {"closed": "Déjà fermée", "upcoming": "À venir"}


def first_source(sources: DataFrame) -> DataFrame:
    """(event_id, first_url, first_source, first_title): of an event's sources the first by URL."""
    one = sources.groupBy("event_id").agg(F.min(F.struct("url", "name", "title")).alias("_s"))
    return one.select("event_id", F.col("_s.url").alias("first_url"), F.col("_s.name").alias("first_source"), F.col("_s.title").alias("first_title"))


def reader_list(events: DataFrame, sources: DataFrame) -> DataFrame:
    """The list for readers, with its 17 headings; an event is to be verified without a date, when not sure, or not confirmed."""
    unsure = F.col("closed_on").isNull() | (F.coalesce("reliability", F.lit(0)) < display.SURE) | ~F.col("status").eqNullSafe(F.lit("confirmed"))
    df = events.join(first_source(sources), "event_id", "left").withColumn("to_verify", F.when(unsure, "oui").otherwise("non"))
    df = df.withColumn("temporal_status", label(F.col("temporal_status"), READER_LABELS, "Inconnu"))
    return df.select(*[_text(c).alias(h) for h, c in READERS.items()])


def export_rows(events: DataFrame, sources: DataFrame, departments: DataFrame) -> DataFrame:
    """The full export, 19 columns: fallbacks where something is not given, all sources and the control as texts.

    ``departments`` (code, name, region) is a dimension of some hundred rows.
    """
    said = F.concat(F.coalesce(F.nullif("name", F.lit("")), F.lit("source")), F.lit(": "), F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("url", F.lit("")))
    lists = sources.groupBy("event_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.coalesce("url", F.lit("")).alias("u"), said.alias("s")))), lambda x: x["s"]), "\n").alias("all_sources"))
    dim = departments.select(F.col("code").alias("department"), F.col("name").alias("_name"), F.col("region").alias("_region"))
    df = events.join(first_source(sources), "event_id", "left").join(lists, "event_id", "left").join(F.broadcast(dim), "department", "left")
    place = F.when(display.meaningful_place(F.col("place")), F.trim("place")).otherwise(NOT_GIVEN)
    department = F.when(_text("department") == "", "Non renseigné").when(F.col("_name").isNotNull(), F.concat_ws(" - ", "department", "_name")).otherwise(_text("department"))
    region = F.coalesce(F.nullif(_text("region"), F.lit("")), "_region", F.lit(NOT_GIVEN))
    control = F.trim(F.concat_ws(" ", "control.status", "control.register_id", "control.source"))
    review = F.when(display.needs_review(F.col("place"), F.col("closed_on"), F.col("reliability"), F.col("status")), "oui").otherwise("non")
    return df.select(
        _text("bank").alias("bank"), place.alias("place"), department.alias("department"), region.alias("region"), _text("kind").alias("kind"), _text("status").alias("status"), "reliability", review.alias("to_verify"), _text("closed_on").alias("closed_on"), _text("announced_on").alias("announced_on"),
        F.coalesce("first_source", F.lit("")).alias("source"), F.coalesce("first_url", F.lit("")).alias("url"), _text("evidence").alias("evidence"), "lat", "lon", _text("code").alias("code"), "event_id", F.coalesce("all_sources", F.lit("")).alias("sources"), F.coalesce(control, F.lit("")).alias("control"),
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_report(findings: DataFrame, summary: DataFrame, path: str) -> None:
    """Findings as JSON and CSV, with their summary."""
    findings.write.mode("overwrite").json(f"{path}/findings_json")
    write_csv(findings, f"{path}/findings_csv")
    summary.write.mode("overwrite").json(f"{path}/summary_json")
