from datetime import date

from pyspark.sql import functions as F

from tallyfold.plans import jobs

GAZETTEER = "name string, department string, code string, rank int"


def test_full_run_publishes_and_explains(spark):
    rows = [
        ("LCL : l'agence de Plouzané ferme le 5 mars 2026", "L'agence de Plouzané dans le Finistère ferme. Le LCL part.", "u1", "2026-01-05"),
        ("LCL : l'agence de Valence ferme le 5 mars 2026", "L'agence LCL de Valence ferme.", "u2", "2026-01-05"),
        ("Football à Brest", "Le match.", "u3", "2026-01-05"),
        ("LCL : l'agence de Brest ferme", "déjà vu", "u4", "2026-01-05"),
    ]
    landed = [spark.createDataFrame(rows, "title string, text string, url string, date string")]
    seen = spark.createDataFrame([("u4",)], "url string")
    texts = spark.createDataFrame([], "url string, status string, full_text string")
    g = spark.createDataFrame([("Plouzané", "29", "29212", 0), ("Brest", "29", "29019", 0), ("Valence", "26", "26362", 0), ("Valence", "82", "82186", 1)], GAZETTEER)
    signals = spark.createDataFrame([("s1", "u1"), ("s2", "u9")], "id string, url string")
    out = jobs.full_run(landed, seen, texts, g, signals)
    assert [(r.place, r.department, r.resolved_code, r.closed_on) for r in out["published"].collect()] == [("Plouzané", "29", "29212", date(2026, 3, 5))]
    assert [(r.place, r.reason) for r in out["quarantined"].collect()] == [("Valence", "ambiguous place")]
    assert {r.outcome: r.n for r in out["recap"].collect()} == {"extract": 2, "irrelevant": 1}
    assert [r.id for r in out["open_signals"].collect()] == ["s2"]


def test_audit_finds_each_kind(spark):
    e = spark.createDataFrame(
        [("1", "b", "Saint-Martin", "01", "ok", None, "2024-01-01"), ("2", "b", "Saint Martine", "01", "rumeur folle", "2024-02-01", "2024-01-01"), ("3", "b", "L'agence", "01", "ok", "2024-02-01", "2024-01-01")],
        "event_id string, bank string, place string, department string, evidence string, c string, k string",
    ).withColumns({"closed_on": F.col("c").cast("date"), "created_at": F.col("k").cast("timestamp")})
    got = {(r.kind, r.event_id) for r in jobs.audit(e, F.lit("2024-12-01").cast("date"), ["rumeur"]).collect()}
    assert got == {("not_publishable", "3"), ("suspicious_evidence", "2"), ("missing_date", "1"), ("near_name", "1")}


def test_network_revision(spark):
    schema = "point_id string, label string, locality string, code string, is_full boolean"
    before = spark.createDataFrame([("a", "A", "Lyon", "1", True), ("b", "B", "Brest", "2", True), ("c", "C", "Nice", "3", True)], schema)
    after = spark.createDataFrame([("b", "B", "Brest", "2", False), ("c", "C2", "Nice", "3", True), ("n", "N", "LYON", "9", False)], schema)
    out = jobs.network_revision(before, after, F.col("is_full"))
    assert {r.point_id: r.change for r in out["diff"].collect()} == {"a": "missing", "b": "same", "c": "changed", "n": "inserted"}
    assert [r.point_id for r in out["downgraded"].collect()] == ["b"] and [(r.point_id, r.replaced_by) for r in out["replaced"].collect()] == [("a", "n")]
