import json

from tallyfold.operators import signals


def test_elements_are_judged_by_themselves(spark):
    good = {"bank": "LCL", "commune": "Lens", "status": "announced", "closure_type": "merge", "confidence": 0.5}
    rows = [
        (1, json.dumps({"article_type": "single_closure", "closures": [good, {**good, "confidence": 1.5, "status": "gone"}, None, {"bank": "CIC"}], "department_signals": [{"bank": "X", "communes_mentioned": ["a"]}, {"departement": "59"}], "vague_signals": [{}, {"scope": "galactic"}]})),
        (2, json.dumps({"source_reliability": "rumour", "confidence": -1})), (3, "{no json"), (4, None), (5, json.dumps({"article_type": "out_of_scope", "closures": None, "confidence": "high"})), (6, ""), (7, json.dumps({"article_type": "ambiguous", "more": 1})),
    ]
    checked = signals.validated(spark.createDataFrame(rows, "id int, j string"), "j")
    got = {r.id: r for r in checked.collect()}
    one = got[1]
    assert one.valid and one.corrupt is None and len(one.parsed.closures) == 1
    c = one.parsed.closures[0]
    assert (c.bank, c.agency_label, c.date_precision, c.is_physical_agency, c.confidence, c.evidence, c.departement) == ("LCL", "", "unknown", True, 0.5, "", None)
    assert [(s.bank, s.communes_mentioned, s.confidence) for s in one.parsed.department_signals] == [("X", ["a"], 0.0)] and [(v.bank, v.scope) for v in one.parsed.vague_signals] == [("", "unknown")]
    assert [(x.field, x.position, x.reasons) for x in one.rejected] == [
        ("closures", 1, ["status unknown", "confidence out of range"]), ("closures", 2, ["bank missing", "commune missing", "status missing", "closure_type missing", "confidence missing"]), ("closures", 3, ["commune missing", "status missing", "closure_type missing", "confidence missing"]),
        ("department_signals", 1, ["bank missing"]), ("vague_signals", 1, ["scope unknown"]),
    ]
    assert not got[2].valid and [(x.field, x.position, x.reasons) for x in got[2].rejected] == [(None, None, ["article_type missing", "source_reliability unknown", "confidence out of range"])]
    assert [(got[i].valid, got[i].corrupt) for i in (3, 4)] == [(False, "{no json"), (False, None)]
    assert not got[5].valid and got[5].corrupt == rows[4][1] and got[5].parsed.closures == [] and got[5].parsed.confidence == 0.0
    assert not got[6].valid and got[7].valid and got[7].parsed.source_reliability == "weak"
    reasons = {(r.id, r.field, r.position, r.reason) for r in signals.ledger(checked, "id").collect()}
    assert (1, "closures", 1, "status unknown") in reasons and (2, None, None, "article_type missing") in reasons and len(reasons) == 2 + 5 + 4 + 1 + 1 + 3 + 3
