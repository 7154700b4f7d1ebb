import math
import random

from pyspark.sql import functions as F

from tallyfold.functions import names
from tallyfold.functions.numbers import EARTH_M
from tallyfold.operators import coverage, frontier, geo, reconcile


def metres(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    return 2 * EARTH_M * math.asin(math.sqrt(min(1, math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2)))


def test_near_points_lose_no_pair(spark):
    rnd = random.Random(3)
    corner = lambda: rnd.choice([(rnd.uniform(-90, 90), rnd.uniform(-180, 180)), (rnd.uniform(88, 90), rnd.uniform(-180, 180)), (rnd.uniform(-1, 1), rnd.choice([-1, 1]) * rnd.uniform(179, 180)), (rnd.choice([90.0, -90.0, 0.0]), rnd.choice([180.0, -180.0, 0.0]))])
    a, b = ([(i, *corner()) for i in range(150)] + [(900, None, 1.0), (901, 1.0, None)] for _ in range(2))
    left, right = spark.createDataFrame(a, "i int, la double, lo double"), spark.createDataFrame(b, "j int, lb double, lp double")
    for reach in (50_000, 700_000, 9_000_000):
        got = {(r.i, r.j) for r in geo.near_points(left, right, reach, ("la", "lo"), ("lb", "lp")).collect()}
        want = {(i, j) for i, p, q in a for j, r, s in b if None not in (p, q, r, s) and metres(p, q, r, s) < reach}
        assert got == want and want
    assert len({(r.i, r.j) for r in geo.near_points(left, right, 500, ("la", "lo"), ("lb", "lp")).collect()}) == geo.near_points(left, right, 500, ("la", "lo"), ("lb", "lp")).count()


def test_map_coverage_equals_plain_rules(spark):
    rnd = random.Random(4)
    names_ = ["", "lens", "lens centre", "centre ville", "agence de lens centre ville", "lille", "lens cen", "ville", "lille centre ville nord"]
    where = lambda: rnd.choice([(None, None), (50.0, 3.0), (50.001, 3.001), (51.0, 3.0)])
    listed = [(i, rnd.choice("ab"), rnd.choice(names_[:3]), rnd.choice(names_), rnd.choice(["59", "62"]), *where()) for i in range(120)]
    events = [(i, rnd.choice("ab"), rnd.choice(names_[:3]), rnd.choice(names_[:2]), rnd.choice(names_), *where()) for i in range(14)]
    signals = [("a", "59"), ("a", "59")]

    def status(row):
        _, bank, place, label, dep, lat, lon = row
        for seq, b, p, o, lab, x, y in sorted(events):
            held = len(lab) >= 8 and label and (lab in label or label in lab)
            if b == bank and (place and place in (p, o) or label and label == lab or held):
                near = None not in (lat, lon, x, y) and metres(lat, lon, x, y) < 500
                return seq, "present_unlocated" if x is None else "exact" if near else "present_on_map"
        return None, "present_department" if (bank, dep) in signals else "needs_research"

    got = coverage.on_map(spark.createDataFrame(listed, "listed_id int, bank_key string, place_key string, label_key string, department string, lat double, lon double"), spark.createDataFrame(events, "event_seq int, bank_key string, e_place string, e_original string, e_label string, e_lat double, e_lon double"), spark.createDataFrame(signals, "bank_key string, department string"))
    want = {r[0]: status(r) for r in listed}
    assert {r.listed_id: (r.event_seq, r.status) for r in got.collect()} == want and len({s for _, s in want.values()}) == 5


def test_signals_are_settled_by_place_department_and_source(spark):
    aliases = names.alias_table(spark, {"LCL": ["lcl", "crédit lyonnais"]})
    events = spark.createDataFrame([
        (1, "LCL", "59", "closure", "Villeneuve-d'Ascq", None, None, 1.0, 1.0, "x", 3, "2026-01-01"), (2, "LCL", "Nord", "closure", "Lens", "Lens Ouest", "Place du Marché Nord", 1.0, 1.0, "x", 5, "2026-01-02"),
        (3, "LCL", None, "closure", "Lens", None, None, None, 1.0, "x", 9, "2026-01-01"), (4, "LCL", "62", "closure", "Lens", None, None, 1.0, 1.0, "x", 4, "2026-01-01"),
    ], "event_id int, bank string, department string, kind string, place string, original_place string, branch string, lat double, lon double, code string, reliability int, created_at string")
    sources = spark.createDataFrame([(i, u) for i in (1, 2, 3, 4) for u in ("https://a/1/", "https://a/2")] + [(1, None), (2, "")], "event_id int, url string")
    rows = [
        (1, "Crédit Lyonnais", "Nord", "À Villeneuve d’Ascq, l'agence ferme", "", None, "https://a/1"), (2, "lcl", "nord", "Lens : fermeture", None, None, "https://a/2/"), (3, "LCL", "Pas-de-Calais", "", "agence de Lens", "", "https://a/1"),
        (4, "LCL", "59", "Lensois", "", "", "https://a/1"), (5, "LCL", None, "rien", "place du marché", "nord de la ville", "https://a/1"), (6, "LCL", "59", "Lens", "", "", "https://a/3"), (7, "BNP", "59", "Lens", "", "", "https://a/1"), (8, "LCL", "59", "Lens", "", "", ""),
        (9, "LCL", "75", "Lens", "", "", "https://a/1"),
    ]
    signals = spark.createDataFrame([(*r, None) for r in rows], "id int, bank string, department string, title string, excerpt string, reason string, url string, resolved int")
    got = {r.id: r.event_id for r in reconcile.resolved_signals(signals, events, sources, aliases).collect()}
    assert got == {1: 1, 2: 2, 3: 4, 5: 2}
    waiting = spark.createDataFrame([(1, "crédit lyonnais", "Nord", "closure", "lens ouest", None), (2, "LCL", "62", None, "LENS", None), (3, "LCL", "75", "closure", "Lens", None), (4, "LCL", None, "closure", "Lens", 7)], "id int, bank string, department string, kind string, place string, resolved int")
    assert {r.id: r.event_id for r in reconcile.resolved_quarantine(waiting, events, aliases).collect()} == {1: 2, 2: 4}


def test_passes_end_and_keep_each_row_once(spark):
    edges = {1: [2, 3], 2: [3, 4], 4: [1, 5], 5: [5], 7: [None], None: [1]}
    table = spark.createDataFrame([(a, b) for a, bs in edges.items() for b in bs], "f int, t int")
    expand = lambda found: found.join(table, F.col("k").eqNullSafe(F.col("f"))).select(F.col("t").alias("k"), (F.col("w") + 1).alias("w"))
    seeds = spark.createDataFrame([(1, 0), (1, 5)], "k int, w int")
    got = lambda df: {(r.k, r.w, r["round"]) for r in df.collect()}
    assert got(frontier.passes(seeds, expand, ["k"])) == {(1, 0, 0), (2, 1, 1), (3, 1, 1), (4, 2, 2), (5, 3, 3)}
    assert got(frontier.passes(seeds, expand, ["k"], most_rounds=1)) == {(1, 0, 0), (2, 1, 1), (3, 1, 1)}
    assert got(frontier.passes(seeds, expand, ["k"], budget=3)) == {(1, 0, 0), (2, 1, 1), (3, 1, 1)}
    assert got(frontier.passes(spark.createDataFrame([(7, 0)], "k int, w int"), expand, ["k"])) >= {(7, 0, 0), (None, 1, 1), (1, 2, 2)}
    assert got(frontier.passes(seeds.limit(0), expand, ["k"])) == set()


def test_texts_that_hold_short_items_are_found(spark):
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 4)))
    docs = [(i, " ".join(word() for _ in range(rnd.randint(0, 12)))) for i in range(60)] + [(90, "alpha beta gammaray"), (91, ""), (92, None)]
    items = [(i, " ".join(word() for _ in range(rnd.randint(1, 6)))) for i in range(150)] + [(900, "alpha beta gamma"), (901, ""), (902, "a beta"), (903, "gamma")]
    got = {(r.item_id, r.doc_id) for r in coverage.text_mentions(spark.createDataFrame(items, "item_id int, k string"), spark.createDataFrame(docs, "doc_id int, t string")).collect()}
    assert got == {(i, d) for i, k in items for d, t in docs if k and t and k in t} and {len(k.split()) for i, k in items for j, _ in got if i == j} >= {1, 2, 3, 4}
