import random
from collections import defaultdict

from pyspark.sql import functions as F

from tallyfold.operators import rollup, select
from tallyfold.plans import jobs


def test_estimates_under_facets_equal_plain_counts(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice(list(rollup.TIERS)), rnd.choice(["01", "02", None]), rnd.choice("ab"), rnd.choice("xyz"), rnd.choice([None, 1, 5]), i, rnd.choice([None, 1.0]), 2.0, rnd.choice([None, 1, 2])) for i in range(120)]
    df = spark.createDataFrame(rows, "tier string, department string, bank_key string, place_key string, n int, seq int, lat double, lon double, star int")
    for facet, keep in ((None, lambda r: True), (F.col("star") > 1, lambda r: (r[8] or 0) > 1), (F.col("bank_key") == "none", lambda r: False)):
        left = [r for r in rows if keep(r)]
        known = {(r[2], r[3]) for r in left if r[0] == "unlocated"}
        want = defaultdict(lambda: [0, 0, 0, 0])
        first = {}
        for r in left:
            if r[0] == "signal":
                if (r[2], r[3]) not in known:
                    first.setdefault((r[2], r[3]), r[1])
            else:
                want[r[1]][list(rollup.TIERS).index(r[0])] += {"precise": int(r[6] is not None), "unlocated": 1, "announced": r[4] or 0}[r[0]]
        for d in first.values():
            want[d][3] += 1
        got = {(r.department, r.is_total): (r.n_precise, r.n_unlocated, r.n_announced, r.n_signals, r.estimate) for r in rollup.facet_estimates(df, facet).collect()}
        assert {d: v for (d, total), v in got.items() if not total} == {d: (*v, sum(v)) for d, v in want.items()}
        assert got[None, True] == tuple(map(sum, zip(*[(*v, sum(v)) for v in want.values()], strict=True))) if want else not [k for k in got if not k[1]]


def test_searches_go_by_domain_path_and_position(spark):
    queries = [(1, '"LCL" fermeture agence Lens site:b.fr'), (2, "fermeture Lens"), (3, "site:*.c.fr site:b.fr, fermeture"), (4, "de la site:b.fr"), (5, None), (6, "SITE:a.fr fermetures")]
    entries = [("a.fr", 0, 0, "https://a.fr/lens-lcl-fermeture", ""), ("a.fr", 0, 1, "https://a.fr/2", "Fermeture à Lens"), ("b.fr", 1, 0, "https://b.fr/1", "Fermeture LCL"), ("b.fr", 0, 0, "https://b.fr/2", "LCL Lens : fermeture"), ("b.fr", 0, 1, "https://b.fr/3", "Lens"), ("b.fr", 0, 2, "https://b.fr/4", "refermeture Lensois"), ("c.fr", 0, 0, "https://b.fr/2", "fermeture"), ("c.fr", 0, 1, "", "fermeture")]
    df, e = spark.createDataFrame(queries, "query_id int, query string"), spark.createDataFrame(entries, "domain string, path int, pos int, url string, title string")

    def got(**how):
        out = defaultdict(list)
        for r in sorted(select.site_search(df, e, ["a.fr", "d.fr"], **how).collect(), key=lambda r: (r.query_id, r["rank"])):
            out[r.query_id].append(r.url.removeprefix("https://"))
        return dict(out)

    both = ["a.fr/lens-lcl-fermeture", "a.fr/2"]
    assert got() == {1: ["b.fr/2", "b.fr/4", "b.fr/1", *both], 2: both, 3: ["b.fr/2", "b.fr/4", "b.fr/1"]}
    assert got(most_domains=1) == {1: ["b.fr/2", "b.fr/4", "b.fr/1"], 2: both, 3: ["b.fr/2"]}
    assert got(per_path=1)[1] == ["b.fr/2", "b.fr/1", "a.fr/lens-lcl-fermeture"] and got(k=2)[1] == ["b.fr/2", "b.fr/4"]


def test_plans_are_searched_place_by_place(spark):
    articles = [("u1", "LCL va fermer sept agences à Lens, Tulle et Nullepart", "", "x"), ("u0", "LCL ferme une agence à Brest", "", "x")]
    pages = [("https://b.fr/lens", "LCL : fermeture agence Lens", "un plan de fermeture de deux agences à Brest"), ("https://b.fr/tulle", "Fermeture LCL à Tulle", ""), ("https://b.fr/brest", "LCL quitte Brest", ""), ("https://b.fr/lyon", "BNP : fermeture à Lyon", "")]
    gazetteer = spark.createDataFrame([(n, "59", n, 0) for n in ("Lens", "Tulle", "Brest", "Lyon")], "name string, department string, code string, rank int")
    p = spark.createDataFrame(pages, "url string, title string, text string")
    entries = p.select(F.lit("b.fr").alias("domain"), F.lit(0).alias("path"), F.monotonically_increasing_id().alias("pos"), "url", "title")
    found = jobs.drill_down(spark.createDataFrame(articles, "url string, title string, text string, source string"), entries, p, gazetteer, ["b.fr"])
    assert {(r.url, r["round"]) for r in found.collect()} == {("u1", 0), ("https://b.fr/lens", 1), ("https://b.fr/tulle", 1), ("https://b.fr/brest", 2)}
    official = spark.createDataFrame([("l1", "LCL : fermeture de l'agence de Lens", "", "2026-01-01", "Légifrance"), ("l2", "Décret", "", "2026-01-01", "Légifrance"), ("l3", "LCL : fermeture de l'agence", "", "2026-01-01", "blog")], "url string, title string, text string, date string, source string")
    assert {(r.url, r.bank, r.reason) for r in jobs.official_vigilance(official, "Légifrance", "no branch named").collect()} == {("l1", "LCL", "no branch named")}


def test_curated_articles_are_settled_by_the_first_stage_that_can(spark):
    import json

    articles = spark.createDataFrame([(f"u{i}", "t", "", "2026-02-03") for i in range(1, 9)], "url string, title string, text string, date string")
    targets = [("u1", "LCL", "Lens", "a"), ("u1", "LCL", "Tulle", "b"), ("u2", "LCL", "Lens", "a"), ("u3", "LCL", "Nullepart", "a"), ("u4", "", "Lens", "a"), ("u4", None, "Lens", "b"), ("u7", "LCL", "Tulle", "a"), ("u8", "LCL", "Lens", "a")]
    made = lambda kind, **more: json.dumps({"article_type": kind, **more})
    closure = {"bank": "LCL", "commune": "Lens", "status": "announced", "closure_type": "closure", "confidence": 1}
    results = [("u1", made("list_closures", closures=[closure])), ("u2", made("single_closure", closures=[closure, {**closure, "is_physical_agency": False}, {**closure, "bank": "nobody"}])), ("u3", "{cut"), ("u4", made("department_signal", department_signals=[{"bank": "LCL"}])), ("u5", made("out_of_scope")), ("u6", made("wrong", vague_signals=[{}])), ("u7", made("ambiguous", vague_signals=[{"bank": "LCL"}]))]
    gazetteer = spark.createDataFrame([("Lens", "62", "62498", 0), ("Tulle", "19", "19272", 0)], "name string, department string, code string, rank int")
    out = jobs.curated_stages(articles, spark.createDataFrame([(u, b, p, None, x, None) for u, b, p, x in targets], "url string, bank string, place string, department string, label string, closed_on date"), spark.createDataFrame(results, "url string, result string"), gazetteer)
    assert {r.url: r.stage for r in out["stages"].collect()} == {"u1": "targets", "u2": "extracted", "u3": "single target", "u4": "signals", "u5": "absent", "u6": "absent", "u7": "single target", "u8": "single target"}
    assert sorted((r.url, r.place, r.reason, r.reliability) for r in out["events"].collect()) == [("u1", "Lens", None, 4), ("u1", "Tulle", None, 4), ("u2", "Lens", None, 3), ("u3", "Nullepart", "place not found", 4), ("u7", "Tulle", None, 4), ("u8", "Lens", None, 4)]
    assert {(r.url, r.field) for r in out["signals"].collect()} == {("u4", "department_signals"), ("u7", "vague_signals")}


def test_reclassified_records_are_due_again(spark):
    records = spark.createDataFrame([(1, "Le bureau de poste de Lens va fermer", "BNP"), (2, "Le bureau de poste de Lens va fermer", "La Banque Postale"), (3, "LCL ferme", "LCL"), (4, "Le bureau de poste de Vire va fermer", None)], "id int, title string, bank string")
    reviews = spark.createDataFrame([(1, "2026-01-01"), (1, "2026-02-01"), (2, "2026-02-01"), (3, "2026-02-01")], "id int, reviewed_at string")
    changed, left = jobs.reclassify(records, reviews)
    assert {r.id: r.bank for r in changed.collect()} == {1: "La Banque Postale", 2: "La Banque Postale", 3: "LCL", 4: "La Banque Postale"}
    assert sorted(r.id for r in left.collect()) == [2, 3]
