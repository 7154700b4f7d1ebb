from datetime import date

from pyspark.sql import functions as F

from tallyfold.functions import dates, keys, names, numbers, web


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_keys_fold_accents_case_and_spaces(spark):
    got = one(spark, keys.canonical(F.lit("  L’Évêché du  Nord ")), keys.place_key(F.lit("Saint-Jean d'Été")), keys.loose_key(F.lit("B.N.P. Paribas!")))
    assert got == ("l'eveche du nord", "saint jean d ete", "b n p paribas")


def test_event_id_ignores_blank_address_and_null(spark):
    a, b, c, d = one(spark, keys.event_id(F.lit("LCL"), F.lit("Lyon"), F.lit("closure")), keys.event_id(F.lit("lcl"), F.lit("LYON "), F.lit("closure"), F.lit(" ")), keys.event_id(F.lit("lcl"), F.lit("lyon"), F.lit("closure"), F.lit("1 rue X")), keys.event_id(F.lit("lcl"), F.lit(None), F.lit("closure")))
    assert a == b and a != c and len(a) == 16 and d is not None


def test_canonical_names_take_the_longest_prefix(spark):
    aliases = names.alias_table(spark, {"Nord": ["Nord", "ND"], "Nord Est": ["Nord Est"]})
    df = spark.createDataFrame([("nd",), ("Nord-Est Caisse 4",), ("NORD caisse",), (" Autre ",), (None,)], "n string")
    assert [r.canonical_name for r in names.canonical_name(df, "n", aliases).select("n", "canonical_name").collect()].count("Nord") == 2
    got = {r.n: r.canonical_name for r in names.canonical_name(df, "n", aliases).collect()}
    assert got == {"nd": "Nord", "Nord-Est Caisse 4": "Nord Est", "NORD caisse": "Nord", " Autre ": "Autre", None: ""}


def test_department_codes(spark):
    got = one(spark, *[names.department_code(F.lit(a), F.lit(b)) for a, b in (("2A004", None), (None, "20100"), ("97105", None), (None, "69001"), ("x", "75011"))])
    assert got == ("2A", None, "971", "69", "75")


def test_dates(spark):
    d = dates.title_date(F.lit("Fermeture le 5 janvier"), F.lit("2025-12-20").cast("date"))
    got = one(spark, dates.article_date(F.lit("Tue, 06 Jan 2026 23:30:00 -0200")), dates.article_date(F.lit("2026-01-06T23:59:00Z")), dates.article_date(F.lit("soon")), dates.article_date_local(F.lit("Tue, 06 Jan 2026 23:30:00 -0200")), dates.text_date(F.lit("le 31 février 2026")), dates.text_date(F.lit("le 1er août 2026 à")), d["day"], d["inferred"], dates.listed_date(F.lit("semaine précédant le 15/03/2026")))
    assert got == (date(2026, 1, 7), date(2026, 1, 6), None, date(2026, 1, 6), None, date(2026, 8, 1), date(2026, 1, 5), True, date(2026, 3, 8))


def test_month_ranges_tile(spark):
    rows = dates.month_ranges(spark, "2024-01-20", "2024-03-05").orderBy("lo").collect()
    assert [(r.lo.isoformat(), r.hi.isoformat()) for r in rows] == [("2024-01-20", "2024-02-01"), ("2024-02-01", "2024-03-01"), ("2024-03-01", "2024-03-06")]


def test_tiers_and_titles(spark):
    got = one(spark, *[web.source_tier(F.lit(u)) for u in ("https://www.ouest-france.fr/x", "https://rennes.ouest-france.fr/", "https://m.facebook.com/a", "https://www.x.gouv.fr/", "https://notouest-france.fr", "", "https://actu.fr")])
    assert got == ("B", "B", "E", "A", "D", "D", "C")
    assert one(spark, web.clean_text(F.lit("Fermeture &amp; fin <b>ici</b> https://a.b/c - Le Journal")))[0].startswith("Fermeture & fin")


def test_numbers(spark):
    got = one(spark, numbers.reliability(F.lit("0.5")), numbers.reliability(F.lit("x")), numbers.reliability(F.lit(7.0)), F.round(numbers.distance_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)), 0))
    assert got == (2, 0, 5, 111195.0)
