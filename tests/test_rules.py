from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyfold.functions import display, web, wordrules
from tallyfold.functions.keys import canonical, fold
from tallyfold.operators import coverage, guard, titles, triage


def judged(spark, cases, column):
    """Asserts what ``column`` gives for the first item of each case, its last item."""
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, s string")
    got = {r.i: r.v for r in df.select("i", column(F.col("s")).alias("v")).collect()}
    for i, c in enumerate(cases):
        assert got[i] == c[-1], (c, got[i])


def test_word_rules_go_by_order_and_distance(spark):
    words = {"a": ["ferm*"], "b": ["#"], "c": ["jours", "mois"], "d": ["##"]}
    cases = [("fermes depuis 12 jours", True), ("ferme 12 mois", True), ("12 jours ferme", False), ("ferme. 12 jours", False), ("ferme a b c d 12 jours", False), ("", False), (None, False), ("fermeture-de-12-jours", True), ("ferme 3 ferme a b 4 jours", True)]
    judged(spark, cases, lambda c: wordrules.says(c, [[("a", 0), ("b", 3), ("c", 1)]], words))
    judged(spark, [("1 mois", False), ("2 mois", True), ("10 mois", True)], lambda c: wordrules.says(c, [[("d", 0), ("c", 1)]], words))
    judged(spark, [("l'agence d'ille-et-vilaine! ille et vilaine", " l agence d @x | @x ")], lambda c: wordrules.put(c, F.lit("ille et-vilaine"), "@x"))


def test_candidate_places_after_cues(spark):
    cases = [
        ("les agences de Bessines, Ambazac et Nieul ferment", ["Bessines", "Ambazac", "Nieul"]), ("fermeture à Tulle, Brive-la-Gaillarde et La Rochelle. Et à Paris", ["Tulle", "Brive-la-Gaillarde", "La Rochelle", "Paris"]),
        ("les communes de Saint-Junien, 12 Rochechouart et Le Dorat ; ailleurs Limoges", ["Saint-Junien", "Le Dorat"]), ("les sites de Mont sous Vaudrey et l'autre", ["Mont sous Vaudrey"]), ("à Tulle et à Tulle", ["Tulle"]), ("rien ici", []), (None, None), ("", []),
        ("agence de " + "x " * 120 + ", Lens", []), ("agence de " + "x " * 120 + ", Lens.", ["Lens"]),
    ]
    judged(spark, cases, triage.candidate_places)
    many = ", ".join("V" + chr(97 + i) + "lle" for i in range(26))
    got = spark.createDataFrame([(f"à {many}.",)], "s string").select(F.size(triage.candidate_places("s")).alias("a"), F.size(triage.candidate_places("s", most=None)).alias("b")).first()
    assert (got.a, got.b) == (triage.MOST_PLACES, 26)


def test_guard_tells_denials_and_passing_closures(spark):
    judged(spark, [("Le bureau ne fermera pas", True), ("il ne rouvrira pas", False), ("maintien des bureaux", True), ("fermeture abandonnée", True)], lambda c: guard.denied(canonical(c)))
    passing = ["fermeture temporaire du bureau pour travaux", "ferme pendant plus de trois semaines", "fermé depuis janvier", "pour raisons de sécurité", "fermé tout l'été", "ferme le lundi", "jusqu'au 3 mai", "fermé plus de deux mois"]
    judged(spark, [(s, True) for s in passing] + [("fermera définitivement", False), ("est menacé de fermeture", False)], lambda c: guard.passing(canonical(c)))
    judged(spark, [("le bureau ferme en août", "aout"), ("fermeture le 17 mars", "mars"), ("le bureau ferme. En août", ""), ("rien", "")], lambda c: guard.closing_month(canonical(c)))
    judged(spark, [("À Saumur, le bureau de Bagneux", "Saumur"), ("Poitiers : le bureau", "Poitiers"), ("Bretagne : le bureau", None), ("Le bureau de Vire ferme", None)], guard.leading_place)


def test_plans_of_several_branches(spark):
    yes = ["va fermer sept agences en Haute-Vienne", "la fermeture d'une vingtaine d'agences", "un plan de fermeture massif", "Réorganisation du réseau bancaire", "une réorganisation territoriale", "fermer plusieurs agences", "Une dizaine d'agences", "DEUX AGENCES", "PLAN DE FERMETURE DES AGENCES.", "ferme 12 agences"]
    no = ["La banque ferme 1 agences de Tulle", "ferme son agence de Tulle", "rénove son agence principale"]
    judged(spark, [(s, True) for s in yes] + [(s, False) for s in no], lambda c: triage.plan_of_several(fold(c)))


def test_tiers(spark):
    cases = [("https://www.credit-agricole.fr/x", "A"), ("https://www.prefet69.gouv.fr/x", "A"), ("https://lamairie.org", "A"), ("https://ma.bnpparibas.net/x", "A"), ("https://rennes.ouest-france.fr/x", "B"), ("https://france3.fr/x", "C"), ("https://www.facebook.com/x", "E"), ("https://maps.google.com/maps?cid=1", "E"), ("https://www.google.com/maps/x", "E"), ("https://news.google.com/search?q=maps", "D"), ("https://www.google.com/search?q=maps", "D"), ("https://ville-x.fr", "D"), ("", "D")]
    judged(spark, cases, web.source_tier)


def test_titles_that_are_no_lasting_closure(spark):
    out = ["Moret : le bureau de poste ferme trois semaines pour se moderniser", "un bureau de poste fermé depuis des mois pour des raisons de sécurité", "fermé jusqu'à nouvel ordre", "Un risque d'effondrement contraint le bureau de poste à fermer", "ne rouvrira pas et va déménager", "liste des agences", "agence immobilière", "distributeur automatique"]
    stay = ["Dun-sur-Auron. L'agence Caisse d'épargne ferme définitivement", "Orléans : le bureau de poste fermera définitivement le 31 octobre", "Le bureau de poste de Vire va fermer"]
    judged(spark, [(s, True) for s in out] + [(s, False) for s in stay], lambda c: titles.excluded(fold(c)))
    state = lambda c: titles.state(c, F.lit("2026-05-04").cast("date"))["temporal_status"]
    judged(spark, [("L'agence va définitivement fermer", "upcoming"), ("La fermeture est prévue", "upcoming"), ("Le bureau de poste fermé", "closed"), ("Il n'accueille plus", "closed"), ("ferme ses portes", "closed"), ("L'agence de Lens", "unknown")], state)


def test_titles_of_one_branch(spark):
    cases = [("Poitiers : l'agence du CIC va fermer", "Poitiers", True), ("LCL ferme son agence de Tulle", "Tulle", True), ("LCL à Vannes va fermer", "Vannes", True), ("Fermeture temporaire de l'agence de Brest", "Brest", False), ("L'agence de Brest ferme", "Nantes", False), ("Le bureau de Brest", "Brest", False)]
    df = spark.createDataFrame(cases, "t string, p string, w boolean")
    assert all(r.w == r.g for r in df.withColumn("g", titles.names_one_branch(F.col("t"), F.lit("LCL"), F.col("p"))).collect())
    places = F.array(F.lit("Vierzon"), F.lit("Bourgneuf"), F.lit("Reims"))
    judged(spark, [("Vierzon. Le bureau de poste de Bourgneuf", ["Vierzon"]), ("Le bureau de poste de Bourgneuf près de Reims", ["Bourgneuf"]), ("Fermeture", ["Vierzon", "Bourgneuf", "Reims"])], lambda c: titles.preferred_places(c, places))
    judged(spark, [("Dans Bretagne, à deux pas du Mans", "Mans"), ("Rien ici", "72")], lambda c: titles.search_hint(c, F.lit("72")))


@pytest.mark.parametrize(("text", "day", "code", "to"), [("À compter du mardi 7 juillet 2026 l'agence de X (02378) transfère son activité vers l'agence de Lens (02369).", date(2026, 7, 7), "02378", "Lens"), ("le 03/09/2026", date(2026, 9, 3), None, None), (None, None, None, None)])
def test_locator_messages(spark, text, day, code, to):
    r = spark.createDataFrame([(text,)], "s string").select(display.locator_message(F.col("s")).alias("m")).first().m
    assert (r.day, r.branch_code, r.destination) == (day, code, to)


def test_row_rules_win_by_position(spark):
    rows = spark.createDataFrame([(1, "b", "p", "x", "s", None), (2, "b", "p", "y", "s", None), (3, "c", "p", "x", "s", "u")], "id int, bank_key string, place_key string, label_key string, status string, flag string")
    rules = spark.createDataFrame([("b", "p", "", 1, "t", "f"), ("b", "p", "x", 2, None, "g")], "bank_key string, place_key string, label_key string, rule_pos int, status string, flag string")
    assert {r.id: (r.status, r.flag) for r in coverage.override_rows(rows, "id", rules, ["status", "flag"]).collect()} == {1: ("t", "g"), 2: ("t", "f"), 3: ("s", "u")}
