"""Steps that must not grow faster than their input: no operator of a plan yields more rows than a few times what it reads."""

from pyspark.sql import functions as F

from tallyfold.functions import web
from tallyfold.operators import coverage, reconcile, resolve, snapshot, titles, triage


def _nodes(plan):
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec" or kind == "InMemoryTableScanExec":
        yield from _nodes(plan.executedPlan()) if kind[0] == "A" else ()
    elif kind.endswith("QueryStageExec"):
        yield from _nodes(plan.plan())
    else:
        yield plan
        for i in range(plan.children().size()):
            yield from _nodes(plan.children().apply(i))


def most(df, metric="numOutputRows"):
    """The rows of ``df``, and the most of a metric in its plan."""
    rows = df.collect()
    found = [p.metrics().get(metric) for p in _nodes(df._jdf.queryExecution().executedPlan())]
    return rows, max([m.get().value() for m in found if m.isDefined()], default=0)


def test_f1_requests_do_not_carry_the_codes_of_their_name(spark):
    g = spark.range(3000).select(F.lit("Mont").alias("name"), F.lit("01").alias("department"), F.col("id").cast("string").alias("code"), F.col("id").alias("rank"))
    q = spark.range(300).select(F.col("id").alias("request_id"), F.lit("mont").alias("name"), F.when(F.col("id") % 2 == 0, "").otherwise("01").alias("department"))
    rows, written = most(resolve.resolve(q, g, listed=False), "shuffleBytesWritten")
    assert {(r.request_id % 2, r.resolved_code, r.ambiguous, r.n_candidates) for r in rows} == {(0, None, True, 3000), (1, "0", False, 0)} and written < 1_000_000
    rows, written = most(resolve.resolve(q, g), "shuffleBytesWritten")
    assert {(r.ambiguous, len(r.candidates)) for r in rows} == {(True, 3000), (False, 0)} and written < 1_000_000


def test_f2_expected_events_of_one_place_are_no_pairs_with_its_events(spark):
    expected = spark.range(1000).select(F.col("id").alias("expected_id"), F.lit("a").alias("bank_key"), F.lit("x").alias("place_key"), F.lit("y").alias("label_key"), F.lit(False).alias("is_plan"))
    events = spark.range(1000).select((F.col("id") + 7).alias("event_seq"), F.lit("a").alias("bank_key"), F.lit("x").alias("place_key"), F.lit("y").alias("label_key"), F.when(F.col("id") == 0, "dated").otherwise("undated").alias("date_status"))
    signals = spark.range(5).select(F.lit("a").alias("bank_key"), F.concat(F.lit("y of "), F.col("id").cast("string")).alias("text_key"), F.lit(False).alias("plan_like"))
    rows, n = most(coverage.expected_status(expected, events, signals))
    assert [r.status for r in rows] == ["dated"] * 1000 and n <= 5000
    assert {r.status for r in coverage.expected_status(expected, events.filter("false"), signals).collect()} == {"mentioned"}


def test_f4_labels_that_begin_alike_are_no_pairs(spark):
    number = F.lpad(F.col("id").cast("string"), 4, "0")
    listed = spark.range(800).select(F.col("id").alias("listed_id"), F.lit("a").alias("bank_key"), F.lit("p").alias("place_key"), F.concat(F.lit("automobile "), number).alias("label_key"), F.lit("d").alias("department"), F.lit(1.0).alias("lat"), F.lit(1.0).alias("lon"))
    events = spark.range(1600).select(F.col("id").alias("event_seq"), F.lit("a").alias("bank_key"), F.lit("q").alias("e_place"), F.lit("").alias("e_original"), F.concat(F.lit("the automobile "), F.lpad((F.col("id") % 800).cast("string"), 4, "0"), F.lit(" centre")).alias("e_label"), F.lit(None).cast("double").alias("e_lat"), F.lit(None).cast("double").alias("e_lon"))
    rows, n = most(coverage.on_map(listed, events))
    assert {(r.listed_id, r.event_seq, r.status) for r in rows} == {(i, i, "present_unlocated") for i in range(800)} and n <= 50_000


def test_f4_rows_of_one_name_are_no_pairs(spark):
    listed = spark.range(600).select(F.col("id").alias("listed_id"), F.lit("a").alias("bank_key"), F.lit("p").alias("place_key"), F.lit("the same label").alias("label_key"), F.lit("d").alias("department"), F.lit(1.0).alias("lat"), F.lit(1.0).alias("lon"))
    events = spark.range(600).select((F.col("id") + 3).alias("event_seq"), F.lit("a").alias("bank_key"), F.lit("p").alias("e_place"), F.lit("p").alias("e_original"), F.lit("at the same label").alias("e_label"), F.lit(1.0).alias("e_lat"), F.lit(1.0).alias("e_lon"))
    rows, n = most(coverage.on_map(listed, events))
    assert {(r.event_seq, r.status) for r in rows} == {(3, "exact")} and n <= 5000


def test_f5_points_of_one_place_are_no_pairs(spark):
    gone = spark.range(500).select(F.col("id"), F.lit("c").alias("code"), F.col("id").cast("string").alias("place"))
    new = spark.range(600).select((F.col("id") + 1000).alias("id"), F.lit("c").alias("code"), (F.col("id") + 400).cast("string").alias("place"))
    rows, n = most(snapshot.replacement(gone, new, "id", ["code", "place"]))
    assert rows == [] and n <= 2000
    few = new.filter("id = 1050").unionByName(new.filter("id = 1060").withColumn("code", F.lit("other")))
    assert {r.id: r.replaced_by for r in snapshot.replacement(gone, few, "id", ["code", "place"]).collect()} == {i: 1050 for i in range(500) if i != 460}


def _folds(df):
    """How often a plan holds the list of accented letters, that is folds a text."""
    return str(df._jdf.queryExecution().optimizedPlan().toString()).count("translate(")


def test_f3_weak_signals_fold_title_and_text_once(spark):
    a = spark.createDataFrame([("u", "Fermeture de l'agence LCL", "Le CIC et la BRED ferment en 2026", "2026-01-01"), ("v", None, "", None)], "url string, title string, text string, date string")
    got = triage.weak_signal(a)
    assert {(r.url, r.bank, r.score) for r in got.collect()} == {("u", "Banque Populaire", 4), ("v", None, 1)} and _folds(got) <= 3


def test_f9_f12_articles_are_folded_once(spark):
    a = spark.createDataFrame([("u", "LCL", "Ici, à Lyon, l'agence LCL ferme.\u0301. Et à Nantes aussi! "), ("v", None, None)], "url string, title string, text string")
    got = triage.analyse(a)
    rows = {r.url: r for r in got.collect()}
    assert rows["u"].is_relevant and not rows["v"].is_relevant and rows["u"].places == ["Lyon", "Nantes"] and rows["u"].relevant_sentences == ["LCL", "Ici, à Lyon, l'agence LCL ferme"]
    assert _folds(got) <= 3


def test_f10_a_title_is_folded_for_its_date_and_its_words_only(spark):
    t = spark.createDataFrame([("L'agence ferme le 3 mars", "2026-01-01"), ("Elle va fermer", "2026-01-01"), (None, None)], "title string, d string")
    got = t.select(titles.state(F.col("title"), F.col("d").cast("date")).alias("s"))
    assert [(r.s.status, r.s.temporal_status, str(r.s.day)) for r in got.collect()] == [("confirmed", "upcoming", "2026-03-03"), ("project", "upcoming", "None"), ("rumour", "unknown", "None")]
    assert _folds(got) <= 2


def test_f6_names_meet_the_gazetteer_without_a_shuffle_by_name(spark):
    rows = spark.range(2000).select(F.col("id").alias("r"), F.array(F.lit("Lyon"), F.lit("Nulle"), F.lit("lyon"), F.lit("Mont")).alias("names"))
    g = spark.createDataFrame([("Lyon",), ("Mont",)], "name string")
    got = resolve.valid_candidates(rows, g, "r", "names", 8)
    assert {tuple(r.places) for r in got.collect()} == {("Lyon", "Mont")} and got.count() == 2000
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
    said = F.lit("L'agence de Lyon et les agences de Mont, Brest; commune de Tulle")
    assert spark.range(1).select(triage.candidate_places(said).alias("p")).first().p == ["Lyon", "Brest", "Mont", "Tulle"]


def test_f7_f8_only_words_that_items_ask_for_become_rows(spark):
    docs = spark.range(5).select(F.col("id").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(400)), lambda i: F.concat(F.lit("w"), i.cast("string"))), " ").alias("t"))
    items = spark.createDataFrame([(1, "w1 w2 w3 w4"), (2, "w1 w3 w4 w5")], "item_id int, k string")
    rows, n = most(coverage.text_mentions(items, docs))
    assert {(r.item_id, r.doc_id) for r in rows} == {(1, i) for i in range(5)} and n <= 5 * 400


def test_f11_waiting_rows_of_one_name_are_no_pairs_with_its_events(spark):
    none = F.lit(None).cast("string")
    events = spark.range(1000).select((F.col("id") + 7).alias("event_id"), F.lit("LCL").alias("bank"), F.lit("closure").alias("kind"), F.lit("Lens").alias("place"), none.alias("original_place"), none.alias("branch"), F.when(F.col("id") % 3 == 1, "62").when(F.col("id") % 3 == 2, "59").alias("department"), F.lit(1.0).alias("lat"), F.lit(1.0).alias("lon"), F.lit("x").alias("code"), F.when(F.col("id") == 5, 9).otherwise(F.when(F.col("id") % 3 == 0, 3).otherwise(4)).alias("reliability"), F.lit("2026-01-01").alias("created_at"))
    waiting = spark.range(1000).select("id", F.lit("lcl").alias("bank"), F.lit("closure").alias("kind"), F.lit("LENS").alias("place"), F.when(F.col("id") % 4 == 1, "62").when(F.col("id") % 4 == 2, "Nord").when(F.col("id") % 4 == 3, "75").alias("department"), none.alias("resolved"))
    rows, n = most(reconcile.resolved_quarantine(waiting, events))
    assert {(r.id % 4, r.event_id) for r in rows} == {(0, 12), (1, 8), (2, 12), (3, 7)} and len(rows) == 1000 and n <= 5000


def test_f11_a_tier_reads_the_host_once(spark):
    urls = [("https://www.m.actu.fr/1", "C"), ("https://notactu.fr", "D"), ("https://actu.fr.example", "D"), ("https://actuxfr", "D"), ("https://x.gouv.fr", "A"), ("https://reddit.com", "E"), (None, "D"), ("", "D")]
    got = spark.createDataFrame(urls, "url string, tier string").withColumn("got", web.source_tier("url"))
    assert got.filter("not got <=> tier").count() == 0
    assert got._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 1
