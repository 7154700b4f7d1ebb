import random
from datetime import date, timedelta
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from tallyfold.functions.keys import fold
from tallyfold.functions.lexicon import DEPARTMENTS, Lexicon
from tallyfold.operators import coverage, guard, merge, reconcile, resolve, rollup, select, similarity, snapshot, titles, triage


def test_triage_scores_and_routes(spark):
    rows = [
        ("Crédit Agricole : l'agence va fermer", "L'agence du Crédit Agricole va fermer ses portes à Plouzané, Brest et Guipavas le 12 mars 2026, 4 rue de Siam.", "u1", "2026-01-05"),
        ("Football", "Le match.", "u2", "2026-01-05"),
        ("Agence postale communale", "Un relais poste fermeture.", "u3", "2026-01-05"),
        ("Vieux", "Le CIC ferme.", "u4", "2020-01-05"),
    ]
    df = triage.analyse(spark.createDataFrame(rows, "title string, text string, url string, date string"))
    df = df.withColumn("is_relevant", triage.relevant(fold(F.concat_ws(" ", "title", "text")), Lexicon()))
    got = {r.url: r for r in triage.route(df, "2024-01-01").collect()}
    assert got["u1"].banks == ["Crédit Agricole"] and got["u1"].places == ["Plouzané", "Brest", "Guipavas", "Siam"] and got["u1"].score == 3 + 3 + 2 + 2 + 1
    assert {u: r.outcome for u, r in got.items()} == {"u1": "extract", "u2": "irrelevant", "u3": "irrelevant", "u4": "too_old"}
    assert got["u2"].score == -3


def test_departments_take_the_longest_name(spark):
    df = spark.range(1).select(triage.departments_of(F.lit("En Loire-Atlantique et dans l'Ain (75) ou (99)"), DEPARTMENTS).alias("d"))
    assert df.first().d == ["44", "01", "75"]


def test_union_keeps_the_first_source_and_blank_urls(spark):
    a = spark.createDataFrame([("u", "a"), ("", "x")], "url string, title string")
    b = spark.createDataFrame([("u", "b", 1), (None, "y", 2), ("v", "c", 3)], "url string, title string, n int")
    got = sorted((r.url or "", r.title) for r in triage.union_first([a, b]).collect())
    assert got == [("", "x"), ("", "y"), ("u", "a"), ("v", "c")]


def test_mentions_allow_a_hyphen_after_but_not_before(spark):
    cases = [("Poitiers", "a poitiers-sud", True), ("Bourgneuf", "vierzon-bourgneuf", False), ("Saint-Jean", "a saint jean ferme", True), ("Lyon", "les lyonnais", False), ("", "x", False)]
    df = spark.createDataFrame(cases, "n string, s string, w boolean")
    assert all(r.w == r.g for r in df.withColumn("g", guard.mentioned(F.col("n"), F.col("s"))).collect())


def test_publishable_names(spark):
    cases = [("Rennes", True), ("L'agence", False), ("Loire-Atlantique", False), ("Le", False), ("3 grandes villes", False), (None, False), ("Y", False)]
    df = spark.createDataFrame(cases, "n string, w boolean")
    assert all(r.w == r.g for r in df.withColumn("g", guard.publishable_name(F.col("n"))).collect())


def test_quarantine_needs_all_sources_to_reject(spark):
    events = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    judged = spark.createDataFrame([("a", 1, "x"), ("a", 0, "y"), ("b", 0, None), ("b", 1, "z")], "id string, source_pos int, reason string")
    kept, gone = guard.quarantine(events, judged)
    assert {r.id for r in kept.collect()} == {"b", "c"} and [(r.id, r.reason) for r in gone.collect()] == [("a", "y")]


def test_merge_does_not_depend_on_the_order_of_rows(spark):
    rnd = random.Random(5)
    rows = [(rnd.randrange(20), i, rnd.choice([None, 1, 3, 5]), rnd.choice([None, "p", "q"]), rnd.choice(["confirmed", "project"]), rnd.choice([None, "closed", "upcoming"]), rnd.choice([None, date(2024, 1, 1), date(2025, 1, 1)]), rnd.choice([True, False])) for i in range(200)]
    want = {}
    for k, _, f, c, s, t, d, a in rows:
        if k not in want:
            want[k] = dict(f=f, c=c, s=s, t=t, d=d, a=a)
            continue
        w = want[k]
        w["f"] = max(w["f"] or 0, f or 0)
        if w["d"] is None and d is not None:
            w["a"] = a
        elif w["d"] is None:
            w["a"] = w["a"] or a
        w["c"] = c if w["c"] is None else w["c"]
        w["d"] = d if w["d"] is None else w["d"]
        w["s"] = "confirmed" if "confirmed" in (w["s"], s) else w["s"]
        w["t"] = t if t is not None else w["t"]
    schema = "k int, seq int, f int, c string, s string, t string, d date, a boolean"
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        out = merge.evidence(spark.createDataFrame(rows, schema).repartition(3), ["k"], "seq", identity=[], attributes=["c"], reliability="f", status="s", temporal="t", day="d", approximate="a")
        assert {r.k: dict(f=r.f, c=r.c, s=r.s, t=r.t, d=r.d, a=r.a) for r in out.collect()} == want


def test_versioned_table(spark, tmp_path):
    t = merge.VersionedTable(spark, f"file://{tmp_path}/t")
    assert t.read() is None
    t.write(spark.range(3))
    t.write(t.read().union(spark.range(10, 11)))
    assert t.version() == 2 and t.read().count() == 4


GAZETTEER = "name string, department string, code string, rank int"


def test_gazetteer_resolution(spark):
    g = spark.createDataFrame([("Valence", "26", "26362", 0), ("Valence", "82", "82186", 1), ("Lyon", "69", "69123", 0), ("Mont", "64", "64396", 0)], GAZETTEER)
    q = spark.createDataFrame([(1, "valence", None), (2, "Valence", "82"), (3, "LYON", ""), (4, "Nulle part", "01"), (5, "Lyon", "01")], "request_id int, name string, department string")
    got = {r.request_id: (r.resolved_code, r.ambiguous, r.candidates) for r in resolve.resolve(q, g).collect()}
    assert got == {1: (None, True, ["26362", "82186"]), 2: ("82186", False, []), 3: ("69123", False, []), 4: (None, False, []), 5: (None, False, [])}
    v = spark.createDataFrame([(1, "Lyon / Part-Dieu", ""), (2, "Mont-Blanc", ""), (3, "Valence – Sud", "")], "request_id int, name string, department string")
    got = {r.request_id: (r.matched_name, r.resolved_code) for r in resolve.resolve_variants(v, g).collect()}
    assert got == {1: ("Lyon", "69123"), 2: ("Mont", "64396"), 3: (None, None)}
    names = spark.createDataFrame([(1, ["Lyon", "Rien", "lyon", "Mont"])], "id int, names array<string>")
    assert resolve.valid_candidates(names, g, "id", "names", 8).first().places == ["Lyon", "Mont"]


def test_retry_states(spark):
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    cache = spark.createDataFrame([("a", "closure", 1, None), ("b", "none", 1, None), ("c", "error", 3, "2023-01-01"), ("d", "error", 1, "2024-01-02"), ("e", "error", 1, "2023-12-31")], "k string, status string, attempts int, r string").select("k", "status", "attempts", F.col("r").cast("timestamp").alias("retry_after"))
    got = {r.k: r.state for r in reconcile.retry_state(spark.createDataFrame([(x,) for x in "abcdef"], "k string"), cache, ["k"], now).collect()}
    assert got == {"a": "hit", "b": "none", "c": "blocked", "d": "blocked", "e": "process", "f": "process"}


def test_missing_counter_equals_a_sequential_one(spark):
    rnd = random.Random(2)
    rows = [(p, r, rnd.random() < 0.5) for p in range(15) for r in range(12)]
    want = {}
    for p in range(15):
        seen, n = False, 0
        for q, r, there in rows:
            if q == p:
                n = 0 if there else n + seen
                seen = seen or there
                want[p, r] = n
    out = snapshot.missing_streak(spark.createDataFrame(rows, "p int, r int, there boolean"), "p", "r", "there")
    assert {(x.p, x.r): x.missing for x in out.collect()} == want


def test_replacement_is_unique_or_none(spark):
    gone = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y"), ("c", None, "z")], "id string, code string, place string")
    new = spark.createDataFrame([("n1", "1", "x"), ("n2", "2", "q"), ("n3", "9", "y"), ("n4", "8", "z")], "id string, code string, place string")
    assert {r.id: r.replaced_by for r in snapshot.replacement(gone, new, "id", ["code", "place"]).collect()} == {"a": "n1", "c": "n4"}


def test_cutoff_needs_enough_closed_weekdays_and_an_open_day(spark):
    start = date(2024, 1, 1)
    rows = [("a", start + timedelta(i), i < 5) for i in range(25)] + [("b", start + timedelta(i), False) for i in range(25)] + [("c", start + timedelta(i), i < 20) for i in range(25)]
    df = spark.createDataFrame(rows, "p string, d date, o boolean")
    assert [(r.p, r.cutoff) for r in snapshot.service_cutoff(df, "p", "d", "o").collect()] == [("a", date(2024, 1, 8))]


def test_near_names_lose_nothing(spark):
    rnd = random.Random(4)
    base = ["saint martin", "saint marcel", "villeneuve", "villefranche", "montreuil", "bois colombes", "la rochelle", "rochefort"]
    names = {*base, *("".join(c if rnd.random() > 0.12 else rnd.choice("abeimnost ") for c in rnd.choice(base)) for _ in range(150)), "rochelle", "saint"}
    names = sorted(n for n in names if len(n) >= 5)
    want = {(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if a in b or b in a or SequenceMatcher(None, a, b).ratio() >= 0.84}
    got = {(r.a, r.b) for r in similarity.near_names(spark.createDataFrame([(n,) for n in names], "n string"), "n").collect()}
    assert got == want and len(want) > 50


def test_expected_status_order(spark):
    expected = spark.createDataFrame([(i, "b", *x) for i, x in enumerate([("p1", "", False), ("p2", "l2", False), ("zz", "p1", False), ("yy", "", True), ("ww", "", False), ("vv", "", False)])], "expected_id int, bank_key string, place_key string, label_key string, is_plan boolean")
    events = spark.createDataFrame([("b", 1, "p1", "", "present"), ("b", 2, "qq", "l2", "missing_date"), ("c", 0, "vv", "", "present")], "bank_key string, event_seq int, place_key string, label_key string, date_status string")
    signals = spark.createDataFrame([("b", "on parle de ww", True)], "bank_key string, text_key string, plan_like boolean")
    got = {r.expected_id: r.status for r in coverage.expected_status(expected, events, signals).collect()}
    assert got == {0: "present", 1: "missing_date", 2: "label_as_place", 3: "plan", 4: "mentioned", 5: "absent"}


def test_even_sample_and_caps(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "i int")
    pick = lambda k: sorted(r.i for r in select.evenly_spaced(df, [F.desc("i")], k).collect())
    assert pick(0) == [] and pick(1) == [9] and pick(3) == [0, 5, 9] and pick(20) == list(range(10))
    assert sorted(r.i for r in select.rotating_batch(df, "i", 4, 2).collect()) == [0, 1, 8, 9]


def test_titles_make_events(spark):
    g = spark.createDataFrame([("Plouzané", "29", "29212", 0), ("Brest", "29", "29019", 0)], GAZETTEER)
    rows = [("u1", "LCL : l'agence de Plouzané ferme le 5 mars 2026", "Texte", "2026-01-05"), ("u2", "LCL : l'agence de Plouzané ferme temporairement", "Texte", "2026-01-05"), ("u3", "LCL : les agences de Plouzané et Brest vont fermer", "Texte", "2026-01-05")]
    out = titles.events_of_titles(spark.createDataFrame(rows, "url string, title string, text string, date string"), g).collect()
    assert [(r.url, r.bank, r.place, r.status, r.closed_on, r.temporal_status) for r in out] == [("u1", "LCL", "Plouzané", "confirmed", date(2026, 3, 5), "upcoming")]


def test_estimates_count_each_place_once(spark):
    t = lambda rows, schema: spark.createDataFrame(rows, schema)
    precise = t([("01", 1.0, 2.0), ("02", None, None)], "department string, lat double, lon double")
    unlocated = t([("01", "b", "p")], "department string, bank_key string, place_key string")
    announced = t([("01", 3), ("03", None)], "department string, n int")
    signals = t([("01", "b", "p", 1), ("01", "b", "q", 2), ("02", "b", "q", 3)], "department string, bank_key string, place_key string, seq int")
    got = {r.department: r.estimate for r in rollup.department_estimate(precise, unlocated, announced, signals).collect()}
    assert got == {"01": 1 + 1 + 3 + 1, "02": 0, "03": 0}


def test_search_counts_tokens_inside_longer_words(spark):
    asked = spark.createDataFrame([(1, ["mill", "lane"]), (2, ["lane"]), (3, [])], "query_id int, tokens array<string>")
    entries = spark.createDataFrame([("a", "windmills close"), ("b", "planes and mill"), ("c", "other mi ll"), ("d", None), ("e", "")], "url string, title_key string")
    assert sorted(map(tuple, select.search(asked, entries, 0.1, 5).collect())) == [(1, "a", 0.5), (1, "b", 1.0), (2, "b", 1.0)]
    assert sorted(map(tuple, select.search(asked, entries, 0.1, 1).collect())) == [(1, "b", 1.0), (2, "b", 1.0)]


def test_queries_read_whole_texts(spark, tmp_path):
    from tallyfold.plans import registry

    start = "one two three four five six seven eight nine ten eleven twelve " * 4
    docs = [(1, start + "left", "s", "en"), (2, start + "right", "s", "en"), (3, "x" * 900 + ". " + "y" * 300, "s", "en")]
    spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, start + "left"), (2, start + "other")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    run = lambda name: registry.queries()[name](spark, str(tmp_path)).collect()
    assert len({r.key_hash for r in run("canonical_key_hash")}) == 3
    assert {r.item_id: r.status for r in run("coverage_classify")} == {1: "mentioned", 2: "word_known"}
    assert {r.status: r.n for r in run("coverage_summary")} == {"mentioned": 1, "word_known": 1, "absent": 0, "never": 0}
    assert {r.doc_id: r.context for r in run("compact_context")}[3] == "en\n" + docs[2][1]
