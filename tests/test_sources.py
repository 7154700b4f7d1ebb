import json

from pyspark.sql import functions as F

from tallyfold.operators import signals
from tallyfold.sources import articles, networks, sinks


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return f"file://{path}"


def test_feeds_and_lists(spark, tmp_path):
    rss = put(tmp_path / "a.xml", "<rss><channel><item><title>T</title><link>http://x/1</link><pubDate>Tue, 06 Jan 2026 10:00:00 GMT</pubDate><description>D</description></item></channel></rss>")
    r = articles.rss(spark, rss, "feed").first()
    assert (r.title, r.text, r.url, r.source) == ("T", "D", "http://x/1", "feed")
    news = put(tmp_path / "n.json", json.dumps({"articles": [{"title": "A", "url": "u", "seendate": "20260112T080000Z", "domain": "d.fr"}]}))
    assert articles.news_list(spark, news).first().date == "2026-01-12"
    reg = put(tmp_path / "r.json", json.dumps({"articles": {"results": [{"title": "A", "url": "u", "source": {"uri": "s"}}, {"title": "B", "url": " "}]}}))
    assert [(x.title, x.source) for x in articles.registry_list(spark, reg).collect()] == [("A", "s")]
    legal = put(tmp_path / "l.json", json.dumps({"results": [{"titles": [{"id": "I1", "title": "<b>Loi</b>"}], "sections": [{"extracts": [{"values": ["un <i>deux</i>"]}]}]}, {"title": "B", "text": "t", "url": "u", "date": "2026-01-01"}]}))
    got = {x.title: (x.text, x.url) for x in articles.legal_results(spark, legal, "https://l/").collect()}
    assert got == {"Loi": ("un deux", "https://l/I1"), "B": ("t", "u")}
    urls = put(tmp_path / "u.txt", "voir https://a.fr/x).\n\nrien\n")
    assert [x.url for x in articles.url_list(spark, urls).collect()] == ["https://a.fr/x"]


def test_registers_and_branches(spark, tmp_path):
    csv = put(tmp_path / "r.csv", "denomination,commune,code_postal,statut\nA,Lyon,69001,Radié\nB,Paris,75001,Actif\n")
    assert [(x.department, x.text) for x in articles.register_csv(spark, csv, "r:").collect()] == [("69", "A, 69001 Lyon : Radié")]
    osm = put(tmp_path / "o.json", json.dumps({"elements": [{"type": "node", "id": 1, "lat": 1.0, "lon": 2.0, "tags": {"brand": "LCL", "addr:postcode": "69001"}}, {"type": "way", "id": 2, "center": {"lat": 3.0, "lon": 4.0}, "tags": {"name": "CIC"}}, {"type": "node", "id": 3, "tags": {}}]}))
    assert sorted((x.branch_id, x.bank, x.lat) for x in networks.osm_branches(spark, osm).collect()) == [("node/1", "LCL", 1.0), ("way/2", "CIC", 3.0)]
    b = put(tmp_path / "b.csv", "Libellé;Adresse;Code postal;Localité;Latitude;Longitude\nP1;1 rue;1000;Bourg;46,2;5,2\n;;;;;\n")
    got = networks.branch_csv(spark, b, "La Banque Postale").collect()
    assert [(x.name, x.postal_code, x.department, x.lat, x.lon) for x in got] == [("P1", "01000", "01", 46.2, 5.2)]
    cal = put(tmp_path / "c.json", '{"identifiant": "1", "date_calendrier": "2024-01-02", "bp_plage_horaire_1": "Fermé"}\n{"identifiant": "1", "date_calendrier": "2024-01-03", "bp_plage_horaire_1": "9h-12h"}\n')
    assert [x.is_open for x in networks.calendar(spark, cal).orderBy("day").collect()] == [False, True]


def test_curated_lists_by_headings(spark, tmp_path):
    p = put(tmp_path / "x.csv", "Banque,Agence / localisation,Commune,Département,Date de fermeture,Source,Lien source,Éléments retenus\nLCL,Centre,Lyon,Rhône,2026-01-01,J,http://x,t\n,,,,,,,\n")
    got = articles.curated(spark, p).collect()
    assert [(x.bank, x.label, x.place, x.url, x.text, x.plan) for x in got] == [("LCL", "Centre", "Lyon", "http://x", "t", None)]


def test_captures_and_full_texts(spark):
    rows = [("k1", "https://a.fr/banque-1", "2024", "200", "text/html"), ("k1", "https://a.fr/banque-1", "2025", "200", "text/html"), ("k2", "https://a.fr/sport", "2024", "200", "text/html"), ("k3", "https://a.fr/banque-2", "2023", "404", "text/html"), ("k4", "https://a.fr/banque-3", "2022", "200", "text/html")]
    idx = spark.createDataFrame(rows, "urlkey string, url string, timestamp string, status string, mime string").withColumn("filename", F.lit("f")).withColumn("offset", F.lit("0"))
    assert [(r.urlkey, r.timestamp) for r in articles.captures(idx, "banque", "sport", 1).collect()] == [("k1", "2025")]
    pages = spark.createDataFrame([("u1", "<p>Bonjour &amp; fin</p>"), ("u2", "<script>x</script>")], "url string, html string")
    known = spark.createDataFrame([("u0", "ok")], "url string, status string")
    got = {r.url: (r.status, r.full_text) for r in articles.full_texts(spark.createDataFrame([("u0",), ("u1",), ("u2",), ("u3",)], "url string"), pages, known).collect()}
    assert got == {"u1": ("ok", "Bonjour & fin"), "u2": ("empty", ""), "u3": ("error", None)}


def test_structured_results(spark):
    good = json.dumps({"article_type": "closure", "confidence": 0.9, "closures": [], "department_signals": [{"bank": "LCL", "departement": "69", "count": 3}]})
    rows = spark.createDataFrame([("u", good), ("v", '{"article_type": "x", "confidence": 0.5}'), ("w", '{"article_type": "closure", "confidence": 4}'), ("x", "no json")], "url string, j string")
    out = signals.parse(rows, "j", checks={"article_type": ["closure", "none"]})
    assert {r.url: r.valid for r in out.collect()} == {"u": True, "v": False, "w": False, "x": False}
    assert [(r.bank, r["count"]) for r in signals.explode_signals(out.filter("valid"), "department_signals", ["bank", "departement"]).select("bank", F.col("count")).collect()] == [("LCL", 3)]


def test_exports(spark, tmp_path):
    e = spark.createDataFrame([("1", "LCL", "Lyon", None, 2, None, "closed")], "event_id string, bank string, place string, address string, reliability int, closed_on date, temporal_status string").withColumns({"department": F.lit("69"), "label": F.lit(""), "approximate": F.lit(False)})
    s = spark.createDataFrame([("1", "u2", "b"), ("1", "u1", "a")], "event_id string, url string, name string")
    r = sinks.event_rows(e, s).first()
    assert (r.first_url, r.sources, r.address, r.temporal_status, r.to_verify) == ("u1", "u1\nu2", "Non renseignée", "Fermée", True)
    sinks.write_sections({"events": e}, f"file://{tmp_path}/out")
    assert spark.read.json(f"file://{tmp_path}/out/events").count() == 1
