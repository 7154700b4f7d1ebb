import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import bpe, chat, exact_dedup, html_text, packing, pieces, quality, sharding

from . import edge

WORD = re.compile("[^ \t-\r]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge.rows(), edge.SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], edge.SCHEMA)


def test_html_main_text():
    page = "<html><head><title>T</title><style>p{}</style></head><body><header>Top</header><nav><a href=x>Menu</a></nav><div class='cookie-notice'>We use cookies</div><article><h1>Head &amp; line</h1><p>First <b>bold</b>\n  text<br>next<p>Second &eacute;t&#233;<script>var a='</p>'</script> end</p><aside>Side</aside><form>Mail</form><div class=ad>Buy</div></article><section class='comments'><p>I like it</p></section><footer>&copy; x</footer>"
    assert html_text.main_text(page) == "Head & line\n\nFirst bold text next\n\nSecond été end"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<nav>x</nav>") == ""
    assert html_text.main_text("<p>cut of") == "cut of" and html_text.main_text("a < b") == "a < b"


def test_html_without_article_keeps_between_surge_and_dive():
    long = "word " * 40
    page = f"<ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul><div><p>{long}</p><p>Short.</p><p>{long}</p></div><div><a>x</a></div><div><a>y</a></div><div><a>z</a></div><div><a>w</a></div><p>Later</p>"
    assert html_text.main_text(page) == f"{long.strip()}\n\nShort.\n\n{long.strip()}"


def test_html_keeps_text_in_wrappers_and_before_the_surge():
    long = ("word " * 40).strip()
    links = "".join(f"<p><a>l{i}</a></p>" for i in range(4))
    for mark in ("layout with-sidebar", "has-sidebar", "no-sidebar", "layout sidebar"):
        page = f'<div class="{mark}"><article><h1>Head</h1><p>{long}</p></article><div class="sidebar">side</div></div>'
        assert html_text.main_text(page) == f"Head\n\n{long}"
    assert html_text.main_text(f'<div class="post-header"><h1>Head</h1></div><p>By one</p><p>{long}</p><div class="site-footer">foot</div>') == f"Head\n\nBy one\n\n{long}"
    assert html_text.main_text(f"<h1>Head line</h1><p>By one</p><p>Date</p><p>Place</p><p>{long}</p>") == f"Head line\n\nBy one\n\nDate\n\nPlace\n\n{long}"
    assert html_text.main_text(f'<article><p>{long}</p></article><div class="comments"><article>said</article></div>') == long
    assert html_text.main_text(f'<div class="sidebar"><p>{long}</p></div><p>x</p>') == f"{long}\n\nx"
    assert html_text.main_text(f"<article>{links}<h1><a>Head</a></h1><p>Short.</p>{links}<p>End.</p><p><a>one</a></p></article>") == "Short.\n\nEnd.\n\none"
    assert html_text.main_text(f"<article><h1><a>Head</a></h1><p>Short.</p></article>") == "Head\n\nShort."


def test_html_rows(spark):
    rows = [(1, "u", "<p>é</p>", "x"), (1, "u", "<p>é</p>", "x"), (2, None, None, "y")]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in out) == [(1, "é", 1), (1, "é", 1), (2, "", 0)]
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i : i + 3])].append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered)


def test_quality_measures_equal_brute_force(spark, docs, none):
    rnd = random.Random(7)
    more = [(100 + i, " ".join(rnd.choice("abc") + rnd.choice(["", "#"]) for _ in range(rnd.randint(0, 40))) + rnd.choice(["", "\n", "\na b\na b"]), None, None, None, None, None) for i in range(60)]
    both = docs.union(spark.createDataFrame(more, edge.SCHEMA))
    texts = {r[0]: r[1] for r in [*edge.rows(), *more]}
    got = quality.measure(both).collect()
    assert len(got) == len(edge.rows()) + 60
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) == measures(texts[r.doc_id])
    assert quality.ledger(none).count() == 0


def test_policies_and_ablations_agree(spark, docs):
    led = quality.ledger(docs).cache()
    rows = [r.bits for r in led.collect()]
    for r in quality.ablations(led).collect():
        mask, bit = quality.POLICIES[r.policy], quality.BITS[r.rule]
        assert (r.rejected, r.failing, r.alone) == (sum(b & mask != 0 for b in rows), sum(b & bit != 0 for b in rows), sum(b & mask == bit for b in rows))
    assert quality.verdict(led, "base").filter("kept").count() == sum(b & 3 == 0 for b in rows)


def test_exact_groups_equal_brute_force(spark, docs, none):
    groups = defaultdict(list)
    key = lambda t: re.sub("[ \t-\r]+", " ", t or "")
    for r in edge.rows():
        groups[key(r[1])].append(r[0])
    got = exact_dedup.dedup(spark, docs).collect()
    texts = {r[0]: r[1] for r in edge.rows()}
    assert len(got) == len(edge.rows())
    for r in got:
        g = groups[key(texts[r.doc_id])]
        assert (r.group_size, r.keep_id, r.text_sha256) == (len(g), min((i for i in g if i is not None), default=None), hashlib.sha256(key(texts[r.doc_id]).encode()).hexdigest())
    for g, n in Counter(key(texts[r.doc_id]) for r in got if r.kept).items():
        assert n == 1, g
    assert {key(texts[r.doc_id]) for r in got if r.kept} == set(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_dedup.dedup(spark, none).count() == 0


def test_loads_meet_one_index(spark):
    rows = [(i, f"text {i % 7}") for i in range(40)] + [(7, "text 0"), (None, "text 3"), (None, "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = exact_dedup.dedup(spark, df, loads=1).collect()
    for loads in (2, 5):
        got = exact_dedup.dedup(spark, df, "many_loads", loads=loads)
        assert spark.table("many_loads").count() == 8
        assert sorted(map(str, got.collect())) == sorted(map(str, want)) and sum(r.kept for r in want) == 8
        spark.sql("drop table many_loads")
    before = len(spark.catalog.listTables())
    exact_dedup.dedup(spark, df)
    assert len(spark.catalog.listTables()) == before


def test_later_loads_keep_the_index(spark):
    a = spark.createDataFrame([(5, "x"), (6, "y")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (3, "z")], "doc_id long, text string")
    exact_dedup.dedup(spark, a, "two_loads")
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.dedup(spark, b, "two_loads").collect()}
    assert got == {1: (5, False), 2: (2, True), 3: (2, False)} and spark.table("two_loads").count() == 3
    spark.sql("drop table two_loads")


def test_lookup_table_is_fair_and_stable():
    names = [f"s{i}" for i in range(12)]
    t = sharding.fill(names, 1009)
    counts = np.bincount(t, minlength=12)
    assert counts.max() - counts.min() <= 1
    fewer = sharding.fill(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(t, fewer, strict=True) if a != 11)
    assert moved < 0.15 * 1009
    turn = [0] * 3  # the first claims, by hand
    seen = {}
    for k in range(3):
        o, s = (int(hashlib.sha256(f"{x}:{names[k]}".encode()).hexdigest()[:15], 16) for x in ("offset", "skip"))
        while (at := (o % 101 + turn[k] * (s % 100 + 1)) % 101) in seen:
            turn[k] += 1
        seen[at] = k
    assert all(sharding.fill(names[:3], 101)[at] == k for at, k in seen.items())
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill(bad)


def test_placement(spark, docs, none):
    out = sharding.place(docs.withColumn("slot", F.lit("old")), ["a", "b", "c"], slots=101)
    assert out.count() == len(edge.rows()) and {r.shard for r in out.collect()} <= {"a", "b", "c"} and sharding.place(none, ["a"]).count() == 0


def conversations(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t, r or "", x or ""))
    return {c: sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, *x[1:])) for c, v in by.items()}


def test_formatting_is_reversible(spark):
    rnd = random.Random(3)
    bits = ["[", "]", "</s>", "[INST]", "\\", "\\l", "\\b", "/", " ", "\n", "é", "[/user] ", "[assistant] x [/assistant]</s>", "] ", "<"]
    said = lambda: "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12)))
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "to[ol]"]), said()) for c in range(40) for t in range(rnd.randint(1, 9))]
    rows += [(50, t, "user" if t % 2 else "assistant", said()) for t in range(200)] + [(51, 0, None, None), (51, 0, "user", "tie"), (51, 0, "user", "tie")]
    rows += [(None, 1, "assistant", "b"), (None, 0, "user", "a"), (None, None, "system", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(1)).repartition(5)
    nodes = chat.nodes_table(df)
    steps = chat.paths(nodes)
    out = chat.format_paths(nodes, steps, chat.best(nodes, steps, top=1)).withColumn("turns", chat.parsed(F.col("formatted")))
    out = out.withColumn("tree", F.col("tree").try_cast("long"))
    got = {r.tree: r for r in out.select("tree", "formatted", "loss_spans", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), chat.unescape(t["raw"]).alias("text"))).alias("turns")).collect()}
    want = conversations(rows)
    assert set(got) == set(want)
    back = lambda s: s.replace("\\l", "[").replace("\\g", "<").replace("\\b", "\\")
    for c, turns in want.items():
        assert [(t.role, t.text) for t in got[c].turns] == [(r, x) for _, r, x in turns]
        assert [back(got[c].formatted[s.start : s.start + s.length]) for s in got[c].loss_spans] == [x for _, r, x in turns if r == "assistant"]


def test_branches_of_a_tree_are_ranked(spark):
    rows = [(1, 1, None, 0.0), (1, 2, 1, 4.0), (1, 3, 1, 1.0), (1, 4, 2, 0.0), (1, 5, 3, 8.0), (1, 6, 99, 2.0), (2, 1, None, 1.0)]
    nodes = spark.createDataFrame([(*r, "user", f"t{r[1]}") for r in rows], "tree long, node long, parent long, score double, role string, text string")
    steps = chat.paths(nodes)
    got = {(r.tree, r.leaf): (round(r.score, 6), r.size, r["rank"]) for r in chat.best(nodes, steps).collect()}
    assert got == {(1, 4): (round(4 / 3, 6), 3, 3), (1, 5): (3.0, 3, 1), (1, 6): (2.0, 1, 2), (2, 1): (1.0, 1, 1)}
    out = chat.format_paths(nodes, steps, chat.best(nodes, steps, 1)).filter("tree = 1").first()
    assert out.formatted == "[user] t1 [/user][user] t3 [/user][user] t5 [/user]"
    empty = nodes.filter("tree < 0")
    assert chat.format_paths(empty, chat.paths(empty), chat.best(empty, chat.paths(empty))).count() == 0


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))


def odd_texts(n):
    rnd = random.Random(11)
    alphabet = " \n\t'stdvemlr abcXYZ019.,!éß你  \x1c\x85😀"
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(n)] + [r[1] or "" for r in edge.rows()]


def test_bpe_equals_the_library(ranks):
    import tiktoken

    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    cache = bpe.piece_cache(ranks, P.PATTERN)
    texts = odd_texts(3000)
    ids, sizes = cache.encode(texts)
    for t, part in zip(texts, np.split(ids, np.cumsum(sizes)[:-1]), strict=True):
        assert part.tolist() == e.encode_ordinary(t)
    rnd = random.Random(2)
    for _ in range(200):
        w = bytes(rnd.choice(b"abetheing") for _ in range(rnd.randint(2, 100)))
        assert bpe.fold_long(w, ranks) == bpe.fold(w, ranks) == e.encode_ordinary(w.decode())


def test_bpe_round_trip(spark, docs, none, ranks):
    out = bpe.encode_decode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_ids=True).collect()
    texts = {r[0]: r[1] or "" for r in edge.rows()}
    assert len(out) == len(edge.rows())
    for r in out:
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.n_tokens == len(r.ids)
    assert bpe.encode_decode(none, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_native_fold_equals_python(spark):
    few = {bytes([b]): i for i, b in enumerate(range(256))} | {w: 256 + i for i, w in enumerate([b"th", b"he", b"the", b" the", b"in", b"ing", b" t"])}
    words = ["the", " the", "thing", "hehehe", "x", "é", " thethe"]
    got = {r.word: r.ids for r in bpe.fold_words(spark.createDataFrame([(w,) for w in words], "word string"), few, buckets=16).collect()}
    assert got == {w: bpe.fold(w.encode(), few) for w in words}


def test_cache_generations_change_nothing(ranks):
    texts = odd_texts(400)
    small = pieces.PieceCache(bpe.piece_cache(ranks, P.PATTERN).encode_many, most=8)
    big = bpe.piece_cache(ranks, P.PATTERN)
    one_by_one = [small.encode([t]) for t in texts]
    ids, sizes = big.encode(texts)
    assert np.concatenate([x for x, _ in one_by_one]).tolist() == ids.tolist() and [n.tolist() for _, n in one_by_one] == [[n] for n in sizes.tolist()]


def test_slices_hold_every_row_once(ranks):
    import pyarrow as pa

    texts = ["x" * n for n in (0, 5, 7 << 20, 3, 3 << 20, 3 << 20, 1)] + [None] + ["y"] * 5000
    b = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["i", "t"])
    parts = list(pieces.slices(b, 1))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(len(texts)))
    assert all(p.num_rows == 1 or p.num_rows <= pieces.SLICE and sum(len(t or "") for t in p.column(1).to_pylist()) <= pieces.SLICE_BYTES for p in parts)
    assert list(pieces.slices(b.slice(0, 0), 1)) == []


def cheapest(at, penalty, capacity):
    pos = [0, *at]
    cost = [0] + [None] * len(at)
    for i in range(1, len(pos)):
        cost[i] = min(cost[j] + capacity - (pos[i] - pos[j]) + penalty[i - 1] for j in range(i) if pos[i] - pos[j] <= capacity and cost[j] is not None)
    return cost[-1]


def test_cuts_are_the_cheapest():
    rnd = random.Random(9)
    for _ in range(200):
        at = np.cumsum([rnd.randint(1, 12) for _ in range(rnd.randint(1, 40))]).tolist()
        penalty = [rnd.choice([0, 2, 6, 16]) for _ in at]
        cuts = packing.cut(at, penalty, 12 + rnd.randint(0, 20) if False else 20)
        where = dict(zip(at, penalty, strict=True))
        total = sum(20 - (b - a) + where[b] for a, b in zip([0, *cuts], cuts, strict=False))
        assert cuts[-1] == at[-1] and total == cheapest(at, penalty, 20)


def test_packing_places_each_token_once(spark, docs, none):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rows = packing.pack(docs, P.path("byte_bpe_50k.json"), block=5000).collect()
    texts = {r[0]: r[1] or "" for r in edge.rows()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for doc, found in by_doc.items():
        ids = np.array([*t.encode(texts[doc], add_special_tokens=False).ids, 1], np.uint32)
        copies = sum(x[0] == doc for x in edge.rows())
        assert sorted(p for r in found for p in range(r.start, r.start + r.length)) == sorted(list(range(len(ids))) * copies)
        assert all(r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in found)
    padding = 0
    for found in by_seq.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        padding += 2048 - at if at & (at - 1) else 0
    assert set(by_doc) == set(texts) and padding < 0.02 * sum(r.length for r in rows)
    assert packing.pack(none, P.path("byte_bpe_50k.json")).count() == 0


def test_vocabularies_agree(ranks):
    assert base64.b64encode(b"a") and len(ranks) == 50256
