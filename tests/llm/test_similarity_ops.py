import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyfold.llm import bitmap, jaccard_join, line_dedup, suffix_dedup
from tallyfold.llm.shingles import shingle_set

from . import edge


def corpus():
    """Groups of near copies around several similarities, a shared passage, and the edge cases."""
    rnd = random.Random(21)
    rows = [r[:2] for r in edge.rows() if r[0] is not None]
    passage = edge.words(77, 55)
    nid = 1000
    for g in range(12):
        base = edge.words(500 + g, rnd.choice([9, 60, 150, 400]))
        rows.append((nid, " ".join(base)))
        for _ in range(rnd.randint(1, 9)):
            w = list(base)
            for _ in range(rnd.choice([1, 1, 2, 3, 6, 12])):
                w[rnd.randrange(len(w))] = "w" + str(rnd.randrange(1000))
            rows.append((nid := nid + 1, " ".join(w)))
        nid += 1
    for i in range(25):
        rows.append((nid := nid + 1, " ".join(edge.words(900 + i, rnd.randint(3, 60)) + passage + edge.words(2000 + i, rnd.randint(3, 60)))))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, -5, True) for i, t in corpus()], "doc_id long, text string, n long, kept boolean").repartition(5)


def union(pairs, nodes):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {x: find(x) for x in nodes}


def test_jaccard_components_equal_brute_force(spark, docs):
    sets = {i: set(shingle_set((t or "").encode()).tolist()) for i, t in corpus()}
    ids = sorted(sets)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = union(pairs, ids)
    got = jaccard_join.join(spark, docs).collect()
    assert len(got) == len(corpus())
    for r in got:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id])
    assert len(pairs) >= 50
    assert jaccard_join.join(spark, docs.filter("doc_id < 0")).count() == 0


def test_rows_without_an_id_link_too(spark):
    base = edge.words(41, 200)
    ends = lambda *at: " ".join(f"w{i}" if i in at else x for i, x in enumerate(base))
    # the rows of 5 and 6 link with the one without an id, but not with each other
    rows = [(5, ends(10, 20)), (None, ends(10, 20, 100, 110)), (6, ends(100, 110, 190, 196)), (None, "alone and without an id"), (8, "other words of a text"), (None, None), (None, ends(10, 20, 100, 110))]
    got = jaccard_join.join(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sets = {t: set(shingle_set((t or "").encode()).tolist()) for _, t in rows}
    alike = lambda a, b: 100 * len(sets[rows[a][1]] & sets[rows[b][1]]) >= 80 * len(sets[rows[a][1]] | sets[rows[b][1]])
    assert alike(0, 1) and alike(1, 2) and not alike(0, 2)
    order = lambda found: sorted(found, key=str)
    assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order((i, len(sets[t]), {0: 5, 1: 5, 2: 5, 3: None, 4: 8, 5: None, 6: 5}[k]) for k, (i, t) in enumerate(rows))


def test_prefixes_share_enough():
    for n in range(1, 400):
        for m in range(n, 400):
            o = -(-80 * (n + m) // 180)
            if o > n:
                break
            need = 1 + jaccard_join.least_overlap(n) // jaccard_join.EXTRA
            # in the worst case all of the other set's own shingles come first
            for size in (n, m):
                assert jaccard_join.prefix_size(size) - (size - max(o, jaccard_join.least_overlap(m))) >= min(need, o)


def test_passages_equal_brute_force(spark, docs):
    at = defaultdict(set)
    text = {i: (t or "").encode().split() for i, t in corpus()}
    for i, w in text.items():
        for j in range(len(w) - 49):
            at[tuple(w[j : j + 50])].add((i, j))
    want, copies = defaultdict(set), defaultdict(set)
    for found in at.values():
        if len({i for i, _ in found}) > 1:
            for i, j in found:
                want[i].update(range(j, j + 50))
                if (i, j) != min(found):
                    copies[i].update(range(j, j + 50))
    spans = suffix_dedup.repeated_spans(spark, docs).cache()
    got, cut = defaultdict(set), defaultdict(set)
    for r in spans.collect():
        got[r.doc_id].update(range(r.start_word, r.start_word + r.n_words))
        if r.is_copy:
            cut[r.doc_id].update(range(r.start_word, r.start_word + r.n_words))
        assert r.other_doc_id != r.doc_id
    assert got == want and cut == copies and len(want) > 25
    left = {r.doc_id: r for r in suffix_dedup.remove_copies(docs, spans).collect()}
    for i, w in text.items():
        rest = [x for k, x in enumerate(w) if k not in copies[i]]
        assert (left[i].text or "").encode().split() == rest if i in left else not rest
    assert suffix_dedup.repeated_spans(spark, docs.filter("doc_id < 0")).count() == 0


def test_lines_keep_one_of_each_group(spark):
    long = edge.words(31, 40)
    near = list(long)
    near[3] = "other"
    rows = [(1, "Hello, World 12\n\n" + " ".join(long)), (2, "hello world 34\nunique line here"), (3, None), (4, " ".join(long) + "\nhello WORLD: 99"), (4, " ".join(long)), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.line_no): (r.keep_doc_id, r.keep_line_no, r.kept) for r in line_dedup.groups(spark, df).collect()}
    assert got == {(1, 0): (1, 0, True), (1, 2): (1, 2, True), (2, 0): (1, 0, False), (2, 1): (2, 1, True), (4, 0): (1, 2, False), (4, 1): (1, 0, False)}
    left = {r.doc_id: r.text for r in line_dedup.drop_lines(df.filter("doc_id in (2, 3)"), line_dedup.groups(spark, df)).collect()}
    assert left == {2: "unique line here", 3: None}
    assert line_dedup.groups(spark, df.filter("doc_id > 9")).count() == 0


@pytest.mark.parametrize("exact", [False, True])
def test_lines_of_rows_without_an_id_link_as_others(spark, exact):
    base = edge.words(41, 40)
    near = list(base)
    near[5] = "other"
    rows = [(None, "lone line of no document\n" + " ".join(base)), (1, "x y\n" + " ".join(base)), (2, " ".join(near)), (None, "lone line of no document"), (None, " ".join(near))]
    got = [(r.doc_id, r.line_no, r.keep_doc_id, r.keep_line_no, r.kept) for r in line_dedup.groups(spark, spark.createDataFrame(rows, "doc_id long, text string"), exact=exact).collect()]
    shown = lambda x: tuple(-1 if v is None else v for v in x)
    linked = [(-1, 1, 1, 1, False), (1, 1, 1, 1, True), (2, 0, 1, 1, False), (-1, 0, 1, 1, False)]
    alone = [(1, 0, 1, 0, True), (-1, 0, -1, 0, True), (-1, 0, -1, 0, True)]
    assert exact and sorted(map(shown, got)) == sorted(linked + alone) or not exact and len(got) == 7


def test_fuzzy_lines_equal_brute_force(spark):
    rnd = random.Random(6)
    rows = []
    for g in range(30):
        base = edge.words(700 + g, rnd.randint(5, 300))
        for _ in range(rnd.randint(1, 5)):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2])):
                w[rnd.randrange(len(w))] = rnd.choice(edge.words(3, 50))
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sim = {r.doc_id: r.simhash for r in line_dedup.lines(df).collect()}
    words = {i: [w.lower() for w in t.split()] for i, t in rows}

    def simhash_of(w):  # votes, by hand, from Spark's hash of the words
        n = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in w) > len(w))
        return n - (1 << 64) if n >> 63 else n

    flat = spark.createDataFrame([(i, w) for i, ws in words.items() for w in ws], "i long, w string").selectExpr("i", "xxhash64(w) as h").collect()
    hashes = defaultdict(list)
    for r in flat:
        hashes[r.i].append(r.h & (1 << 64) - 1)
    assert all(simhash_of(hashes[i]) == sim[i] for i in sim)

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    ids = sorted(words)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if ((sim[a] ^ sim[b]) & (1 << 64) - 1).bit_count() <= 3 and edits(words[a], words[b]) <= max(len(words[a]), len(words[b])) * 20 // 100]
    want = union(pairs, ids)
    assert {r.doc_id: r.keep_doc_id for r in line_dedup.groups(spark, df).collect()} == want and len(pairs) > 20


def test_every_similar_line_is_found(spark):
    rnd = random.Random(8)
    words = []
    for g in range(30):
        base = edge.words(1700 + g, rnd.choice([4, 5, 6, 9, 10, 14, 28, 60, 150]))
        words.append(base)
        for _ in range(rnd.randint(1, 4)):
            w = list(base)
            for _ in range(rnd.randint(1, max(1, len(base) // 5))):
                at, how = rnd.randrange(len(w)), rnd.randrange(3)
                w[at : at + (how != 1)] = [] if how == 2 else [rnd.choice(edge.words(3, 50))]
            words.append(w)
    words += [["the"] * n for n in (3, 4, 5, 6)] + [["the", "of"] * n for n in (4, 5)]
    words = [[x.lower() for x in w] for w in words if w]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(words)], "doc_id long, text string")

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    ids = range(len(words))
    want = union([(a, b) for a in ids for b in ids[a + 1 :] if edits(words[a], words[b]) <= max(len(words[a]), len(words[b])) * 20 // 100], ids)
    assert {r.doc_id: r.keep_doc_id for r in line_dedup.groups(spark, df, exact=True).collect()} == want
    few = {r.doc_id: r.keep_doc_id for r in line_dedup.groups(spark, df).collect()}
    assert sum(want[i] != i for i in ids) > 40 > sum(few[i] != i for i in ids)


def test_pieces_of_lines_that_link_are_runs_of_the_shorter(spark):
    rnd = random.Random(12)
    pairs = []
    for n in [*range(4, 40), 99]:
        for _ in range(4):
            a = [chr(97 + rnd.randrange(9)) + chr(97 + i // 26) + chr(97 + i % 26) for i in range(n)]
            b = list(a)
            for at in sorted(rnd.sample(range(n), n // 5), reverse=True):
                b[at : at + 1] = [] if rnd.random() < 0.5 else ["other"]
            pairs.append((" ".join(a), " ".join(b)))
    df = spark.createDataFrame([(2 * i + j, t) for i, p in enumerate(pairs) for j, t in enumerate(p)], "doc_id long, text string")
    keys = line_dedup.signed_lines(df).select("doc_id", F.col("sig.n").alias("n"), F.posexplode("runs").alias("at", "key")).withColumn("own", line_dedup.is_piece(F.col("n"), F.col("at")))
    own, runs, size = defaultdict(set), defaultdict(set), {}
    for r in keys.collect():
        runs[r.doc_id].add(r.key)
        size[r.doc_id] = r.n
        if r.own:
            own[r.doc_id].add(r.key)
    assert all(len(own[2 * i]) == size[2 * i] // 5 + 1 for i in range(len(pairs)) if size[2 * i] > 4)
    assert all(own[2 * i] & runs[2 * i + 1] for i in range(len(pairs)) if size[2 * i] > 4)
    listed = len([k for k in runs if size[k] > 15]) and max(len(own[k]) / size[k] for k in runs if size[k] > 15)
    assert listed < 0.27  # neighbouring words, as before, were 0.4 of a line's words


def test_lines_with_a_run_by_chance_are_no_candidates(spark):
    rnd = random.Random(13)
    phrase, rows = ["of", "the", "and", "to"], []
    for g in range(60):  # the same words in each line, so that no count of words tells them apart, and one phrase at any place
        w = [chr(97 + i // 26) + "x" + chr(97 + i % 26) for i in range(40)]
        rnd.shuffle(w)
        at = rnd.randrange(41)
        rows.append((g, " ".join(w[:at] + phrase + w[at:])))
    near = rows[0][1].split()
    near[10:12] = ["other"]
    rows.append((60, " ".join(near)))
    found = line_dedup.runs(spark.createDataFrame(rows, "id long, line string")).selectExpr("id", "key", "own", "shiftleft(cast(n as bigint), 32) + 2 * place + cast(own as int) v")
    keys = found.groupBy("key").agg(F.countDistinct("id").alias("c"), F.bool_or("own").alias("own")).filter("c > 1 and own").select("key")
    lists = found.join(keys, "key").groupBy("key", "id").agg(F.min("v").alias("l"), F.max("v").alias("h"))
    a, b = (lists.selectExpr("key", f"id {x}", f"l l{x}", f"h h{x}") for x in "ab")
    met = a.join(b, "key").filter("a < b").select("a", "b", F.expr(line_dedup.MAY_LINK).alias("may")).groupBy("a", "b").agg(F.bool_or("may").alias("may")).collect()
    may = {(r.a, r.b) for r in met if r.may}
    assert (0, 60) in may and len(met) > 100 and len(may) < len(met) / 2  # before, all of them were: their words' parities are equal
    got = {r.doc_id: r.keep_doc_id for r in line_dedup.groups(spark, spark.createDataFrame(rows, "doc_id long, text string"), exact=True).collect()}
    assert got == {i: 0 if i == 60 else i for i in range(61)}


def test_a_line_is_brought_to_its_form_once(spark):
    df = spark.createDataFrame([(1, "Ab,  c – 12\t«D»\r\n\n  .\nE é…  "), (2, None)], "doc_id long, text string")
    found = line_dedup.normalised(df, "doc_id", "text")
    assert [(r.line_no, r.line) for r in found.orderBy("line_no").collect()] == [(0, "ab c 00 d"), (3, "e é")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 1 and plan.count("lower(") == 1  # before, a filter had them made again for each line


@pytest.mark.parametrize("bits", [10, 18])
def test_a_dense_bitmap_has_each_key(spark, bits):
    rows = spark.range(3000).selectExpr("id as key", "id % 7 as v")
    marks = bitmap.dense_bitmap(rows.filter("key % 10 = 0"), "key", bits)
    left = {r.key for r in bitmap.may_be_in_dense(rows, "key", marks, bits).collect()}
    assert set(range(0, 3000, 10)) <= left and len(left) < 450
    assert all(len(r[0]) == 1 << (bitmap.CHUNK - 6) for r in marks.select("_bm_words").collect())


def test_a_common_run_makes_few_pairs(spark, monkeypatch):
    rnd = random.Random(14)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(9))
    common = [[word() for _ in range(4)] for _ in range(2)]
    rows = []
    for g in range(80):  # at one place each, so that no bound on places tells the lines apart
        w = [word() for _ in range(60)]
        for at, run in zip((8, 40), common, strict=True):
            w[at : at + 4] = run
        rows.append((g, " ".join(w)))
    for g in (3, 50):
        w = rows[g][1].split()
        for at in rnd.sample([i for i in range(60) if not (8 <= i < 12 or 40 <= i < 44)], 12):
            w[at] = word()
        rows.append((len(rows), " ".join(w)))
    written, write = [], line_dedup.Scratch.write

    def counted(self, df, *args, **kinds):
        out = write(self, df, *args, **kinds)
        if df.columns == ["a", "b"]:
            written.append(out.count())
        return out

    monkeypatch.setattr(line_dedup.Scratch, "write", counted)
    got = {r.doc_id: r.keep_doc_id for r in line_dedup.groups(spark, spark.createDataFrame(rows, "doc_id long, text string"), exact=True).collect()}
    assert got == {i: {80: 3, 81: 50}.get(i, i) for i in range(82)}
    assert max(written) < 400  # before, each two of the 82 lines were compared: 3,321 pairs


def test_lines_link_whatever_the_rounds(spark, monkeypatch):
    rnd = random.Random(15)
    rows = []
    for g in range(25):
        base = edge.words(3100 + g, rnd.choice([5, 9, 14, 30, 70]))
        for _ in range(3):
            w = list(base)
            for _ in range(rnd.randint(0, len(base) // 5)):
                w[rnd.randrange(len(w))] = rnd.choice(edge.words(4, 50))
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {r.doc_id: r.keep_doc_id for r in line_dedup.groups(spark, df, exact=True).collect()}
    monkeypatch.setattr(line_dedup, "ROUND_PIECES", 50)
    rounds, listed = [], line_dedup._listed
    monkeypatch.setattr(line_dedup, "_listed", lambda *args: rounds.append(out := listed(*args)) or out)
    assert {r.doc_id: r.keep_doc_id for r in line_dedup.groups(spark, df, exact=True).collect()} == whole
    assert len(rounds) == line_dedup.ROUNDS and sum(k != v for k, v in whole.items()) > 20
