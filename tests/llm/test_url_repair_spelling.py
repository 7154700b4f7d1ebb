import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyfold.llm import conversation_repair as repair
from tallyfold.llm import queries, spelling, url_filter

URLS = [None, "", "no scheme", "http://", "https://Example.COM/en/1", "https://www.example.com/en/2?x=1", "https://a.www.example.com/en/", "http://blog.site.example.com/fr/3#top", "http://example.com", "http://notexample.com/en/4", "http://x.net/es/5", "http://x.net/esx/5", "http://net/fr/6", "http://x.network/fr/7", "ftp://É.NET/fr/8", "http://x.org/a://b.com/c", "http://com?/en/", "https://example.com/EN/9", "http://h.net/es/" + "9/" * 30_000, "http://example.com/en/9 space#://y.net/es/"]


def rule_of(url):
    url = url or ""
    at = url.find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [(len(h + p), h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


def test_rules_equal_plain_code(spark):
    rows = spark.createDataFrame([(i, u) for i, u in enumerate([*URLS, *URLS[:3]])], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.rule_verdict) for r in url_filter.ruled(url_filter.split_url(rows), queries.URL_RULES).collect()}
    assert got == {i: rule_of(u) for i, u in enumerate([*URLS, *URLS[:3]])}


def test_lexical_features(spark):
    import math

    urls = ["https://a-b.c.org/x//y1?p=1&&q=2#z", "", "http://é.de/%20"]
    got = url_filter.lexical(url_filter.split_url(spark.createDataFrame([(u,) for u in urls], "url string"))).collect()
    for r in got:
        n = len(r.url)
        share = [c / n for c in Counter(r.url).values()]
        assert r.entropy == pytest.approx(-sum(p * math.log2(p) for p in share)) and r.url_length == n
    a = got[0]
    assert (a.depth, a.n_params, a.hyphens, a.host_labels, a.secure, a.fragment, a.query_length) == (2, 2, 1, 3, 1, 1, 8)
    assert a.digit_ratio == pytest.approx(3 / len(urls[0])) and got[2].escapes == 1


def labelled(n, seed):
    """URLs to be blocked have long digits and many parameters, or a host under one of the bad domains."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        bad = rnd.random() < 0.4
        host = f"w{rnd.randrange(9)}.{'spam' if bad and rnd.random() < 0.5 else 'site'}{rnd.randrange(3)}.org"
        junk = bad and "spam" not in host
        path = f"/{rnd.randrange(10**12)}/{rnd.randrange(10**12)}" if junk else f"/page/{rnd.choice('abc')}"
        query = "?" + "&".join(f"k{j}={rnd.randrange(10**6)}" for j in range(4)) if junk else f"?v={i}"
        rows.append((i, f"https://{host}{path}{query}", float(bad)))
    return rows


def test_trees_on_held_out_urls(spark):
    rows = labelled(1500, 5)
    pages = spark.createDataFrame([(i, u, None, "x") for i, u, _ in rows], "page_id long, url string, html string, rule string")
    labels = spark.createDataFrame([(i, b) for i, _, b in rows if i < 1000], "key long, block double")
    got = url_filter.judge(pages, labels, F.col("page_id"), []).collect()
    assert len(got) == len(rows)
    held = [(r.verdict == "block") == bool(rows[r.page_id][2]) for r in got if r.page_id >= 1000]
    assert len(held) == 500 and sum(held) / len(held) > 0.97
    bounded = url_filter.judge(pages, labels, F.col("page_id"), [], sample=300).collect()
    assert sum((r.verdict == "block") == bool(rows[r.page_id][2]) for r in bounded) / len(bounded) > 0.95


def test_a_folds_statistics_leave_its_own_labels_out(spark):
    one = spark.createDataFrame([("u1", "a.b.c", "/", 0, 1.0), ("u2", "a.b.c", "/", 1, 0.0)], "url string, host string, path string, fold int, block double")
    counts = url_filter.suffix_counts(one)
    got = {r.fold: r for r in url_filter.host_statistics(spark.createDataFrame([("a.b.c", 0), ("a.b.c", 1), ("a.b.c", -1)], "host string, fold int"), counts).collect()}
    assert got[0].rate_3 == 0 and got[1].rate_3 == pytest.approx(1) and got[-1].rate_3 == pytest.approx(0.5)


def test_urls_without_two_kinds_of_labels(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    none = spark.createDataFrame([], "key long, block double")
    one = spark.createDataFrame([(4, 1.0), (4, 1.0), (5, None), (None, 0.0)], "key long, block double").filter("block is not null")
    for labels, plain in ((none, "allow"), (one, "block")):
        got = {r.page_id: r.verdict for r in url_filter.judge(pages, labels, F.col("page_id"), queries.URL_RULES).collect()}
        assert got == {i: rule_of(u)[3] or plain for i, u in enumerate(URLS)}
    assert url_filter.judge(pages.limit(0), one, F.col("page_id"), queries.URL_RULES).count() == 0


# ---- conversations


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(key.encode()) % 20
        out[conv]
        if h:
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            out[conv] += [(turn, "user" if h == 4 else role, text)] * (1 + (h == 3))
    return {c: sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, v in out.items()}


def cheapest(items):
    """(cost, audit, result) by search over all edits; items are (role, text, fault)."""
    due = {0: "u", 1: "u", 2: "a", 3: "u"}
    after = {0: 2, 1: 2, 2: 3, 3: 2}
    name = {"u": "user", "a": "assistant"}
    heap = [(0, "", 0, 0, ())]
    done = set()
    while heap:
        cost, audit, i, q, result = heapq.heappop(heap)
        if (i, q) in done:
            continue
        if i == len(items) and q in (0, 3):
            return cost, audit, result
        done.add((i, q))
        heapq.heappush(heap, (cost + 5, audit + "I", i, after[q], (*result, (name[due[q]], ""))))
        if i < len(items):
            role, text, fault = items[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, q, result))
            if fault in ("", "truncated"):
                x = 5 if fault else 0
                heapq.heappush(heap, (cost + 1 + x, audit + "R", i + 1, after[q], (*result, (name[due[q]], text))))
                if role[:1] == due[q]:
                    heapq.heappush(heap, (cost + x, audit + "K", i + 1, after[q], (*result, (role, text))))
                elif role[:1] == "s" and q == 0:
                    heapq.heappush(heap, (cost + x, audit + "K", i + 1, 1, (*result, (role, text))))


def expected(rows):
    out = {}
    for conv, kept in damage(rows).items():
        seen, items = set(), []
        for _, role, text in kept:
            solid = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            items.append((role, text, fault))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        cost, audit, result = cheapest(items)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in result).encode()).hexdigest()
        out[conv] = (gaps, *(sum(x[2] == f for x in items) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


SCHEMA = "conv_id long, turn long, role string, text string, cost long, audit string, rows int"


def talk():
    rnd = random.Random(4)
    rows = []
    for c in range(120):
        for t in range(rnd.choice([1, 2, 3, 5, 8, 13])):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "sheep", None, "User"])
            rows.append((c, rnd.choice([t, t, t, None, t * 3]), role, rnd.choice(["Yes.", "No?", "cut of", "é 😀!\n", "", None, " \t", "a\nb. ", "Yes."])))
    rows += [(None, None, None, None), (None, 3, "user", "x."), (None, 4, "assistant", "y."), (500, 0, "user", "w. " * 60_000), (500, 1, "assistant", "v.")]
    rows += [(600, t, "user" if t % 2 else "assistant", f"line {t}.") for t in range(1500)] + [(700, 1, "user", "twice.")] * 3
    return [(*r, 1, "x", 2) for r in rows]


def test_repair_equals_search(spark):
    got = repair.repair(repair.damaged(spark.createDataFrame(talk(), SCHEMA).repartition(6))).collect()
    want = expected([r[:4] for r in talk()])
    assert len(got) == len(want)
    for r in got:
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) == want[r.conv_id], r.conv_id


def test_repair_of_nothing(spark):
    assert repair.repair(repair.damaged(spark.createDataFrame([], SCHEMA))).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    (r,) = repair.repair(repair.damaged(spark.createDataFrame([(gone, 0, "user", "x.", 1, "", 1)], SCHEMA))).collect()
    assert (r.gaps, r.cost, r.audit, r.repaired_sha256) == (0, 0, "", hashlib.sha256(b"").hexdigest())


def test_equal_ends_are_one_node(monkeypatch):
    made = []
    plain = repair.node_values
    monkeypatch.setattr(repair, "node_values", lambda *a: made.append(1) or plain(*a))
    signatures = sorted(["suaua", "uaua", "xuaua", "Uaua", "ua"], key=lambda s: s[::-1])
    got = {s: (c, a) for s, c, a in repair.repair_signatures(iter(signatures))}
    assert len(made) == len({s[i:] for s in signatures for i in range(len(s))})
    assert got["suaua"] == (0, "KKKKK") and got["xuaua"] == (2, "DKKKK") and got["Uaua"] == (4, "DDKK") and got["ua"] == (0, "KK")


# ---- spelling


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    return a != b and (len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1 or len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b))))


def variants(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def prose():
    rnd = random.Random(9)
    base = ["".join(rnd.choice("abcé") for _ in range(rnd.randint(6, 11))) for _ in range(60)] + ["prefix" + "".join(rnd.choice("xyÿ×") for _ in range(rnd.randint(3, 5))) for _ in range(40)]
    rows = []
    for d in range(80):
        words = []
        for _ in range(120):
            w = base[min(int(rnd.expovariate(0.05)), len(base) - 1)]
            if rnd.random() < 0.3:
                i = rnd.randrange(len(w))
                w = rnd.choice([w[:i] + w[i + 1 :], w[:i] + rnd.choice("abé") + w[i:], w[:i] + rnd.choice("abÉ") + w[i + 1 :]])
            words.append(rnd.choice([w, w, w.title(), w.upper() if w.isascii() else w]))
        rows.append((d, rnd.choice([" ", "-", "_1", "\n"]).join(words)))
    rows += [(None, "nowhere " * 7), (900, None), (901, ""), (902, "x" * 5000), (903, "samesame " * 20_000), (904, "chainword " * 300), (905, "chainwork " * 60), (906, "chainwark " * 12), rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("chunk", [spelling.CHUNK, 7])
def test_spelling_equals_brute_force(spark, chunk):
    docs = spark.createDataFrame([(*r, "x", 1) for r in prose()], "doc_id long, text string, word string, n long").repartition(5)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group(docs, chunk=chunk).collect()}
    want = variants(prose())
    assert got == want and sum(v[0] is not None for v in want.values()) > 10 and want["chainwark"][:2] == ("chainwork", "chainword")


def test_spelling_of_nothing(spark):
    assert spelling.group(spark.createDataFrame([(1, None), (2, "short words")], "doc_id long, text string")).count() == 0
    assert spelling.group(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_both_searches_find_all_pairs():
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("abé") for _ in range(rnd.randint(6, 9))) for _ in range(400)})
    want = {(a, b) for a in words for b in words if one_apart(a, b)}
    for backwards in (False, True):
        got = {(words[i], words[j]) for q, e in spelling.near_words(words, words, backwards) for i, j in zip(q, e, strict=True)}
        half = lambda a, b: b.endswith(a[len(a) // 2 :]) if backwards else b.startswith(a[: len(a) // 2])  # noqa: B023, E731
        assert got == {(a, b) for a, b in want if half(a, b)}
