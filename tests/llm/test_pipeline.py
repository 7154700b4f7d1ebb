import hashlib
import re
import sys
from collections import defaultdict
from pathlib import Path

import corpus_pipeline
import pytest

from tallyfold.llm.scratch import Scratch
from tallyfold.llm.shingles import shingle_set

from . import edge

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scratch, out = Scratch(spark, "t"), [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(scratch.write(stage(spark, out[-1], SF)))
    return [df.collect() for df in out]


def test_stages_equal_brute_force(stages):
    docs, quality, exact, near, cut, packed = stages
    words = lambda t: re.findall("[^ \t-\r]+", t or "")
    assert {r.doc_id for r in quality} <= {r.doc_id for r in docs if len(words(r.text)) >= 50} and len(quality) > 0.6 * len(docs)
    first = {}
    for r in sorted(quality):
        first.setdefault(" ".join(words(r.text)) if r.text.strip() == r.text else re.sub("[ \t-\r]+", " ", r.text), r.doc_id)
    assert {r.doc_id for r in exact} == set(first.values())
    sets = {r.doc_id: set(shingle_set(r.text.encode()).tolist()) for r in exact}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert {r.doc_id for r in near} == {i for i in ids if find(i) == i}
    at = defaultdict(set)
    for r in near:
        w = r.text.encode().split()
        for j in range(len(w) - 49):
            at[hashlib.md5(b" ".join(w[j : j + 50])).digest()].add((r.doc_id, j))
    gone = defaultdict(set)
    for found in at.values():
        if len({i for i, _ in found}) > 1:
            for i, j in found - {min(found)}:
                gone[i].update(range(j, j + 50))
    want = {r.doc_id: [x for k, x in enumerate(r.text.encode().split()) if k not in gone[r.doc_id]] for r in near}
    assert {r.doc_id: r.text.encode().split() for r in cut} == {i: w for i, w in want.items() if w}
    assert {r.doc_id for r in packed} == {r.doc_id for r in cut}


def test_stages_stand_edge_cases(spark):
    for rows in (edge.rows(), []):
        docs = spark.createDataFrame([(r[0], r[1], "en", "s", len(r[1] or ""), True, 3) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, kept boolean, bits int")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = Scratch(spark, "e").write(stage(spark, docs, SF))
            assert out.columns == docs.columns
            docs = out
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= 0


def test_quality_and_exact_stages_go_row_by_row(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(7, text), (7, text), (9, text), (None, text + " end"), (None, text + " end"), (None, "two words"), (4, text + "\n\n end"), (8, text + " other")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), True, 3) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, kept boolean, bits int")
    for df in (docs, Scratch(spark, "rows").write(docs.repartition(3))):
        good = corpus_pipeline.quality_rules(spark, df, SF)
        assert good.columns == docs.columns and sorted(r.text for r in good.collect()) == sorted(t for _, t in rows if t != "two words")
        once = corpus_pipeline.exact_copies(spark, Scratch(spark, "good").write(good), SF)
        assert once.columns == docs.columns
        assert sorted((r.doc_id or -1, r.text) for r in once.collect()) == sorted([(7, text), (4, text + "\n\n end"), (8, text + " other")])


def test_entry_imports_without_this_subpackage(tmp_path):
    import shutil
    import subprocess

    repo = Path(__file__).resolve().parents[2]
    shutil.copytree(repo / "tallyfold", tmp_path / "tallyfold", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(repo / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and not any(n.startswith('op') for n in q) and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
