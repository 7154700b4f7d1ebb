import random
import threading

import pytest
from pyspark.sql import functions as F

from tallyfold.operators.keyed import Conflict, KeyedTable, create_once
from tallyfold.operators.merge import VersionedTable

SCHEMA = "k int, seq int, v string, first int"


def rows(spark, *items):
    return spark.createDataFrame([(k, s, v, s) for k, s, v in items], SCHEMA)


def content(t, version=None):
    return {r.k: (r.seq, r.v, r["first"]) for r in t.read(version).collect()}


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, f"file://{tmp_path}/t", ["k"], buckets=8)


def test_upsert_insert_delete_equal_a_dict(spark, table):
    rnd, want, dead = random.Random(5), {}, {}
    assert table.read() is None and table.delete(spark.range(3).select(F.col("id").cast("int").alias("k"))) == 0
    for step in range(7):
        items = [(rnd.choice([None, *range(30)]), 100 * step + i, f"s{step}") for i in range(12)]
        kind = ["upsert", "insert", "delete"][step % 3]
        before = dict(want)
        if kind == "upsert":
            table.upsert(rows(spark, *items), "seq", keep_first=["first"])
            for k, s, v in items:
                first = want[k][2] if k in want else dead.pop(k)[2] if k in dead else s
                want[k] = (s, v, first)
        elif kind == "insert":
            table.insert(rows(spark, *items), "seq")
            for k, s, v in items:
                if k not in want and k not in dead:
                    want[k] = (s, v, s)
        else:
            table.delete(rows(spark, *items))
            for k, _, _ in items:
                if k in want:
                    dead[k] = want.pop(k)
        assert content(table) == want and {r.k for r in table.deleted().collect()} == set(dead)
        changed = {r.k: r.change for r in table.changes(step).collect()} if step else {}
        if step:
            assert changed == {k: "inserted" if k not in before else "deleted" if k not in want else "updated" for k in {*before, *want} if before.get(k) != want.get(k)}
    assert table.purge() == 8 and content(table) == want and table.deleted().count() == 0
    assert table.vacuum(keep=1, older_than_s=-1) > 0 and content(table) == want and table.versions() == [8]


def test_only_touched_buckets_are_rewritten(spark, table):
    table.upsert(rows(spark, *[(k, 1, "a") for k in range(200)]), "seq")
    before = table.state()["buckets"]
    table.upsert(rows(spark, (7, 2, "b"), (7, 1, "older")), "seq")
    after = table.state()["buckets"]
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1 and content(table)[7][1] == "b"
    table.upsert(rows(spark, (7, 0, "late")), "seq")
    assert content(table)[7][:2] == (2, "b")


def interleaved(spark, table, mine, theirs, attempts):
    """``theirs`` commits after ``mine`` has read and written, but before it commits."""
    late = KeyedTable(spark, table.path, ["k"], buckets=8)
    plain, once = late.write_buckets, []

    def write(df):
        out = plain(df)
        if not once:
            once.append(table.upsert(theirs, "seq"))
        return out

    late.write_buckets = write
    return late.upsert(mine, "seq", attempts=attempts)


def test_of_two_interleaved_writers_one_fails_and_nothing_is_lost(spark, table):
    table.upsert(rows(spark, (1, 1, "a"), (2, 1, "a")), "seq")
    with pytest.raises(Conflict):
        interleaved(spark, table, rows(spark, (1, 2, "mine"), (3, 2, "mine")), rows(spark, (1, 3, "theirs")), attempts=1)
    assert content(table) == {1: (3, "theirs", 3), 2: (1, "a", 1)}
    assert interleaved(spark, table, rows(spark, (1, 5, "mine"), (3, 5, "mine")), rows(spark, (1, 4, "theirs"), (4, 4, "theirs")), attempts=2) == 4
    assert content(table) == {1: (5, "mine", 5), 2: (1, "a", 1), 3: (5, "mine", 5), 4: (4, "theirs", 4)}


def test_writers_of_other_buckets_do_not_disturb_each_other(spark, table):
    table.upsert(rows(spark, *[(k, 1, "a") for k in range(50)]), "seq")
    bucket = {r.k: r.b for r in spark.range(50).select(F.col("id").cast("int").alias("k")).select("k", F.pmod(F.xxhash64("k"), F.lit(8)).alias("b")).collect()}
    other = next(k for k in bucket if bucket[k] != bucket[0])
    assert interleaved(spark, table, rows(spark, (0, 2, "mine")), rows(spark, (other, 2, "theirs")), attempts=1) == 3
    assert content(table)[0][1] == "mine" and content(table)[other][1] == "theirs" and len(content(table)) == 50


def test_a_batch_is_applied_once(spark, table):
    assert table.upsert(rows(spark, (1, 1, "a")), "seq", source="feed", batch=0) == 1
    assert table.delete(rows(spark, (1, 1, "a")), source="feed", batch=1) == 2
    assert table.upsert(rows(spark, (1, 9, "again")), "seq", source="feed", batch=0) == 2 and content(table) == {}
    assert table.upsert(rows(spark, (1, 9, "other")), "seq", source="other", batch=0) == 3 and content(table)[1][1] == "other"
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([(1, 2)], "k int, seq int"), "seq")


def test_a_file_is_created_by_one_of_many(spark, tmp_path):
    won = []
    threads = [threading.Thread(target=lambda i=i: won.append(create_once(spark, f"file://{tmp_path}/x", f"{i}"))) for i in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sum(won) == 1 and len(won) == 12


def test_of_two_versions_one_is_made(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/v")
    assert t.read() is None and t.write(spark.range(3)) == 1 and t.write(spark.range(5)) == 2 and t.read().count() == 5
    late = VersionedTable(spark, f"file://{tmp_path}/v")
    late.version = lambda: 1  # it read the first version before the second was there
    for _ in range(4):
        with pytest.raises(Conflict):
            late.write(spark.range(7))
        assert t.read().count() == 5
