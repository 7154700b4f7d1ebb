import random

from pyspark.sql import functions as F

from tallyfold.operators import merge, snapshot, triage
from tallyfold.streaming import incremental, revisions


def files(spark, rows, schema, path, n):
    for i in range(n):
        spark.createDataFrame(rows[i::n], schema).coalesce(1).write.mode("append").parquet(path)


def test_each_url_once_equals_batch(spark, tmp_path):
    rows = [(f"u{i % 7}", f"t{i}") for i in range(30)]
    schema = "url string, title string"
    src = f"file://{tmp_path}/in"
    files(spark, rows, schema, src, 3)
    table = incremental.BatchLog(spark, f"file://{tmp_path}/t")
    incremental.run_once(incremental.first_seen(incremental.read_files(spark, src, schema)), incremental.log_to(table), f"file://{tmp_path}/cp")
    files(spark, [("u1", "again"), ("", "a"), (None, "b"), ("u8", "new"), ("", "a")], schema, src, 2)
    incremental.run_once(incremental.first_seen(incremental.read_files(spark, src, schema)), incremental.log_to(table), f"file://{tmp_path}/cp")
    assert sorted(r.url or "-" for r in table.read().filter("batch > 2").collect()) == ["-", "-", "-", "u8"]
    table = spark.createDataFrame(table.read().filter("url <> ''").collect())
    batch = triage.union_first([spark.read.parquet(src).filter("url <> ''")])
    assert {r.url for r in table.collect()} == {r.url for r in batch.collect()} and table.count() == 8


def test_merge_equals_batch(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(rnd.randrange(5), i, rnd.choice([None, i])) for i in range(40)]
    schema = "k int, seq int, v int"
    src = f"file://{tmp_path}/in"
    files(spark, rows, schema, src, 4)
    fold = lambda df: merge.signal_merge(df, ["k"], "seq", last_known=["v"], last=[], highest=[])
    events = incremental.BatchLog(spark, f"file://{tmp_path}/t")
    incremental.merge_to(incremental.read_files(spark, src, schema), fold, events, f"file://{tmp_path}/cp")
    files(spark, rows[::5], schema, src, 1)  # rows that come again, after a restart
    incremental.merge_to(incremental.read_files(spark, src, schema), fold, events, f"file://{tmp_path}/cp")
    touched = {r.k for r in events.read().filter("batch = 4").collect()}
    assert touched == {r[0] for r in rows[::5]}  # a batch writes its own keys
    assert {tuple(r) for r in incremental.latest(events, ["k"]).collect()} == {tuple(r) for r in fold(spark.read.parquet(src)).collect()}


def test_missing_counter_equals_batch(spark, tmp_path):
    rnd = random.Random(8)
    schema = "p int, r int, there boolean"
    src = f"file://{tmp_path}/in"
    everything = []
    for r in range(6):
        rows = [(p, r, rnd.random() < 0.5) for p in range(8)]
        everything += rows
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    out = incremental.missing_streaks(incremental.read_files(spark, src, schema), "p", "r", "there")
    q = out.writeStream.format("memory").queryName("streaks").option("checkpointLocation", f"file://{tmp_path}/cp").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(x.p, x.r): x.missing for x in spark.table("streaks").collect()}
    want = {(x.p, x.r): x.missing for x in snapshot.missing_streak(spark.createDataFrame(everything, schema), "p", "r", "there").select("p", "r", F.col("missing")).collect()}
    assert got == want


def days_of(spark, rows, path):
    import datetime

    start = datetime.datetime(2026, 1, 1)
    made = [(p, start + datetime.timedelta(days=d, hours=h)) for p, d, h in rows]
    spark.createDataFrame(made, "p string, ts timestamp").coalesce(1).write.mode("append").parquet(path)


def test_revision_state_with_timers_and_a_restart(spark, tmp_path):
    rnd = random.Random(2)
    seen = {(p, d) for p in "abcdefgh" for d in range(20) if rnd.random() < 0.5} | {("once", 0), ("late", 11), ("clock", 19)} | {("clock", d) for d in range(0, 20, 3)}
    rows = [(p, d, h) for p, d in sorted(seen) for h in ((1, 13) if d % 2 else (7,))]
    rnd.shuffle(rows)
    src, cp = f"file://{tmp_path}/in", f"file://{tmp_path}/cp"
    log = incremental.BatchLog(spark, f"file://{tmp_path}/log")
    for low, high in ((0, 6), (6, 11), (11, 20)):  # a run each, from the checkpoint of the one before
        days_of(spark, [r for r in rows if low <= r[1] < high], src)
        revisions.run(incremental.read_files(spark, src, "p string, ts timestamp"), "p", "ts", log, cp)
    got = {(r.p, r.day.toordinal()): (r.missing, r.change) for r in log.read().collect()}
    base = __import__("datetime").date(2026, 1, 1).toordinal()
    want = {}
    for p in {p for p, _ in seen}:
        missing = 0
        first = min(d for q, d in seen if q == p)
        for d in range(first, 19):  # the last day has not ended
            there = (p, d) in seen
            change = "new" if d == first else ("returned" if missing else "seen") if there else ("missing" if missing == 0 else "confirmed" if missing == 1 else "gone")
            missing = 0 if there else missing + 1
            want[p, base + d] = (missing, change)
    assert got == want and log.read().count() == len(want)
