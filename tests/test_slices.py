from tallyfold.operators import merge


def test_a_replaced_slice_leaves_the_others(spark, tmp_path):
    path = f"file://{tmp_path}/slices"
    merge.replace_slice(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "x int, s string"), path, "s")
    merge.replace_slice(spark.createDataFrame([(9, "b"), (8, "c")], "x int, s string"), path, "s")
    assert {(r.x, r.s) for r in spark.read.parquet(path).collect()} == {(1, "a"), (9, "b"), (8, "c"), (3, None)}
