from tierstar.operators.keys import key_range, position_key


def test_key_range_counts_each_key_once(spark):
    odd = spark.createDataFrame([(k,) for k in (-65, -64, -1, 0, 0, 63, 64, 64, 1 << 40, None)], "k long")
    assert tuple(key_range(odd, "k").first()) == (10, -65, 1 << 40, 7)
    assert tuple(key_range(odd.limit(0), "k").first()) == (0, None, None, 0)


def test_keys_by_position_sort_no_file_in_one_task(spark, tmp_path):
    """The rows of one large file stay where they are read; no table of all keys is kept."""
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    plan = key_range(position_key(spark.read.parquet(str(tmp_path / "t")), "k"), "k")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert tuple(key_range(position_key(spark.read.parquet(str(tmp_path / "t")), "k"), "k").first()) == (1000, 1, 1000, 1000)
