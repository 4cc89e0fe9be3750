from datetime import datetime

from pyspark.sql import functions as F

from helpers import at, rows, table
from tierstar.operators.history import merge_history, start_history
from tierstar.schemas import TABLES
from tierstar.streaming.incremental import append_new_files, high_water_mark, newer_than, upsert

FIRST, SECOND, THIRD = datetime(2020, 1, 1), datetime(2021, 1, 1), datetime(2022, 1, 1)


def test_history_keeps_old_values(spark):
    history = start_history(table(spark, k=["a", "b", "c"], v=["1", None, "3"]), FIRST)
    history = merge_history(history, table(spark, k=["a", "b", "d"], v=["1", "2", "4"]), "k", ["v"], SECOND)
    assert rows(history, "k", "valid_from") == [
        ("a", "1", FIRST, None, 1),
        ("b", None, FIRST, SECOND, 0),
        ("b", "2", SECOND, None, 1),
        ("c", "3", FIRST, SECOND, 0),
        ("d", "4", SECOND, None, 1),
    ]
    again = merge_history(history, table(spark, k=["a", "b", "d"], v=["1", "2", "4"]), "k", ["v"], THIRD)
    assert rows(again, "k", "valid_from") == rows(history, "k", "valid_from")
    back = merge_history(history, table(spark, k=["c"], v=["3"]), "k", ["v"], THIRD)
    assert [(r.k, r.valid_from) for r in back.filter("is_current = 1").collect()] == [("c", THIRD)]


def test_upsert_and_watermark(spark):
    df = table(spark, k=["a", "a", "b"], t=[FIRST, SECOND, FIRST], v=[1, 2, 3]).withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert high_water_mark(df, "t") == SECOND
    assert newer_than(df, "t", SECOND).count() == 1 and newer_than(df, "t", FIRST).count() == newer_than(df, "t", None).count() == 3
    arrived = table(spark, k=["b", "c"], t=[FIRST, FIRST], v=[30, 4]).withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = upsert(df, arrived, ["k"], [F.col("t").desc_nulls_last()])
    # On equal times the arrived row replaces the stored one.
    assert rows(got.select("k", "v"), "k") == [("a", 2), ("b", 30), ("c", 4)]
    unique = df.filter("v > 1")
    passed_through = upsert(unique, arrived, ["k"], [F.col("t").desc_nulls_last()], existing_unique=True)
    assert rows(passed_through.select("k", "v"), "k") == [("a", 2), ("b", 30), ("c", 4)]


def test_only_new_files_are_loaded(spark, tmp_path):
    inbox, target, checkpoint = tmp_path / "inbox", str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    inbox.mkdir()
    header = "product_category_name,product_category_name_english\n"
    spec = TABLES["category_translation"]

    def load():
        append_new_files(spark, str(inbox), spec, target, checkpoint)
        return sorted(r.product_category_name for r in spark.read.parquet(target).collect())

    (inbox / "1.csv").write_text(header + "artes,art\n")
    assert load() == ["artes"]
    (inbox / "2.csv").write_text(header + "bebes,baby\n")
    assert load() == ["artes", "bebes"]
    assert load() == ["artes", "bebes"]
