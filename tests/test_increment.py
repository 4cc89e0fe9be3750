from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import rows, table
from tierstar.operators import partials
from tierstar.operators.asof import as_of
from tierstar.operators.history import apply_changes
from tierstar.operators.partials import Measures, State
from tierstar.sources.store import LayerStore, RunInfo
from tierstar.streaming.feed import Feed, fold, forget, live

KEPT = Measures("k", ("a",), "m")
DAY = datetime(2021, 1, 1)


def lines(spark, *items):
    k, m, a = zip(*items, strict=True) if items else ((), (), ())
    made = pa.table({"k": pa.array(k, pa.string()), "m": pa.array(m, pa.string()), "a": pa.array(a, pa.float64())})
    return spark.createDataFrame(made).withColumn("a", F.col("a").cast("decimal(10,2)"))


def same(one: State, other: State):
    for x, y in ((one.totals, other.totals), (one.members, other.members)):
        assert sorted(map(repr, rows(x.select(*sorted(x.columns))))) == sorted(map(repr, rows(y.select(*sorted(x.columns)))))


def test_state_after_changes_is_that_of_all_rows(spark):
    stay = [("x", "1", 5.0), ("x", "2", None), ("y", "1", 1.5), (None, "3", 2.0), ("w", None, 1.0)]
    gone = [("x", "1", 7.0), ("x", "3", 1.0), ("z", "9", 4.0), (None, "4", 1.0)]
    came = [("x", "1", 8.0), ("x", "4", None), ("v", "1", 1.0), (None, "3", 1.0), ("w", "5", None)]
    before = partials.start(lines(spark, *stay, *gone), KEPT)
    after = partials.advance(before, lines(spark, *gone), lines(spark, *came), KEPT)
    same(after, partials.start(lines(spark, *stay, *came), KEPT))
    same(partials.advance(after, lines(spark), lines(spark), KEPT), after)
    same(partials.advance(after, lines(spark, *came), lines(spark, *gone), KEPT), before)


def test_a_state_of_other_rows_is_an_error(spark):
    state = partials.start(lines(spark, ("x", "1", 5.0)), KEPT)
    with pytest.raises(Exception, match="than its state holds"):
        partials.advance(state, lines(spark, ("x", "2", 5.0)), lines(spark, ("x", "1", 1.0)), KEPT).members.collect()


def test_averages_like_avg(spark):
    state = partials.start(lines(spark, ("x", "1", 1.0), ("x", "1", 1.0), ("x", "1", 2.01), ("x", "1", None), ("y", "2", None)), KEPT)
    assert [tuple(map(str, r)) for r in rows(state.totals.select("k", partials.average("a", "decimal(16,6)")), "k")] == [("x", "1.336667"), ("y", "None")]


def changes(spark, *items):
    k, n, op, v = zip(*items, strict=True)
    return table(spark, k=pa.array(k, pa.string()), n=pa.array(n, pa.int64()), op=pa.array(op, pa.string()), v=pa.array(v, pa.string()))


def test_feed_in_any_order(spark):
    events = [("a", 1, "insert", "x"), ("a", 3, "delete", None), ("a", 2, "update", "late"), ("b", 5, "INSERT", "y"), ("c", 4, "delete", "z"), ("b", 6, None, "w"), (None, 9, "insert", "q"), ("d", None, "insert", "q")]
    want = None
    for order in [(0, 1, 2), (2, 1, 0)]:
        lots = [events[:3], events[3:5], events[5:]]
        state = None
        for k in (*order, order[0]):
            state = fold(state, changes(spark, *lots[k]), ["k"], "n", "op")
        got = rows(state.select("k", "_sequence", "_gone", "v"), "k")
        want = want or got
        assert got == want == [("a", 3, True, None), ("b", 6, False, "w"), ("c", 4, True, None)]
    assert rows(live(state)) == [("b", "w")]
    assert rows(forget(state, 4).select("k"), "k") == [("b",), ("c",)]


def test_feed_publishes_a_batch_once(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    feed = Feed(store, "t", ["k"], "n", "op")
    assert feed.table() is None
    assert feed.apply(changes(spark, ("a", 1, "insert", "x"), ("a", 1, "insert", "x")), 0)
    assert not feed.apply(changes(spark, ("b", 2, "insert", "x")), 0)
    # An attempt that failed before its manifest leaves only files behind.
    store.stage(RunInfo("t-000000000001-failed"), feed.layer, "t", feed.table())
    assert feed.apply(changes(spark, ("a", 2, "delete", None), ("c", 7, "insert", "y")), 1)
    assert rows(live(feed.table())) == [("c", "y")]
    assert rows(feed.marks()) == [(1, 7, 2, 2, 1)]
    assert store.manifest().filter("layer = 'feed_t'").count() == 4


def test_feed_stream_takes_each_file_once(spark, tmp_path):
    feed = Feed(LayerStore(spark, str(tmp_path / "store")), "t", ["k"], "n", "op")
    first = changes(spark, ("a", 2, "insert", "x"))
    for df in (first, changes(spark, ("a", 1, "delete", None), ("b", 3, "insert", "y"))):
        df.write.mode("append").parquet(str(tmp_path / "in"))
        feed.run(spark, str(tmp_path / "in"), first.schema, str(tmp_path / "check"))
    assert rows(live(feed.table()), "k") == [("a", "x"), ("b", "y")]


def test_version_at_a_time(spark):
    v = [("a", DAY, DAY + timedelta(40), "1"), ("a", DAY + timedelta(50), None, "2"), ("b", DAY + timedelta(3), None, None), ("c", DAY, None, "9")]
    k, start, end, name = zip(*v, strict=True)
    versions = table(spark, k=list(k), valid_from=list(start), valid_to=list(end), name=list(name))
    asked = [("a", -1, None), ("a", 0, "1"), ("a", 20, "1"), ("a", 39, "1"), ("a", 40, None), ("a", 49, None), ("a", 50, "2"), ("a", 900, "2"), ("b", 2, None), ("b", 400, None), ("z", 5, None), (None, 5, None), ("a", None, None)]
    asked += [("a", 300 + i % 90, "2") for i in range(500)]
    ids = list(range(len(asked)))
    df = table(spark, id=ids, k=pa.array([a[0] for a in asked]), t=pa.array([None if a[1] is None else DAY + timedelta(a[1]) for a in asked], pa.timestamp("us")))
    for slice in ("month", "day"):
        got = as_of(df, versions, "k", "t", ["name"], slice=slice)
        assert got.columns == ["id", "k", "t", "name"]
        assert [r.name for r in got.orderBy("id").collect()] == [a[2] for a in asked]


def test_hot_key_is_spread_over_slices(spark):
    versions = table(spark, k=["a"], valid_from=[DAY], valid_to=pa.array([None], pa.timestamp("us")), name=["1"])
    df = spark.range(40_000).select(F.lit("a").alias("k"), F.expr("TIMESTAMP_NTZ '2021-01-02' + make_dt_interval(cast(id % 700 AS int))").alias("t"))
    found = as_of(df, versions, "k", "t", ["name"]).repartition(200, "k", F.date_trunc("month", "t"))
    assert found.filter("name = '1'").count() == 40_000
    # The sort of rows is by key and slice: no part of it holds more than a month.
    plan = as_of(df, versions, "k", "t", ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_key" in plan and "_part" in plan.split("hashpartitioning(_key")[1][:40]


def points(spark, *items):
    k, day, v, here, n = zip(*items, strict=True)
    return table(spark, k=list(k), valid_from=[DAY + timedelta(d) for d in day], v=list(v), is_present=list(here), recorded=list(n))


def test_history_in_any_order_of_arrival(spark):
    all_points = [("a", 0, "x", 1, 1), ("a", 20, "x", 1, 2), ("a", 10, "y", 1, 7), ("a", 30, None, 0, 3), ("a", 30, "z", 1, 4), ("b", 5, None, 0, 5), ("b", 6, "q", 1, 6), ("c", 1, None, 1, 8)]
    on = lambda d: DAY + timedelta(d)
    want = [("a", "x", on(0), on(10), 0), ("a", "y", on(10), on(20), 0), ("a", "x", on(20), on(30), 0), ("a", "z", on(30), None, 1), ("b", "q", on(6), None, 1), ("c", None, on(1), None, 1)]
    lots = [all_points[:2], all_points[2:4] + all_points[:1], all_points[4:]]
    for order in [(2, 0, 1), (1, 2, 0)]:
        found = kept = None
        for k in order:
            found, kept = (df.cache() for df in apply_changes(found, kept, points(spark, *lots[k]), "k", ["v"]))
        assert rows(found.select("k", "v", "valid_from", "valid_to", "is_current"), "k", "valid_from") == want
        assert kept.count() == 7


def test_kept_parts_are_computed_once_and_change_nothing(spark):
    kept = partials.Measures("k", ("x",), "m")
    of = lambda some: spark.createDataFrame(some, "k int, m string, x int").withColumn("x", F.col("x").cast("decimal(12,2)"))
    before = of([(1, "a", 1), (1, "a", 2), (1, "b", None), (2, "c", 4), (None, "d", 5)])
    gone, came = of([(1, "a", 1), (2, "c", 4), (None, "d", 5)]), of([(1, "e", 7), (3, "a", 8), (None, None, 9)])
    seen = {}

    def keep(name, df):
        seen[name] = seen.get(name, 0) + 1
        return spark.createDataFrame(df.collect(), df.schema)

    state = partials.start(before, kept)
    one, other = partials.advance(state, gone, came, kept), partials.advance(state, gone, came, kept, keep)
    assert seen == {"changed": 1, "paired": 1, "delta": 1}
    for a, b in ((one.totals, other.totals), (one.members, other.members)):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
