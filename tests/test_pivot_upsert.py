from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fleetframe.operators import dedup, pivot, upsert

T0 = datetime(2024, 1, 1)
LONG = "imo string, signal string, signal_timestamp timestamp, signal_value double, loaddate string"
KEY = ["imo", "signal_timestamp"]


def long(spark, *rows):
    data = [(imo, s, T0 + timedelta(hours=h), v, load) for imo, s, h, v, load in rows]
    return spark.createDataFrame(data, LONG)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def sample(spark):
    return long(spark, ("1", "b.x", 0, 1.0, "L1"), ("1", "a c", 0, 2.0, "L2"), ("1", "a c", 1, 3.0, "L1"),
                ("2", "b.x", 0, 4.0, "L1"))


def test_pivot_forms(spark):
    by_load = pivot.pivot_long(sample(spark))
    assert by_load.columns == ["imo", "signal_timestamp", "loaddate", "a c", "b.x"]
    assert rows(by_load) == [("1", T0, "L1", None, 1.0), ("1", T0, "L2", 2.0, None),
                             ("1", T0 + timedelta(hours=1), "L1", 3.0, None), ("2", T0, "L1", None, 4.0)]
    assert rows(pivot.pivot_conditional(sample(spark))) == rows(by_load)
    assert rows(pivot.pivot_long(sample(spark), unique=True)) == rows(by_load)
    assert rows(pivot.pivot_latest(sample(spark))) == [
        ("1", T0, "L2", 2.0, 1.0), ("1", T0 + timedelta(hours=1), "L1", 3.0, None), ("2", T0, "L1", None, 4.0)]


def test_listed_signals_only(spark):
    assert rows(pivot.pivot_long(sample(spark), ["b.x"])) == [("1", T0, "L1", 1.0), ("2", T0, "L1", 4.0)]


def test_duplicate_cells(spark):
    twice = sample(spark).union(long(spark, ("1", "b.x", 0, 7.0, "L1")))
    assert (("1", T0, "L1", None, 7.0)) in rows(pivot.pivot_long(twice))
    with pytest.raises(PySparkException, match="several rows for one cell"):
        pivot.pivot_long(twice, on_duplicate="error").collect()
    assert rows(pivot.pivot_long(sample(spark), on_duplicate="error")) == rows(pivot.pivot_long(sample(spark)))


def test_unpivot_restores_the_rows(spark):
    back = pivot.unpivot(pivot.pivot_long(sample(spark))).select(sample(spark).columns)
    assert rows(back) == rows(sample(spark))


def test_wide_rows_are_built_after_the_only_shuffle(spark):
    cells = sample(spark).repartition(3)
    plan = pivot.pivot_long(cells, ["a c", "b.x"], unique=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1
    assert "Exchange" not in plan[: plan.index("REPARTITION_BY_COL")].replace("Exchange hashpartitioning", "", 1)


def test_hot_cell_is_reduced_before_the_shuffle(spark):
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("imo"), F.lit("a").alias("signal"),
        F.lit(T0).alias("signal_timestamp"), F.col("id").cast("double").alias("signal_value"), F.lit("L").alias("loaddate"))
    out = pivot.pivot_long(hot)
    assert out.filter("imo = 'hot'").first()["a"] == 29997.0 and out.count() == 20001
    assert "partial_max" in out._jdf.queryExecution().executedPlan().toString()


def test_too_many_signals(spark):
    spark.conf.set("spark.sql.pivotMaxValues", "1")
    try:
        with pytest.raises(ValueError, match="more than 1 signals"):
            pivot.signal_list(sample(spark))
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_top_signals_and_stats(spark):
    assert rows(pivot.top_signals(sample(spark), 1)) == [("a c", 2)]
    assert pivot.keep_top_signals(sample(spark), 1).count() == 2
    assert pivot.keep_top_signals(sample(spark), 9).count() == 4
    assert tuple(pivot.pivot_stats(pivot.pivot_latest(sample(spark))).first()) == (
        3, 5, 2, T0, T0 + timedelta(hours=1))


def wide(spark, columns, *data):
    return spark.createDataFrame([(imo, T0, load, *v) for imo, load, *v in data],
                                 f"imo string, signal_timestamp timestamp, loaddate string, {columns}")


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_pivot_upsert(spark, limit):
    target = wide(spark, "a double, b double", ("1", "L1", 1.0, 2.0), ("2", "L1", 3.0, 4.0), (None, "L1", 0.0, 0.0))
    source = wide(spark, "b double, `c.d` double", ("2", "L2", None, 5.0), ("3", "L2", 6.0, None), (None, "L2", 1.0, 1.0))
    out = upsert.pivot_upsert(target, source, limit=limit)
    assert out.columns == ["imo", "signal_timestamp", "loaddate", "a", "b", "c.d"]
    assert rows(out) == [("1", T0, "L1", 1.0, 2.0, None), ("2", T0, "L2", 3.0, None, 5.0),
                         ("3", T0, "L2", None, 6.0, None), (None, T0, "L1", 0.0, 0.0, None),
                         (None, T0, "L2", None, 1.0, 1.0)]
    kept = upsert.pivot_upsert(target, source, ignore_null=True, limit=limit)
    assert ("2", T0, "L2", 3.0, 4.0, 5.0) in rows(kept)
    assert rows(upsert.pivot_upsert(out.dropna(subset=["imo"]), source.dropna(subset=["imo"]), limit=limit)) == [
        r for r in rows(out) if r[0]]
    with pytest.raises(upsert.DuplicateKeyError):
        upsert.pivot_upsert(target, source.union(source), limit=limit)


@pytest.mark.parametrize("limit", [1 << 20, -1])
@pytest.mark.parametrize("keys", [["a"], ["a", "b"], ["a", "b", "c"]])
def test_merge_upsert(spark, limit, keys):
    target = spark.createDataFrame([(1, 1, 1, "t"), (2, 1, 1, "t"), (None, 1, 1, "t")], "a int, b int, c int, v string")
    source = spark.createDataFrame([(2, 1, 1, "s"), (3, 1, 1, "s")], "a int, b int, c int, v string")
    out = upsert.merge_upsert(target, source, keys, limit=limit)
    expected = [(1, 1, 1, "t"), (2, 1, 1, "s"), (3, 1, 1, "s"), (None, 1, 1, "t")]
    assert rows(out) == expected
    assert rows(upsert.merge_upsert(out, source, keys, limit=limit)) == expected
    assert rows(upsert.merge_upsert(target.limit(0), source, keys, limit=limit)) == expected[1:3]


def test_small_load_leaves_the_target_unshuffled(spark):
    target = wide(spark, "a double", ("1", "L1", 1.0))
    plan = upsert.merge_upsert(target, wide(spark, "a double", ("2", "L1", 1.0)), KEY)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_evolve(spark):
    out = upsert.evolve(wide(spark, "a double", ("1", "L1", 1.0)), wide(spark, "z double, b double", ("1", "L1", 1.0, 2.0)))
    assert out.columns == ["imo", "signal_timestamp", "loaddate", "a", "b", "z"]
    assert dict(out.dtypes)["z"] == "double" and rows(out)[0][4:] == (None, None)


def test_pivot_after_latest_wins_keeps_all_cells(spark):
    late = long(spark, ("1", "b.x", 0, 9.0, "L3"))
    out = pivot.pivot_latest(dedup.latest_wins(dedup.combine([sample(spark), late])))
    assert ("1", T0, "L3", 2.0, 9.0) in rows(out)
