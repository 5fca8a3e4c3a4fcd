from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from fleetframe.operators import dedup, quality, summary

T0 = datetime(2024, 1, 1)
LONG = "imo string, signal string, friendly_name string, signal_timestamp timestamp, signal_value double, loaddate string"


def long(spark, *rows):
    return spark.createDataFrame([("1", s, n, T0, v, load) for s, n, v, load in rows], LONG)


def values(df):
    return sorted(r.signal_value for r in df.collect())


def test_latest_wins(spark):
    df = long(spark, ("a", "A", 1.0, "2024/01/01/00/00"), ("a", "A", 2.0, "2024/01/02/00/00"),
              ("a", "A", 3.0, "2023/12/31/00/00"), ("b", "B", 9.0, "2024/01/01/00/00"))
    assert values(dedup.latest_wins(df)) == [2.0, 9.0]
    assert values(dedup.latest_wins(dedup.latest_wins(df).repartition(3))) == [2.0, 9.0]
    assert values(dedup.merge_history(df, long(spark, ("a", "A", 5.0, "2024/01/03/00/00")))) == [5.0, 9.0]


def test_null_filter_comes_before_dedup(spark):
    df = long(spark, ("a", "A", 1.0, "2024/01/01/00/00"), ("a", "A", None, "2024/01/02/00/00"))
    assert values(dedup.latest_wins(quality.measurements(df))) == [1.0]


def test_latest_wins_prunes_hot_keys_before_the_shuffle(spark):
    df = spark.range(100000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("imo"), F.lit("a").alias("signal"),
        F.lit(T0).alias("signal_timestamp"), F.col("id").cast("double").alias("signal_value"),
        F.format_string("%06d", "id").alias("loaddate"))
    out = dedup.latest_wins(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1
    assert out.filter("imo = 'hot'").collect()[0].signal_value == 99999.0
    assert out.count() == 1 + 66666


def test_first_seen_order(spark):
    hist = long(spark, ("a", "A", 1.0, "2024/01/01/00/00"))
    today = long(spark, ("a", "A", 2.0, "2024/01/01/00/00"), ("b", "B", 3.0, "2024/01/02/00/00"))
    new = long(spark, ("a", "A", 4.0, "2024/01/03/00/00"), ("b", "B", 5.0, "2024/01/03/00/00"),
               ("c", "C", 6.0, "2024/01/03/00/00"))
    tagged = summary.tag_sources(hist, today, new)
    kept = summary.daily_summary(tagged)
    assert sorted((r.signal, r.signal_value, r.tag) for r in kept.collect()) == [("b", 3.0, "today"), ("c", 6.0, "new")]
    assert values(summary.daily_delta(tagged)) == [6.0]
    assert summary.summary_columns(kept).columns == ["imo", "signal", "friendly_name", "signal_timestamp",
                                                     "signal_value", "loaddate"]


def test_unnamed_signals_share_a_key(spark):
    empty = long(spark)
    new = long(spark, ("a", None, 1.0, "2024/01/03/00/00"), ("b", None, 2.0, "2024/01/03/00/00"))
    tagged = summary.tag_sources(empty, empty, new)
    assert values(summary.daily_summary(tagged)) == [1.0]
    assert values(summary.daily_summary(tagged, key=summary.SAFE_KEY)) == [1.0, 2.0]


def test_rollover_cutoff_is_strict(spark):
    cutoff = quality.cutoff_day(date(2024, 1, 10), 5)
    assert cutoff == "2024/01/05"
    ref = long(spark, ("a", "A", 1.0, "2024/01/04/23/59"), ("b", "B", 2.0, "2024/01/05/23/59"),
               ("c", "C", 3.0, "2024/01/06/00/00"))
    out = summary.rollover(summary.tag_source(ref, "hist"), long(spark, ("d", "D", 4.0, "2024/01/01/00/00")), cutoff)
    assert sorted((r.signal_value, r.tag) for r in out.collect()) == [(3.0, "hist"), (4.0, "hist")]


def test_combine_fills_missing_columns(spark):
    out = dedup.combine([long(spark, ("a", "A", 1.0, "x")), long(spark, ("b", "B", 2.0, "x")).drop("friendly_name")])
    assert sorted((r.signal, r.friendly_name) for r in out.collect()) == [("a", "A"), ("b", None)]


def test_stage_counts(spark):
    df = long(spark, ("a", "A", 1.0, "x"), ("a", "A", 2.0, "y"), ("b", "B", None, "x"))
    assert tuple(quality.stage_counts(df, dedup.POINT_KEY).first()) == (3, 2, 1)
    assert tuple(quality.stage_counts(df.limit(0), dedup.POINT_KEY).first()) == (0, 0, 0)


def test_history_filter(spark):
    df = long(spark, ("a", "A", 1.0, "2024/01/05/10/00"), ("b", "B", 2.0, "2024/01/06/00/00"))
    assert values(quality.within_history(df, "2024/01/05")) == [2.0]
    assert T0 + timedelta(days=5) == datetime(2024, 1, 6)
