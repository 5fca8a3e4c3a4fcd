from pyspark.sql import functions as F

from fleetframe import scale
from fleetframe.operators import enrich

MAPPING = "imo string, signal string, friendly_name string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def long(spark):
    hot = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "1").otherwise((F.col("id") % 50).cast("string")).alias("imo"),
        F.when(F.col("id") % 2 == 0, "rpm").otherwise("temp").alias("signal"),
        F.col("id").alias("n"))
    return hot


def mapping(spark):
    data = [("1", "rpm", "Speed"), ("1", "rpm", "Speed"), ("1", "temp", None), ("2", "rpm", "Shaft speed"),
            ("2", "temp", "Temperature")]
    return spark.createDataFrame(data, MAPPING)


def test_global_fans_out_and_salted_form_agrees(spark):
    small = enrich.enrich_global(long(spark), mapping(spark))
    salted = enrich.enrich_global(long(spark), mapping(spark), limit=-1, salts=5)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in str(salted._jdf.queryExecution().optimizedPlan().toString())
    assert small.count() == 9000  # "rpm" has two names
    assert rows(small) == rows(salted.select(*small.columns))


def test_salt_spreads_equal_copies(spark):
    copies = spark.range(0, 8000, 1, 16).select(F.lit("1").alias("imo"), F.lit("rpm").alias("signal"))
    for how in ("left", "left_semi"):
        joined = scale._salted_join(copies, mapping(spark).distinct().filter("friendly_name = 'Speed'"),
                                    ["imo", "signal"], how, 8)
        assert joined.count() == 8000
    salt = F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(8))
    assert copies.select(salt.alias("s")).distinct().count() > 4


def test_salt_spreads_a_hot_key(spark):
    left = long(spark).withColumn("_salt", F.pmod(F.xxhash64("n"), F.lit(5)))
    sizes = [r["count"] for r in left.filter("imo = '1' AND signal = 'rpm'").groupBy("_salt").count().collect()]
    assert len(sizes) == 5 and max(sizes) < 2 * min(sizes)


def test_per_ship(spark):
    out = enrich.enrich_per_ship(long(spark), mapping(spark))
    assert out.columns == ["imo", "signal", "friendly_name", "n"]
    assert out.count() == 6000
    names = {(r.imo, r.signal): r.friendly_name for r in out.filter("imo IN ('1', '2', '4')").distinct().collect()}
    assert names[("1", "rpm")] == "Speed" and names[("1", "temp")] is None and names[("2", "rpm")] == "Shaft speed"
    assert rows(out) == rows(enrich.enrich_per_ship(long(spark), mapping(spark), limit=-1, salts=3))


def test_reenrich_replaces_names(spark):
    old = long(spark).withColumn("friendly_name", F.lit("old"))
    assert rows(enrich.reenrich(old, mapping(spark))) == rows(enrich.enrich_per_ship(long(spark), mapping(spark)))


def test_semi_and_anti_joins(spark):
    keys = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "imo string")
    for limit in (scale.BROADCAST_BYTES, -1):
        kept = scale.semi_join(long(spark), keys, ["imo"], limit)
        rest = scale.anti_join(long(spark), keys, ["imo"], limit)
        assert kept.count() + rest.count() == 6000
        assert {r.imo for r in kept.select("imo").distinct().collect()} == {"1", "2"}
    nulls = spark.createDataFrame([(None, 1)], "imo string, n int")
    assert scale.anti_join(nulls, keys, ["imo"]).count() == 1


def test_mapping_only_grows(spark):
    new = spark.createDataFrame([("1", "rpm", "Speed"), ("1", "rpm", "Revolutions"), ("3", "rpm", None)], MAPPING)
    out = enrich.update_mapping(mapping(spark), new)
    assert out.count() == 6
    assert rows(enrich.update_mapping(out, new)) == rows(out)


def test_first_definition_wins(spark):
    out = enrich.catalog_first_wins(mapping(spark), ["imo", "friendly_name"])
    assert rows(out.select("signal", "imo")) == [("rpm", "1"), ("temp", "1")]


def test_measured_bytes(spark):
    assert scale.measured_bytes(spark.createDataFrame([("abcd", 1), ("ab", None)], "a string, b int")) == 2 * 32 + 6
    assert scale.measured_bytes(spark.createDataFrame([([1],)], "a array<int>")) is None
    assert scale.measured_bytes(spark.createDataFrame([], "a string")) == 0


def test_only_hot_keys_are_repeated(spark):
    hot = spark.range(0, 60000, 1, 8).select(F.when(F.col("id") < 20000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    names = hot.select("k").distinct().withColumn("name", F.upper("k"))
    found = scale._hot_keys(hot, ["k"], 8)
    assert rows(found) == [("hot", True)]
    joined = scale._salted_join(hot, names, ["k"], "left", 8)
    assert joined.count() == 60000 and joined.filter("name = 'HOT'").count() == 20000
    nulls = hot.withColumn("k", F.lit(None).cast("string"))
    assert scale._salted_join(nulls, names, ["k"], "left", 8).count() == 60000
