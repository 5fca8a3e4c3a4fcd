import json

import pytest
from pyspark.sql import functions as F

from fleetframe.operators import nested, quality

RUN = "2024/01/31/00/05"


def payload(spark, *raws, imo="1"):
    return spark.createDataFrame([(imo, RUN, raw) for raw in raws], "imo string, loaddate string, raw string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("flag,active", [
    ("", True), ('"active": true,', True), ('"active": null,', False), ('"active": false,', False),
    ('"active": 0,', False), ('"active": "",', False), ('"active": "no",', True), ('"active": 1,', True),
    ('"active": [],', False),
])
def test_active_flag(spark, flag, active):
    ships = nested.ships_of(payload(spark, f'[{{{flag} "imo": "7"}}]'))
    assert rows(nested.active_ships(ships)) == ([("7",)] if active else [])


FLEET = json.dumps([
    {"imo": "1", "data": {"name": "A", "home": {"port": "X", "geo": {"lat": 1.5}},
                          "main_engines": [{"no": 1, "kw": 10.5}, {"no": 2, "kw": 11.0}], "tags": ["a", "b"]}},
    {"imo": "2", "data": {"name": "B", "home": None, "main_engines": [], "tags": None}},
])


def fleet(spark):
    ships = nested.ships_of(payload(spark, FLEET))
    return nested.unnest(nested.parse_ships(ships, nested.infer_ship_schema(ships)), "data")


def test_fleet_tables(spark):
    tables = nested.child_tables(fleet(spark))
    assert sorted(tables) == ["main_engines", "tags"]
    engines = tables["main_engines"].select("imo", "no", "kw", "loaddate")
    assert rows(engines) == [("1", 1, 10.5, RUN), ("1", 2, 11.0, RUN), ("2", None, None, RUN)]
    assert rows(tables["tags"]) == [("1", "a", RUN), ("1", "b", RUN), ("2", None, RUN)]
    main = nested.main_table(fleet(spark))
    assert sorted(main.columns) == ["home", "imo", "loaddate", "name"]
    flat = nested.flatten_once(main)
    assert sorted(flat.columns) == ["geo", "imo", "loaddate", "name", "port"]
    assert flat.schema["geo"].dataType.typeName() == "struct"


def test_inferred_names_and_types(spark):
    raw = json.dumps({"imo": "1", "data": {"a b": 1, "x-y": 1.25, "`q`": [1, 2.5], "none": None, "Ü": "u"}})
    ships = nested.ships_of(payload(spark, raw))
    data = nested.parse_ships(ships, nested.infer_ship_schema(ships)).select("data.*")
    assert dict(data.dtypes) == {"a b": "bigint", "x-y": "double", "`q`": "array<double>", "none": "void", "Ü": "string"}
    assert rows(data)[0] == tuple(data.select([F.col("`" + c.replace("`", "``") + "`") for c in data.columns]).first())


def test_void_to_string(spark):
    df = nested.void_to_string(spark.sql("SELECT 1 AS a, null AS b"))
    assert df.dtypes == [("a", "int"), ("b", "string")]
    deep = nested.void_to_string(spark.sql("SELECT named_struct('x', null, 'y', array(null)) AS s, 1 AS `a.b`"))
    assert deep.dtypes == [("s", "struct<x:string,y:array<string>>"), ("a.b", "int")]


def test_signals(spark):
    raw = json.dumps({"imo": "1", "signals": {
        "rpm": {"friendly_name": "Speed", "unit": "1/min", "sub_group": None},
        "temp": {"friendly_name": None, "unit": "C", "other": 1}}})
    found = nested.signals_to_rows(payload(spark, raw)).select("imo", "signal", "friendly_name", "unit", "group_name")
    assert rows(found) == [("1", "rpm", "Speed", "1/min", None), ("1", "temp", None, "C", None)]
    assert nested.catalog_columns(nested.signals_to_rows(payload(spark, raw))).columns == [
        "signal", "friendly_name", "unit", "object_code", "name_code", "group_name", "sub_group"]


def test_signal_definition_is_found(spark):
    raw = json.dumps({"imo": "1", "signals": {"rpm": {"friendly_name": "S", "range": {"low": 0, "high": 9.5}},
                                              "temp": {"friendly_name": None, "code": 7, "note": None}}})
    definition = nested.infer_signal_definition(payload(spark, raw))
    found = nested.signals_to_rows(payload(spark, raw), definition)
    assert sorted(found.columns) == ["code", "friendly_name", "high", "imo", "loaddate", "low", "note", "signal"]
    assert rows(found.select("signal", "code", "high", "note")) == [("rpm", None, 9.5, None), ("temp", 7, None, None)]
    assert dict(found.dtypes)["note"] == "string"


SERIES = json.dumps({"timestamp": "2024-01-31T00:05:00Z",
                     "rpm": {"2024-01-31T00:00:00Z": 1, "2024-01-31T00:05:00Z": None},
                     "temp": {"2024-01-31T00:00:00Z": 20.5, "2024-01-31T00:10:00Z": 21},
                     "dead": None})


def points(df):
    return rows(df.select("signal", F.date_format("signal_timestamp", "HH:mm"), "signal_value"))


@pytest.mark.parametrize("raw", [SERIES, f"[{SERIES}]"])
def test_timeseries_sparse(spark, raw):
    assert points(nested.timeseries_to_long(payload(spark, raw))) == [
        ("rpm", "00:00", 1.0), ("rpm", "00:05", None), ("temp", "00:00", 20.5), ("temp", "00:10", 21.0)]


def test_timeseries_dense(spark):
    long = nested.timeseries_to_long(payload(spark, SERIES), densify=True)
    assert points(long) == [
        ("dead", "00:00", None), ("dead", "00:05", None), ("dead", "00:10", None),
        ("rpm", "00:00", 1.0), ("rpm", "00:05", None), ("rpm", "00:10", None),
        ("temp", "00:00", 20.5), ("temp", "00:05", None), ("temp", "00:10", 21.0)]
    assert quality.measurements(long).count() + quality.gap_points(long).count() == long.count() == 3 * 3


@pytest.mark.parametrize("densify", [False, True])
def test_one_bad_value_leaves_the_others(spark, densify):
    raw = json.dumps({"rpm": {"2024-01-31T00:00:00Z": 1.5, "2024-01-31T00:05:00Z": "n/a", "2024-01-31T00:10:00Z": True,
                              "sometime": 4, "2024-01-31T00:15:00Z": "2"}, "temp": 7})
    long = nested.timeseries_to_long(payload(spark, raw), densify).filter("signal = 'rpm'")
    assert points(long) == [("rpm", "00:00", 1.5), ("rpm", "00:05", None), ("rpm", "00:10", None),
                            ("rpm", "00:15", 2.0), ("rpm", None, 4.0)]


def test_quarantine(spark):
    raws = {'{"detail": "no"}': "error", '[{"detail": "no"}]': "error", "[]": "empty", "{}": "empty", "[ ]": "empty",
            "": "empty", "null": "empty", '{"a": {': "corrupt", "oops": "corrupt", "[1, 2": "corrupt",
            '{"detail": "x", "rpm": {}}': "ok", SERIES: "ok"}
    marked = quality.classify_payloads(payload(spark, *raws))
    assert {r.raw: r.status for r in marked.collect()} == raws
    assert {r.detail for r in marked.filter("status = 'error'").collect()} == {"no"}
    good, bad = quality.split_errors(payload(spark, *raws))
    assert good.count() == 2 and bad.count() == len(raws) - 2
    assert points(nested.timeseries_to_long(good)) == points(nested.timeseries_to_long(payload(spark, SERIES)))
    null = spark.createDataFrame([("1", RUN, None)], "imo string, loaddate string, raw string")
    assert quality.classify_payloads(null).first().status == "empty"


def test_run_audit(spark):
    data = [("1", RUN, SERIES), ("2", RUN, "[]"), ("3", RUN, '{"detail": "no"}'), ("4", "2024/02/01/00/00", SERIES)]
    marked = quality.classify_payloads(spark.createDataFrame(data, "imo string, loaddate string, raw string"))
    assert rows(quality.run_audit(marked)) == [(RUN, 3, 1, 2, 3, 2, 1, False),
                                               ("2024/02/01/00/00", 1, 1, 0, 1, 1, 0, True)]
    assert {(r.imo, r.message) for r in quality.run_errors(marked).collect()} == {("2", "payload is empty"), ("3", "no")}


def test_observed_counts(spark):
    df, counted = quality.observed(spark.range(100).filter("id < 40"), "kept")
    df.write.format("noop").mode("overwrite").save()
    assert counted.get == {"rows": 40}


MIXED = json.dumps([
    {"imo": "1", "active": True, "data": {"kw": 10, "it's": "a", "port": {"code": "X"}, "tags": [1], "none": None}},
    {"imo": "2", "data": {"kw": 10.5, "it's": "b", "port": {"code": "Y", "lat": 1}, "tags": [2, 3]}},
    {"imo": "3", "active": None, "data": {"kw": "n/a", "it's": 7, "port": "Z", "tags": {"a": 1}}},
    {"imo": "4", "data": {"kw": None, "port": [], "extra": False, "a?": 1}},
    {"imo": "5", "data": None},
    {"imo": "6"},
])


def test_types_by_majority(spark):
    """One odd ship changes neither the types nor the other rows; its values are kept as text."""
    ships = nested.ships_of(payload(spark, MIXED))
    fields = nested.variant_fields(ships)
    schema = nested.majority_schema(fields)
    assert {f.name: f.dataType.simpleString() for f in schema} == {
        "kw": "double", "it's": "string", "port": "struct<code:string,lat:bigint>", "tags": "array<bigint>", "none": "string", "extra": "boolean"}
    found = {r.imo: r for r in nested.ships_by_majority(ships, schema).collect()}
    assert [found[i].kw for i in "123456"] == [10.0, 10.5, None, None, None, None]
    assert [found[i]["it's"] for i in "123"] == ["a", "b", None]
    assert found["2"].port.code == "Y" and found["1"].port.lat is None and found["3"].port is None and found["4"].port is None
    assert (found["1"].active, found["3"].active, found["4"].extra) == (True, None, False)
    assert rows(nested.odd_values(fields, schema).drop("loaddate")) == sorted([
        ("3", "kw", "STRING", '"n/a"'), ("3", "it's", "NUMBER", "7"), ("3", "port", "STRING", '"Z"'), ("3", "tags", "OBJECT", '{"a":1}'),
        ("4", "port", "ARRAY", "[]"), ("4", "a?", "NUMBER", "1")], key=str)
    assert nested.majority_schema(nested.variant_fields(ships.limit(0))).fields == []


def test_ties_of_kinds_are_ordered(spark):
    raws = json.dumps([{"imo": "1", "data": {"a": 1}}, {"imo": "2", "data": {"a": "x"}}])
    fields = nested.variant_fields(nested.ships_of(payload(spark, raws)))
    assert nested.majority_schema(fields)["a"].dataType.simpleString() == "bigint"
