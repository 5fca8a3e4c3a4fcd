"""Nested JSON payloads to tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetframe import schemas
from fleetframe.functions import elements, exact, falsy_json, quoted

# Payload field that is not a signal (fixed value).
TIMESTAMP_FIELD = "timestamp"

# Points of one signal: ISO timestamp to number or null. Read as text: a number type would void all
# points of a signal for one value that is not a number.
POINTS = "map<string,string>"


def _no_points() -> Column:
    return F.create_map().cast(POINTS)



def ships_of(payloads: DataFrame) -> DataFrame:
    """One row per ship object of a fleet payload: (imo, loaddate, ship), `ship` is JSON text."""
    rows = payloads.select("loaddate", F.explode(elements(F.col("raw"))).alias("ship"))
    return rows.select(F.get_json_object("ship", "$.imo").alias("imo"), "loaddate", "ship")


def active_ships(ships: DataFrame) -> DataFrame:
    """Ids of ships that are active. A missing flag counts as active, an explicit null does not."""
    return ships.filter(~falsy_json(F.col("ship"), "active")).select("imo")


def infer_ship_schema(ships: DataFrame) -> T.StructType:
    """Schema of the ship objects, one distributed aggregation over the payloads."""
    return _inferred(ships, "ship")


def infer_signal_definition(payloads: DataFrame) -> T.StructType:
    """All fields that signal definitions have."""
    return _inferred(_signal_bodies(payloads), "body")


def _inferred(df: DataFrame, column: str) -> T.StructType:
    """Schema of JSON objects: objects become structs, numbers with a fraction DOUBLE."""
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(column))).first()[0]
    if found is None or not found.startswith("OBJECT<"):
        return T.StructType([])
    ddl = re.sub(r"\bDECIMAL\(\d+,\s*\d+\)", "DOUBLE", found.replace("OBJECT<", "STRUCT<"))
    return T.StructType.fromDDL(ddl.removeprefix("STRUCT<").removesuffix(">"))


# Kinds of JSON values; a number with a fraction in one ship makes the field DOUBLE for all.
_KINDS = {"OBJECT": r"^OBJECT", "ARRAY": r"^ARRAY", "NUMBER": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)", "BOOLEAN": r"^BOOLEAN", "STRING": r"^STRING"}


def _kind(value: Column) -> Column:
    """The kind of a variant value; null for a JSON null."""
    name = F.schema_of_variant(value)
    return F.coalesce(*[F.when(name.rlike(pattern), F.lit(kind)) for kind, pattern in _KINDS.items()])


def variant_fields(ships: DataFrame, path: str = "$.data") -> DataFrame:
    """(imo, loaddate, field, value, kind): the fields below `path` of each ship object, values as VARIANT."""
    spark = ships.sparkSession
    body = ships.select("imo", "loaddate", F.try_variant_get(F.try_parse_json("ship"), path, "variant").alias("body"))
    spread = body.lateralJoin(spark.tvf.variant_explode(F.col("body").outer()))
    return spread.select("imo", "loaddate", F.col("key").alias("field"), "value").filter(F.col("field").isNotNull()).withColumn("kind", _kind(F.col("value")))


def majority_schema(fields: DataFrame) -> T.StructType:
    """One type per field: that of the kind most ships have; of equal kinds the first by name.

    One pass over all ships; a field and kind is one row, so what reaches the driver is bounded by the names. Fields that
    are null throughout are strings. A name that no path can hold (with a question mark, or both kinds of quotes) has no
    column; its values are odd ones.
    """
    named = fields.filter(F.col("field").rlike("^([^'?]+|[^\"?]+)$"))
    found = named.groupBy("field", "kind").agg(F.count(F.lit(1)).alias("n"), F.schema_of_variant_agg("value").alias("type"))
    most = Window.partitionBy("field").orderBy(F.col("kind").isNull(), F.desc("n"), "kind")
    chosen = found.withColumn("place", F.row_number().over(most)).filter("place = 1").orderBy("field").collect()
    return T.StructType([T.StructField(row.field, _typed(row.type) if row.kind else T.StringType()) for row in chosen])


def ships_by_majority(ships: DataFrame, schema: T.StructType, path: str = "$.data") -> DataFrame:
    """(imo, active, fields of `schema`, loaddate): values of another kind than their field's are null here.

    They are rows of `odd_values`, so one odd ship changes neither types nor the rows of the others.
    """
    parsed = ships.select("imo", "loaddate", F.try_parse_json("ship").alias("_ship"))
    columns = []
    for field in schema:
        value = F.try_variant_get("_ship", _step(path, field.name), "variant")
        made = F.try_variant_get("_ship", _step(path, field.name), field.dataType.simpleString())
        columns.append(F.when(_kind(value) == _kind_of(field.dataType), made).alias(field.name))
    return parsed.select("imo", F.try_variant_get("_ship", "$.active", "boolean").alias("active"), *columns, "loaddate")


def odd_values(fields: DataFrame, schema: T.StructType) -> DataFrame:
    """(imo, field, kind, value, loaddate): values that `ships_by_majority` leaves out, as JSON text."""
    kinds = F.create_map(*[F.lit(x) for field in schema for x in (field.name, _kind_of(field.dataType))]).cast("map<string,string>")
    other = fields.filter(F.col("kind").isNotNull() & ~F.col("kind").eqNullSafe(F.try_element_at(kinds, F.col("field"))))
    return other.select("imo", "field", "kind", F.to_json("value").alias("value"), "loaddate")


def _step(path: str, field: str) -> str:
    return f"{path}['{field}']" if "'" not in field else f'{path}["{field}"]'


def _kind_of(kind: T.DataType) -> str:
    by_type = {T.StructType: "OBJECT", T.ArrayType: "ARRAY", T.BooleanType: "BOOLEAN", T.StringType: "STRING"}
    return by_type.get(type(kind), "NUMBER")


def _typed(found: str) -> T.DataType:
    """The type that a variant schema names: objects become structs, numbers with a fraction DOUBLE."""
    ddl = re.sub(r"\bDECIMAL\(\d+,\s*\d+\)", "DOUBLE", found.replace("OBJECT<", "STRUCT<"))
    return _without_void(T.StructType.fromDDL(f"x {ddl}")["x"].dataType)


def parse_ships(ships: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Ship objects as columns (of `schema`) plus loaddate."""
    return ships.select(F.from_json("ship", schema).alias("s"), "loaddate").select("s.*", "loaddate")


def unnest(df: DataFrame, column: str) -> DataFrame:
    """Lift the fields of a struct column one level, in place."""
    out: list[Column] = []
    for field in df.schema:
        name = quoted(field.name)
        out.append(F.col(f"{name}.*") if field.name == column else F.col(name))
    return df.select(*out)


def list_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]


def child_table(df: DataFrame, key: str, column: str, stamp: str = "loaddate") -> DataFrame:
    """Rows of one list column: structs become columns, scalars one column.

    Empty and null lists keep one row with nulls.
    """
    element = df.schema[column].dataType.elementType
    rows = df.select(key, F.explode_outer(exact(column)).alias(column), stamp)
    if isinstance(element, T.StructType):
        return rows.select(key, f"{quoted(column)}.*", stamp)
    return rows.select(key, quoted(column), stamp)


def child_tables(df: DataFrame, key: str = "imo") -> dict[str, DataFrame]:
    """One table per list column, found from the schema."""
    return {name: child_table(df, key, name) for name in list_columns(df)}


def main_table(df: DataFrame) -> DataFrame:
    """All columns that are not lists; structs below the first level stay structs."""
    return df.drop(*list_columns(df))


def flatten_once(df: DataFrame) -> DataFrame:
    """Unnest the struct columns, exactly one level."""
    structs = [f.name for f in df.schema if isinstance(f.dataType, T.StructType)]
    for name in structs:
        df = unnest(df, name)
    return df


def void_to_string(df: DataFrame) -> DataFrame:
    """Columns that are null throughout (type VOID) become strings, also inside structs and lists."""
    typed = [(f.name, f.dataType, _without_void(f.dataType)) for f in df.schema]
    return df.select(*[exact(n) if old == new else exact(n).cast(new).alias(n) for n, old, new in typed])


def _without_void(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.NullType):
        return T.StringType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _without_void(f.dataType), f.nullable) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_without_void(kind.elementType), kind.containsNull)
    return kind


def stamp(df: DataFrame, loaddate: str) -> DataFrame:
    """The load stamp of a run, for rows that come without one."""
    return df.withColumn("loaddate", F.lit(loaddate))


def signals_to_rows(payloads: DataFrame, definition: T.StructType = schemas.SIGNAL_DEFINITION) -> DataFrame:
    """Signal catalogue payloads: one row per (imo, signal) with the definition fields as columns."""
    rows = _signal_bodies(payloads).select("imo", "signal", F.from_json("body", definition).alias("d"), "loaddate")
    return void_to_string(flatten_once(rows.select("imo", "signal", "d.*", "loaddate")))


def _signal_bodies(payloads: DataFrame) -> DataFrame:
    """(imo, loaddate, signal, body): one JSON text per signal definition."""
    objects = payloads.select("loaddate", F.explode(elements(F.col("raw"))).alias("o"))
    maps = objects.select(
        F.get_json_object("o", "$.imo").alias("imo"),
        "loaddate",
        F.explode_outer(F.from_json(F.get_json_object("o", "$.signals"), "map<string,string>")).alias("signal", "body"),
    )
    return _exploded(maps, "signal")


def catalog_columns(signals: DataFrame) -> DataFrame:
    """The signal name and its definition fields."""
    return signals.select("signal", *schemas.SIGNAL_FIELDS)


def timeseries_to_long(payloads: DataFrame, densify: bool = False, strict: bool = False) -> DataFrame:
    """Time-series payloads (imo, loaddate, raw) to (imo, signal, signal_timestamp, signal_value, loaddate).

    With `densify`, a signal that lacks a timestamp another signal of the same payload has gets a
    null there, that is, a gap. The timestamps travel with the row: nothing is shuffled. A value that
    is not a number is a null, a key that is not a timestamp gives a null timestamp. With `strict`
    such cells are left out: they are neither measurements nor gaps (see `bad_cells`).
    """
    cells = _cells(payloads, densify)
    return _long_columns(cells.filter(~_is_bad()) if strict else cells)


def bad_cells(payloads: DataFrame) -> DataFrame:
    """Cells whose key is no timestamp or whose value is no number, with both as they were delivered."""
    reason = F.when(F.try_to_timestamp("at").isNull(), "timestamp").otherwise("value")
    return _cells(payloads, False).filter(_is_bad()).select("imo", "signal", "at", "value", reason.alias("reason"), "loaddate")


def _is_bad() -> Column:
    return F.try_to_timestamp("at").isNull() | (F.col("value").isNotNull() & F.col("value").try_cast("double").isNull())


def _cells(payloads: DataFrame, densify: bool) -> DataFrame:
    """(imo, loaddate, signal, at, value) as texts."""
    objects = payloads.select("imo", "loaddate", F.explode(elements(F.col("raw"))).alias("o"))
    bodies = F.map_filter(F.from_json("o", "map<string,string>"), lambda name, _: name != TIMESTAMP_FIELD)
    if not densify:
        rows = _exploded(objects.select("imo", "loaddate", F.explode_outer(bodies).alias("signal", "body")), "signal")
        cells = F.explode_outer(F.from_json("body", POINTS)).alias("at", "value")
        return _exploded(rows.select("imo", "loaddate", "signal", cells), "at")
    # A signal without points (null) takes part: all timestamps of the payload are missing there.
    points = F.transform_values(bodies, lambda _, body: F.coalesce(F.from_json(body, POINTS), _no_points()))
    parsed = objects.select("imo", "loaddate", points.alias("signals"))
    times = F.array_distinct(F.flatten(F.transform(F.map_values("signals"), lambda points: F.map_keys(points))))
    # Its own projection, below the explode: once per payload, not once per signal.
    timed = parsed.withColumn("times", times)
    rows = _exploded(
        timed.select("imo", "loaddate", "times", F.explode_outer("signals").alias("signal", "points")), "signal"
    )
    absent = F.transform(
        F.array_except("times", F.map_keys("points")),
        lambda at: F.struct(at.alias("key"), F.lit(None).cast("string").alias("value")),
    )
    grid = rows.select("imo", "loaddate", "signal", F.explode(F.concat(F.map_entries("points"), absent)).alias("c"))
    return grid.select("imo", "loaddate", "signal", F.col("c.key").alias("at"), F.col("c.value").alias("value"))


def _exploded(df: DataFrame, key: str) -> DataFrame:
    """Drop the empty rows of an outer explode. A plain explode would get an inferred filter that
    parses the JSON a second time."""
    return df.filter(F.col(key).isNotNull())


def _long_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "imo", "signal", F.try_to_timestamp("at").alias("signal_timestamp"),
        F.col("value").try_cast("double").alias("signal_value"), "loaddate",
    )
