"""Schemas of the stored tables. Ids and load stamps are strings, points in time are UTC timestamps."""

from pyspark.sql import types as T

LONG = T.StructType([
    T.StructField("imo", T.StringType()),
    T.StructField("signal", T.StringType()),
    T.StructField("friendly_name", T.StringType()),
    T.StructField("signal_timestamp", T.TimestampType()),
    T.StructField("signal_value", T.DoubleType()),
    T.StructField("loaddate", T.StringType()),
])

LONG_COLUMNS = LONG.fieldNames()

TAGGED = T.StructType([*LONG.fields, T.StructField("tag", T.StringType())])

GAPS = T.StructType([
    T.StructField("imo", T.StringType()),
    T.StructField("signal", T.StringType()),
    T.StructField("gap_start", T.TimestampType()),
    T.StructField("gap_end", T.TimestampType()),
    T.StructField("loaddate", T.StringType()),
])

MAPPING = T.StructType([
    T.StructField("imo", T.StringType()),
    T.StructField("signal", T.StringType()),
    T.StructField("friendly_name", T.StringType()),
])

# Definition fields of a signal (fixed values).
SIGNAL_FIELDS = ["friendly_name", "unit", "object_code", "name_code", "group_name", "sub_group"]

SIGNAL_DEFINITION = T.StructType([T.StructField(name, T.StringType()) for name in SIGNAL_FIELDS])

SIGNALS = T.StructType([
    T.StructField("imo", T.StringType()),
    T.StructField("signal", T.StringType()),
    *SIGNAL_DEFINITION.fields,
    T.StructField("loaddate", T.StringType()),
])

SHIPS = T.StructType([T.StructField("imo", T.StringType())])

# Key of the wide table; one DOUBLE column per signal is added as signals appear.
PIVOT_KEY = ["imo", "signal_timestamp"]

PIVOT = T.StructType([
    T.StructField("imo", T.StringType()),
    T.StructField("signal_timestamp", T.TimestampType()),
    T.StructField("loaddate", T.StringType()),
])

LANDING = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("imo", T.StringType()),
    T.StructField("loaddate", T.StringType()),
    T.StructField("raw", T.StringType()),
])

RUN_AUDIT = T.StructType([
    T.StructField("loaddate", T.StringType()),
    T.StructField("ships_total", T.LongType()),
    T.StructField("ships_processed", T.LongType()),
    T.StructField("ships_failed", T.LongType()),
    T.StructField("calls_total", T.LongType()),
    T.StructField("calls_success", T.LongType()),
    T.StructField("calls_failed", T.LongType()),
    T.StructField("success", T.BooleanType()),
])
