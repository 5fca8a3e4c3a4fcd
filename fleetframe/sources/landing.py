"""The landing zone: raw JSON payloads as the source delivered them.

Two layouts are read. *Files*: `{root}/{yyyy}/{MM}/{dd}/{HH}/{mm}/{Entity}[_{imo}].json`, one payload
per file. *Bundles*: JSON lines `{imo, loaddate, raw}` below `entity=/run_date=/run=`, many payloads per
file, which is what this package writes, since a file per ship and run does not scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetframe.functions import run_time
from fleetframe.session import materialize
from fleetframe.sources import landing_source

# Path below the landing root (fixed format): run directory, entity and optional ship id.
PATH_PATTERN = r"/(\d{4}/\d{2}/\d{2}/\d{2}/\d{2})/([A-Za-z]+)(?:_([^/]+))?\.(?:json|parquet)$"

BUNDLE_SCHEMA = "imo string, loaddate string, raw string, entity string, run_date date, run string"


def path_parts(path: Column) -> list[Column]:
    """Entity, ship id (null for fleet-wide payloads) and load stamp, taken from a file path."""
    return [
        F.regexp_extract(path, PATH_PATTERN, 2).alias("entity"),
        F.nullif(F.regexp_extract(path, PATH_PATTERN, 3), F.lit("")).alias("imo"),
        F.regexp_extract(path, PATH_PATTERN, 1).alias("loaddate"),
    ]


def read_landing(spark: SparkSession, path: str, entity: str, run: str | None = None) -> DataFrame:
    """Payloads of one entity in the file layout: (entity, imo, loaddate, raw).

    `run` (a load stamp) restricts the read to that run's directory.
    """
    folder = f"{path.rstrip('/')}/{run}" if run else path
    rows = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"{entity}*.json")
    parsed = rows.select(*path_parts(F.col("_metadata.file_path")), F.col("value").alias("raw"))
    return parsed.filter(F.col("entity") == entity)


def write_files(df: DataFrame, path: str) -> None:
    """Store payloads (entity, imo, loaddate, raw) in the file layout, as the source delivers them."""
    landing_source.register(df.sparkSession)
    df.select("entity", "imo", "loaddate", "raw").write.format(landing_source.NAME).mode("append").save(path)


def read_runs(spark: SparkSession, path: str, entity: str, after: str = "", upto: str = "9") -> DataFrame:
    """Payloads of one entity in the file layout, of the runs behind `after` up to `upto`; other runs are not listed."""
    landing_source.register(spark)
    reader = spark.read.format(landing_source.NAME).option("entity", entity)
    return reader.option("after", after).option("upto", upto).load(path)


def write_landing(df: DataFrame, path: str) -> None:
    """Store payloads (entity, imo, loaddate, raw) as bundles; `raw` is stored unmodified.

    Each entity and load stamp of `df` replaces what was landed for it before, so landing a run again leaves it once.
    A day's runs are folders of their own: a run rewrites no other.
    """
    stamped = df.select("imo", "loaddate", "raw", "entity", F.to_date(run_time("loaddate")).alias("run_date"),
                        F.translate("loaddate", "/", "").alias("run"))
    (stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("entity", "run_date", "run").json(path))


def bundle_dates(spark: SparkSession, path: str) -> DataFrame:
    """(run_date, rows): the bundle files per day, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(path)
    day = F.regexp_extract("path", r"/run_date=([^/]+)/", 1)
    return files.select(day.cast("date").alias("run_date"), "length").groupBy("run_date").agg(F.count(F.lit(1)).alias("rows"))


def read_bundles(spark: SparkSession, path: str, entity: str, run: str | None = None) -> DataFrame:
    """Payloads of one entity in the bundle layout, of one run or of all; both prune directories."""
    rows = spark.read.schema(BUNDLE_SCHEMA).json(path).filter(F.col("entity") == entity)
    if run is not None:
        rows = rows.filter(F.col("run") == run.replace("/", ""))
    return rows.select("entity", "imo", "loaddate", "raw", "run_date")


def list_files(spark: SparkSession, path: str, pattern: str = "Timeseries_*") -> DataFrame:
    """File listing (entity, imo, loaddate, path, length) below a landing or run directory.

    The file contents are not read: only listing columns are selected.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return files.select(*path_parts(F.col("path")), "path", "length")


def ship_files(files: DataFrame, max_days: int | None = None) -> DataFrame:
    """Per ship: number of files, distinct days, months and years, of the newest `max_days` days."""
    days = files.withColumn("run_date", F.to_date(run_time("loaddate")))
    # One row per (ship, day) first: both levels combine on the map side, so a ship with a third of
    # all files costs one row per day in the second step. The newest days are chosen from that list.
    daily = days.groupBy("imo", "run_date").agg(F.count(F.lit(1)).alias("files"))
    if max_days is not None:
        daily = newest_days(materialize(daily), max_days)
    return daily.groupBy("imo").agg(
        F.sum("files").alias("files"),
        F.count("run_date").alias("days"),
        F.countDistinct(F.trunc("run_date", "month")).alias("months"),
        F.countDistinct(F.trunc("run_date", "year")).alias("years"),
    )


def newest_days(df: DataFrame, max_days: int) -> DataFrame:
    """Rows of the newest `max_days` values of `run_date`; the day list is bounded by the calendar."""
    newest = df.select("run_date").distinct().orderBy(F.desc("run_date")).limit(max_days)
    return df.join(F.broadcast(newest), "run_date", "left_semi")
