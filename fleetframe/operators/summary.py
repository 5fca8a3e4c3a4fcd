"""Daily summary: first-seen rows of a day against a rolling reference window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetframe import schemas
from fleetframe.operators.dedup import combine, first_wins
from fleetframe.operators.quality import by_tag, within_history

# Provenance tags in order of precedence (fixed values).
TAGS = ["hist", "today", "new"]

# A key of the summary. Unnamed signals (null friendly_name) of one ship and time share a key; use
# SAFE_KEY to tell them apart.
SUMMARY_KEY = ["signal_timestamp", "imo", "friendly_name"]
SAFE_KEY = ["signal_timestamp", "imo", "signal"]


def tag_source(df: DataFrame, tag: str) -> DataFrame:
    return df.withColumn("tag", F.lit(tag))


def precedence() -> Column:
    return F.array_position(F.array(*[F.lit(t) for t in TAGS]), F.col("tag"))


def tag_sources(hist: DataFrame, today: DataFrame, new: DataFrame) -> DataFrame:
    return combine([tag_source(frame, tag) for frame, tag in zip((hist, today, new), TAGS)])


def first_seen(tagged: DataFrame, key: list[str] = SUMMARY_KEY, order: list[str] | None = None) -> DataFrame:
    """First row per key in the order hist, today, new; `order` decides within one source."""
    ranking: list[Column | str] = [precedence().asc(), *(order or ["loaddate", "signal", "signal_value"])]
    return first_wins(tagged, key, ranking)


def daily_summary(tagged: DataFrame, key: list[str] = SUMMARY_KEY, order: list[str] | None = None) -> DataFrame:
    """Rows of today that history does not know. A changed value of a known key is ignored."""
    return by_tag(first_seen(tagged, key, order), "new", "today")


def daily_delta(tagged: DataFrame, key: list[str] = SUMMARY_KEY, order: list[str] | None = None) -> DataFrame:
    """Only the rows that this run added."""
    return by_tag(first_seen(tagged, key, order), "new")


def summary_columns(df: DataFrame) -> DataFrame:
    return df.select(*schemas.LONG_COLUMNS)


def rollover(reference: DataFrame, yesterday: DataFrame, cutoff: str) -> DataFrame:
    """Reference window on the first run of a day: still-valid rows plus yesterday's summary."""
    return combine([tag_source(within_history(reference, cutoff), "hist"), tag_source(yesterday, "hist")])
