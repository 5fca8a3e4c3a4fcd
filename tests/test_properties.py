"""Properties on random data, against plain Python; batch results against streams."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetframe.operators import dedup, gaps, nested, pivot, quality, summary, upsert
from fleetframe.streaming import replay, streams

T0 = datetime(2024, 1, 1)
SCHEMA = ("imo string, signal string, friendly_name string, signal_timestamp timestamp, signal_value double, "
          "loaddate string, event_id long")


def random_rows(seed, n=4000):
    """A third of the rows are copies of one point, another third belong to one series."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = rng.randrange(3)
        imo = ("hot", "hot", str(rng.randrange(30)))[kind]
        signal = ("rpm", "rpm", rng.choice(["rpm", "temp", "flow", "fuel"]))[kind]
        hour = 0 if kind == 0 else rng.randrange(60)
        value = None if rng.random() < 0.2 else float(rng.randrange(100))
        out.append((imo, signal, rng.choice([None, signal.upper()]), T0 + timedelta(hours=hour), value,
                    f"2024/01/{rng.randrange(10, 28)}/00/00", i))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def pick(rows, key, rank):
    best = {}
    for row in rows:
        if key(row) not in best or rank(row) > rank(best[key(row)]):
            best[key(row)] = row
    return set(best.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_latest_wins(spark, seed):
    rows = random_rows(seed)
    expected = pick(rows, lambda r: (r[0], r[1], r[3]), lambda r: (r[5], r[6]))
    order = ["loaddate", "event_id"]
    for parts in (1, 7):
        latest = dedup.latest_wins(frame(spark, rows).repartition(parts), order=order)
        assert as_set(latest) == expected
    assert as_set(dedup.latest_wins(latest, order=order)) == expected


@pytest.mark.parametrize("seed", [3])
def test_first_seen(spark, seed):
    rows = random_rows(seed)
    third = len(rows) // 3
    sources = [rows[:third], rows[third:2 * third], rows[2 * third:]]
    tagged = [(*r, tag) for tag, part in zip(summary.TAGS, sources) for r in part]
    expected = pick(tagged, lambda r: (r[0], r[3], r[2]), lambda r: (-summary.TAGS.index(r[7]), -r[6]))
    found = summary.first_seen(summary.tag_sources(*[frame(spark, s) for s in sources]), order=["event_id"])
    assert as_set(found) == expected
    none = frame(spark, [])
    both = summary.daily_summary(summary.tag_sources(none, frame(spark, sources[1]), frame(spark, sources[2])),
                                 order=["event_id"])
    first = pick([r for r in tagged if r[7] != "hist"], lambda r: (r[0], r[3], r[2]),
                 lambda r: (-summary.TAGS.index(r[7]), -r[6]))
    assert as_set(both) == first


def test_measurements_and_gaps_make_the_whole(spark):
    df = frame(spark, random_rows(4))
    assert quality.measurements(df).count() + quality.gap_points(df).count() == df.count()


@pytest.mark.parametrize("hours", [1, 5])
def test_gaps_are_apart(spark, hours):
    found = gaps.gap_intervals(quality.gap_points(frame(spark, random_rows(5))), timedelta(hours=hours)).collect()
    series = {}
    for g in found:
        series.setdefault((g.imo, g.signal), []).append((g.gap_start, g.gap_end))
    for spans in series.values():
        spans.sort()
        assert all(a <= b for a, b in spans)
        assert all(after[0] - before[1] > timedelta(hours=hours) for before, after in zip(spans, spans[1:]))


def test_pivot_and_back(spark):
    latest = dedup.latest_wins(quality.measurements(frame(spark, random_rows(6))), order=["loaddate", "event_id"])
    columns = ["imo", "signal", "signal_timestamp", "signal_value", "loaddate"]
    wide = pivot.pivot_long(latest, unique=True)
    assert as_set(pivot.unpivot(wide).select(columns)) == as_set(latest.select(columns))
    assert as_set(pivot.pivot_conditional(latest)) == as_set(wide)


def test_upsert_twice_is_once(spark):
    latest = dedup.latest_wins(quality.measurements(frame(spark, random_rows(7))), order=["loaddate", "event_id"])
    half = F.lit(T0 + timedelta(hours=30))
    stored = pivot.pivot_latest(latest.filter(F.col("signal_timestamp") < half))
    loaded = pivot.pivot_latest(latest.filter(F.col("signal_timestamp") >= F.lit(T0 + timedelta(hours=20))))
    once = upsert.pivot_upsert(stored, loaded)
    assert as_set(upsert.pivot_upsert(once, loaded)) == as_set(once)
    assert as_set(upsert.pivot_upsert(stored, loaded, limit=-1).select(once.columns)) == as_set(once)
    assert as_set(once) == as_set(pivot.pivot_latest(latest).select(once.columns))


def test_dense_grid_is_complete(spark):
    rng = random.Random(8)
    payloads, expected = [], set()
    for imo in range(20):
        times = [f"2024-01-01T{h:02d}:00:00" for h in range(24)]
        body = {s: {t: rng.randrange(9) for t in rng.sample(times, rng.randrange(1, 6))} for s in "abc"}
        seen = {t for points in body.values() for t in points}
        expected |= {(str(imo), s, t, body[s].get(t)) for s in body for t in seen}
        text = ", ".join(f'"{s}": {{{", ".join(f""""{t}": {v}""" for t, v in p.items())}}}' for s, p in body.items())
        payloads.append((str(imo), "2024/01/02/00/00", f'{{"timestamp": "now", {text}}}'))
    df = spark.createDataFrame(payloads, "imo string, loaddate string, raw string")
    long = nested.timeseries_to_long(df, densify=True)
    at = F.date_format("signal_timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    assert as_set(long.select("imo", "signal", at, "signal_value")) == expected
    assert long.count() == len(expected)


def test_streams_agree_with_batch(spark):
    rows = frame(spark, random_rows(9, 1500)).drop("friendly_name")
    measured = quality.measurements(rows)
    order = ["loaddate", "event_id"]
    assert as_set(replay.latest_wins(measured, order)) == as_set(dedup.latest_wins(measured, order=order))
    points = quality.gap_points(rows)
    batch = gaps.gap_intervals(points, timedelta(hours=2))
    assert as_set(replay.gap_sessions(points, timedelta(hours=2)).select(batch.columns)) == as_set(batch)
    assert as_set(replay.late_gaps(points, timedelta(hours=2), timedelta(hours=3)).select(batch.columns)) == as_set(batch)
    first = replay.first_seen(measured, dedup.POINT_KEY, order)
    assert as_set(first) == as_set(dedup.first_wins(measured, dedup.POINT_KEY, order))


def test_stream_batch_can_be_repeated(spark, tmp_path):
    """The same files read by a second stream (a lost checkpoint) leave the table as it was."""
    rows = frame(spark, random_rows(10, 300)).drop("friendly_name")
    rows.write.parquet(str(tmp_path / "in"))
    for attempt in ("a", "b"):
        stream = streams.long_stream(spark, str(tmp_path / "in"), rows.schema)
        streams.start_latest_wins(stream, str(tmp_path / "out"), str(tmp_path / attempt),
                                  ["loaddate", "event_id"]).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).select(rows.columns)
    assert as_set(out) == as_set(dedup.latest_wins(rows, order=["loaddate", "event_id"]))
    assert out.count() == len(as_set(out))


def test_no_row_is_too_late(spark, tmp_path):
    day = lambda n: T0 + timedelta(days=n)
    schema = "imo string, signal string, signal_timestamp timestamp, loaddate string"
    for rows in ([("1", "a", day(20), "y")], [("1", "a", day(18), "y"), ("1", "a", day(20), "z"), ("1", "a", day(1), "z"), ("1", "a", None, "z")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = streams.long_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
        streams.start_first_seen(stream, str(tmp_path / "out"), str(tmp_path / "check"),
                                 dedup.POINT_KEY).awaitTermination()
    seen = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.signal_timestamp, r.loaddate) for r in seen.collect()} == {
        (day(20), "y"), (day(18), "y"), (day(1), "z"), (None, "z")}


def test_streams_leave_the_session_as_it_was(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = quality.gap_points(frame(spark, random_rows(11, 50)).drop("friendly_name")).select("imo", "signal", "gap_start", "loaddate")
    rows.write.parquet(str(tmp_path / "in"))
    stream = streams.long_stream(spark, str(tmp_path / "in"), rows.schema)
    streams.start_gap_sessions(stream, str(tmp_path / "out"), str(tmp_path / "check"), state_partitions=3).awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition") == "false"
