import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetframe.operators import gaps

BASE = datetime(2024, 1, 1)
SCHEMA = "imo string, signal string, gap_start timestamp, loaddate string"


def frame(spark, points):
    return spark.createDataFrame(points, SCHEMA)


def result(df):
    return sorted((r.imo, r.signal, r.gap_start, r.gap_end, r.loaddate) for r in df.collect())


def brute_force(points, threshold):
    series = {}
    for imo, signal, at, load in points:
        known = series.setdefault((imo, signal), {})
        known[at] = max(known.get(at, load), load)
    out = []
    for (imo, signal), known in series.items():
        start = last = None
        for at in sorted(known):
            if last is not None and at - last > threshold:
                out.append((imo, signal, start, last, known[last]))
                start = None
            start = at if start is None else start
            last = at
        out.append((imo, signal, start, last, known[last]))
    return sorted(out)


@pytest.mark.parametrize("form", [gaps.gap_intervals, gaps.gap_sessions])
def test_threshold(spark, form):
    at = [timedelta(0), timedelta(minutes=15), timedelta(minutes=30, seconds=1), timedelta(hours=2)]
    points = [("1", "a", BASE + d, "x") for d in reversed(at)] + [("2", "a", BASE, "y")]
    assert result(form(frame(spark, points), gaps.GAP_THRESHOLD)) == [
        ("1", "a", BASE, BASE + at[1], "x"), ("1", "a", BASE + at[2], BASE + at[2], "x"),
        ("1", "a", BASE + at[3], BASE + at[3], "x"), ("2", "a", BASE, BASE, "y")]
    assert len(result(form(frame(spark, points), gaps.FINE_GAP_THRESHOLD))) == 5


@pytest.mark.parametrize("form", [gaps.gap_intervals, gaps.gap_sessions])
@pytest.mark.parametrize("threshold", [timedelta(minutes=7), timedelta(microseconds=1500), timedelta(days=2)])
def test_against_brute_force(spark, form, threshold):
    rng = random.Random(7)
    step = threshold / 3
    points = []
    for _ in range(3000):
        # A third of the rows in one series; times on both sides of 1970; repeated points.
        imo = "hot" if rng.random() < 0.34 else str(rng.randrange(20))
        origin = datetime(1970, 1, 1) if imo == "hot" else BASE
        at = origin + rng.randrange(-900, 900) * step * rng.choice([1, 1, 7])
        points.append((imo, rng.choice("ab"), at, f"2024/01/{rng.randrange(10, 20)}/00/00"))
    assert result(form(frame(spark, points).repartition(5), threshold)) == brute_force(points, threshold)


def test_slots_combine_before_the_shuffle(spark):
    """A hot series sends one row per slot and map task; the ordered step sees slots only."""
    points = frame(spark, [("hot", "a", BASE + timedelta(seconds=i), "x") for i in range(50000)])
    slots = gaps._slots(points, gaps.GAP_THRESHOLD)
    assert slots.count() == 56
    plan = slots._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange")


def test_no_points(spark):
    assert result(gaps.gap_intervals(frame(spark, []))) == []


def test_append_is_idempotent(spark):
    found = gaps.gap_intervals(frame(spark, [("1", "a", BASE, "x"), ("1", "a", BASE + timedelta(hours=1), "x")]))
    later = gaps.gap_intervals(frame(spark, [("1", "a", BASE, "y"), ("2", "a", BASE, "y")]))
    once = gaps.append_gaps(found, later)
    assert len(result(once)) == 3
    assert result(gaps.append_gaps(once, later)) == result(once)
    assert result(once.filter(F.col("imo") == "1"))[0][4] == "x"


def test_a_stored_gap_grows(spark):
    minute = lambda n: BASE + timedelta(minutes=n)
    table = spark.createDataFrame([], gaps.gap_intervals(frame(spark, [])).schema)
    for load, last in (("a", 0), ("b", 5), ("c", 10), ("d", 5)):
        points = frame(spark, [("1", "s", minute(n), load) for n in range(0, last + 1, 5)])
        table = gaps.append_gaps(table, gaps.gap_intervals(points))
    assert [(r.gap_start, r.gap_end, r.loaddate) for r in table.collect()] == [(minute(0), minute(10), "c")]


@pytest.mark.parametrize("seed", [1, 2])
def test_points_merged_into_intervals(spark, seed):
    rng = random.Random(seed)
    points = [(rng.choice("12"), rng.choice("ab"), BASE + timedelta(minutes=rng.randrange(0, 3000, 5)), "x") for _ in range(300)]
    points = list(dict.fromkeys(points))
    early, late = points[:200], points[200:]
    merged = gaps.merge_points(gaps.gap_intervals(frame(spark, early)), frame(spark, late))
    assert result(merged) == result(gaps.gap_intervals(frame(spark, points)))


def intervals(points, threshold=gaps.GAP_THRESHOLD):
    return brute_force(points, threshold)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_merge_into_the_gaps_of_all_points(spark, seed):
    """Runs in any order, overlapping, touching, nested; a point that two runs report keeps the first stamp."""
    rng = random.Random(seed)
    runs = [[(rng.choice(["1", "2", None]), "s", BASE + timedelta(minutes=rng.randrange(0, 4000, 5)), f"run{n}") for _ in range(120)] for n in range(4)]
    table = spark.createDataFrame([], gaps.gap_intervals(frame(spark, [])).schema)
    first = {}
    for points in runs:
        for imo, signal, at, load in points:
            first.setdefault((imo, signal, at), load)
        found = gaps.gap_intervals(frame(spark, points)).checkpoint()
        table = gaps.append_gaps(table, found).checkpoint()
        gone, new = gaps.changed_gaps(table, found)
        assert gone.isEmpty() and new.isEmpty()
    every = [(*key, load) for key, load in first.items()]
    key = lambda r: (str(r[0]), *map(str, r[1:4]))
    found = sorted(((r.imo, r.signal, r.gap_start, r.gap_end) for r in table.collect()), key=key)
    wanted = {}
    for imo in ("1", "2", None):
        for row in intervals([(str(i), s, at, load) for i, s, at, load in every if i == imo]):
            wanted[(imo, *row[1:4])] = row[4]
    assert found == sorted(wanted, key=key)
    assert {(r.imo, r.signal, r.gap_start, r.gap_end): r.loaddate for r in table.collect()} == wanted


def test_only_touched_gaps_change(spark):
    minute = lambda n: BASE + timedelta(minutes=n)
    schema = gaps.gap_intervals(frame(spark, [])).schema
    table = spark.createDataFrame([("1", "s", minute(10), minute(20), "a"), ("1", "s", minute(60), minute(90), "a"),
                                   ("1", "s", minute(-2000), minute(-5), "a"), ("2", "s", minute(10), minute(20), "a")], schema)
    found = spark.createDataFrame([("1", "s", minute(0), minute(20), "b"), ("1", "s", minute(70), minute(80), "b")], schema)
    gone, new = gaps.changed_gaps(table, found)
    assert {(r.gap_start, r.gap_end) for r in gone.collect()} == {(minute(10), minute(20)), (minute(-2000), minute(-5))}
    assert result(new) == [("1", "s", minute(-2000), minute(20), "a")]
    plan = gaps.touching(table, found)._jdf.queryExecution().optimizedPlan().toString()
    assert "gap_end" in plan.split("Filter")[1]


def test_threshold_must_be_positive(spark):
    with pytest.raises(ValueError):
        gaps.gap_intervals(frame(spark, []), timedelta(0))


class BucketHandle:
    """A state store in memory that counts its calls."""

    def __init__(self):
        self.rows, self.timers, self.puts = [], [], 0

    def getListState(self, name, schema):  # noqa: N802
        return self

    def exists(self):
        return bool(self.rows)

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows, self.puts = rows, self.puts + 1

    def clear(self):
        self.rows = []

    def listTimers(self):  # noqa: N802
        return iter(self.timers)

    def deleteTimer(self, timer):  # noqa: N802
        self.timers.remove(timer)

    def registerTimer(self, timer):  # noqa: N802
        self.timers.append(timer)


def test_gap_state_of_a_bucket_of_series():
    """Series of a bucket share its state: one store call for all, and no gap over two series."""
    import pandas as pd

    from fleetframe.streaming.keyed_gaps import GapState

    handle, state = BucketHandle(), GapState(10, 1000)
    state.init(handle)

    def batch(*rows):
        part = pd.DataFrame(rows, columns=["imo", "signal", "first", "last", "loaddate"])
        (made,) = state.handleInputRows((7,), iter([part]), None)
        return {(row.imo, row.signal, row.gap_start.microsecond, row.change) for row in made.itertuples()}

    changes = batch(("1", "a", 100, 100, "x"), ("2", "a", 105, 105, None), (None, "a", 100, 104, "x"), ("1", None, 100, 100, "x"))
    assert changes == {("1", "a", 100, "put"), ("2", "a", 105, "put"), (None, "a", 100, "put"), ("1", None, 100, "put")}
    assert handle.puts == 1 and len(handle.rows) == 4 and len(handle.timers) == 1
    changes = batch(("1", "a", 95, 95, "w"))
    assert changes == {("1", "a", 95, "put"), ("1", "a", 100, "remove")}
    assert handle.puts == 2 and sorted(map(str, handle.rows)) == sorted(map(str, [
        ("1", "a", 95, 100, "x"), ("2", "a", 105, 105, None), (None, "a", 100, 104, "x"), ("1", None, 100, 100, "x")]))
    assert batch(("1", "a", 95, 95, "w")) == set() and handle.puts == 2
