"""History over batches: equal to one pass over all events, with states that stay small."""

import datetime
import random

from pyspark.sql import functions as F

from cellwatch.operators.history import fire_history, precipitation_7d, recent_maxima
from cellwatch.operators.history_state import RING_DAYS, history_step, maxima_step

SCHEMA = (
    "h3_cell string, seq bigint, event_time bigint, event_date date, source_type string, precipitation double, "
    "smoke double, co2 double, sensor_temperature double, newest string, days int"
)
KINDS = ("fire", "FIRE", "meteo", "sensor", None)


def events(seed, n=400):
    """Sparse days over three years, dense stretches, days across a turn of the year."""
    rng = random.Random(seed)
    day, out = 19_300, []
    for i in range(n):
        day += rng.choice((0, 0, 0, 1, 1, 2, 9, 35)) if i % 50 else 200
        at = day * 86_400_000 + i * 1000
        date = datetime.date(1970, 1, 1) + datetime.timedelta(days=day)
        values = [rng.choice((None, float(rng.randrange(40)))) for _ in range(4)]
        out.append((rng.choice("ab"), i, at, date, rng.choice(KINDS), *values, "x", 1))
    return out


def plain(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_batches_equal_one_pass_and_states_stay_small(spark, tmp_path):
    for seed, cuts in ((1, (0, 133, 134, 260, 400)), (2, (0, 3, 399, 400))):
        rows = events(seed)
        whole = spark.createDataFrame(rows, SCHEMA)
        both = fire_history(whole).join(precipitation_7d(whole), ["h3_cell", "event_date"])
        state, known, given = None, {}, {}
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            found, changed = history_step(spark.createDataFrame(rows[a:b], SCHEMA), state)
            given |= {(r["h3_cell"], r["event_date"]): r for r in found.collect()}
            for r in changed.collect():
                assert len(r["days"]) <= RING_DAYS + 1
                known[r["h3_cell"]] = r
            state = spark.createDataFrame(list(known.values()), changed.schema)
        names = both.columns
        assert sorted(tuple(str(r[c]) for c in names) for r in given.values()) == plain(both)


def test_late_days_and_missing_keys_are_left_out(spark):
    rows = events(3, 60)
    _, state = history_step(spark.createDataFrame(rows[30:], SCHEMA))
    state = spark.createDataFrame(state.collect(), state.schema)
    late, unchanged = history_step(spark.createDataFrame(rows[:30], SCHEMA), state)
    assert late.count() == 0 and unchanged.count() == 0
    nothing, none = history_step(spark.createDataFrame([(None, *rows[0][1:]), (*rows[1][:3], None, *rows[1][4:])], SCHEMA), state)
    assert nothing.count() == 0 and none.count() == 0
    empty, still = history_step(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and still.count() == 0


def test_maxima_of_batches_equal_one_pass(spark):
    rng = random.Random(5)
    rows, at = [], 0
    for i in range(300):
        at += rng.choice((0, 50, 400, 5000))
        values = [rng.choice((None, float(rng.randrange(40)))) for _ in range(4)]
        rows.append((rng.choice("aab"), i, at, None, rng.choice(KINDS), *values, "x", 1))
    whole, tail, found = spark.createDataFrame(rows, SCHEMA), None, []
    for a, b in ((0, 100), (100, 101), (101, 300)):
        part, tail = maxima_step(spark.createDataFrame(rows[a:b], SCHEMA), tail, 1000)
        found += plain(part)
        tail = spark.createDataFrame(tail.collect(), tail.schema)
    assert sorted(found) == plain(recent_maxima(whole, 1000))
    newest = whole.groupBy("h3_cell").agg(F.max("event_time").alias("m"))
    assert tail.join(newest, "h3_cell").filter("event_time < m - 1000").count() == 0
