import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cellwatch.operators import confirm
from cellwatch.operators.skew import SplitPolicy, part_of
from cellwatch.schemas import PREDICTION_SCHEMA, SNAPSHOT_COLUMNS, SNAPSHOT_SCHEMA

from tests import day_machine

DAY = dt.date(2025, 6, 1)


def frames(spark, events):
    rows = [(e["cell"], e["date"], e["time"], e["seq"], e["kind"], e["risk"]) for e in events]
    schema = "h3_cell string, event_date date, event_time long, seq long, source_type string, risk string"
    df = spark.createDataFrame(rows, schema)
    meteo = df.filter("source_type = 'meteo'")
    given = {f: F.col(f) for f in ("h3_cell", "event_date", "event_time")}
    scored = meteo.select(
        *[
            given.get(c, F.lit(None).cast(SNAPSHOT_SCHEMA[c].dataType)).alias(c)
            for c in SNAPSHOT_COLUMNS
        ],
        "seq",
        F.struct(
            F.col("h3_cell").alias("h3_cell"),
            F.col("event_time").alias("event_time"),
            F.col("event_date").alias("event_date"),
            F.lit(0).alias("prediction"),
            F.lit(0.5).alias("probability"),
            F.col("risk").alias("risk_level"),
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in PREDICTION_SCHEMA.fields[6:]],
        ).alias("p"),
    )
    return scored, df.filter("source_type <> 'meteo'")


def results(walked):
    walked = walked.cache()
    alerts = sorted(
        tuple(r)
        for r in confirm.alert_rows(walked)
        .select(
            "h3_cell", "event_date", "event_time",
            F.when(F.col("fire_on"), "sensor_fire").otherwise("sensor"), "fire_on", "snapshot.event_time",
            confirm.suspected_voluntary(F.col("fire_on"), F.col("last.risk_level")),
        )
        .collect()
    )
    pick = [
        "h3_cell", "event_date", "sensor_confirmed", "fire_observed", "fire_confirmed_with_sensor",
        "confirmation_time", "confirmation_source", "latest_meteo_event_time", "suspected_voluntary",
    ]
    log = sorted((tuple(r) for r in confirm.outcome_log(walked).select(pick).collect()), key=str)
    final = sorted(tuple(r) for r in confirm.daily_outcomes(walked).select(pick).collect())
    training = sorted(
        tuple(r)
        for r in confirm.daily_training(walked)
        .select(
            "h3_cell", "event_date", "label", "confirmation_source", "input_event_time", "fire_observed",
            "sensor_confirmed", "suspected_voluntary",
        )
        .collect()
    )
    return alerts, log, final, training


def expected(events):
    alerts, outcomes, training, _ = day_machine.run(events)
    return (
        sorted(alerts),
        sorted(outcomes, key=str),
        day_machine.upsert(outcomes),
        day_machine.upsert(training),
    )


def random_events(seed, cells, rows, days, hot=0.0):
    rng = random.Random(seed)
    out = []
    day = 0
    for seq in range(rows):
        if rng.random() < 0.12:
            day = max(0, min(days - 1, day + rng.choice([1, 1, 1, -1])))
        cell = "c0" if rng.random() < hot else f"c{rng.randrange(cells)}"
        out.append(
            {
                "cell": cell,
                "date": DAY + dt.timedelta(days=day),
                "time": 1_750_000_000_000 + seq * 1000,
                "seq": seq,
                "kind": rng.choice(["meteo", "meteo", "sensor", "fire"]),
                "risk": rng.choice(["LOW", "HIGH"]),
            }
        )
    return out


def sequence(text):
    """m, s, f in order; | moves to the next day, < one day back."""
    day, out = 0, []
    for ch in text.replace(" ", ""):
        if ch in "|<":
            day += 1 if ch == "|" else -1
            continue
        out.append(
            {
                "cell": "c",
                "date": DAY + dt.timedelta(days=day),
                "time": 1_750_000_000_000 + len(out) * 1000,
                "seq": len(out),
                "kind": {"m": "meteo", "s": "sensor", "f": "fire"}[ch],
                "risk": "LOW",
            }
        )
    return out


GOLDEN = {
    # sequence: (alert source, final outcome per day, label and fire flag per day)
    "m s": (["sensor"], ["sensor"], [(1, False)]),
    "m f s": (["sensor_fire"], ["sensor_fire"], [(1, True)]),
    "m s f": (["sensor"], ["sensor_fire"], [(1, False)]),
    "m f": ([], ["fire_pending"], []),
    "m f | m": ([], ["fire_pending"], [(0, True)]),
    "s m f": (["sensor_fire"], ["sensor_fire"], [(1, True)]),
    "s m": ([], [], []),
    "s m | m": ([], [], [(0, False)]),
    "f s": ([], ["fire_pending"], []),
    "m s s": (["sensor"], ["sensor"], [(1, False)]),
    "m < m | m s": (["sensor"], ["sensor"], [(0, False), (1, False)]),
}


@pytest.mark.parametrize("text", list(GOLDEN))
def test_golden_sequences(spark, text):
    alerts, _, final, training = results(confirm.timeline(*frames(spark, sequence(text))))
    assert (
        [a[3] for a in alerts],
        [o[6] for o in final],
        [(t[2], t[5]) for t in training],
    ) == GOLDEN[text]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_state_machine(spark, seed):
    events = random_events(seed, 40, 1500, 6)
    assert results(confirm.timeline(*frames(spark, events))) == expected(events)


@pytest.fixture
def whole_ranges(spark):
    """Keep AQE from merging the small ranges of these small inputs."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("ranges", [200, 60, 20])
def test_hot_cells_in_parts_match_state_machine(spark, whole_ranges, ranges):
    events = random_events(ranges, 12, 1200, 5, hot=0.5)
    walked = confirm.timeline(*frames(spark, events), policy=SplitPolicy(ranges))
    assert walked.select("_part").distinct().count() > 5
    assert results(walked) == expected(events)


def test_more_cut_cells_than_any_former_limit(spark, whole_ranges):
    """Every one of 6,000 cells fills several ranges."""
    events = [
        {"cell": f"c{c}", "date": DAY, "time": 1_750_000_000_000 + i, "seq": i, "kind": k, "risk": "LOW"}
        for c in range(6000)
        for i, k in enumerate(["meteo", "fire", "sensor"])
    ]
    pairs = frames(spark, events)
    rows = confirm.merge_inputs(*pairs)
    starts = rows.groupBy("h3_cell").agg(F.sort_array(F.collect_list("seq")).alias("s"))
    cuts = starts.select("h3_cell", F.slice("s", 2, 2).alias("_cuts"))
    placed = rows.join(cuts, "h3_cell").withColumn("_part", part_of(F.col("_cuts"), F.col("seq")))
    assert placed.filter("_part <> seq").isEmpty() and placed.count() == 18_000


@pytest.mark.parametrize("ranges", [None, 40])
def test_order_may_be_a_struct_that_no_number_holds(spark, whole_ranges, ranges):
    """Offsets on both sides of 2^19, and far over it, within one millisecond."""
    events = random_events(5, 6, 300, 4, hot=0.5)
    scored, control = frames(spark, events)
    offset = F.lit(2**19 - 150) + F.col("seq") + F.when(F.col("seq") > 200, F.lit(2**62)).otherwise(0)
    wide = F.struct(F.lit(7).alias("clock"), F.lit(0).alias("topic"), F.lit(3).alias("partition"), offset.alias("offset"))
    walked = confirm.timeline(*[df.withColumn("seq", wide) for df in (scored, control)], policy=SplitPolicy(ranges))
    assert results(walked) == expected(events)


@pytest.mark.parametrize("ranges", [None, 30])
def test_late_rows_can_be_ignored(spark, whole_ranges, ranges):
    events = random_events(8, 10, 900, 5, hot=0.4)
    newest, kept = {}, []
    for e in events:
        if e["date"] >= newest.get(e["cell"], e["date"]):
            newest[e["cell"]] = e["date"]
            kept.append(e)
    assert len(kept) < len(events)
    walked = confirm.timeline(*frames(spark, events), policy=SplitPolicy(ranges), late="ignore")
    assert results(walked) == expected(kept)
    with pytest.raises(ValueError):
        confirm.timeline(*frames(spark, events[:3]), late="drop")


def test_long_day_over_many_parts(spark, whole_ranges):
    for text in ["m" + "m" * 30 + "s" * 10 + "f" * 10, "s" * 20 + "m" * 20 + "f" * 20, "f" * 30 + "|" + "m" * 30 + "s"]:
        events = sequence(text)
        walked = confirm.timeline(*frames(spark, events), policy=SplitPolicy(12))
        assert results(walked) == expected(events)


@pytest.mark.parametrize("policy", [SplitPolicy(), SplitPolicy(40)])
def test_runs_continue_from_state(spark, whole_ranges, policy):
    events = random_events(11, 8, 600, 5, hot=0.4)
    whole = expected(events)
    alerts, log, finals, labels, state = [], [], {}, {}, None
    for piece in (events[:200], events[200:210], events[210:]):
        walked = confirm.timeline(*frames(spark, piece), state=state, policy=policy)
        a, o, f, t = results(walked)
        alerts += a
        log += o
        finals.update({(r[0], r[1]): r for r in f})
        labels.update({(r[0], r[1]): r for r in t})
        kept = confirm.final_state(walked)
        state = spark.createDataFrame(kept.collect(), kept.schema)
    assert (sorted(alerts), sorted(log, key=str), sorted(finals.values()), sorted(labels.values())) == whole


def test_rows_that_share_seq_have_one_order(spark):
    """The result does not depend on how such rows arrive."""
    events = sequence("m s f m | m f s")
    for e in events:
        e["seq"] //= 3
    scored, control = frames(spark, events)
    seen = {str(results(confirm.timeline(scored.repartition(n), control.repartition(n)))) for n in (1, 3, 5)}
    assert len(seen) == 1


def test_open_days_can_be_flushed(spark):
    walked = confirm.timeline(*frames(spark, sequence("m | m f")))
    rows = confirm.flush_open_days(walked).select("event_date", "label", "fire_observed").collect()
    assert [tuple(r) for r in rows] == [(DAY + dt.timedelta(days=1), 0, True)]
