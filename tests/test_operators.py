import datetime as dt
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwatch.functions import calendar as cal
from cellwatch.functions.scalars import round_half_up, rounded_element
from cellwatch.operators import aggregate, cells, encode, history, model_io, scoring
from cellwatch.operators.skew import CUTS, SplitPolicy, cut_points, part_of
from cellwatch.schemas import UNIFIED_SCHEMA
from cellwatch.sources import payload


def lattice(spark, rows=12, columns=12, lat=36.0, lon=3.0):
    pts = [
        (f"c{r:02d}{c:02d}", lat + r * 0.0081, lon + (c + 0.5 * (r % 2)) * 0.0104)
        for r in range(rows)
        for c in range(columns)
    ]
    return spark.createDataFrame(pts, "h3_cell string, h3_center_lat double, h3_center_lon double")


def km(a, b):
    la, lo, lb, lp = map(math.radians, (*a, *b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 12742.0 * math.asin(math.sqrt(h))


@pytest.mark.parametrize("lon", [3.0, 179.95])
def test_nearest_cell_equals_brute_force(spark, lon):
    centres = lattice(spark, lon=lon).withColumn(
        "h3_center_lon", F.when(F.col("h3_center_lon") > 180, F.col("h3_center_lon") - 360).otherwise(F.col("h3_center_lon"))
    )
    known = {r[0]: (r[1], r[2]) for r in centres.collect()}
    rng = random.Random(5)
    points = []
    for i in range(300):
        x = lon - 0.02 + rng.random() * 0.17
        points.append((i, "given", 35.98 + rng.random() * 0.14, x - 360 if x > 180 else x))
    points += [(300, "given", None, 3.0), (301, "given", float("nan"), 3.0), (302, None, 36.0, None)]
    events = spark.createDataFrame(points, "seq int, h3_cell string, lat double, lon double")
    got = {r.seq: r.h3_cell for r in cells.resolve_cell(events, cells.grid_index(centres)).collect()}
    for i, given, la, lo in points:
        if la is None or lo is None or math.isnan(la):
            assert got[i] == given
            continue
        best = min((km((la, lo), p), c) for c, p in known.items())
        assert got[i] == (best[1] if best[0] <= 0.9 else given)
    assert len(got) == len(points)


def test_adjacency_is_the_hexagon_ring(spark):
    pairs = cells.adjacency(lattice(spark))
    assert pairs.groupBy("h3_cell").count().agg(F.max("count")).first()[0] == 6
    ring = {r.neighbor for r in pairs.filter("h3_cell = 'c0505'").collect()}
    assert ring == {"c0504", "c0506", "c0405", "c0406", "c0605", "c0606"}
    assert pairs.exceptAll(pairs.selectExpr("neighbor as h3_cell", "h3_cell as neighbor")).isEmpty()


def test_centres_that_nearly_coincide_are_refused(spark):
    two = spark.createDataFrame([("a", 36.0001, 3.0001), ("b", 36.00011, 3.00011)], "h3_cell string, h3_center_lat double, h3_center_lon double")
    with pytest.raises(Exception, match="too close"):
        cells.grid_index(two).collect()


@pytest.mark.parametrize("lat, spread, turn", [(36.0, 0.05, 0.1), (78.0, 0.05, 0.2), (89.99, 0.03, 360.0), (90.0, 0.04, 0.5), (-90.0, 0.03, 360.0), (179.99, 0.05, 0.1)])
def test_close_centres_anywhere_equal_brute_force(spark, lat, spread, turn):
    """Centres of any density, near and beyond the poles; five cells share one centre."""
    rng = random.Random(11)

    def place():
        return lat + (rng.random() - 0.5) * 2 * spread, 3.0 + (rng.random() - 0.5) * turn

    known = {f"c{i:03d}": place() for i in range(120)}
    known |= {f"d{i}": known["c007"] for i in range(5)}
    schema = "h3_cell string, h3_center_lat double, h3_center_lon double"
    centres = spark.createDataFrame([(c, *p) for c, p in known.items()], schema)
    pairs = [tuple(r) for r in cells.adjacency(centres).collect()]
    assert sorted(pairs) == sorted((a, b) for a in known for b in known if a != b and km(known[a], known[b]) <= 1.3)

    points = {i: place() for i in range(200)} | {200: known["c007"]}
    events = spark.createDataFrame([(i, "given", *p) for i, p in points.items()], "seq int, h3_cell string, lat double, lon double")
    index = cells.grid_index(centres, min_spacing_km=None)
    got = {r.seq: r.h3_cell for r in cells.resolve_cell(events, index).collect()}
    assert len(got) == len(points) and got[200] == "c007"
    for i, p in points.items():
        best = min((km(p, q), c) for c, q in known.items())
        assert got[i] == (best[1] if best[0] <= 0.9 else "given")


def test_clock_functions(spark):
    ms = [1735689599999, 1735689600000, 1750000000000]
    df = spark.createDataFrame([(m,) for m in ms], "t long")
    rows = df.select("t", cal.utc_date(F.col("t")), cal.slot_label(F.col("t"))).collect()
    for r in rows:
        t = dt.datetime.fromtimestamp(r[0] / 1000, dt.timezone.utc)
        assert r[1] == t.date()
        assert r[2] == (t + dt.timedelta(hours=1)).strftime("%H:00")
    day = spark.sql("select date'2025-06-01' d")
    eight = day.select(cal.local_hour_epoch(F.col("d"), 8)).first()[0]
    assert dt.datetime.fromtimestamp(eight / 1000, dt.timezone.utc) == dt.datetime(2025, 6, 1, 7, tzinfo=dt.timezone.utc)


def test_clock_functions_ignore_the_session_zone(spark):
    df = spark.createDataFrame([(1750000000000,)], "t long")
    read = lambda: df.select(cal.utc_date(F.col("t")), cal.slot_label(F.col("t")), cal.local_epoch(cal.utc_date(F.col("t")))).first()
    here = read()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert read() == here
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calendar_columns(spark):
    r = spark.sql("select date'2024-12-28' d").select(*cal.calendar_columns(F.col("d"))).first()
    assert (r.month, r.is_weekend) == (12, 1)
    assert r.doy_sin == pytest.approx(math.sin(2 * math.pi * 363 / 365))
    assert r.month_cos == pytest.approx(1.0)


def test_rounding(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (None,)], "x double")
    assert [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()] == [0.13, -0.12, None]
    a = spark.sql("select array(1.23456, null) a")
    assert tuple(a.select(*[rounded_element(F.col("a"), F.lit(i)) for i in (-1, 0, 1, 2)]).first()) == (None, 1.235, None, None)


def test_encoder_codes_follow_the_order(spark):
    words = [f"w{i:05d}" for i in range(3000)]
    random.Random(1).shuffle(words)
    df = spark.createDataFrame([(w,) for w in words * 2], "w string").repartition(7)
    table = {r["class"]: r["code"] for r in encode.export_encoder(df, "w").collect()}
    assert table == {w: i for i, w in enumerate(sorted(set(words)))}


def test_encode_modes(spark):
    table = spark.createDataFrame([("a", 0), ("b", 1)], "class string, code int")
    rows = spark.createDataFrame([("a", "x"), (" ", "b"), ("z", "a"), (None, "")], "h3_commune string, h3_cell string")
    marked = encode.encode_strict(rows, table)
    assert sorted((str(r.code), str(r.reject_reason)) for r in marked.collect()) == [
        ("0", "None"), ("1", "None"), ("None", "blank_cell"), ("None", "unknown_cell"),
    ]
    with pytest.raises(Exception, match="unknown_cell"):
        encode.encode_strict(rows, table, on_unknown="fail").collect()
    lenient = encode.encode_fallback(rows, table, "h3_commune").collect()
    assert {r.h3_commune: r.code for r in lenient} == {"a": 0, " ": 0, "z": 0, None: 0}
    with_unknown = table.union(spark.createDataFrame([("Unknown", 2)], "class string, code int"))
    assert {r.h3_commune: r.code for r in encode.encode_fallback(rows, with_unknown, "h3_commune").collect()}["z"] == 2


@pytest.mark.parametrize(
    "p1, p2, wanted",
    [
        (0.2, 0.1, (0, 0.8, "LOW")),
        (0.55, 0.2, (1, 0.35, "MEDIUM")),
        (0.9, 0.7, (2, 0.7, "HIGH")),
        (0.3, 0.9, (0, 0.7, "LOW")),
        (0.8, 0.95, (2, 0.8, "HIGH")),
        (0.0, 0.0, (0, 1.0, "LOW")),
    ],
)
def test_ordinal_classes(spark, p1, p2, wanted):
    r = scoring.ordinal_classes(spark.createDataFrame([(p1, p2)], "p_ge_1 double, p_ge_2 double")).first()
    assert (r.prediction, r.probability, r.risk_level) == wanted


def test_positive_class_shapes():
    assert scoring.positive_class(np.array([[0.2, 0.8]])).tolist() == [0.8]
    assert scoring.positive_class(np.array([[0.3]])).tolist() == [0.3]
    assert scoring.positive_class([0.4]).tolist() == [0.4]
    assert scoring.positive_class([{0: 0.1, 1: 0.9}]).tolist() == [0.9]
    with pytest.raises(ValueError):
        scoring.positive_class(np.zeros((1, 2, 3)))


def test_unknown_feature_is_refused(spark):
    with pytest.raises(ValueError):
        scoring.feature_vector(spark.range(1), ["month", "wishes"])


def test_requests_and_responses(spark):
    data = F.from_json(F.lit('{"temperature_moy":1,"humidity_min":2,"humidity_min(%)":3}'), "map<string,string>")
    full = spark.range(1).select(model_io.normalise_aliases(data).alias("d")).first().d
    assert full == {"temperature_moy": "1", "humidity_min": "2", "humidity_min(%)": "3", "temperature_moy(°C)": "1"}
    texts = [
        ('{"prediction":{"probabilities":{"class_0":0.4,"class_1":0.4,"class_2":0.2}}}', (1, 0.4, "MEDIUM", None)),
        ('{"prediction":{"risk_level":2}}', (2, 0.0, "HIGH", None)),
        ('{"known_h3":"no","prediction":{"risk_level":2}}', (0, 0.0, "REJECTED_UNKNOWN_H3", None)),
        ('{"prediction":3}', (None, None, None, "missing_prediction")),
        ('{"prediction_status":"ok"}', (None, None, None, "missing_prediction")),
    ]
    for text, wanted in texts:
        r = model_io.decode_response(spark.createDataFrame([(text,)], "response string")).first()
        assert (r.prediction, r.probability, r.risk_level, r.reject_reason) == wanted


def unified(spark, rows):
    names = UNIFIED_SCHEMA.fieldNames()
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in UNIFIED_SCHEMA.fields) + ", seq long"
    return spark.createDataFrame([tuple(r.get(n) for n in [*names, "seq"]) for r in rows], schema)


DAY = dt.date(2025, 6, 1)
T0 = 1748736000000


def event(seq, kind, cell="c", at=0, **values):
    return {"seq": seq, "source_type": kind, "h3_cell": cell, "event_time": T0 + at, "event_date": DAY, **values}


def test_cell_window_defaults(spark):
    rows = [event(1, "FIRE", fire_declared=1, altitude_moy=5.0), event(2, "sensor", co2=3.0, altitude_moy=None, at=5)]
    w = aggregate.cell_windows(unified(spark, rows)).first()
    assert (w.fire_count, w.fire_declared_count, w.meteo_count, w.sensor_count) == (1, 1, 0, 1)
    assert (w.total_burned_area, w.avg_fire_intensity, w.total_precipitation_1d, w.avg_temp) == (0.0, None, 0.0, None)
    assert (w.altitude_moy, w.avg_co2, w.window_start, w.window_end) == (5.0, 3.0, T0, T0 + 86_400_000)
    s = aggregate.window_snapshots(aggregate.cell_windows(unified(spark, rows))).first()
    assert (s.event_date, s.event_time) == (DAY + dt.timedelta(days=1), T0 + 86_400_000)


@pytest.mark.parametrize("span", [600_000, 7_000])
def test_recent_maxima_equal_brute_force(spark, span):
    rng = random.Random(span)
    rows = [
        event(i, rng.choice(["sensor", "fire", "meteo"]), rng.choice(["a", "b"]), rng.randrange(0, 4_000) * 1000,
              smoke=rng.choice([None, rng.random()]))
        for i in range(400)
    ]
    got = {r.seq: r for r in history.recent_maxima(unified(spark, rows), span).collect()}
    for e in rows:
        near = [o for o in rows if o["h3_cell"] == e["h3_cell"] and e["event_time"] - span <= o["event_time"] <= e["event_time"]]
        sensors = [o for o in near if o["source_type"] == "sensor"]
        smoke = [o["smoke"] for o in sensors if o["smoke"] is not None]
        fires = [o["event_time"] for o in near if o["source_type"] == "fire"]
        r = got[e["seq"]]
        assert (r.max_smoke_10m, r.sensor_alerts_10m, r.last_fire_time) == (
            max(smoke, default=None), len(sensors), max(fires, default=None),
        )


def test_payload_cases(spark):
    texts = [
        (1, '{"daily":{"time":["2025-06-01","2025-06-02"],"temperature_2m_mean":[1.23456,null]},'
            '"hourly":{"time":["2025-06-01T00:00","2025-06-01T01:00","2025-06-02T00:00"],"soil_moisture_0_to_1cm":[0.1,0.2]}}'),
        (2, '{"daily":{"time":[]}}'),
        (3, "{}"),
        (1, '{"daily":{"time":["2025-06-01"],"temperature_2m_mean":[9.0]}}'),
    ]
    df = spark.createDataFrame(texts, "id int, payload string")
    rows = payload.flatten_payload(df, ["id"]).orderBy("event_date", "temperature").collect()
    assert [(r.id, r.event_date.day, r.temperature, r.soil_moisture) for r in rows] == [
        (1, 1, 1.235, 0.15), (1, 1, 9.0, None), (1, 2, None, None),
    ]
    wanted = payload.payload_day(df, ["id"], F.lit(DAY), {"temperature": F.lit(30.0)}).orderBy("id", "temperature").collect()
    assert [(r.id, r.from_payload, r.temperature) for r in wanted] == [
        (1, True, 1.235), (1, True, 9.0), (2, False, 30.0), (3, False, 30.0),
    ]


def test_payload_days_out_of_order_and_long(spark):
    """Hourly days come back later, some readings are null, and the first entry of a day counts."""
    rng = random.Random(3)
    days = [f"2025-06-{d:02d}" for d in range(1, 29)]
    hours = [(f"{rng.choice(days)}T{rng.randrange(24):02d}:00", rng.choice([None, round(rng.random(), 3)])) for _ in range(900)]
    body = {
        "daily": {"time": [*days, days[0], None], "temperature_2m_mean": [float(i) for i in range(30)]},
        "hourly": {"time": [h for h, _ in hours], "soil_moisture_0_to_1cm": [v for _, v in hours]},
    }
    df = spark.createDataFrame([(1, json.dumps(body))], "id int, payload string")
    out = payload.flatten_payload(df, ["id"])
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.event_date.isoformat(): (r.temperature, r.soil_moisture) for r in out.collect()}
    assert len(got) == out.count() == 28
    for i, d in enumerate(days):
        values = [v for h, v in hours if h.startswith(d) and v is not None]
        assert got[d][0] == float(i) and got[d][1] == pytest.approx(sum(values) / len(values), abs=1e-3)


def test_hot_key_parts_are_contiguous_and_small(spark):
    rows = [("hot", i * 3) for i in range(3000)] + [("cold", i) for i in range(10)]
    df = spark.createDataFrame(rows, "h3_cell string, seq long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cuts = cut_points(df, "h3_cell", "seq", SplitPolicy(30))
        cells_cut = [r.h3_cell for r in cuts.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert cells_cut == ["hot"]
    out = df.join(cuts, "h3_cell").withColumn("_part", part_of(F.col(CUTS), F.col("seq")))
    parts = out.groupBy("_part").agg(F.min("seq").alias("a"), F.max("seq").alias("b"), F.count("*").alias("n"))
    got = parts.orderBy("_part").collect()
    assert 25 <= len(got) <= 31 and max(r.n for r in got) <= 250
    assert all(x.b < y.a for x, y in zip(got, got[1:]))
    assert out.count() == 3000


def test_small_inputs_are_not_cut(spark):
    df = spark.createDataFrame([("a", i) for i in range(1000)], "h3_cell string, seq long")
    assert cut_points(df, "h3_cell", "seq").count() == 0


def test_repeated_cells_count_once(spark):
    lat, lon = 36.0, 3.0
    centres = spark.createDataFrame(
        [("a", lat, lon)] * 3 + [("b", lat + 0.0081, lon)], "h3_cell string, h3_center_lat double, h3_center_lon double"
    )
    pairs = [tuple(r) for r in cells.adjacency(centres).collect()]
    assert sorted(pairs) == [("a", "b"), ("b", "a")]


def test_partials_of_partials_equal_one_pass(spark):
    """Merging in any grouping, over batches of one cell's windows, with and without static values of the events."""
    from cellwatch.operators import aggregate, partials
    from cellwatch.registry.windows import changing_static

    events = changing_static(spark, "/root/testdata/sf0.001")
    parts = [partials.partial_windows(events.filter(F.col("seq") % 4 == i)) for i in range(4)]
    early = partials.merge_partials(parts[2].unionByName(parts[0]))
    merged = partials.merge_partials(parts[3].unionByName(early).unionByName(parts[1]))

    def rows(df):
        return sorted(
            (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=lambda r: (r[0], r[2])
        )

    once = aggregate.cell_windows(events)
    out = partials.finished_windows(merged)
    assert out.columns == once.columns and rows(out) == rows(once)
    assert partials.merge_partials(partials.partial_windows(events.limit(0))).count() == 0
