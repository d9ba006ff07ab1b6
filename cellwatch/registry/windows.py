"""Queries over windows, payloads and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellwatch.operators import aggregate, enrich, history, partials
from cellwatch.operators.history_state import HISTORY_STATE, history_step, maxima_step
from cellwatch.plans import driver_tables as dt
from cellwatch.plans.risk import snapshot_scores
from cellwatch.registry.common import BASE, CELLS, ENCODER, EV, SQL, UNIFIED, calendar, day, num, query, scores, slot, sql
from cellwatch.registry.inputs import SNAPSHOT_SELECT, unified, unified_alone
from cellwatch.schemas import METADATA_COLUMNS, PREDICTION_COLUMNS, STATIC_COLUMNS
from cellwatch.session import materialise, scratch_path
from cellwatch.sinks.tables import Table
from cellwatch.sources import payload

_STATIC_MAX = ", ".join(f"any_value(st.{c}) AS {c}" for c in STATIC_COLUMNS)
WINDOWS = f"""win AS (
  SELECT u.h3_cell, arg_max(u.event_date, u.seq) AS event_date, u.event_time // 86400000 * 86400000 AS window_start,
         u.event_time // 86400000 * 86400000 + 86400000 AS window_end, min(u.event_time) AS first_event_time,
         max(u.event_time) AS last_event_time, count(*) FILTER (source_type = 'fire') AS fire_count,
         CAST(coalesce(sum(fire_declared), 0) AS BIGINT) AS fire_declared_count, avg(intensity) AS avg_fire_intensity,
         max(intensity) AS max_fire_intensity, coalesce(sum(burned_area), 0.0) AS total_burned_area,
         count(*) FILTER (source_type = 'meteo') AS meteo_count, avg(temperature) AS avg_temp,
         min(humidity) AS min_humidity, max(wind_speed) AS max_wind_speed, avg(vpd) AS avg_vpd,
         avg(soil_moisture) AS avg_soil_moisture, coalesce(sum(precipitation), 0.0) AS total_precipitation_1d,
         coalesce(sum(precipitation), 0.0) AS total_precipitation_7d,
         count(*) FILTER (source_type = 'sensor') AS sensor_count, avg(co2) AS avg_co2, max(co2) AS max_co2,
         avg(smoke) AS avg_smoke, max(smoke) AS max_smoke, avg(sensor_temperature) AS avg_sensor_temp,
         max(sensor_temperature) AS max_sensor_temp, min(battery) AS min_battery, avg(lat) AS avg_lat,
         avg(lon) AS avg_lon, {_STATIC_MAX}
  FROM uni u LEFT JOIN st ON st.h3_cell = u.h3_cell
  GROUP BY u.h3_cell, u.event_time // 86400000)"""
_WIN_NUM = num(
    "avg_fire_intensity", "max_fire_intensity", "total_burned_area", "avg_temp", "min_humidity", "max_wind_speed",
    "avg_vpd", "avg_soil_moisture", "total_precipitation_1d", "total_precipitation_7d", "avg_co2", "max_co2",
    "avg_smoke", "max_smoke", "avg_sensor_temp", "max_sensor_temp", "min_battery", "avg_lat", "avg_lon",
    *STATIC_COLUMNS, of="w.",
)
_WIN_SELECT = f"""w.h3_cell, {day(of="w.")}, w.window_start, w.window_end, w.first_event_time, w.last_event_time,
  w.fire_count, w.fire_declared_count, w.meteo_count, w.sensor_count, {_WIN_NUM}"""


@query("cell_windows", sql(*BASE, UNIFIED, WINDOWS, select=f"SELECT {_WIN_SELECT} FROM win w"))
def cell_windows(spark, sf_dir):
    return aggregate.cell_windows(unified_alone(spark, sf_dir), static=dt.static(spark, sf_dir))


@query("cell_windows_merged", sql(*BASE, UNIFIED, WINDOWS, select=f"SELECT {_WIN_SELECT} FROM win w"))
def cell_windows_merged(spark, sf_dir):
    """The same from stored partials of three batches that share windows; one batch is written twice."""
    events, static = unified_alone(spark, sf_dir), dt.static(spark, sf_dir)
    table = None
    for batch, part in ((0, 0), (1, 1), (0, 0), (2, 2)):
        rows = partials.partial_windows(events.filter(F.col("seq") % 3 == part))
        table = table or Table(scratch_path(spark, "partials"), rows.schema)
        table.write(rows, "a", batch)
    return partials.finished_windows(partials.merge_partials(table.read(spark)), static)


def changing_static(spark, sf_dir):
    """Events that carry static values of their own, which change and are missing now and then."""
    k = F.col("k").cast("double")
    own = {c: F.when(F.col("k") % (i + 2) == 0, k * (i + 1)) for i, c in enumerate(STATIC_COLUMNS)}
    ev = dt.events(spark, sf_dir)
    values = ev.select("seq", *[v.alias(c) for c, v in own.items()])
    parts = [
        enrich.unify_weather(dt.weather(ev).join(values, "seq"), None, extra=("seq",)),
        enrich.unify_sensor(dt.sensors(ev).join(values, "seq"), None, extra=("seq",)),
        enrich.unify_fire(dt.fires(ev).join(values, "seq"), None, extra=("seq",)),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_LAST_KNOWN = ", ".join(
    f"round(arg_max(CAST(k AS DOUBLE) * {i + 1}, seq) FILTER (k % {i + 2} = 0), 6) + 0.0 AS {c}"
    for i, c in enumerate(STATIC_COLUMNS)
)


@query(
    "window_last_static",
    sql(
        EV,
        select=f"""SELECT h3_cell, event_time // 86400000 * 86400000 AS window_start, {_LAST_KNOWN} FROM ev
GROUP BY h3_cell, event_time // 86400000""",
    ),
)
def window_last_static(spark, sf_dir):
    return aggregate.cell_windows(changing_static(spark, sf_dir)).select("h3_cell", "window_start", *STATIC_COLUMNS)


@query(
    "cell_windows_described",
    sql(
        *BASE,
        UNIFIED,
        WINDOWS,
        select=f"""SELECT {_WIN_SELECT}, r_name AS wilaya, n_name AS daira, r_name || '-' || n_name AS commune,
  c_name AS nom_foret_ou_lieu_dit, c_mktsegment AS essence_principale
FROM win w LEFT JOIN (SELECT 'u' || c_custkey AS cell, * FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey) m ON m.cell = w.h3_cell""",
    ),
)
def cell_windows_described(spark, sf_dir):
    windows = cell_windows(spark, sf_dir)
    described = enrich.with_metadata(windows, dt.metadata(spark, sf_dir))
    return described.select(*windows.columns, *METADATA_COLUMNS)


def _window_snapshots(bound: str) -> str:
    return f"""snap AS (
  SELECT h3_cell, h3_cell AS h3_commune, window_end AS event_time, d AS event_date, h3_center_lat, h3_center_lon,
         altitude_moy, pente_moy, dist_route_m, dist_urbain_m, min_humidity AS humidity_min,
         avg_temp AS temperature_moy, max_wind_speed AS wind_speed_max, total_precipitation_1d AS precipitation_1d_mm,
         total_precipitation_7d AS precipitation_7d_sum_mm, avg_soil_moisture AS soil_moisture, avg_vpd AS vpd_kpa,
         ndvi_30d_mean, ndvi_30d_min, ndvi_30d_std, {calendar("d")}
  FROM (SELECT *, DATE '1970-01-01' + CAST({bound} // 86400000 AS INTEGER) AS d FROM win))"""


@query(
    "window_snapshots",
    sql(*BASE, UNIFIED, WINDOWS, _window_snapshots("window_end"), select=f"SELECT {SNAPSHOT_SELECT} FROM snap"),
)
def window_snapshots(spark, sf_dir):
    return aggregate.window_snapshots(cell_windows(spark, sf_dir))


@query(
    "window_snapshots_by_start",
    sql(*BASE, UNIFIED, WINDOWS, _window_snapshots("window_start"), select=f"SELECT {SNAPSHOT_SELECT} FROM snap"),
)
def window_snapshots_by_start(spark, sf_dir):
    return aggregate.window_snapshots(cell_windows(spark, sf_dir), date_from="start")


@query(
    "window_scores",
    sql(
        *BASE,
        UNIFIED,
        WINDOWS,
        ENCODER,
        _window_snapshots("window_end"),
        scores("snap", "sc"),
        select=f"""SELECT h3_cell, event_time, {day()}, prediction, round(probability, 6) + 0.0 AS probability, risk_level,
  0 AS suspected_voluntary, NULL::VARCHAR AS trigger_type, NULL::VARCHAR AS trigger_source,
  NULL::BOOLEAN AS is_neighbor_prediction, NULL::VARCHAR AS trigger_h3_cell, NULL::BOOLEAN AS confirmed_alert,
  NULL::BOOLEAN AS fire_observed, NULL::BOOLEAN AS sensor_confirmed, NULL::BIGINT AS confirmation_time,
  NULL::VARCHAR AS prediction_slot FROM sc""",
    ),
)
def window_scores(spark, sf_dir):
    snapshots = aggregate.window_snapshots(cell_windows(spark, sf_dir))
    _, scored = snapshot_scores(snapshots, dt.model(spark, sf_dir))
    return scored


@query(
    "window_kept",
    sql(*BASE, UNIFIED, WINDOWS, _window_snapshots("window_end"), select=f"SELECT {SNAPSHOT_SELECT} FROM snap"),
)
def window_kept(spark, sf_dir):
    """The snapshot side of lenient scoring: a window that has no score stays."""
    kept, _ = snapshot_scores(aggregate.window_snapshots(cell_windows(spark, sf_dir)), dt.model(spark, sf_dir))
    return kept


# ---- stored payloads: each order carries three days of daily and six-hourly values ----


def payloads(spark, sf_dir):
    orders = dt.table(spark, sf_dir, "orders")
    start = F.col("o_orderdate").cast("date")
    price = F.col("o_totalprice")
    days = [F.date_format(F.date_add(start, i), "yyyy-MM-dd") for i in range(3)]
    daily = F.struct(
        F.when(F.col("o_orderstatus") != "P", F.array(*days)).alias("time"),
        F.array(*[price / (7 + i) for i in range(3)]).alias("temperature_2m_mean"),
        F.array(price / 11, F.lit(None), price / 13).alias("relative_humidity_2m_min"),
        F.array(price / 17).alias("wind_speed_10m_max"),
        F.when(F.col("o_orderstatus") == "O", F.array(*[F.lit(float(i)) for i in range(3)])).alias("precipitation_sum"),
    )
    stamps = [F.concat(d, F.lit(f"T{h:02d}:00")) for d in days[:2] for h in (0, 6, 12, 18)]
    hourly = F.struct(
        F.array(*stamps).alias("time"),
        F.array(*[F.lit(None) if i in (1, 4, 5, 6, 7) else price / (100 + i) for i in range(7)]).alias(
            "soil_moisture_0_to_1cm"
        ),
    )
    body = F.to_json(
        F.struct(daily.alias("daily"), F.when(F.col("o_orderpriority") != "5-LOW", hourly).alias("hourly")),
        {"ignoreNullFields": "false"},
    )
    return orders.select("o_orderkey", start.alias("wanted"), body.alias("payload"))


_FLAT = """flat AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) + i AS event_date, i, o_totalprice AS x, o_orderstatus AS s,
         o_orderpriority AS p
  FROM orders, (SELECT unnest([0, 1, 2]) AS i) WHERE o_orderstatus <> 'P'),
measured AS (
  SELECT o_orderkey, event_date, i, floor(x / (7 + i) * 1000 + 0.5) / 1000 AS temperature,
         floor(CASE i WHEN 0 THEN x / 11 WHEN 2 THEN x / 13 END * 1000 + 0.5) / 1000 AS humidity,
         CASE WHEN i = 0 THEN floor(x / 17 * 1000 + 0.5) / 1000 END AS wind_speed,
         CASE WHEN s = 'O' THEN CAST(i AS DOUBLE) END AS precipitation, NULL::DOUBLE AS vpd,
         CASE WHEN i = 0 AND p <> '5-LOW' THEN floor((x / 100 + x / 102 + x / 103) / 3 * 1000 + 0.5) / 1000 END
           AS soil_moisture
  FROM flat)"""
_MEASURES = num("temperature", "humidity", "wind_speed", "precipitation", "vpd", "soil_moisture")


@query(
    "payload_flatten",
    "WITH " + _FLAT + f" SELECT o_orderkey, {day()}, {_MEASURES} FROM measured",
)
def payload_flatten(spark, sf_dir):
    return payload.flatten_payload(payloads(spark, sf_dir), ["o_orderkey"])


@query(
    "payload_day",
    "WITH "
    + _FLAT
    + f""", one AS (
  SELECT o.o_orderkey, CAST(o_orderdate AS DATE) + 1 AS event_date, m.o_orderkey IS NOT NULL AS from_payload,
         m.* EXCLUDE (o_orderkey, event_date, i)
  FROM orders o LEFT JOIN measured m ON m.o_orderkey = o.o_orderkey AND m.i = 1)
SELECT o_orderkey, {day()}, from_payload,
  round(CASE WHEN from_payload THEN temperature ELSE 30.0 END, 6) + 0.0 AS temperature,
  round(CASE WHEN from_payload THEN humidity ELSE 30.0 END, 6) + 0.0 AS humidity,
  {num("wind_speed", "precipitation", "vpd", "soil_moisture")} FROM one""",
)
def payload_day(spark, sf_dir):
    wanted = F.date_add("wanted", 1)
    fallback = {"temperature": F.lit(30.0), "humidity": F.lit(30.0)}
    return payload.payload_day(payloads(spark, sf_dir), ["o_orderkey"], wanted, fallback)


# ---- history ----


@query(
    "fire_history",
    sql(
        EV,
        """d AS (SELECT h3_cell, event_date, count(*) FILTER (event_type = 'purchase') AS fires FROM ev GROUP BY ALL)""",
        select=f"""SELECT h3_cell, {day()},
  (SELECT CAST(coalesce(sum(fires), 0) AS BIGINT) FROM d p WHERE p.h3_cell = d.h3_cell
     AND p.event_date BETWEEN d.event_date - 7 AND d.event_date - 1) AS fires_cell_last_7d,
  (SELECT CAST(coalesce(sum(fires), 0) AS BIGINT) FROM d p WHERE p.h3_cell = d.h3_cell
     AND p.event_date BETWEEN d.event_date - 30 AND d.event_date - 1) AS fires_cell_last_30d,
  (SELECT CAST(d.event_date - max(p.event_date) AS INTEGER) FROM d p WHERE p.h3_cell = d.h3_cell AND p.fires > 0
     AND p.event_date < d.event_date) AS days_since_last_fire,
  (SELECT CAST(coalesce(sum(fires), 0) AS BIGINT) FROM d p WHERE p.h3_cell = d.h3_cell
     AND year(p.event_date) = year(d.event_date) AND p.event_date < d.event_date) AS seasonal_fire_count,
  CASE WHEN EXISTS (SELECT 1 FROM d p WHERE p.h3_cell = d.h3_cell AND p.fires > 0 AND p.event_date < d.event_date)
     THEN 0 ELSE 1 END AS never_burned_before FROM d""",
    ),
)
def fire_history(spark, sf_dir):
    return history.fire_history(unified(spark, sf_dir))


def _in_time(uni, parts: int = 3):
    """The events in parts that follow each other in time; cuts fall inside days."""
    low, high = uni.agg(F.min("event_time"), F.max("event_time")).first()
    part = F.floor((F.col("event_time") - low) * parts / F.lit(high + 1 - low))
    return [uni.filter(part == i) for i in range(parts)]


_HISTORY_ROWS = (
    "h3_cell string, event_date date, fires_cell_last_7d bigint, fires_cell_last_30d bigint, days_since_last_fire int, "
    "seasonal_fire_count bigint, never_burned_before int, precipitation_1d double, precipitation_true_7d double"
)


def _carried_history(spark, sf_dir):
    """Three batches, one of them written twice; each starts from the states of those before it."""
    rows = Table(scratch_path(spark, "history"), _HISTORY_ROWS, ("h3_cell", "event_date"))
    states = Table(scratch_path(spark, "history-state"), HISTORY_STATE, ("h3_cell",))
    batches = _in_time(materialise(unified(spark, sf_dir), "unified"))
    for i in (0, 1, 1, 2):
        found, state = history_step(batches[i], states.read(spark, "main", i) if i else None)
        rows.write(found, "main", i)
        states.write(state, "main", i)
    return rows.read(spark)


@query("fire_history_batches", SQL["fire_history"])
def fire_history_batches(spark, sf_dir):
    return _carried_history(spark, sf_dir).drop("precipitation_1d", "precipitation_true_7d")


@query(
    "true_precipitation",
    sql(
        *BASE,
        UNIFIED,
        "d AS (SELECT h3_cell, event_date, coalesce(sum(precipitation), 0.0) AS rain FROM uni GROUP BY ALL)",
        select=f"""SELECT h3_cell, {day()}, round(rain, 6) + 0.0 AS precipitation_1d,
  round((SELECT sum(rain) FROM d p WHERE p.h3_cell = d.h3_cell
     AND p.event_date BETWEEN d.event_date - 6 AND d.event_date), 6) + 0.0 AS precipitation_true_7d FROM d""",
    ),
)
def true_precipitation(spark, sf_dir):
    return history.precipitation_7d(unified(spark, sf_dir))


@query("true_precipitation_batches", SQL["true_precipitation"])
def true_precipitation_batches(spark, sf_dir):
    return _carried_history(spark, sf_dir).select("h3_cell", "event_date", "precipitation_1d", "precipitation_true_7d")


_HOUR = 3_600_000


@query(
    "recent_maxima",
    sql(
        *BASE,
        UNIFIED,
        select="""SELECT a.seq, a.h3_cell, a.event_time, round(max(b.smoke), 6) + 0.0 AS max_smoke,
  round(max(b.co2), 6) + 0.0 AS max_co2, round(max(b.sensor_temperature), 6) + 0.0 AS max_sensor_temp,
  count(*) FILTER (b.source_type = 'sensor') AS sensor_alerts,
  max(b.event_time) FILTER (b.source_type = 'sensor') AS last_sensor_time,
  max(b.event_time) FILTER (b.source_type = 'fire') AS last_fire_time
FROM uni a JOIN uni b ON b.h3_cell = a.h3_cell AND b.event_time BETWEEN a.event_time - 36000000 AND a.event_time
GROUP BY a.seq, a.h3_cell, a.event_time""",
    ),
)
def recent_maxima(spark, sf_dir):
    """Ten hours instead of ten minutes, since a cell here has three events a day."""
    return _maxima(history.recent_maxima(unified(spark, sf_dir), span_ms=10 * _HOUR))


def _maxima(recent):
    return recent.select(
        "seq",
        "h3_cell",
        "event_time",
        F.col("max_smoke_10m").alias("max_smoke"),
        F.col("max_co2_10m").alias("max_co2"),
        F.col("max_sensor_temp_10m").alias("max_sensor_temp"),
        F.col("sensor_alerts_10m").alias("sensor_alerts"),
        "last_sensor_time",
        "last_fire_time",
    )


@query("recent_maxima_batches", SQL["recent_maxima"])
def recent_maxima_batches(spark, sf_dir):
    """Three batches; each reads the last ten hours of every cell besides its own events."""
    found, tail = [], None
    for batch in _in_time(materialise(unified(spark, sf_dir), "unified")):
        rows, tail = maxima_step(batch, tail, 10 * _HOUR)
        found.append(materialise(rows, "maxima"))
        tail = materialise(tail, "tail")
    return _maxima(found[0].unionByName(found[1]).unionByName(found[2]))


@query(
    "latest_weather",
    sql(
        *BASE,
        select=f"""SELECT h3_cell, event_time, {num("temperature", "humidity", "wind_speed", "precipitation",
  "soil_moisture", "vpd")} FROM (SELECT *, row_number() OVER (PARTITION BY h3_cell ORDER BY event_time DESC, seq DESC)
  AS rn FROM weather) WHERE rn = 1""",
    ),
)
def latest_weather(spark, sf_dir):
    return history.latest_weather(unified(spark, sf_dir))


__all__ = ["CELLS", "PREDICTION_COLUMNS", "WINDOWS", "slot"]
