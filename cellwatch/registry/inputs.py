"""Queries over decoding, clocks, snapshots, unified events and geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellwatch.functions import calendar as cal
from cellwatch.functions.scalars import round_half_up
from cellwatch.operators import enrich
from cellwatch.operators.cells import adjacency as cell_adjacency
from cellwatch.operators.cells import resolve_cell
from cellwatch.plans import driver_tables as dt
from cellwatch.plans.risk import RiskJob
from cellwatch.registry.common import (
    BASE,
    CELLS,
    EV,
    SNAPSHOTS,
    STATIC,
    UNIFIED,
    WEATHER,
    calendar,
    day,
    num,
    query,
    slot,
    sql,
)
from cellwatch.schemas import STATIC_COLUMNS
from cellwatch.sources import decode
from cellwatch.sources.dimensions import parse_cell_list, static_numeric

# ---- JSON decoding: the events as JSON text, damaged where k says so ----


def _json(**members):
    parts = [F.concat(F.lit(f'"{name}":'), value) for name, value in members.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _text(value):
    return F.concat(F.lit('"'), value, F.lit('"'))


def _plain(value):
    return value.cast("string")


def _damage(text):
    k = F.col("k")
    return (
        F.when(k == 11, F.concat(F.lit("{bad"), F.col("seq")))
        .when(k == 12, F.lit(""))
        .when(k == 18, F.lit("null"))
        .otherwise(text)
    )


def _keys():
    k = F.col("k")
    return {
        "h3Cell": F.when(k != 16, _text(F.col("h3_cell"))),
        "eventTime": F.when(k != 15, _plain(F.col("event_time"))),
        "eventDate": _text(F.when(k == 14, "2024-13-45").otherwise(F.date_format("event_date", "yyyy-MM-dd"))),
        "unknownField": F.when(k == 17, F.lit("[1,2]")),
    }


def raw_weather(spark, sf_dir):
    k = F.col("k")
    ev = dt.events(spark, sf_dir).filter(F.col("event_type").isin("view", "click", "signup"))
    text = _json(
        **_keys(),
        temperature=F.when(k == 13, _text(F.lit("hot"))).otherwise(_plain(F.col("value"))),
        humidity=F.when(k >= 90, _text(_plain(k))).otherwise(_plain(k)),
        windSpeed=F.when(k >= 50, _plain(F.col("value") * 0.25)),
        precipitation=F.lit("null"),
    )
    return ev.select("seq", _damage(text).alias("value"))


def raw_sensor(spark, sf_dir):
    k = F.col("k")
    ev = dt.events(spark, sf_dir).filter("event_type = 'error'")
    text = _json(
        **_keys(),
        co2=_plain(F.col("value") + 400.0),
        battery=F.when(k == 13, F.lit("true")).otherwise(_plain(k)),
        alertLevel=_text(F.when(k > 50, "HIGH").otherwise("MEDIUM")),
        fireRelated=F.when(k < 30, F.lit("true")).when(k < 60, F.lit("false")).when(k < 70, F.lit('"TRUE"')),
    )
    return ev.select("seq", _damage(text).alias("value"))


def raw_fire(spark, sf_dir):
    k = F.col("k")
    ev = dt.events(spark, sf_dir).filter("event_type = 'purchase'")
    text = _json(
        **_keys(),
        intensity=_plain(F.col("value")),
        declaredAt=F.when(k == 13, F.lit("1.5")).otherwise(_plain(F.col("event_time") + k * 60_000)),
        agentId=_text(F.concat(F.lit("AG_"), k)),
        cause=F.when(k > 20, _text(F.lit("HUMAN"))),
        declared=F.when(k >= 30, F.lit("true")).when(k >= 5, F.lit("false")),
    )
    return ev.select("seq", _damage(text).alias("value"))


# Rows that decode, and rows that also have their keys, in SQL.
_DECODED = "k NOT IN (11, 12, 13, 14, 18)"
_KEYED = f"{_DECODED} AND k NOT IN (15, 16)"


@query(
    "decode_weather",
    sql(
        EV,
        select=f"""SELECT seq, h3_cell, event_time, {day()}, {num("value")}, CAST(k AS DOUBLE) AS humidity,
  CASE WHEN k >= 50 THEN round(value * 0.25, 6) + 0.0 END AS wind_speed, NULL::DOUBLE AS precipitation
FROM ev WHERE event_type IN ('view', 'click', 'signup') AND {_KEYED}""",
    ),
)
def decode_weather(spark, sf_dir):
    rows = decode.accepted(decode.decode_events(raw_weather(spark, sf_dir), "weather"))
    return decode.require_keys(rows).select(
        "seq", "h3_cell", "event_time", "event_date", F.col("temperature").alias("value"), "humidity", "wind_speed",
        "precipitation",
    )


@query(
    "decode_sensor",
    sql(
        EV,
        select=f"""SELECT seq, h3_cell, event_time, {day()}, round(value + 400, 6) + 0.0 AS co2,
  CAST(k AS DOUBLE) AS battery, CASE WHEN k > 50 THEN 'HIGH' ELSE 'MEDIUM' END AS alert_level,
  CASE WHEN k < 30 THEN true WHEN k < 60 THEN false WHEN k < 70 THEN true END AS fire_related
FROM ev WHERE event_type = 'error' AND {_KEYED}""",
    ),
)
def decode_sensor(spark, sf_dir):
    rows = decode.accepted(decode.decode_events(raw_sensor(spark, sf_dir), "sensor"))
    return decode.require_keys(rows).select(
        "seq", "h3_cell", "event_time", "event_date", "co2", "battery", "alert_level", "fire_related"
    )


@query(
    "decode_fire",
    sql(
        EV,
        select=f"""SELECT seq, h3_cell, event_time, {day()}, round(value, 6) + 0.0 AS intensity,
  event_time + k * 60000 AS declared_at, 'AG_' || k AS agent_id, CASE WHEN k > 20 THEN 'HUMAN' END AS cause,
  CASE WHEN k >= 30 THEN true WHEN k >= 5 THEN false END AS declared
FROM ev WHERE event_type = 'purchase' AND {_KEYED}""",
    ),
)
def decode_fire(spark, sf_dir):
    rows = decode.accepted(decode.decode_events(raw_fire(spark, sf_dir), "fire"))
    return decode.require_keys(rows).select(
        "seq", "h3_cell", "event_time", "event_date", "intensity", "declared_at", "agent_id", "cause", "declared"
    )


@query(
    "decode_rejects",
    sql(
        EV,
        select="""SELECT CASE WHEN event_type = 'error' THEN 'sensor' WHEN event_type = 'purchase' THEN 'fire'
    ELSE 'weather' END AS kind,
  CASE WHEN k IN (11, 12, 18) THEN 'malformed_json' WHEN k = 14 THEN 'bad_date:eventDate'
    WHEN event_type = 'error' THEN 'bad_double:battery'
    WHEN event_type = 'purchase' THEN 'bad_bigint:declaredAt' ELSE 'bad_double:temperature' END AS reject_reason,
  count(*) AS n_rows
FROM ev WHERE k IN (11, 12, 13, 14, 18) GROUP BY ALL""",
    ),
)
def decode_rejects(spark, sf_dir):
    raw = {"weather": raw_weather, "sensor": raw_sensor, "fire": raw_fire}
    parts = [
        decode.quarantined(decode.decode_events(read(spark, sf_dir), kind)).withColumn("kind", F.lit(kind))
        for kind, read in raw.items()
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("kind", "reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "keyed_json",
    sql(
        EV,
        select="""SELECT h3_cell AS key, '{"h3Cell":"' || h3_cell || '","eventTime":' || event_time || ',"eventDate":"'
  || strftime(event_date, '%Y-%m-%d') || '","co2":' || CAST(value + 400 AS VARCHAR)
  || CASE WHEN k NOT BETWEEN 20 AND 24 THEN ',"smoke":' || CAST(CAST(k AS DOUBLE) AS VARCHAR) ELSE '' END
  || ',"battery":' || CAST(CAST(100 - k AS DOUBLE) AS VARCHAR) || ',"alertLevel":"HIGH","fireRelated":true}' AS value
FROM ev WHERE event_type = 'error'""",
    ),
)
def keyed_json(spark, sf_dir):
    rows = dt.sensors(dt.events(spark, sf_dir)).withColumns(
        {
            **{c: F.lit(None).cast("double") for c in ("lat", "lon", "sensor_temperature")},
            "alert_level": F.lit("HIGH"),
            "fire_related": F.lit(True),
        }
    )
    return decode.encode_events(rows, "sensor")


@query(
    "cell_list",
    sql(CELLS, select=f"SELECT h3_cell, {num('h3_center_lat', 'h3_center_lon')} FROM cells"),
)
def cell_list(spark, sf_dir):
    lines = dt.all_cells(spark, sf_dir).select(
        F.explode(
            F.array(
                F.concat_ws(", ", F.concat(F.lit(" "), "h3_cell"), "h3_center_lat", "h3_center_lon", F.lit("extra")),
                F.lit("  "),
                F.concat_ws(",", "h3_cell", "h3_center_lat"),
            )
        ).alias("value")
    )
    return parse_cell_list(lines)


@query(
    "static_latest",
    sql(
        """o AS (SELECT 'u' || o_custkey AS h3_cell, o_orderkey, o_totalprice,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 2 END AS pente_moy FROM orders)""",
        select=f"""SELECT h3_cell, {num("altitude_moy", "pente_moy")} FROM (
  SELECT h3_cell, o_totalprice AS altitude_moy, pente_moy,
         row_number() OVER (PARTITION BY h3_cell ORDER BY o_orderkey DESC) AS rn FROM o) WHERE rn = 1""",
    ),
)
def static_latest(spark, sf_dir):
    rows = dt.table(spark, sf_dir, "orders").withColumns(
        {
            "h3_cell": F.concat(F.lit("u"), F.col("o_custkey")),
            "altitude_moy": F.col("o_totalprice"),
            "pente_moy": F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 2),
            **{c: F.lit(None).cast("double") for c in STATIC_COLUMNS[2:]},
        }
    )
    return static_numeric(rows, F.col("o_orderkey")).select("h3_cell", "altitude_moy", "pente_moy")


# ---- calendar, clocks, rounding ----


@query(
    "calendar_features",
    f"""SELECT o_orderkey, {day()}, month, {num("month_sin", "month_cos", "doy_sin", "doy_cos")}, day_of_year, is_weekend
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS event_date, {calendar("o_orderdate")},
  CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year FROM orders)""",
)
def calendar_features(spark, sf_dir):
    rows = dt.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("event_date"))
    date = F.col("event_date")
    return rows.select(
        "o_orderkey", "event_date", *cal.calendar_columns(date), cal.day_of_year(date).alias("day_of_year")
    )


@query(
    "clocks",
    sql(
        EV,
        select=f"""SELECT seq, {day()}, {slot("event_time")} AS slot,
  (event_date - DATE '1970-01-01')::BIGINT * 86400000 + (8 - 1) * 3600000 AS local_eight,
  (event_date - DATE '1970-01-01')::BIGINT * 86400000 - 3600000 + k * 60000 AS local_offset FROM ev""",
    ),
)
def clocks(spark, sf_dir):
    date = F.col("event_date")
    return dt.events(spark, sf_dir).select(
        "seq",
        cal.utc_date(F.col("event_time")).alias("event_date"),
        cal.slot_label(F.col("event_time")).alias("slot"),
        cal.local_hour_epoch(date, 8).alias("local_eight"),
        cal.local_day_start_plus(date, F.col("k").cast("bigint") * 60_000).alias("local_offset"),
    )


@query(
    "rounding",
    """SELECT l_orderkey, l_linenumber, l_partkey, floor(x * 100 + 0.5) / 100 AS r2, floor(x * 1000 + 0.5) / 1000 AS r3,
  floor(x * 10000 + 0.5) / 10000 AS r4, floor(-l_quantity * 0.125 * 100 + 0.5) / 100 AS below_zero
FROM (SELECT *, l_extendedprice * l_discount / 7 AS x FROM lineitem)""",
)
def rounding(spark, sf_dir):
    x = F.col("l_extendedprice") * F.col("l_discount") / 7
    return dt.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        *[round_half_up(x, n).alias(f"r{n}") for n in (2, 3, 4)],
        round_half_up(-F.col("l_quantity") * 0.125, 2).alias("below_zero"),
    )


@query(
    "date_ranges",
    """SELECT strftime(d, '%Y-%m-%d') AS event_date, count(*) AS n_orders FROM (
  SELECT unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + 2, INTERVAL 1 DAY)) AS d
  FROM orders) GROUP BY ALL""",
)
def date_ranges(spark, sf_dir):
    start = F.col("o_orderdate").cast("date")
    days = dt.table(spark, sf_dir, "orders").select(
        F.explode(cal.date_range(start, F.date_add(start, 2))).alias("event_date")
    )
    return days.groupBy("event_date").agg(F.count(F.lit(1)).alias("n_orders"))


# ---- snapshots and unified events ----

_SNAP_NUM = [
    "h3_center_lat", "h3_center_lon", "altitude_moy", "pente_moy", "dist_route_m", "dist_urbain_m", "humidity_min",
    "temperature_moy", "wind_speed_max", "precipitation_1d_mm", "precipitation_7d_sum_mm", "soil_moisture", "vpd_kpa",
    "ndvi_30d_mean", "ndvi_30d_min", "ndvi_30d_std",
]
SNAPSHOT_SELECT = (
    f"h3_cell, h3_commune, event_time, {day()}, {num(*_SNAP_NUM)}, month, "
    f"{num('month_sin', 'month_cos', 'doy_sin', 'doy_cos')}, is_weekend"
)


@query("feature_snapshots", sql(*BASE, SNAPSHOTS, select=f"SELECT seq, {SNAPSHOT_SELECT} FROM snap"))
def feature_snapshots(spark, sf_dir):
    weather = dt.weather(dt.events(spark, sf_dir))
    return enrich.weather_snapshots(weather, dt.static(spark, sf_dir), extra=("seq",))


@query(
    "static_misses",
    sql(
        *BASE,
        select="""SELECT h3_cell, count(*) AS n_events FROM weather
WHERE h3_cell NOT IN (SELECT h3_cell FROM st) GROUP BY h3_cell""",
    ),
)
def static_misses(spark, sf_dir):
    return enrich.static_misses(dt.weather(dt.events(spark, sf_dir)), dt.static(spark, sf_dir))


_UNIFIED_NUM = num(
    "temperature", "humidity", "wind_speed", "precipitation", "soil_moisture", "vpd", "co2", "smoke",
    "sensor_temperature", "battery", "intensity", "burned_area", of="u.",
)
_UNIFIED_SELECT = f"""SELECT u.seq, u.h3_cell, u.event_time, {day(of="u.")}, u.source_type, {_UNIFIED_NUM},
  u.fire_declared, {num(*STATIC_COLUMNS, of="st.")}
FROM uni u LEFT JOIN st ON st.h3_cell = u.h3_cell"""


def unified(spark, sf_dir):
    ev, static = dt.events(spark, sf_dir), dt.static(spark, sf_dir)
    control = enrich.control_events(
        enrich.unify_sensor(dt.sensors(ev), static, extra=("seq",)),
        enrich.unify_fire(dt.fires(ev), static, extra=("seq",)),
    )
    return control.unionByName(enrich.unify_weather(dt.weather(ev), static, extra=("seq",)))


def unified_alone(spark, sf_dir):
    """All events without the dimension's columns."""
    ev = dt.events(spark, sf_dir)
    control = enrich.control_events(
        enrich.unify_sensor(dt.sensors(ev), None, extra=("seq",)), enrich.unify_fire(dt.fires(ev), None, extra=("seq",))
    )
    return control.unionByName(enrich.unify_weather(dt.weather(ev), None, extra=("seq",)))


@query("unified_events", sql(*BASE, UNIFIED, select=_UNIFIED_SELECT))
def unified_events(spark, sf_dir):
    return unified(spark, sf_dir).drop("lat", "lon")


@query("control_events", sql(*BASE, UNIFIED, select=_UNIFIED_SELECT + " WHERE u.source_type <> 'meteo'"))
def control(spark, sf_dir):
    ev, static = dt.events(spark, sf_dir), dt.static(spark, sf_dir)
    return enrich.control_events(
        enrich.unify_sensor(dt.sensors(ev), static, extra=("seq",)),
        enrich.unify_fire(dt.fires(ev), static, extra=("seq",)),
    ).drop("lat", "lon")


# ---- geometry ----

_KM = """12742.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, pow(sin(radians(b.h3_center_lat - a.lat) / 2), 2)
  + cos(radians(a.lat)) * cos(radians(b.h3_center_lat)) * pow(sin(radians(b.h3_center_lon - a.lon) / 2), 2))))"""


@query(
    "nearest_cell",
    sql(
        EV,
        CELLS,
        STATIC,
        """pts AS (
  SELECT e.seq, e.h3_cell, CASE WHEN k < 95 THEN h3_center_lat + (k - 50) * 0.0001::DOUBLE END AS lat,
         CASE WHEN k < 95 THEN h3_center_lon + (seq % 11 - 5) * 0.0011::DOUBLE END AS lon
  FROM ev e JOIN cells c ON c.h3_cell = e.h3_cell WHERE event_type IN ('view', 'click', 'signup'))""",
        f"""near AS (
  SELECT a.seq, b.h3_cell AS cell, {_KM} AS km
  FROM pts a JOIN st b ON abs(a.lat - b.h3_center_lat) < 0.02 AND abs(a.lon - b.h3_center_lon) < 0.02)""",
        """best AS (
  SELECT seq, arg_min(cell, km) AS cell FROM near WHERE km <= 0.9 GROUP BY seq)""",
        select="""SELECT p.seq, coalesce(b.cell, p.h3_cell) AS h3_cell FROM pts p LEFT JOIN best b ON b.seq = p.seq""",
    ),
)
def nearest_cell(spark, sf_dir):
    return resolve_cell(dt.placed_weather(spark, sf_dir), dt.index(spark, sf_dir)).select("seq", "h3_cell")


ADJACENCY = f"""adj AS (
  SELECT a.h3_cell, b.h3_cell AS neighbor
  FROM (SELECT h3_cell, h3_center_lat AS lat, h3_center_lon AS lon FROM st) a
  JOIN st b ON abs(a.lat - b.h3_center_lat) < 0.03 AND a.h3_cell <> b.h3_cell
  WHERE {_KM} <= 1.3)"""


@query("adjacency", sql(CELLS, STATIC, ADJACENCY, select="SELECT h3_cell, neighbor FROM adj"))
def adjacency(spark, sf_dir):
    return dt.touching(spark, sf_dir)


@query("adjacency_of_repeated_cells", sql(CELLS, STATIC, ADJACENCY, select="SELECT h3_cell, neighbor FROM adj"))
def adjacency_of_repeated_cells(spark, sf_dir):
    """A dimension that lists every cell three times gives every pair once."""
    static = dt.static(spark, sf_dir)
    return cell_adjacency(static.unionByName(static).unionByName(static))


@query(
    "snapshots_of_repeated_cells",
    sql(*BASE, SNAPSHOTS, select=f"SELECT seq, {SNAPSHOT_SELECT} FROM snap"),
)
def snapshots_of_repeated_cells(spark, sf_dir):
    """A dimension with outdated rows: the job takes the last row of a cell."""
    static = dt.static(spark, sf_dir)
    old = static.withColumns({"altitude_moy": F.col("altitude_moy") - 1, "pente_moy": F.lit(-5.0)})
    both = old.withColumn("version", F.lit(1)).unionByName(static.withColumn("version", F.lit(2)))
    job = RiskJob(both, None, None, static_order="version")
    return job.snapshots(dt.weather(dt.events(spark, sf_dir)))


__all__ = ["ADJACENCY", "SNAPSHOT_SELECT", "WEATHER", "unified", "unified_alone"]
