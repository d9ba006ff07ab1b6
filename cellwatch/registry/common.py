"""Registering queries with their SQL twins, and SQL pieces they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellwatch.plans import driver_tables as dt

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: comparable(fn(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to 6 digits and dates as text, so that two engines can be compared."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            out.append((F.round(c, 6) + F.lit(0.0)).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            out.append(F.date_format(c, "yyyy-MM-dd").alias(f.name))
        else:
            out.append(c.alias(f.name))
    return df.select(*out)


def num(*names: str, of: str = "") -> str:
    """SQL list of doubles rounded like ``comparable`` does."""
    return ", ".join(f"round({of}{n}, 6) + 0.0 AS {n}" for n in names)


def day(name: str = "event_date", of: str = "") -> str:
    return f"strftime({of}{name}, '%Y-%m-%d') AS {name}"


EV = """ev AS (
  SELECT event_id AS seq, 'u' || user_id AS h3_cell, epoch_us(ts) // 1000 AS event_time, CAST(ts AS DATE) AS event_date,
         event_type, value, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
         CASE WHEN event_id % 5 <> 0 THEN 36.0::DOUBLE + (event_id % 97) * 0.01::DOUBLE END AS lat,
         CASE WHEN event_id % 7 <> 0 THEN 3.0::DOUBLE + (event_id % 89) * 0.01::DOUBLE END AS lon
  FROM events)"""

CELLS = f"""cells AS (
  SELECT 'u' || c_custkey AS h3_cell, c_acctbal AS altitude_moy, CAST(c_nationkey AS DOUBLE) AS pente_moy,
         CAST(c_custkey * 10 AS DOUBLE) AS dist_route_m,
         CASE WHEN c_nationkey <> 3 THEN CAST(c_custkey * 25 AS DOUBLE) END AS dist_urbain_m,
         CAST(c_nationkey + 1 AS DOUBLE) / 32 AS ndvi_30d_mean, CAST(c_nationkey + 1 AS DOUBLE) / 64 AS ndvi_30d_min,
         CAST(c_nationkey + 1 AS DOUBLE) / 128 AS ndvi_30d_std,
         {dt.LAT_ZERO}::DOUBLE + (c_custkey // {dt.LATTICE_COLUMNS})::DOUBLE * {dt.LAT_STEP}::DOUBLE AS h3_center_lat,
         {dt.LON_ZERO}::DOUBLE + ((c_custkey % {dt.LATTICE_COLUMNS})::DOUBLE
           + ((c_custkey // {dt.LATTICE_COLUMNS}) % 2)::DOUBLE * 0.5::DOUBLE) * {dt.LON_STEP}::DOUBLE AS h3_center_lon,
         c_mktsegment
  FROM customer)"""

STATIC = f"""st AS (SELECT * FROM cells WHERE c_mktsegment <> '{dt.NO_STATIC_SEGMENT}')"""

WEATHER = """weather AS (
  SELECT seq, h3_cell, event_time, event_date, value AS temperature,
         CASE WHEN k NOT BETWEEN 20 AND 24 THEN CAST(k AS DOUBLE) END AS humidity,
         value * 0.25::DOUBLE AS wind_speed,
         CASE WHEN k NOT BETWEEN 30 AND 39 THEN CAST(k AS DOUBLE) / 8 END AS precipitation,
         CAST(k AS DOUBLE) / 256 AS soil_moisture, value / 2 AS vpd, lat, lon
  FROM ev WHERE event_type IN ('view', 'click', 'signup'))"""

UNIFIED = """uni AS (
  SELECT seq, h3_cell, event_time, event_date, 'meteo' AS source_type, temperature, humidity, wind_speed,
         precipitation, soil_moisture, vpd, NULL::DOUBLE AS co2, NULL::DOUBLE AS smoke,
         NULL::DOUBLE AS sensor_temperature, NULL::DOUBLE AS battery, NULL::INTEGER AS fire_declared,
         NULL::DOUBLE AS intensity, NULL::DOUBLE AS burned_area, lat, lon
  FROM weather
  UNION ALL
  SELECT seq, h3_cell, event_time, event_date, 'sensor', NULL, NULL, NULL, NULL, NULL, NULL, value + 400,
         CASE WHEN k NOT BETWEEN 20 AND 24 THEN CAST(k AS DOUBLE) END, value / 2, CAST(100 - k AS DOUBLE),
         NULL, NULL, NULL, lat, lon
  FROM ev WHERE event_type = 'error'
  UNION ALL
  SELECT seq, h3_cell, event_time, event_date, 'fire', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
         CASE WHEN k >= 30 THEN 1 ELSE 0 END, value, CASE WHEN k <= 90 THEN CAST(k AS DOUBLE) / 8 END, lat, lon
  FROM ev WHERE event_type = 'purchase')"""

TURN = "2 * pi() *"


def calendar(date: str) -> str:
    return f"""CAST(month({date}) AS INTEGER) AS month,
         sin({TURN} month({date}) / 12.0::DOUBLE) AS month_sin, cos({TURN} month({date}) / 12.0::DOUBLE) AS month_cos,
         sin({TURN} dayofyear({date}) / 365.0::DOUBLE) AS doy_sin,
         cos({TURN} dayofyear({date}) / 365.0::DOUBLE) AS doy_cos,
         CASE WHEN isodow({date}) >= 6 THEN 1 ELSE 0 END AS is_weekend"""


SNAPSHOTS = f"""snap AS (
  SELECT w.seq, w.h3_cell, w.h3_cell AS h3_commune, w.event_time, w.event_date, st.h3_center_lat, st.h3_center_lon,
         st.altitude_moy, st.pente_moy, st.dist_route_m, st.dist_urbain_m, w.humidity AS humidity_min,
         w.temperature AS temperature_moy, w.wind_speed AS wind_speed_max, w.precipitation AS precipitation_1d_mm,
         w.precipitation AS precipitation_7d_sum_mm, w.soil_moisture, w.vpd AS vpd_kpa, st.ndvi_30d_mean,
         st.ndvi_30d_min, st.ndvi_30d_std, {calendar("w.event_date")}
  FROM weather w JOIN st ON w.h3_cell = st.h3_cell)"""

ENCODER = f"""enc AS (
  SELECT class, CAST(row_number() OVER (ORDER BY class) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT h3_cell AS class FROM cells WHERE c_mktsegment <> '{dt.NO_CODE_SEGMENT}'))"""


def real(x: str) -> str:
    return f"CAST(CAST(coalesce({x}, 0) AS REAL) AS DOUBLE)"


def z_score(alias: str, code: str = "enc.code") -> str:
    return (
        f"(({real(alias + '.temperature_moy')} - 40) * 0.03::DOUBLE"
        f" + (50 - {real(alias + '.humidity_min')}) * 0.01::DOUBLE + {real(code)} * 0.0005::DOUBLE)"
    )


def scores(source: str, name: str, extra: str = "") -> str:
    """CTE ``name``: rows of ``source`` with p1, p2, class shares, class, probability and level."""
    return f"""{name}_p AS (
  SELECT s.*, 1 / (1 + exp(-({z_score("s")} - 0.0::DOUBLE))) AS p1,
         1 / (1 + exp(-({z_score("s")} - 0.4::DOUBLE))) AS raw2
  FROM {source} s JOIN enc ON enc.class = s.h3_commune),
{name}_c AS (SELECT *, least(raw2, p1) AS p2 FROM {name}_p),
{name} AS (
  SELECT *, CASE WHEN p2 >= 0.7 THEN 2 WHEN p1 >= 0.55 THEN 1 ELSE 0 END AS prediction,
         floor((CASE WHEN p2 >= 0.7 THEN p2 WHEN p1 >= 0.55 THEN p1 - p2 ELSE 1 - p1 END
                / ((1 - p1) + (p1 - p2) + p2)) * 10000 + 0.5) / 10000 AS probability,
         CASE WHEN p2 >= 0.7 THEN 'HIGH' WHEN p1 >= 0.55 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM {name}_c)"""


def slot(ms: str) -> str:
    """The local zone has been one hour ahead of UTC all year since 1981."""
    return f"lpad(CAST((({ms} // 3600000) + 1) % 24 AS VARCHAR), 2, '0') || ':00'"


def sql(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


BASE = (EV, CELLS, STATIC, WEATHER)
