"""Stored weather-service payloads: parallel daily and hourly arrays per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.functions.calendar import strict_date
from cellwatch.functions.scalars import round_half_up, rounded_element

# Names of the payload members and the measures they give.
DAILY_MEMBERS = {
    "temperature_2m_mean": "temperature",
    "relative_humidity_2m_min": "humidity",
    "wind_speed_10m_max": "wind_speed",
    "precipitation_sum": "precipitation",
    "vapour_pressure_deficit_max": "vpd",
}
HOURLY_MEMBER = "soil_moisture_0_to_1cm"

PAYLOAD_SCHEMA = (
    "daily struct<time: array<string>, "
    + ", ".join(f"{m}: array<double>" for m in DAILY_MEMBERS)
    + f">, hourly struct<time: array<string>, {HOURLY_MEMBER}: array<double>>"
)


def parse_payload(df: DataFrame, value: str = "payload") -> DataFrame:
    return df.withColumn("_p", F.from_json(F.col(value), PAYLOAD_SCHEMA))


def daily_mean(date_text: Column, times: Column, values: Column) -> Column:
    """Mean of the hourly values stamped with a date, rounded to 3; null if none.

    Stays inside the row, so the payload is never exploded and regrouped.
    """
    pairs = F.arrays_zip(times.alias("t"), values.alias("v"))
    of_day = F.filter(pairs, lambda p: p["t"].startswith(date_text) & p["v"].isNotNull())
    total = F.aggregate(of_day, F.lit(0.0), lambda acc, p: acc + p["v"])
    return round_half_up(F.when(F.size(of_day) > 0, total / F.size(of_day)), 3)


def _hourly_sums() -> Column:
    """Map from a day to the sum and count of its hourly values, in one pass over them.

    The readings are sorted by day and position, summed in a running total, and
    a total is put away when the day changes.
    """
    pairs = F.arrays_zip(
        F.coalesce("_p.hourly.time", F.array().cast("array<string>")).alias("t"),
        F.coalesce(f"_p.hourly.{HOURLY_MEMBER}", F.array().cast("array<double>")).alias("v"),
    )
    readings = F.transform(
        pairs, lambda p, i: F.struct(F.substring(p["t"], 1, 10).alias("day"), i.alias("i"), p["v"].alias("v"))
    )
    in_order = F.sort_array(F.filter(readings, lambda r: r["day"].isNotNull() & r["v"].isNotNull()))
    day_type = "struct<key:string,value:struct<total:double,n:int>>"
    start = F.struct(
        F.lit(None).cast(day_type).alias("open"), F.array().cast(f"array<{day_type}>").alias("done")
    )

    def entry(day: Column, total: Column, n: Column) -> Column:
        return F.struct(day.alias("key"), F.struct(total.alias("total"), n.alias("n")).alias("value"))

    def add(acc: Column, r: Column) -> Column:
        at = acc["open"]
        same = at["key"] == r["day"]
        more = entry(r["day"], at["value"]["total"] + r["v"], at["value"]["n"] + 1)
        put_away = F.when(at.isNull() | same, acc["done"]).otherwise(F.concat(acc["done"], F.array(at)))
        return F.struct(
            F.when(same, more).otherwise(entry(r["day"], r["v"], F.lit(1))).alias("open"), put_away.alias("done")
        )

    return F.aggregate(
        in_order, start, add, lambda acc: F.map_from_entries(F.concat(acc["done"], F.array_compact(F.array(acc["open"]))))
    )


def flatten_payload(df: DataFrame, keep: list[str], value: str = "payload") -> DataFrame:
    """One row per payload and day; the first entry of a day counts.

    Everything happens inside the row: nothing is shuffled and no row id is
    needed, so it runs on streams as well.
    """

    def listed(name: str, kind: str) -> Column:
        return F.coalesce(F.col(name), F.array().cast(f"array<{kind}>"))

    daily = [listed(f"_p.daily.{m}", "double").alias(n) for m, n in DAILY_MEMBERS.items()]
    entries = F.arrays_zip(listed("_p.daily.time", "string").alias("time"), *daily)
    rows = parse_payload(df, value).select(*keep, entries.alias("_days"), _hourly_sums().alias("_per_day"))
    rows = rows.withColumn("_names", F.transform("_days", lambda d: d["time"]))
    out = rows.select(*keep, "_names", "_per_day", F.posexplode("_days").alias("_at", "_d"))
    hourly = F.col("_per_day")[F.col("_d.time")]
    return out.filter(F.array_position("_names", F.col("_d.time")) == F.col("_at") + 1).select(
        *keep,
        strict_date(F.col("_d.time")).alias("event_date"),
        *[round_half_up(F.col(f"_d.{n}"), 3).alias(n) for n in DAILY_MEMBERS.values()],
        round_half_up(hourly["total"] / hourly["n"], 3).alias("soil_moisture"),
    )


def payload_day(df: DataFrame, keep: list[str], date: Column, fallback: dict[str, Column], value: str = "payload"):
    """Weather of one wanted date per payload row, or the fallback values.

    The fallback applies as a whole, when the payload has no such day at all.
    """
    parsed = parse_payload(df, value)
    date_text = F.date_format(date, "yyyy-MM-dd")
    position = F.array_position(F.col("_p.daily.time"), date_text)
    found = F.coalesce(position > 0, F.lit(False))
    index = (position - 1).cast("int")
    measures = {
        name: rounded_element(F.col(f"_p.daily.{member}"), index) for member, name in DAILY_MEMBERS.items()
    }
    measures["soil_moisture"] = daily_mean(
        date_text, F.col("_p.hourly.time"), F.col(f"_p.hourly.{HOURLY_MEMBER}")
    )
    return parsed.select(
        *keep,
        date.alias("event_date"),
        found.alias("from_payload"),
        *[
            F.when(found, m).otherwise(fallback.get(name, F.lit(None).cast("double"))).alias(name)
            for name, m in measures.items()
        ],
    )
