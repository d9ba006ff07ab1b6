"""JSON event text to typed rows, with a reason for every row that is refused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.functions.calendar import strict_date
from cellwatch.functions.scalars import whole_number
from cellwatch.schemas import EVENT_FIELDS

REASON = "reject_reason"
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}

# JSON field to column name of the typed rows.
COLUMN_NAMES = {
    "h3Cell": "h3_cell",
    "eventTime": "event_time",
    "eventDate": "event_date",
    "windSpeed": "wind_speed",
    "soilMoisture": "soil_moisture",
    "sensorTemperature": "sensor_temperature",
    "alertLevel": "alert_level",
    "fireRelated": "fire_related",
    "declaredAt": "declared_at",
    "agentId": "agent_id",
    "burnedArea": "burned_area",
}


def _typed(text: Column, kind: str) -> Column:
    if kind == "double":
        return text.try_cast("double")
    if kind == "bigint":
        return whole_number(text)
    if kind == "date":
        return strict_date(text)
    if kind == "boolean":
        # A quoted word other than true counts as false; a number is an error.
        return F.when(text.try_cast("double").isNull(), F.lower(F.trim(text)) == "true")
    return text


def decode_events(raw: DataFrame, kind: str, value: str = "value") -> DataFrame:
    """Typed columns next to the other input columns, plus ``reject_reason``.

    Fields are read as text and cast one by one: a number in quotes is
    accepted, while one unreadable field refuses the whole row instead of
    leaving a silent null. Unknown fields are ignored, missing ones are null.
    """
    fields = EVENT_FIELDS[kind]
    schema = ", ".join(f"{f} string" for f in fields) + ", _corrupt string"
    # Parsed through a generator: a filter on the result stays above it, so
    # each text is parsed once however many conditions look at its fields.
    members = F.from_json(F.col(value), schema, _PERMISSIVE)
    keep = [c for c in raw.columns if c != value]
    parsed = raw.select(*keep, F.col(value).alias("raw"), F.inline(F.array(members)).alias(*[f"_{f}" for f in fields], "_corrupt"))
    typed = {f: _typed(F.col(f"_{f}"), t) for f, t in fields.items()}
    reason = F.when(
        F.col("raw").isNull() | (F.trim(F.col("raw")) == "") | F.col("_corrupt").isNotNull(), "malformed_json"
    )
    for f, t in fields.items():
        if t != "string":
            reason = reason.when(F.col(f"_{f}").isNotNull() & typed[f].isNull(), f"bad_{t}:{f}")
    return parsed.select(
        *keep,
        "raw",
        reason.alias(REASON),
        *[typed[f].alias(COLUMN_NAMES.get(f, f)) for f in fields],
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(REASON).isNull()).drop(REASON, "raw")


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(REASON).isNotNull()).select("raw", REASON)


def require_keys(df: DataFrame, cell: str = "h3_cell") -> DataFrame:
    """Rows that have a cell, an event date and an event time."""
    return df.dropna(subset=[cell, "event_date", "event_time"])


def event_json(kind: str) -> Column:
    """The JSON text of a typed event row; null fields are left out of the object."""
    members = []
    for f, t in EVENT_FIELDS[kind].items():
        column = F.col(COLUMN_NAMES.get(f, f))
        members.append((F.date_format(column, "yyyy-MM-dd") if t == "date" else column).alias(f))
    return F.to_json(F.struct(*members))


def encode_events(df: DataFrame, kind: str, key: str = "h3_cell") -> DataFrame:
    """Rows back to keyed JSON text."""
    return df.select(F.col(key).alias("key"), event_json(kind).alias("value"))
