"""Request and response records of an external scoring service, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.functions.scalars import first_not_blank_or_null, round_half_up
from cellwatch.operators.scoring import MODEL_FEATURES, chosen, risk_name

# Short feature names accepted in requests. Every other accepted
# name is its own alias and needs no entry.
ALIASES = {
    "temperature_moy": "temperature_moy(°C)",
    "humidity_min": "humidity_min(%)",
    "wind_speed_max": "wind_speed_max(km/h)",
}

# Member names of responses and the level of a refused cell.
REFUSED_LEVEL = "REJECTED_UNKNOWN_H3"
_RESPONSE = (
    "prediction_status string, known_h3 string, prediction struct<risk_level: string, "
    "probabilities: struct<class_0: string, class_1: string, class_2: string>>"
)


def request_json(snapshots: DataFrame, keep: list[str]) -> DataFrame:
    """``{"data": {...}}`` with the model's feature names; null members are left out."""
    members = [
        first_not_blank_or_null(F.col("h3_commune"), F.col("h3_cell")).alias("h3_commune"),
        *[F.col(column).alias(name) for name, column in MODEL_FEATURES.items() if name != "h3_commune"],
    ]
    return snapshots.select(*keep, F.to_json(F.struct(F.struct(*members).alias("data"))).alias("request"))


def parse_request(df: DataFrame, value: str = "request") -> DataFrame:
    """The ``data`` object of a request as a map of texts in ``data``."""
    return df.withColumn("data", F.from_json(F.get_json_object(F.col(value), "$.data"), "map<string,string>"))


def normalise_aliases(data: Column) -> Column:
    """Adds the full name for every short name whose full name is absent."""
    added = [
        F.when(
            F.map_contains_key(data, short) & ~F.map_contains_key(data, full),
            F.struct(F.lit(full).alias("key"), data[short].alias("value")),
        )
        for short, full in ALIASES.items()
    ]
    return F.map_concat(data, F.map_from_entries(F.array_compact(F.array(*added))))


def missing_features(data: Column, required: list[str] | None = None) -> Column:
    """Names of required features that the map lacks, in feature order."""
    names = F.array(*[F.lit(n) for n in (required or MODEL_FEATURES)])
    return F.filter(names, lambda n: ~F.map_contains_key(data, n))


def _largest(p0: Column, p1: Column, p2: Column) -> Column:
    """Index of the largest; ties go to the higher class."""
    return F.when((p2 >= p1) & (p2 >= p0), 2).when(p1 >= p0, 1).otherwise(0)


def decode_response(df: DataFrame, value: str = "response") -> DataFrame:
    """Class, probability and risk level from response text.

    Unknown cells come back as class 0 with their own level. A response without
    a prediction object has ``reject_reason`` set and no class.
    """
    members = F.from_json(F.col(value), _RESPONSE)
    parsed = df.select("*", F.inline(F.array(members)).alias("_status", "_known", "_prediction"))
    shares = [F.coalesce(F.col(f"_prediction.probabilities.class_{i}").try_cast("double"), F.lit(0.0)) for i in range(3)]
    refused = F.coalesce(F.col("_status") == "rejected_unknown_h3", F.lit(False)) | F.coalesce(
        F.lower("_known") != "true", F.lit(False)
    )
    out = parsed.select(
        *df.columns,
        refused.alias("_refused"),
        F.when(~refused & F.col("_prediction").isNull(), "missing_prediction").alias("reject_reason"),
        F.col("_prediction.risk_level").try_cast("double").cast("int").alias("_level"),
        *[s.alias(f"_p{i}") for i, s in enumerate(shares)],
    ).withColumn("_class", F.coalesce("_level", _largest(F.col("_p0"), F.col("_p1"), F.col("_p2"))))
    usable = ~F.col("_refused") & F.col("reject_reason").isNull()
    level_name = F.coalesce(risk_name(F.when(F.col("_class").isin(1, 2), F.col("_class"))), F.lit("LOW"))
    return out.select(
        *df.columns,
        F.when(F.col("_refused"), 0).when(usable, F.col("_class")).alias("prediction"),
        F.when(F.col("_refused"), 0.0)
        .when(usable, round_half_up(chosen("_class", "_p0", "_p1", "_p2"), 4))
        .alias("probability"),
        F.when(F.col("_refused"), REFUSED_LEVEL).when(usable, level_name).alias("risk_level"),
        "reject_reason",
    )
