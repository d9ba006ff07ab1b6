"""Ordinal risk: feature vectors, scorers, classes and prediction rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.functions.calendar import slot_label
from cellwatch.functions.scalars import round_half_up
from cellwatch.operators.encode import encode_strict, fill_cell_ids, known
from cellwatch.operators.enrich import refuse
from cellwatch.schemas import PREDICTION_SCHEMA

# The model's features in order, with the snapshot column of each.
MODEL_FEATURES = {
    "h3_commune": "code",
    "h3_center_lat": "h3_center_lat",
    "h3_center_lon": "h3_center_lon",
    "altitude_moy": "altitude_moy",
    "pente_moy": "pente_moy",
    "dist_route_m": "dist_route_m",
    "dist_urbain_m": "dist_urbain_m",
    "humidity_min(%)": "humidity_min",
    "temperature_moy(°C)": "temperature_moy",
    "wind_speed_max(km/h)": "wind_speed_max",
    "precipitation_1d_mm": "precipitation_1d_mm",
    "precipitation_7d_sum_mm": "precipitation_7d_sum_mm",
    "soil_moisture": "soil_moisture",
    "VPD_kPa": "vpd_kpa",
    "NDVI_30d_mean": "ndvi_30d_mean",
    "NDVI_30d_min": "ndvi_30d_min",
    "NDVI_30d_std": "ndvi_30d_std",
    "month": "month",
    "month_sin": "month_sin",
    "month_cos": "month_cos",
    "doy_sin": "doy_sin",
    "doy_cos": "doy_cos",
    "is_weekend": "is_weekend",
}


@dataclass(frozen=True)
class Thresholds:
    """Fixed default values of the two decision thresholds."""

    medium: float = 0.55
    high: float = 0.70


def feature_text(name: str) -> str:
    """SQL text of one feature: float32, null as 0."""
    if name not in MODEL_FEATURES:
        raise ValueError(f"unsupported feature: {name}")
    return f"coalesce(CAST({MODEL_FEATURES[name]} AS FLOAT), CAST(0 AS FLOAT))"


def feature_vector(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Adds ``features``: float32 values in list order, null as 0."""
    names = list(MODEL_FEATURES) if features is None else features
    if not names:
        raise ValueError("the feature list is empty")
    return df.withColumn("features", F.expr(f"array({', '.join(feature_text(n) for n in names)})"))


class Scorer(Protocol):
    """Adds ``p_ge_1`` and ``p_ge_2`` to rows that have ``features``."""

    def apply(self, df: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class ColumnScorer:
    """Both probabilities as column expressions; stays in generated code."""

    ge_1: Callable[[], Column]
    ge_2: Callable[[], Column]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"p_ge_1": self.ge_1(), "p_ge_2": self.ge_2()})


@dataclass(frozen=True)
class BatchScorer:
    """Two models called once per Arrow batch.

    ``load`` runs once per Python worker and returns two functions from a
    float32 matrix to whatever a classifier gives (``positive_class``).
    """

    load: Callable[[], tuple[Callable[[np.ndarray], object], Callable[[np.ndarray], object]]]
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def apply(self, df: DataFrame) -> DataFrame:
        load, key = self.load, self.key

        @F.pandas_udf("p_ge_1 double, p_ge_2 double")
        def positive(vectors: pd.Series) -> pd.DataFrame:
            from cellwatch.operators import loaded_models

            ge_1, ge_2 = loaded_models.get(key, load)
            if not len(vectors):
                return pd.DataFrame({"p_ge_1": np.empty(0), "p_ge_2": np.empty(0)})
            matrix = np.stack(vectors.to_numpy()).astype(np.float32)
            return pd.DataFrame({"p_ge_1": positive_class(ge_1(matrix)), "p_ge_2": positive_class(ge_2(matrix))})

        scored = df.withColumn("_s", positive("features"))
        return scored.withColumns({"p_ge_1": F.col("_s.p_ge_1"), "p_ge_2": F.col("_s.p_ge_2")}).drop("_s")


def positive_class(output) -> np.ndarray:
    """Probability of class 1 from the shapes classifiers return.

    A list of ``{class: probability}`` maps, an (n, 2) matrix, or one column.
    """
    if isinstance(output, list) and output and isinstance(output[0], dict):
        return np.array([m.get(1, m.get("1", 0.0)) for m in output], float)
    values = np.asarray(output, float)
    if values.ndim == 2 and values.shape[1] >= 2:
        return values[:, 1]
    if values.ndim == 1 or (values.ndim == 2 and values.shape[1] == 1):
        return values.reshape(-1)
    raise ValueError(f"no class probabilities in an output of shape {values.shape}")


def ordinal_classes(df: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Classes from P(y>=1) and P(y>=2).

    P(y>=2) is held below P(y>=1), the three class probabilities are scaled to
    one, and the class comes from the two thresholds, not from the largest.
    """
    clamped = df.withColumn("p_ge_2", F.least("p_ge_2", "p_ge_1"))
    shares = clamped.selectExpr(
        "*",
        "greatest(0.0D, 1.0D - p_ge_1) AS _0",
        "greatest(0.0D, p_ge_1 - p_ge_2) AS _1",
        "greatest(0.0D, p_ge_2) AS _2",
        f"CASE WHEN p_ge_2 >= {thresholds.high}D THEN 2 WHEN p_ge_1 >= {thresholds.medium}D THEN 1 "
        "WHEN p_ge_1 IS NOT NULL THEN 0 END AS prediction",
    ).selectExpr("*", "CASE WHEN _0 + _1 + _2 > 0 THEN _0 + _1 + _2 ELSE 1.0D END AS _sum")
    scaled = shares.selectExpr(*df.columns, "prediction", *[f"_{i} / _sum AS class_{i}" for i in range(3)])
    return scaled.withColumns(
        {
            "probability": round_half_up(chosen("prediction", "class_0", "class_1", "class_2"), 4),
            "risk_level": risk_name(F.col("prediction")),
        }
    )


def chosen(prediction: str, p0: str, p1: str, p2: str) -> Column:
    return F.expr(f"CASE {prediction} WHEN 2 THEN {p2} WHEN 1 THEN {p1} ELSE {p0} END")


def risk_name(prediction: Column) -> Column:
    return F.when(prediction == 2, "HIGH").when(prediction == 1, "MEDIUM").when(prediction.isNotNull(), "LOW")


def score_record(df: DataFrame, thresholds: Thresholds = Thresholds()) -> Column:
    """The full score as one nested column over the output of ``ordinal_classes``."""
    return F.struct(
        F.col("prediction").alias("risk_level"),
        F.lower("risk_level").alias("risk_label"),
        F.struct("p_ge_1", "p_ge_2").alias("scores"),
        F.struct("class_0", "class_1", "class_2").alias("probabilities"),
        F.struct(
            F.lit(thresholds.medium).alias("medium_threshold"), F.lit(thresholds.high).alias("high_threshold")
        ).alias("thresholds"),
    )


def _prediction_text(trigger: str, marks: dict[str, str]) -> str:
    """SQL text of the prediction struct of a scored row."""
    scored = ("h3_cell", "event_time", "event_date", "prediction", "probability", "risk_level")
    values = {
        **{c: c for c in scored},
        "suspected_voluntary": "CASE WHEN prediction = 0 THEN 1 ELSE 0 END" if trigger.lower() == "fire" else "0",
        **marks,
    }
    members = [
        f"'{f.name}', CAST({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()})"
        for f in PREDICTION_SCHEMA.fields
    ]
    return f"named_struct({', '.join(members)})"


# How a prediction from a weather snapshot is marked.
REGULAR_MARKS = {
    "trigger_type": "'regular_meteo'",
    "trigger_source": "'meteo'",
    "is_neighbor_prediction": "false",
    "confirmed_alert": "false",
    "fire_observed": "false",
    "sensor_confirmed": "false",
    "prediction_slot": "_slot",
}


@dataclass(frozen=True)
class RiskModel:
    """Encoder, scorer and thresholds: everything that turns snapshots into scores."""

    encoder: DataFrame
    scorer: Scorer
    thresholds: Thresholds = Thresholds()
    on_unknown: str = "quarantine"

    def _classes(self, snapshots: DataFrame) -> DataFrame:
        encoded = known(encode_strict(fill_cell_ids(snapshots), self.encoder, self.on_unknown))
        return ordinal_classes(self.scorer.apply(feature_vector(encoded)), self.thresholds)

    def predict(self, snapshots: DataFrame, trigger: str) -> DataFrame:
        """Snapshots plus their prediction in a struct ``p``; unscored rows drop out."""
        keep = snapshots.columns
        scored = self._classes(snapshots).filter("prediction is not null")
        return scored.select(*keep, F.expr(_prediction_text(trigger, {})).alias("p"))

    def predict_regular(self, snapshots: DataFrame) -> DataFrame:
        """Scores of weather snapshots, marked as regular predictions."""
        keep = snapshots.columns
        scored = self._classes(snapshots).filter("prediction is not null")
        marked = scored.withColumn("_slot", slot_label(F.col("event_time")))
        return marked.select(*keep, F.expr(_prediction_text("meteo", REGULAR_MARKS)).alias("p"))

    def predict_marked(self, snapshots: DataFrame) -> DataFrame:
        """``predict_regular`` that keeps every row; ``p`` is null where ``reason`` says why.

        ``snapshots`` has ``stage`` and ``reason`` already.
        """
        keep = snapshots.columns
        coded = encode_strict(fill_cell_ids(snapshots), self.encoder, "quarantine")
        scored = ordinal_classes(self.scorer.apply(feature_vector(coded)), self.thresholds)
        marked = refuse(refuse(scored, "encoder", F.col("reject_reason")), "score", F.when(F.col("prediction").isNull(), "no_score"))
        slots = marked.withColumn("_slot", slot_label(F.col("event_time")))
        p = F.when(F.col("reason").isNull(), F.expr(_prediction_text("meteo", REGULAR_MARKS)))
        return slots.select(*keep, p.alias("p"))

    def predict_neighbor(self, snapshots: DataFrame) -> DataFrame:
        return self.predict(snapshots, "neighbor")

    def unscorable(self, snapshots: DataFrame) -> DataFrame:
        """Snapshots whose cell the encoder does not know, with the reason."""
        marked = encode_strict(fill_cell_ids(snapshots), self.encoder, "quarantine")
        return marked.filter("reject_reason is not null").drop("code")
