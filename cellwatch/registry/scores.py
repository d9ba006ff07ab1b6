"""Queries over encoding, scoring and scoring-service records."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellwatch.operators import encode, model_io, scoring
from cellwatch.operators.enrich import weather_snapshots
from cellwatch.plans import driver_tables as dt
from cellwatch.plans.batch_models import logistic_models
from cellwatch.registry.common import (
    BASE,
    CELLS,
    ENCODER,
    SNAPSHOTS,
    day,
    num,
    query,
    real,
    scores,
    slot,
    sql,
    z_score,
)
from cellwatch.schemas import PREDICTION_COLUMNS
from cellwatch.session import scratch_path
from cellwatch.sources import dimensions


def snapshots(spark, sf_dir):
    return weather_snapshots(dt.weather(dt.events(spark, sf_dir)), dt.static(spark, sf_dir), extra=("seq",))


@query("encoder_export", sql(CELLS, ENCODER, select="SELECT class, code FROM enc"))
def encoder_export(spark, sf_dir):
    return dt.encoder(spark, sf_dir)


@query("model_resources", sql(
    CELLS, ENCODER,
    select="""SELECT 'h3_commune' AS feature, class, code, 0.55::DOUBLE AS medium, 0.7::DOUBLE AS high, 23 AS n_features FROM enc""",
))
def model_resources(spark, sf_dir):
    """The model's three resource files, written from the tables and loaded: class lists, feature list, thresholds.

    A class list is one JSON value, so it is one row here too.
    """
    encoder, features, limits = (scratch_path(spark, n) for n in ("encoders", "features", "thresholds"))
    kept = dt.all_cells(spark, sf_dir).filter(F.col("c_mktsegment") != dt.NO_CODE_SEGMENT)
    classes = kept.agg(F.sort_array(F.collect_set("h3_cell")).alias("c"))
    classes.select(F.to_json(F.create_map(F.lit("h3_commune"), "c"))).write.text(encoder)
    one = spark.range(1)
    one.select(F.to_json(F.array(*[F.lit(f) for f in scoring.MODEL_FEATURES]))).write.text(features)
    values = {"MEDIUM_THRESHOLD": scoring.Thresholds().medium, "HIGH_THRESHOLD": scoring.Thresholds().high}
    one.select(F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in values.items()]))).write.text(limits)
    medium, high = dimensions.read_thresholds(spark, limits)
    n = len(dimensions.read_feature_list(spark, features))
    return dimensions.read_encoders(spark, encoder).select(
        F.col("column").alias("feature"), "class", "code", F.lit(medium).alias("medium"), F.lit(high).alias("high"),
        F.lit(n).alias("n_features"),
    )


@query(
    "encode_strict",
    sql(
        *BASE,
        ENCODER,
        SNAPSHOTS,
        select="""SELECT s.seq, s.h3_cell, enc.code, CASE WHEN enc.code IS NULL THEN 'unknown_cell' END AS reject_reason
FROM snap s LEFT JOIN enc ON enc.class = s.h3_commune""",
    ),
)
def encode_strict(spark, sf_dir):
    marked = encode.encode_strict(snapshots(spark, sf_dir), dt.encoder(spark, sf_dir))
    return marked.select("seq", "h3_cell", "code", "reject_reason")


@query(
    "unscorable_snapshots",
    sql(
        *BASE,
        ENCODER,
        SNAPSHOTS,
        select="""SELECT h3_cell, 'unknown_cell' AS reject_reason, count(*) AS n_snapshots FROM snap
WHERE h3_commune NOT IN (SELECT class FROM enc) GROUP BY h3_cell""",
    ),
)
def unscorable_snapshots(spark, sf_dir):
    lost = dt.model(spark, sf_dir).unscorable(snapshots(spark, sf_dir))
    return lost.groupBy("h3_cell", "reject_reason").agg(F.count(F.lit(1)).alias("n_snapshots"))


@query(
    "cell_id_fill",
    """SELECT o_orderkey, CASE WHEN trim(c) = '' AND trim(b) <> '' THEN b ELSE c END AS h3_cell,
  CASE WHEN trim(b) = '' AND trim(c) <> '' THEN c ELSE b END AS h3_commune
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '  ' ELSE 'u' || o_custkey END AS c,
  CASE WHEN o_orderpriority LIKE '1%' THEN '' ELSE 'v' || o_custkey END AS b FROM orders)""",
)
def cell_id_fill(spark, sf_dir):
    rows = dt.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "  ").otherwise(F.concat(F.lit("u"), "o_custkey")).alias("h3_cell"),
        F.when(F.col("o_orderpriority").startswith("1"), "")
        .otherwise(F.concat(F.lit("v"), "o_custkey"))
        .alias("h3_commune"),
    )
    return encode.fill_cell_ids(rows)


@query(
    "encode_fallback",
    """WITH v AS (SELECT DISTINCT event_type AS c FROM events WHERE event_type <> 'click'
  UNION SELECT 'Unknown'),
e AS (SELECT c, CAST(row_number() OVER (ORDER BY c) - 1 AS INTEGER) AS code FROM v)
SELECT event_id, event_type, coalesce(e.code, (SELECT code FROM e WHERE c = 'Unknown')) AS code
FROM events LEFT JOIN e ON e.c = event_type""",
)
def encode_fallback(spark, sf_dir):
    events = dt.table(spark, sf_dir, "events").select("event_id", "event_type")
    classes = F.when(F.col("event_type") == "click", "Unknown").otherwise(F.col("event_type")).alias("class")
    table = encode.export_encoder(events.select(classes), "class")
    return encode.encode_fallback(events, table, "event_type")


_FEATURE_SQL = ["enc.code", *[f"s.{c}" for c in list(scoring.MODEL_FEATURES.values())[1:]]]


@query(
    "feature_vector",
    sql(
        *BASE,
        ENCODER,
        SNAPSHOTS,
        select="SELECT s.seq, "
        + ", ".join(f"round({real(c)}, 6) + 0.0 AS f{i}" for i, c in enumerate(_FEATURE_SQL))
        + " FROM snap s JOIN enc ON enc.class = s.h3_commune",
    ),
)
def feature_vector(spark, sf_dir):
    coded = encode.known(encode.encode_strict(snapshots(spark, sf_dir), dt.encoder(spark, sf_dir)))
    vectors = scoring.feature_vector(coded)
    n = len(scoring.MODEL_FEATURES)
    return vectors.select("seq", *[F.col("features")[i].cast("double").alias(f"f{i}") for i in range(n)])


SCORED = (*BASE, ENCODER, SNAPSHOTS, scores("snap", "sc"))


def classes(spark, sf_dir):
    coded = encode.known(encode.encode_strict(snapshots(spark, sf_dir), dt.encoder(spark, sf_dir)))
    return scoring.ordinal_classes(dt.SCORER.apply(scoring.feature_vector(coded)))


@query(
    "ordinal_risk",
    sql(
        *SCORED,
        select="""SELECT seq, h3_cell, prediction, round(probability, 6) + 0.0 AS probability, risk_level,
  round(p1, 6) + 0.0 AS p_ge_1, round(p2, 6) + 0.0 AS p_ge_2, round(1 - p1, 6) + 0.0 AS class_0,
  round(p1 - p2, 6) + 0.0 AS class_1, round(p2, 6) + 0.0 AS class_2 FROM sc""",
    ),
)
def ordinal_risk(spark, sf_dir):
    return classes(spark, sf_dir).select(
        "seq", "h3_cell", "prediction", "probability", "risk_level", "p_ge_1", "p_ge_2", "class_0", "class_1", "class_2"
    )


@query(
    "score_record",
    sql(
        *SCORED,
        select="""SELECT seq, prediction AS risk_level, lower(risk_level) AS risk_label, round(p1, 6) + 0.0 AS p_ge_1,
  round(p2, 6) + 0.0 AS class_2, 0.55::DOUBLE AS medium_threshold, 0.7::DOUBLE AS high_threshold FROM sc""",
    ),
)
def score_record(spark, sf_dir):
    scored = classes(spark, sf_dir)
    record = scored.select("seq", scoring.score_record(scored).alias("r"))
    return record.select(
        "seq",
        "r.risk_level",
        "r.risk_label",
        "r.scores.p_ge_1",
        "r.probabilities.class_2",
        "r.thresholds.medium_threshold",
        "r.thresholds.high_threshold",
    )


REGULAR = f"""reg AS (
  SELECT seq, h3_cell, event_time, event_date, prediction, probability, risk_level, 0 AS suspected_voluntary,
         'regular_meteo' AS trigger_type, 'meteo' AS trigger_source, false AS is_neighbor_prediction,
         NULL::VARCHAR AS trigger_h3_cell, false AS confirmed_alert, false AS fire_observed,
         false AS sensor_confirmed, NULL::BIGINT AS confirmation_time, {slot("event_time")} AS prediction_slot
  FROM sc)"""
PREDICTION_SELECT = f"""seq, h3_cell, event_time, {day()}, prediction, round(probability, 6) + 0.0 AS probability,
  risk_level, suspected_voluntary, trigger_type, trigger_source, is_neighbor_prediction, trigger_h3_cell,
  confirmed_alert, fire_observed, sensor_confirmed, confirmation_time, prediction_slot"""


@query("regular_predictions", sql(*SCORED, REGULAR, select=f"SELECT {PREDICTION_SELECT} FROM reg"))
def regular_predictions(spark, sf_dir):
    scored = dt.model(spark, sf_dir).predict_regular(snapshots(spark, sf_dir))
    return scored.select("seq", *[f"p.{c}" for c in PREDICTION_COLUMNS])


@query(
    "batch_model_scores",
    sql(*SCORED, select="SELECT seq, prediction, risk_level, round(p1, 6) + 0.0 AS p_ge_1 FROM sc"),
)
def batch_model_scores(spark, sf_dir):
    coded = encode.known(encode.encode_strict(snapshots(spark, sf_dir), dt.encoder(spark, sf_dir)))
    scorer = scoring.BatchScorer(logistic_models, key="logistic")
    out = scoring.ordinal_classes(scorer.apply(scoring.feature_vector(coded)))
    return out.select("seq", "prediction", "risk_level", "p_ge_1")


# The same scores from a second model that often says more than the first.
_STEEP = scores("snap", "sc").replace(f"(-({z_score('s')} - 0.4::DOUBLE))", f"(-(1.5::DOUBLE * {z_score('s')}))")


@query(
    "clamped_scores",
    sql(
        *BASE,
        ENCODER,
        SNAPSHOTS,
        _STEEP,
        select="""SELECT seq, prediction, round(probability, 6) + 0.0 AS probability, round(p2, 6) + 0.0 AS class_2,
  round(p1 - p2, 6) + 0.0 AS class_1, raw2 > p1 AS clamped FROM sc""",
    ),
)
def clamped_scores(spark, sf_dir):
    coded = encode.known(encode.encode_strict(snapshots(spark, sf_dir), dt.encoder(spark, sf_dir)))
    raw = dt.STEEP_SCORER.apply(scoring.feature_vector(coded)).withColumn("clamped", F.col("p_ge_2") > F.col("p_ge_1"))
    return scoring.ordinal_classes(raw).select("seq", "prediction", "probability", "class_2", "class_1", "clamped")


_SCORELESS = f"{real('humidity_min')} >= 30"


@query(
    "scoreless_rows",
    sql(
        *SCORED,
        select=f"""SELECT s.seq, CASE WHEN sc.seq IS NULL THEN 'unknown_cell' WHEN NOT {_SCORELESS.replace("humidity_min", "s.humidity_min")}
    THEN 'no_score' END AS reason, CASE WHEN {_SCORELESS.replace("humidity_min", "s.humidity_min")} THEN sc.prediction END AS prediction
FROM snap s LEFT JOIN sc ON sc.seq = s.seq""",
    ),
)
def scoreless_rows(spark, sf_dir):
    """A scorer that gives null for dry air: those rows are kept apart with a reason."""
    model = scoring.RiskModel(dt.encoder(spark, sf_dir), dt.PARTIAL_SCORER)
    blank = F.lit(None).cast("string")
    marked = model.predict_marked(snapshots(spark, sf_dir).withColumns({"stage": blank, "reason": blank}))
    return marked.select("seq", "reason", "p.prediction")


@query(
    "scores_without_nulls",
    sql(*SCORED, select=f"SELECT seq, prediction FROM sc WHERE {_SCORELESS}"),
)
def scores_without_nulls(spark, sf_dir):
    model = scoring.RiskModel(dt.encoder(spark, sf_dir), dt.PARTIAL_SCORER)
    return model.predict_regular(snapshots(spark, sf_dir)).select("seq", "p.prediction")


@query(
    "fire_trigger_scores",
    sql(
        *SCORED,
        select="""SELECT seq, prediction, risk_level, CASE WHEN prediction = 0 THEN 1 ELSE 0 END AS suspected_voluntary
FROM sc""",
    ),
)
def fire_trigger_scores(spark, sf_dir):
    scored = dt.model(spark, sf_dir).predict(snapshots(spark, sf_dir), "fire")
    return scored.select("seq", "p.prediction", "p.risk_level", "p.suspected_voluntary")


# ---- requests and responses ----


@query(
    "request_json",
    sql(
        *BASE,
        SNAPSHOTS,
        select="SELECT seq, h3_commune, month, is_weekend, "
        "round(temperature_moy, 6) + 0.0 AS temperature, round(humidity_min, 6) + 0.0 AS humidity, "
        "round(dist_urbain_m, 6) + 0.0 AS dist_urbain, round(doy_cos, 6) + 0.0 AS doy_cos, "
        "CAST(23 - CASE WHEN humidity_min IS NULL THEN 1 ELSE 0 END - CASE WHEN dist_urbain_m IS NULL THEN 1 ELSE 0 END"
        " - CASE WHEN precipitation_1d_mm IS NULL THEN 2 ELSE 0 END AS INTEGER) AS n_members FROM snap",
    ),
)
def request_json(spark, sf_dir):
    sent = model_io.request_json(snapshots(spark, sf_dir), ["seq"])
    data = model_io.parse_request(sent)

    def member(name: str, kind: str):
        return F.col("data")[name].cast(kind)

    return data.select(
        "seq",
        member("h3_commune", "string").alias("h3_commune"),
        member("month", "int").alias("month"),
        member("is_weekend", "int").alias("is_weekend"),
        member("temperature_moy(°C)", "double").alias("temperature"),
        member("humidity_min(%)", "double").alias("humidity"),
        member("dist_urbain_m", "double").alias("dist_urbain"),
        member("doy_cos", "double").alias("doy_cos"),
        F.size("data").alias("n_members"),
    )


def _short_requests(spark, sf_dir):
    """Requests from line items: short names, sometimes both names, sometimes neither."""
    rows = dt.table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    body = F.struct(
        F.when(flag != "R", F.col("l_quantity")).alias("temperature_moy"),
        F.when(flag == "A", F.col("l_tax")).alias("temperature_moy(°C)"),
        F.col("l_discount").alias("humidity_min"),
        F.col("l_linenumber").alias("month"),
    )
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_json(F.struct(body.alias("data"))).alias("request")
    )


@query(
    "alias_normalise",
    """SELECT l_orderkey, l_linenumber, l_partkey,
  round(CASE l_returnflag WHEN 'A' THEN l_tax WHEN 'N' THEN l_quantity END, 6) + 0.0 AS temperature,
  round(l_discount, 6) + 0.0 AS humidity,
  CASE WHEN l_returnflag = 'R' THEN 'temperature_moy(°C),wind_speed_max(km/h)' ELSE 'wind_speed_max(km/h)' END
    AS missing FROM lineitem""",
)
def alias_normalise(spark, sf_dir):
    data = model_io.parse_request(_short_requests(spark, sf_dir))
    full = data.withColumn("data", model_io.normalise_aliases(F.col("data")))
    wanted = ["humidity_min(%)", "temperature_moy(°C)", "wind_speed_max(km/h)", "month"]
    return full.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("data")["temperature_moy(°C)"].cast("double").alias("temperature"),
        F.col("data")["humidity_min(%)"].cast("double").alias("humidity"),
        F.array_join(model_io.missing_features(F.col("data"), wanted), ",").alias("missing"),
    )


def _responses(spark, sf_dir):
    """Service responses from line items, with every odd shape the decoder knows."""
    rows = dt.table(spark, sf_dir, "lineitem")
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    shares = F.struct(
        F.when(line != 3, F.col("l_tax") * 10).alias("class_0"),
        (F.col("l_discount") * 10).alias("class_1"),
        (F.col("l_quantity") / 50).alias("class_2"),
    )
    prediction = F.when(
        line != 7,
        F.struct(
            F.when(flag == "N", F.col("l_partkey") % 3).alias("risk_level"), F.when(line != 6, shares).alias("probabilities")
        ),
    )
    body = F.struct(
        F.when(line == 1, "rejected_unknown_h3").otherwise("ok").alias("prediction_status"),
        F.when(line == 2, False).when(line == 4, True).alias("known_h3"),
        prediction.alias("prediction"),
    )
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.to_json(body).alias("response"))


@query(
    "response_decode",
    """SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(CASE WHEN refused THEN 0 WHEN l_linenumber <> 7 THEN c END AS INTEGER) AS prediction,
  round(CASE WHEN refused THEN 0.0 WHEN l_linenumber <> 7 THEN
    floor(CASE c WHEN 2 THEN p2 WHEN 1 THEN p1 ELSE p0 END * 10000 + 0.5) / 10000 END, 6) + 0.0 AS probability,
  CASE WHEN refused THEN 'REJECTED_UNKNOWN_H3' WHEN l_linenumber <> 7 THEN
    CASE c WHEN 2 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END END AS risk_level,
  CASE WHEN l_linenumber = 7 THEN 'missing_prediction' END AS reject_reason
FROM (SELECT *, CASE WHEN l_returnflag = 'N' THEN l_partkey % 3 WHEN p2 >= p1 AND p2 >= p0 THEN 2
    WHEN p1 >= p0 THEN 1 ELSE 0 END AS c
  FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linenumber IN (1, 2) AS refused,
      CASE WHEN l_linenumber IN (3, 6) THEN 0.0 ELSE l_tax * 10 END AS p0,
      CASE WHEN l_linenumber = 6 THEN 0.0 ELSE l_discount * 10 END AS p1,
      CASE WHEN l_linenumber = 6 THEN 0.0 ELSE l_quantity / 50 END AS p2 FROM lineitem))""",
)
def response_decode(spark, sf_dir):
    return model_io.decode_response(_responses(spark, sf_dir)).drop("response")


__all__ = ["PREDICTION_SELECT", "REGULAR", "SCORED", "num", "snapshots"]
