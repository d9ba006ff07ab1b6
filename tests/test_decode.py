import datetime as dt

import pytest
from pyspark.sql import functions as F

from cellwatch.sources import decode, dimensions

GOOD = '{"h3Cell":"c1","lat":36.1,"lon":3.2,"eventTime":1750000000000,"eventDate":"2025-06-15","temperature":30.5}'


def one(spark, text, kind="weather"):
    return decode.decode_events(spark.createDataFrame([(text,)], "value string"), kind).first()


def test_typed_row(spark):
    r = one(spark, GOOD)
    assert (r.h3_cell, r.lat, r.event_time, r.event_date, r.temperature) == (
        "c1", 36.1, 1750000000000, dt.date(2025, 6, 15), 30.5,
    )
    assert r.humidity is None and r.reject_reason is None


@pytest.mark.parametrize(
    "text, reason",
    [
        ("{bad", "malformed_json"),
        ("", "malformed_json"),
        ("null", "malformed_json"),
        (None, "malformed_json"),
        ('{"lat":"north"}', "bad_double:lat"),
        ('{"eventTime":"soon"}', "bad_bigint:eventTime"),
        ('{"eventTime":1.5}', "bad_bigint:eventTime"),
        ('{"eventDate":"2025-02-30"}', "bad_date:eventDate"),
        ('{"eventDate":"2025-6-1"}', "bad_date:eventDate"),
        ('{"temperature":true}', "bad_double:temperature"),
    ],
)
def test_refused_rows_say_why(spark, text, reason):
    assert one(spark, text).reject_reason == reason


def test_lenient_forms(spark):
    r = one(spark, '{"temperature":"36.5","eventTime":1.75E12,"more":[1,{"a":2}]}')
    assert (r.temperature, r.event_time, r.reject_reason) == (36.5, 1750000000000, None)
    s = one(spark, '{"fireRelated":"TRUE","alertLevel":"HIGH"}', "sensor")
    assert (s.fire_related, s.alert_level) == (True, "HIGH")
    assert one(spark, '{"declared":1}', "fire").reject_reason == "bad_boolean:declared"
    assert one(spark, '{"declared":null}', "fire").declared is None


def test_keys_are_required(spark):
    texts = [GOOD, '{"h3Cell":"c1"}', '{"eventTime":1,"eventDate":"2025-01-01"}']
    rows = decode.decode_events(spark.createDataFrame([(t,) for t in texts], "value string"), "weather")
    assert decode.require_keys(decode.accepted(rows)).count() == 1


def test_text_is_parsed_once(spark):
    rows = decode.accepted(decode.decode_events(spark.createDataFrame([(GOOD,)], "value string"), "weather"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_round_trip(spark):
    rows = decode.accepted(decode.decode_events(spark.createDataFrame([(GOOD,)], "value string"), "weather"))
    sent = decode.encode_events(rows, "weather")
    assert sent.first().key == "c1"
    assert decode.accepted(decode.decode_events(sent, "weather")).drop("key").collect() == rows.collect()


def test_cell_list_file(spark, tmp_path):
    path = tmp_path / "cells.csv"
    path.write_text("h3_cell,h3_center_lat,h3_center_lon\n a , 36.1 ,3.2,more\n\n  \nb,36.2\nc,36.3,3.4\n")
    rows = dimensions.read_cell_list(spark, str(path)).orderBy("h3_cell").collect()
    assert [tuple(r) for r in rows] == [("a", 36.1, 3.2), ("c", 36.3, 3.4)]
    path.write_text("h3_cell,h3_center_lat,h3_center_lon\n")
    with pytest.raises(ValueError):
        dimensions.read_cell_list(spark, str(path))
    path.write_text("h3_cell,h3_center_lat,h3_center_lon\na,north,3.2\n")
    with pytest.raises(Exception, match="north"):
        dimensions.read_cell_list(spark, str(path)).collect()


def test_model_resources(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"h3_commune": ["a", "b", "c"]}')
    (tmp_path / "f.json").write_text('["month", "is_weekend"]')
    (tmp_path / "t.json").write_text('{"MEDIUM_THRESHOLD": 0.5, "HIGH_THRESHOLD": 0.8}')
    (tmp_path / "bad.json").write_text('{"MEDIUM_THRESHOLD": 0.5}')
    (tmp_path / "none.json").write_text("[]")
    encoder = dimensions.read_encoders(spark, str(tmp_path / "e.json"))
    assert [tuple(r) for r in encoder.orderBy("code").collect()] == [
        ("h3_commune", "a", 0), ("h3_commune", "b", 1), ("h3_commune", "c", 2),
    ]
    assert dimensions.read_feature_list(spark, str(tmp_path / "f.json")) == ["month", "is_weekend"]
    assert dimensions.read_thresholds(spark, str(tmp_path / "t.json")) == (0.5, 0.8)
    with pytest.raises(ValueError):
        dimensions.read_thresholds(spark, str(tmp_path / "bad.json"))
    with pytest.raises(ValueError):
        dimensions.read_feature_list(spark, str(tmp_path / "none.json"))


def test_last_dimension_row_wins(spark):
    columns = ["h3_cell", *dimensions.STATIC_COLUMNS, "n"]
    rows = [("a", *([1.0] * 9), 1), ("a", 2.0, None, *([2.0] * 7), 2)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} {'string' if c == 'h3_cell' else 'double' if c != 'n' else 'int'}" for c in columns))
    r = dimensions.static_numeric(df, F.col("n")).collect()
    assert len(r) == 1 and r[0].altitude_moy == 2.0 and r[0].pente_moy is None
