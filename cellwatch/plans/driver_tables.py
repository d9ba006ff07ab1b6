"""Cells, events and dimensions read out of the benchmark tables.

The tables hold orders, customers and a click stream rather than weather, so
users stand for cells and event types for sources:

* cell = ``u<user_id>``; arrival order = ``event_id``
* ``error`` = sensor, ``purchase`` = fire, the other types = weather
* customers = cell dimension with centres on a hexagonal lattice; one market
  segment is left out of it, another out of the encoder
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch.operators.cells import adjacency, grid_index
from cellwatch.operators.encode import export_encoder
from cellwatch.operators.scoring import ColumnScorer, RiskModel
from cellwatch.plans.risk import RiskJob
from cellwatch.sources.decode import event_json

# Parameters of the made-up geography and of the stand-in risk formula.
LATTICE_COLUMNS = 50
LAT_STEP, LON_STEP = 0.0081, 0.0104
LAT_ZERO, LON_ZERO = 36.0, 3.0
NO_STATIC_SEGMENT = "FURNITURE"
NO_CODE_SEGMENT = "MACHINERY"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a wall-clock timestamp taken as UTC."""
    day = F.unix_date(ts.cast("date")).cast("bigint") * 86_400_000
    clock = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("bigint") * 1000
    return day + clock + F.floor(F.extract(F.lit("SECOND"), ts) * 1000).cast("bigint")


def shape_events(events: DataFrame) -> DataFrame:
    """Event rows, from a table or a stream, with cell, clock and ``k``."""
    return events.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("u"), F.col("user_id")).alias("h3_cell"),
        epoch_ms(F.col("ts")).alias("event_time"),
        F.col("ts").cast("date").alias("event_date"),
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_events(table(spark, sf_dir, "events"))


def _somewhere() -> list[Column]:
    """Coordinates that mean nothing, absent now and then; jobs without a grid index do not look at them."""
    lat = F.when(F.col("seq") % 5 != 0, F.lit(36.0) + (F.col("seq") % 97) * F.lit(0.01))
    lon = F.when(F.col("seq") % 7 != 0, F.lit(3.0) + (F.col("seq") % 89) * F.lit(0.01))
    return [lat.alias("lat"), lon.alias("lon")]


_KEYS = ["seq", "h3_cell", "event_time", "event_date"]


def weather(ev: DataFrame) -> DataFrame:
    k = F.col("k").cast("double")
    return ev.filter(F.col("event_type").isin("view", "click", "signup")).select(
        *_KEYS,
        *_somewhere(),
        F.col("value").alias("temperature"),
        F.when(~F.col("k").between(20, 24), k).alias("humidity"),
        (F.col("value") * 0.25).alias("wind_speed"),
        F.when(~F.col("k").between(30, 39), k / 8.0).alias("precipitation"),
        (k / 256.0).alias("soil_moisture"),
        (F.col("value") / 2.0).alias("vpd"),
    )


def sensors(ev: DataFrame) -> DataFrame:
    k = F.col("k").cast("double")
    return ev.filter("event_type = 'error'").select(
        *_KEYS,
        *_somewhere(),
        (F.col("value") + 400.0).alias("co2"),
        F.when(~F.col("k").between(20, 24), k).alias("smoke"),
        (F.col("value") / 2.0).alias("sensor_temperature"),
        (F.lit(100.0) - k).alias("battery"),
    )


def fires(ev: DataFrame) -> DataFrame:
    return ev.filter("event_type = 'purchase'").select(
        *_KEYS,
        *_somewhere(),
        F.when(F.col("k") >= 5, F.col("k") >= 30).alias("declared"),
        F.col("value").alias("intensity"),
        F.when(F.col("k") <= 90, F.col("k") / 8.0).alias("burned_area"),
    )


def _lattice() -> tuple[Column, Column]:
    row = F.floor(F.col("c_custkey") / LATTICE_COLUMNS)
    column = F.col("c_custkey") % LATTICE_COLUMNS
    return (
        F.lit(LAT_ZERO) + row * F.lit(LAT_STEP),
        F.lit(LON_ZERO) + (column + (row % 2) * F.lit(0.5)) * F.lit(LON_STEP),
    )


def all_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = _lattice()
    nation = F.col("c_nationkey").cast("double")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("u"), F.col("c_custkey")).alias("h3_cell"),
        F.col("c_acctbal").alias("altitude_moy"),
        nation.alias("pente_moy"),
        (F.col("c_custkey") * 10.0).alias("dist_route_m"),
        F.when(F.col("c_nationkey") != 3, F.col("c_custkey") * 25.0).alias("dist_urbain_m"),
        ((nation + 1) / 32.0).alias("ndvi_30d_mean"),
        ((nation + 1) / 64.0).alias("ndvi_30d_min"),
        ((nation + 1) / 128.0).alias("ndvi_30d_std"),
        lat.alias("h3_center_lat"),
        lon.alias("h3_center_lon"),
        "c_mktsegment",
        "c_nationkey",
    )


def static(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_cells(spark, sf_dir).filter(F.col("c_mktsegment") != NO_STATIC_SEGMENT).drop(
        "c_mktsegment", "c_nationkey"
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    places = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    cells = table(spark, sf_dir, "customer")
    return cells.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("u"), F.col("c_custkey")).alias("h3_cell"),
        F.col("r_name").alias("wilaya"),
        F.col("n_name").alias("daira"),
        F.concat_ws("-", "r_name", "n_name").alias("commune"),
        F.col("c_name").alias("nom_foret_ou_lieu_dit"),
        F.col("c_mktsegment").alias("essence_principale"),
    )


def touching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adjacency(static(spark, sf_dir))


def placed_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather events with coordinates scattered around their cell's centre."""
    centres = all_cells(spark, sf_dir).select("h3_cell", "h3_center_lat", "h3_center_lon")
    known = F.col("k") < 95
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type").isin("view", "click", "signup"))
        .join(centres, "h3_cell")
        .select(
            "seq",
            "h3_cell",
            F.when(known, F.col("h3_center_lat") + (F.col("k") - 50) * F.lit(0.0001)).alias("lat"),
            F.when(known, F.col("h3_center_lon") + (F.col("seq") % 11 - 5) * F.lit(0.0011)).alias("lon"),
        )
    )


_encoders: dict[tuple, DataFrame] = {}


def encoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of the cells the model knows; exported again when the table's files change."""
    version = table(spark, sf_dir, "customer").agg(
        F.max("_metadata.file_modification_time"), F.max("_metadata.file_size"), F.count(F.lit(1))
    ).first()
    key = (spark.sparkContext.applicationId, sf_dir, *version)
    if key not in _encoders:
        cells = all_cells(spark, sf_dir).filter(F.col("c_mktsegment") != NO_CODE_SEGMENT)
        _encoders[key] = export_encoder(cells, "h3_cell")
    return _encoders[key]


def _feature(i: int) -> Column:
    return F.get("features", F.lit(i)).cast("double")


def _risk() -> Column:
    return (_feature(8) - 40.0) * 0.03 + (F.lit(50.0) - _feature(7)) * 0.01 + _feature(0) * 0.0005


def risk_score(shift: float, steepness: float = 1.0) -> Column:
    """Logistic stand-in for a model, over the float32 feature vector."""
    z = _risk() * steepness - F.lit(shift) if steepness != 1.0 else _risk() - F.lit(shift)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


SCORER = ColumnScorer(lambda: risk_score(0.0), lambda: risk_score(0.4))
# The second model often exceeds the first.
STEEP_SCORER = ColumnScorer(lambda: risk_score(0.0), lambda: risk_score(0.0, 1.5))
# No score for dry air.
PARTIAL_SCORER = ColumnScorer(
    lambda: F.when(_feature(7) >= 30, risk_score(0.0)), lambda: F.when(_feature(7) >= 30, risk_score(0.4))
)


def model(spark: SparkSession, sf_dir: str) -> RiskModel:
    return RiskModel(encoder(spark, sf_dir), SCORER)


def job(spark: SparkSession, sf_dir: str, **options) -> RiskJob:
    return RiskJob(static(spark, sf_dir), touching(spark, sf_dir), model(spark, sf_dir), **options)


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The lattice narrows towards the poles, so its centres have no least spacing.
    return grid_index(static(spark, sf_dir), min_spacing_km=None)


def placed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of cells in the dimension get coordinates near their centre and a wrong cell name."""
    centres = static(spark, sf_dir).select("h3_cell", "h3_center_lat", "h3_center_lon")
    near = F.col("h3_center_lat").isNotNull()
    return (
        events(spark, sf_dir)
        .join(centres, "h3_cell", "left")
        .withColumns(
            {
                "own_cell": F.col("h3_cell"),
                "h3_cell": F.when(near, F.concat(F.lit("x"), F.col("h3_cell"))).otherwise(F.col("h3_cell")),
                "lat": F.col("h3_center_lat") + (F.col("k") - 50) * F.lit(0.00002),
                "lon": F.col("h3_center_lon") + (F.col("seq") % 11 - 5) * F.lit(0.0002),
            }
        )
    )


_ABSENT = {"alert_level": "string", "fire_related": "boolean", "declared_at": "bigint", "agent_id": "string", "cause": "string"}


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as records of three topics with four partitions each.

    Some texts are damaged where ``k`` says so. Several records share a broker
    time, some times go back, and offsets cross 2^19.
    """
    ev = placed_events(spark, sf_dir)
    parts = []
    for kind, shape in (("weather", weather), ("sensor", sensors), ("fire", fires)):
        typed = shape(ev).drop("lat", "lon").join(ev.select("seq", "lat", "lon", "k", "own_cell"), "seq")
        filled = typed.withColumns({c: F.lit(None).cast(t) for c, t in _ABSENT.items() if c not in typed.columns})
        filled = filled.withColumn("event_time", F.when(F.col("k") != 15, F.col("event_time")))
        parts.append(filled.select("*", event_json(kind).alias("_json")).select(F.lit(kind).alias("kind"), "seq", "k", "own_cell", "_json"))
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.select(
        "kind",
        F.when(F.col("k") == 11, F.concat(F.lit("{bad"), F.col("seq"))).otherwise(F.col("_json")).alias("value"),
        (F.floor(F.col("seq") / 64) - F.when(F.col("k") % 9 == 0, 3).otherwise(0)).cast("bigint").alias("stamp"),
        (F.substring("own_cell", 2, 20).cast("bigint") % 4).cast("int").alias("partition"),
        (F.col("seq") + 524_000).cast("bigint").alias("offset"),
    )
