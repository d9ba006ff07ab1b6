"""Geometry of cells: which cell a point is in, and which cells touch.

Cells are rows of a dimension with a centre. A point belongs to the nearest
centre within ``max_km``. The dimension is turned into a grid index: each
centre is listed in its own bucket and the surrounding ones, so a point needs
one equality lookup and a minimum over a short list inside its row. No point
is paired with more than the centres around it and nothing is regrouped.

Latitudes beyond a pole go on along the opposite meridian, as the distance does.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_KM = 6371.0
KM_PER_DEGREE = EARTH_KM * math.pi / 180.0
# Listings of one cell in one slot of this size count once.
SLOT_KM = 0.25


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def on_globe(lat: Column, lon: Column) -> tuple[Column, Column]:
    """The same place with a latitude of -90 to 90; such latitudes stay as they are."""
    turned = F.pmod(lat + 90.0, F.lit(360.0))
    inside, far = F.abs(lat) <= 90.0, turned > 180.0
    return (
        F.when(inside, lat).when(far, F.lit(270.0) - turned).otherwise(turned - 90.0),
        F.when(~inside & far, lon + 180.0).otherwise(lon),
    )


def _band(lat: Column, size_km: float) -> Column:
    return F.floor(lat / F.lit(size_km / KM_PER_DEGREE)).cast("int")


def _buckets_around(band: Column, size_km: float) -> Column:
    """Number of buckets in a latitude band, each at least ``size_km`` wide.

    Widths are taken at the far edge of the neighbouring bands, so one bucket
    to either side always covers ``size_km``, also across the date line.
    """
    edge = F.least(F.lit(90.0), (F.abs(band) + 2) * F.lit(size_km / KM_PER_DEGREE))
    return F.greatest(F.lit(1), F.floor(F.cos(F.radians(edge)) * F.lit(360.0 * KM_PER_DEGREE / size_km))).cast("int")


def _bucket(lon: Column, band: Column, size_km: float) -> Column:
    n = _buckets_around(band, size_km)
    return F.pmod(F.floor((lon + 180.0) / 360.0 * n), n).cast("int")


def _slotted(centres: DataFrame, fine: float, cell: str, lat: str, lon: str) -> DataFrame:
    """Cells and their centres, with the slot of size ``fine`` that each centre is in."""
    y, x = on_globe(F.col(lat).cast("double"), F.col(lon).cast("double"))
    pts = centres.select(F.col(cell).alias("cell"), y.alias("lat"), x.alias("lon")).dropna()
    slot = _band(F.col("lat"), fine)
    return pts.withColumns({"_y": slot, "_x": _bucket(F.col("lon"), slot, fine)})


def _one_per_slot(centres: DataFrame, cell: str, lat: str, lon: str) -> DataFrame:
    """Every cell with its centre; listed several times in one slot it counts once."""
    pts = _slotted(centres, SLOT_KM, cell, lat, lon)
    return pts.groupBy("_y", "_x", "cell").agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"))


def _refused_if_close(centres: DataFrame, min_spacing_km: float, cell: str, lat: str, lon: str) -> DataFrame:
    """The same, while counting, with an error for two cells in one slot."""
    close = F.raise_error(F.concat_ws(" ", F.lit("centres too close:"), "cell", "_other")).cast("string")
    return (
        _slotted(centres, min_spacing_km / 2, cell, lat, lon)
        .groupBy("_y", "_x")
        .agg(
            F.min("cell").alias("cell"),
            F.max("cell").alias("_other"),
            F.min("lat").alias("lat"),
            F.min("lon").alias("lon"),
        )
        .withColumn("cell", F.when(F.col("cell") != F.col("_other"), close).otherwise(F.col("cell")))
    )


def _listed(centres: DataFrame, max_km: float) -> DataFrame:
    """Every centre in its own bucket and in those around it."""
    home = _band(F.col("lat"), max_km)
    bands = F.array(home - 1, home, home + 1)
    steps = F.array(F.lit(-1), F.lit(0), F.lit(1))
    return (
        centres.select("cell", "lat", "lon", F.explode(bands).alias("_band"))
        .withColumns(
            {"_n": _buckets_around(F.col("_band"), max_km), "_mid": _bucket(F.col("lon"), F.col("_band"), max_km)}
        )
        .withColumn(
            "_bucket",
            F.explode(F.array_distinct(F.transform(steps, lambda s: F.pmod(F.col("_mid") + s, F.col("_n"))))),
        )
        .select("_band", "_bucket", "cell", "lat", "lon")
    )


def grid_index(
    centres: DataFrame,
    max_km: float = 0.9,
    min_spacing_km: float | None = 0.5,
    cell: str = "h3_cell",
    lat: str = "h3_center_lat",
    lon: str = "h3_center_lon",
) -> DataFrame:
    """Bucket to nearby centres, for points at most ``max_km`` from a centre.

    A cell that is listed several times with one centre counts once. Two different centres closer than about ``min_spacing_km`` are refused
    while counting, before any list is built. That bounds every list by how
    many centres fit around a bucket. With None nothing is refused: centres may
    be as close as they are, of cells with one and the same centre the smallest
    is listed, as lookups choose it, and lists are as long as centres are dense.
    """
    if min_spacing_km is None:
        alone = _one_per_slot(centres, cell, lat, lon).groupBy("lat", "lon").agg(F.min("cell").alias("cell"))
    else:
        alone = _refused_if_close(centres, min_spacing_km, cell, lat, lon)
    return (
        _listed(alone, max_km)
        .groupBy("_band", "_bucket")
        .agg(F.collect_list(F.struct("cell", "lat", "lon")).alias("_centres"))
        .withColumn("_max_km", F.lit(max_km))
    )


def _keyed(points: DataFrame, lat: str, lon: str, max_km: float) -> DataFrame:
    """Points with their place on the globe and their bucket."""
    placed = F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    # Rows that cannot be placed get scattered keys below any band, so they do
    # not gather in one task when the lookup is a shuffled join.
    nowhere = F.lit(-1_000_000) - F.pmod(F.xxhash64(*points.columns), F.lit(4096)).cast("int")
    y, x = on_globe(F.col(lat), F.col(lon))
    keyed = points.withColumns({"_lat": F.when(placed, y), "_lon": F.when(placed, x)}).withColumn(
        "_band", F.when(placed, _band(F.col("_lat"), max_km)).otherwise(nowhere)
    )
    return keyed.withColumn(
        "_bucket", F.when(placed, _bucket(F.col("_lon"), F.col("_band"), max_km)).otherwise(0)
    )


def resolve_cell(
    events: DataFrame, index: DataFrame, max_km: float = 0.9, lat: str = "lat", lon: str = "lon", cell: str = "h3_cell"
) -> DataFrame:
    """Cell of the nearest centre where coordinates give one, else the given cell."""
    ranked = F.transform(
        F.col("_centres"),
        lambda c: F.struct(haversine_km(F.col("_lat"), F.col("_lon"), c["lat"], c["lon"]).alias("km"), c["cell"].alias("cell")),
    )
    return (
        _keyed(events, lat, lon, max_km)
        .join(index.drop("_max_km"), ["_band", "_bucket"], "left")
        .withColumn("_best", F.array_min(ranked))
        .withColumn(cell, F.coalesce(F.when(F.col("_best.km") <= max_km, F.col("_best.cell")), F.col(cell)))
        .select(*events.columns)
    )


def adjacency(
    centres: DataFrame,
    touch_km: float = 1.3,
    min_spacing_km: float | None = None,
    cell: str = "h3_cell",
    lat: str = "h3_center_lat",
    lon: str = "h3_center_lon",
) -> DataFrame:
    """Pairs (cell, neighbor) whose centres lie within ``touch_km``.

    On a resolution-8 hexagon grid ring 1 ends near 1.0 km and ring 2 starts
    near 1.6 km. Only neighbours in the dimension appear; a table of pairs from
    elsewhere can be used in place of this one. Centres meet row by row, so no
    list is built and centres may be as close as they are; a ``min_spacing_km``
    refuses those that are closer.
    """
    if min_spacing_km is None:
        alone = _one_per_slot(centres, cell, lat, lon)
    else:
        alone = _refused_if_close(centres, min_spacing_km, cell, lat, lon)
    points = (
        centres.groupBy(F.col(cell).alias("h3_cell"))
        .agg(F.max(F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon"))).alias("c"))
        .select("h3_cell", "c.lat", "c.lon")
    )
    keyed = _keyed(points, "lat", "lon", touch_km).drop("lat", "lon")
    return (
        keyed.join(_listed(alone, touch_km), ["_band", "_bucket"])
        .filter(haversine_km(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon")) <= touch_km)
        .filter(F.col("cell") != F.col("h3_cell"))
        .select("h3_cell", F.col("cell").alias("neighbor"))
    )
