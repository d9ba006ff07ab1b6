"""Static cell dimensions and the model's resource files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch.schemas import STATIC_COLUMNS


def one_per_cell(df: DataFrame, order: Column | None = None) -> DataFrame:
    """One row per cell: the last by ``order``, and of equal ones the largest by its columns."""
    row = F.struct(*[F.col(c) for c in df.columns])
    rank = row if order is None else F.struct(order, row)
    return (
        df.filter("h3_cell is not null")
        .groupBy("h3_cell")
        .agg(F.max_by(row, rank).alias("_row"))
        .select(*[F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def static_numeric(df: DataFrame, order: Column | None = None) -> DataFrame:
    """The cell dimension, one row per cell; the last row wins where given an order."""
    columns = [F.col("h3_cell"), *[F.col(c).cast("double").alias(c) for c in STATIC_COLUMNS]]
    if order is None:
        return one_per_cell(df.select(*columns))
    return one_per_cell(df.select(*columns, order.alias("_order")), F.col("_order")).drop("_order")


def read_static_jdbc(
    spark: SparkSession, url: str, order: str, table: str = "h3_static_numeric", **options: str
) -> DataFrame:
    """The dimension from a database table, the last row per cell by the column ``order``.

    Needs the database's JDBC driver on the class path.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    return static_numeric(reader.options(**options).load(), F.col(order))


def parse_cell_list(lines: DataFrame, value: str = "value") -> DataFrame:
    """Cell list rows ``cell,lat,lon`` from text lines without the header.

    Blank lines and rows with fewer than three columns are skipped, further
    columns ignored, and a number that cannot be read fails the job.
    """
    parts = F.split(F.col(value), ",")
    return (
        lines.filter(F.trim(F.col(value)) != "")
        .select(parts.alias("p"))
        .filter(F.size("p") >= 3)
        .select(
            F.trim(F.col("p")[0]).alias("h3_cell"),
            F.trim(F.col("p")[1]).cast("double").alias("h3_center_lat"),
            F.trim(F.col("p")[2]).cast("double").alias("h3_center_lon"),
        )
    )


def read_cell_list(spark: SparkSession, path: str) -> DataFrame:
    """Cell list from CSV text whose first line is a header; an empty list fails."""
    with_header = (
        spark.read.format("csv")
        .options(header="true", sep="\x01", quote="", ignoreLeadingWhiteSpace="false")
        .load(path)
    )
    cells = parse_cell_list(with_header.toDF("value"))
    if cells.isEmpty():
        raise ValueError(f"no cells in {path}")
    return cells


def read_encoders(spark: SparkSession, path: str) -> DataFrame:
    """``{column: [class, ...]}`` as rows (column, class, code); position is the code."""
    raw = spark.read.text(path, wholetext=True)
    table = raw.select(
        F.explode(F.from_json("value", "map<string, array<string>>")).alias("column", "classes")
    ).select("column", F.posexplode("classes").alias("code", "class"))
    if table.isEmpty():
        raise ValueError(f"no encoders in {path}")
    return table.select("column", "class", "code")


def _small_json(spark: SparkSession, path: str):
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    features = _small_json(spark, path)
    if not features:
        raise ValueError(f"no features in {path}")
    return features


def read_thresholds(spark: SparkSession, path: str) -> tuple[float, float]:
    """(medium, high) from a JSON object; a missing member fails."""
    values = _small_json(spark, path)
    try:
        return float(values["MEDIUM_THRESHOLD"]), float(values["HIGH_THRESHOLD"])
    except KeyError as missing:
        raise ValueError(f"{path} lacks {missing}") from None
