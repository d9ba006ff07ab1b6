"""Category codes: building them, and looking them up strictly or leniently."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellwatch.functions.scalars import first_not_blank, not_blank
from cellwatch.session import ensure_checkpoints


def export_encoder(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in order with codes 0, 1, 2, ... as (class, code).

    The values are range partitioned and numbered inside their partition; only
    the partition sizes are summed up in one place. The first checkpoint pins
    the partitions, so sizes and numbers can never come from different layouts;
    the second keeps the finished table, which every scoring job reads.
    """
    ensure_checkpoints(df.sparkSession)
    ordered = (
        df.select(F.col(column).cast("string").alias("class"))
        .filter("class is not null")
        .distinct()
        .repartitionByRange("class")
        .sortWithinPartitions("class")
        .withColumn("_id", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_run", F.shiftright("_id", 33))
    )
    runs = ordered.groupBy("_run").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    codes = ordered.join(starts, "_run").select(
        "class", (F.col("_start") + F.col("_id") - F.col("_first")).cast("int").alias("code")
    )
    return codes.checkpoint()


def fill_cell_ids(df: DataFrame) -> DataFrame:
    """A blank commune takes the cell's value and a blank cell the commune's.

    Where both are blank nothing changes.
    """
    commune, cell = not_blank(F.col("h3_commune")), not_blank(F.col("h3_cell"))
    return df.withColumns(
        {
            "h3_commune": F.coalesce(commune, cell, F.col("h3_commune")),
            "h3_cell": F.coalesce(cell, commune, F.col("h3_cell")),
        }
    )


def encode_strict(df: DataFrame, encoder: DataFrame, on_unknown: str = "quarantine") -> DataFrame:
    """Adds ``code`` and ``reject_reason`` for the commune, falling back to the cell.

    An unknown or blank value has no code. ``fail`` stops the job on such a row
    and ``quarantine`` marks it; ``known`` and ``unknown`` split the marked rows.
    """
    wanted = not_blank(first_not_blank(F.col("h3_commune"), F.col("h3_cell")))
    codes = encoder.select(F.col("class").alias("_class"), "code")
    joined = df.withColumn("_class", wanted).join(codes, "_class", "left")
    reason = F.when(F.col("_class").isNull(), "blank_cell").when(F.col("code").isNull(), "unknown_cell")
    marked = joined.withColumn("reject_reason", reason)
    if on_unknown == "fail":
        stop = F.raise_error(F.concat_ws(" ", "reject_reason", "_class")).cast("int")
        marked = marked.withColumn("code", F.when(F.col("reject_reason").isNotNull(), stop).otherwise(F.col("code")))
    elif on_unknown != "quarantine":
        raise ValueError(f"on_unknown must be fail or quarantine, not {on_unknown}")
    return marked.drop("_class")


def known(encoded: DataFrame) -> DataFrame:
    return encoded.filter("reject_reason is null").drop("reject_reason")


def unknown(encoded: DataFrame) -> DataFrame:
    return encoded.filter("reject_reason is not null")


def encode_fallback(df: DataFrame, encoder: DataFrame, column: str) -> DataFrame:
    """Adds ``code``; unknown values take the class ``Unknown`` if there is one, else class 0."""
    codes = encoder.select(F.col("class").alias("_class"), F.col("code").alias("_code"))
    substitute = encoder.agg(F.max(F.when(F.col("class") == "Unknown", F.col("code")))).scalar()
    return (
        df.withColumn("_class", F.col(column).cast("string"))
        .join(codes, "_class", "left")
        .withColumn("code", F.coalesce(F.col("_code"), substitute, F.lit(0)))
        .drop("_class", "_code")
    )
