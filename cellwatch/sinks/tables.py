"""Output tables that survive crashes, repeated batches and new checkpoints.

A table is a folder with two parts. ``data/run=R/batch=N`` holds the rows of
one batch of one run; ``commits`` is a small Parquet table with a row per
finished batch. Writing a batch replaces its own data folder and then adds the
commit row; readers see committed folders only. So whatever step a job dies in,
the batch is either there or not, and running it again gives the same table.
Nothing that is committed is ever rewritten in place.

A run is a checkpoint: batch numbers start again with a new one, and its rows
go next to those of earlier runs. Keyed tables take deltas and read the newest
row per key, so an upsert never reads what is stored. ``compact`` folds a
table into one commit and then removes what that replaces.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch.operators.confirm import latest_per_key

DATE = "event_date"
COMMITS = "run string, batch bigint, place bigint, replaces bigint"


def read_if_present(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@dataclass(frozen=True)
class Table:
    """A table under ``root``; with ``keys`` the newest row of a key counts."""

    root: str
    schema: object
    keys: tuple[str, ...] = ()

    def _data(self, run: str, batch: int) -> str:
        return os.path.join(self.root, "data", f"run={run}", f"batch={batch}")

    def commits(self, spark: SparkSession) -> DataFrame:
        """One row per batch that counts: its run, number and place in the order of commits.

        A batch that was committed again keeps its first place, and commits
        that a later one replaces are gone.
        """
        log = read_if_present(spark, os.path.join(self.root, "commits"), COMMITS)
        if log is None:
            return spark.createDataFrame([], COMMITS)
        kept = log.groupBy("run", "batch").agg(F.min("place").alias("place"), F.max("replaces").alias("replaces"))
        newest = kept.agg(F.max("replaces")).first()[0]
        if newest is None:
            return kept
        # A folded commit stands where the last commit that it replaces stood.
        return kept.filter(
            (F.col("replaces") == newest) | (F.col("replaces").isNull() & (F.col("place") > newest))
        ).withColumn("place", F.coalesce("replaces", "place"))

    def has(self, spark: SparkSession, run: str, batch: int) -> bool:
        """Whether the batch was committed, folded into a later commit or not."""
        log = read_if_present(spark, os.path.join(self.root, "commits"), COMMITS)
        return log is not None and not log.filter((F.col("run") == run) & (F.col("batch") == batch)).isEmpty()

    def write(self, df: DataFrame, run: str, batch: int, replaces: int | None = None) -> None:
        """Write one batch and commit it. ``df`` of a keyed table has one row per key."""
        spark = df.sparkSession
        df.hint("rebalance").write.mode("overwrite").parquet(self._data(run, batch))
        self._commit(spark, run, batch, replaces)

    def _commit(self, spark: SparkSession, run: str, batch: int, replaces: int | None) -> None:
        log = read_if_present(spark, os.path.join(self.root, "commits"), COMMITS)
        mine, last = None, 0
        if log is not None:
            same = (F.col("run") == run) & (F.col("batch") == batch)
            mine, last = log.agg(F.min(F.when(same, F.col("place"))), F.coalesce(F.max("place"), F.lit(0))).first()
        if mine is None:
            row = spark.createDataFrame([(run, batch, last + 1, replaces)], COMMITS)
            row.coalesce(1).write.mode("append").parquet(os.path.join(self.root, "commits"))

    def _rows(self, spark: SparkSession, run: str | None = None, before: int | None = None) -> DataFrame:
        """Stored rows with ``_place``; of one run and its batches before a number where given."""
        commits = self.commits(spark)
        if run is not None:
            known = commits.filter((F.col("run") == run) & (F.col("batch") == before)).agg(F.min("place")).first()[0]
            commits = commits if known is None else commits.filter(F.col("place") < known)
        listed = commits.collect()  # a row per commit since the last compaction
        parts = [
            spark.read.schema(self.schema).parquet(self._data(r["run"], r["batch"])).withColumn("_place", F.lit(r["place"]))
            for r in listed
        ]
        if not parts:
            return spark.createDataFrame([], self.schema).withColumn("_place", F.lit(0).cast("bigint"))
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        return rows

    def read(self, spark: SparkSession, run: str | None = None, before: int | None = None) -> DataFrame:
        """The table's rows, or what it held before a batch of a run."""
        rows = self._rows(spark, run, before)
        if self.keys:
            rows = latest_per_key(rows, list(self.keys), ["_place"])
        return rows.drop("_place")

    def compact(self, spark: SparkSession, run: str, batch: int) -> None:
        """Fold the commits before this batch into one, then remove the folders that it replaces.

        The batch itself stays apart, so it can be run again after the fold.
        """
        commits = self.commits(spark)
        mine = commits.filter((F.col("run") == run) & (F.col("batch") == batch)).agg(F.min("place")).first()[0]
        old = [] if mine is None else commits.filter(F.col("place") < mine).collect()
        if len(old) < 2:
            return
        name = f"{run}-folded"
        self.write(self.read(spark, run, batch), name, batch, max(r["place"] for r in old))
        for r in old:
            _remove(spark, self._data(r["run"], r["batch"]))


# How many rows a database insert sends at once.
JDBC_BATCH_ROWS = 20


def upsert_statement(table: str, staged: str, columns: list[str], keys: tuple = ("h3_cell", DATE)) -> str:
    """SQL that moves rows appended to a staged table into a keyed table."""
    names = ", ".join(columns)
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in keys)
    return (
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staged} "
        f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {updates}"
    )
