"""Stored forms of the telemetry for particular questions, each written once per
application into the shared folder.

* ``telemetry_by_slice``: bucketed and sorted by (vehicle, time slice), so that
  windows and aggregates over these need no exchange;
* ``telemetry_by_cell``: in Z-order of the place, so that boxes skip files and
  row groups;
* ``stop_sketches``: distinct vehicles per (stop, hour) as sketches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators.cells import cell
from tramline.operators.sketches import hourly_sketches
from tramline.sources.tables import stored_copy, telemetry

SLICE, SLICE_SECONDS = "slice", 6 * 3600
CELL = "cell"


def store_by_slice(rows: DataFrame, path: str, *, seconds: int = SLICE_SECONDS,
                   buckets: int | None = None) -> DataFrame:
    """Write readings bucketed by (vehicleID, slice) at ``path``; the table, as
    the session's catalogue knows it. Buckets hold about a million rows each
    unless their number is given."""
    spark = rows.sparkSession
    if buckets is None:
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                      -(-rows.count() // 1_000_000))
    sliced = rows.withColumn(SLICE, F.floor(F.unix_seconds("date") / F.lit(seconds)))
    name = f"telemetry_by_slice_{uuid.uuid4().hex[:12]}"
    # Dealt as they will lie: one file for each bucket.
    (sliced.repartition(buckets, "vehicleID", SLICE)
     .write.bucketBy(buckets, "vehicleID", SLICE).sortBy("vehicleID", SLICE, "date")
     .option("path", path).format("parquet").saveAsTable(name))
    return spark.table(name)


_TABLES: dict[str, DataFrame] = {}


def telemetry_by_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(path: str) -> str:
        _TABLES[path] = store_by_slice(telemetry(spark, sf_dir), path)
        return path
    return stored_copy(spark, "telemetry-by-slice", sf_dir, write, lambda path: _TABLES[path])


def store_by_cell(rows: DataFrame, path: str, *, parts: int | None = None, **options) -> str:
    """Write readings in the order of their cells. Without ``parts`` AQE sizes
    the files from the measured data."""
    celled = rows.withColumn(CELL, cell("latitude", "longitude"))
    dealt = celled.repartitionByRange(*([parts] if parts else []), CELL)
    dealt.sortWithinPartitions(CELL).write.options(**options).parquet(path)
    return path


def telemetry_by_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_copy(spark, "telemetry-by-cell", sf_dir,
                       lambda path: store_by_cell(telemetry(spark, sf_dir), path))


def stop_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(closerStopID, hour, sketch, exact, readings), day-partitioned."""
    def write(path: str) -> str:
        at_stop = telemetry(spark, sf_dir).where(F.col("atStop") == 1)
        (hourly_sketches(at_stop, "closerStopID", "vehicleID")
         .withColumn("day", F.to_date("hour")).repartition("day")
         .sortWithinPartitions("day", "hour").write.partitionBy("day").parquet(path))
        return path
    return stored_copy(spark, "stop-sketches", sf_dir, write)
