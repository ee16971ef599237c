"""A hot key: one vehicle with most of the rows must not become one task."""

import pytest
from pyspark.sql import functions as F

from tramline.operators import change_points, with_previous

DAY0 = 1704672000  # 2024-01-08 00:00:00 UTC


@pytest.fixture
def hot(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark.range(24000).select(
        F.lit(1).alias("vehicleID"),
        F.timestamp_seconds(F.lit(DAY0) + F.col("id") * F.lit(3.6)).alias("date"),
        F.col("id").alias("reading_id"),
        (F.col("id") % 3 == 2).cast("int").alias("closerStopID"),
    ).unionByName(spark.range(2000).select(
        (F.col("id") % 20 + 2).cast("int").alias("vehicleID"),
        F.timestamp_seconds(F.lit(DAY0) + F.col("id") * F.lit(40)).alias("date"),
        (F.col("id") + 100000).alias("reading_id"),
        (F.col("id") % 2).cast("int").alias("closerStopID"),
    ))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def task_sizes(df):
    # Rows per task after the operator (counting ``prev`` keeps the window).
    per_task = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count("prev").alias("n"))
    return [r.n for r in per_task.collect()]


def test_hot_series_fans_out_over_slices(spark, hot):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        whole = with_previous(hot, ["vehicleID"], "date", "reading_id", ["closerStopID"],
                              slice_seconds=None)
        sliced = with_previous(hot, ["vehicleID"], "date", "reading_id", ["closerStopID"],
                               slice_seconds=3600)
        assert max(task_sizes(whole)) >= 24000 - 1      # the hot vehicle is one task
        assert max(task_sizes(sliced)) <= 24000 / 3     # spread over its 24 hourly slices
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_series_result_is_exact(spark, hot):
    args = (["vehicleID"], "date", "reading_id", "closerStopID")
    a = {r.reading_id for r in change_points(hot, *args, slice_seconds=None).collect()}
    b = {r.reading_id for r in change_points(hot, *args, slice_seconds=3600).collect()}
    assert a == b and len(a) > 1000
