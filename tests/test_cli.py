"""The command line runs the analyses over CSV folders, batch and stream."""

import os

from pyspark.sql import functions as F

from tramline import cli
from tramline.sources.csv import bike_lines, bus_lines
from tramline.sources.staging import write_feed
from tramline.sources.tables import bike_readings, telemetry
from conftest import SF_SMALL


def test_cli_batch_and_stream(spark, tmp_dir):
    bus = os.path.join(tmp_dir, "bus")
    bus_lines(telemetry(spark, SF_SMALL)).write.text(bus)
    out = cli.run(["congestion", "--input", bus], spark=spark)
    assert out.columns == ["hour", "percentage", "numMeasurements", "congestionMeasurements"]
    out = cli.run(["arrivals", "--input", bus, "--vehicle", "7", "--day", "2024-01-08"],
                  spark=spark)
    assert out.columns == ["lineID", "stationID", "arrivalTime", "onTime"]
    sink = os.path.join(tmp_dir, "sink")
    cli.run(["stops-per-vehicle", "--input", bus, "--day", "2024-01-08", "--stream",
             "--output", sink], spark=spark)
    assert spark.read.parquet(sink).count() > 0     # complete mode: a folder per epoch
    hist = os.path.join(tmp_dir, "hist")
    cli.run(["distance-histogram", "--input", bus, "--day", "2024-01-08", "--bucket", "10",
             "--output", hist], spark=spark)
    assert spark.read.parquet(hist).columns == ["bucket", "bucket_range", "numVehicles"]


def test_cli_bikes(spark, tmp_dir):
    src = os.path.join(tmp_dir, "bikes")
    bike_lines(bike_readings(spark, SF_SMALL)).write.text(src)
    out = cli.run(["bike-extremes", "--input", src], spark=spark)
    assert out.columns == ["HOUR", "min_bike", "max_bike", "min_bike_station_id",
                           "max_bike_station_id"]
    assert out.count() > 0


def test_cli_bikes_as_a_stream(spark, tmp_dir):
    src = os.path.join(tmp_dir, "bikes")
    bike_lines(bike_readings(spark, SF_SMALL)).repartition(3).write.text(src)
    want = cli.run(["bike-extremes", "--input", src], spark=spark)
    out = os.path.join(tmp_dir, "out")
    cli.run(["bike-extremes", "--input", src, "--stream", "--max-files-per-trigger", "1",
             "--output", out], spark=spark)
    got = spark.read.parquet(f"{out}-result")
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(
        map(tuple, want.collect()))


def test_cli_arrivals_out_of_order(spark, tmp_dir):
    """One order of files is that of time, the other is not: same arrivals."""
    rows = telemetry(spark, SF_SMALL).where("vehicleID = 7")
    day = rows.groupBy(F.to_date("date").cast("string").alias("d")).count().orderBy(
        F.desc("count")).first().d
    told = []
    for name, parts, more in (("a", 1, []), ("b", 4, ["--lateness", "1 day"])):
        src, out = os.path.join(tmp_dir, name), os.path.join(tmp_dir, f"{name}-out")
        write_feed(rows, src, parts=parts, files=1, delay_seconds=F.pmod(
            F.xxhash64("reading_id"), F.lit(80_000)) if more else None)
        cli.run(["arrivals", "--input", src, "--stream", "--vehicle", "7", "--day", day,
                 "--width", "2 hours", "--slide", "1 hour", "--max-files-per-trigger", "1",
                 "--output", out, *more], spark=spark)
        told.append(sorted(map(tuple, spark.read.parquet(f"{out}-result").collect())))
    assert told[0] == told[1] and told[0]


def test_cli_stream_outputs(spark, tmp_dir):
    bus = os.path.join(tmp_dir, "bus")
    bus_lines(telemetry(spark, SF_SMALL)).write.text(bus)
    out = os.path.join(tmp_dir, "congestion")
    cli.run(["congestion", "--input", bus, "--stream", "--width", "1 day", "--output", out],
            spark=spark)
    rows = spark.read.parquet(out)
    assert {"window_start", "window_end", "hour", "percentage"} <= set(rows.columns)
    arrivals = os.path.join(tmp_dir, "arrivals")
    cli.run(["arrivals", "--input", bus, "--stream", "--vehicle", "7", "--day", "2024-01-08",
             "--width", "2 hours", "--slide", "1 hour", "--output", arrivals], spark=spark)
    assert spark.read.parquet(f"{arrivals}-result").columns == [
        "window_start", "window_end", "lineID", "stationID", "arrivalTime", "onTime"]


def test_cli_streams_without_output(spark, tmp_dir, capsys):
    """Sinks then belong to the checkpoint; the result's first rows are shown."""
    bus = os.path.join(tmp_dir, "bus")
    bus_lines(telemetry(spark, SF_SMALL)).write.text(bus)
    common = ["--input", bus, "--stream", "--rows", "2"]
    sink = cli.run(["distance-histogram", *common, "--day", "2024-01-08", "--bucket", "1",
                    "--checkpoint", f"{tmp_dir}/h"], spark=spark)
    assert sink == f"{tmp_dir}/h-sink"
    assert "bucket_range" in capsys.readouterr().out
    cli.run(["busiest-stops", *common, "--start", "2024-01-02 00:00:00", "--horizon", "864000",
             "--width", "6 hours"], spark=spark)
    shown = capsys.readouterr()
    assert "numVehicles" in shown.out and "first 2 of" in shown.err
    cli.run(["vehicles-per-stop", *common, "--start", "2024-01-08 00:00:00", "--horizon", "86400",
             "--width", "1 hour", "--arrival-time", "--output", f"{tmp_dir}/v"], spark=spark)


def test_cli_rejects_malformed_lines(spark, tmp_dir, capsys):
    good = "2024-01-08 07:00:00,1,p,0,-6.25,53.35,10,7,3,1"
    rows = [good, good + ",extra", good.replace(",10,", ",n/a,")]
    spark.createDataFrame([(x,) for x in rows], "value string").write.text(f"{tmp_dir}/bus")
    out = cli.run(["congestion", "--input", f"{tmp_dir}/bus"], spark=spark)
    assert [r.numMeasurements for r in out.collect()] == [1]
    assert "rejected lines (field_count): 1" in capsys.readouterr().err
