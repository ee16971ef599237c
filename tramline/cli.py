"""Command line: run an analysis over a folder of CSV files, batch or stream.

    python -m tramline congestion --input DIR [--stream] [--output DIR]
    python -m tramline arrivals --input DIR --vehicle 33145 --day 2013-01-02
    python -m tramline busiest-stops --input DIR --start "2013-01-07 06:30:00" --horizon 1800
    python -m tramline vehicles-per-stop --input DIR --start ... --horizon ... [--stream]
    python -m tramline stops-per-vehicle --input DIR --day 2013-01-07 [--stream]
    python -m tramline distance-histogram --input DIR --day 2013-01-07 --bucket 1 --max-speed 28
    python -m tramline bike-extremes --input DIR [--first-hour 7 --last-hour 19] [--stream]

Batch runs read the folder once; ``--stream`` watches it (``--trigger`` for
a processing-time interval, otherwise it drains what is there and stops).
Results go to ``--output`` (parquet; streams also need ``--checkpoint`` when
restarts must resume) or, without it, are shown on the console. Streams that
carry a table from trigger to trigger (arrivals, busiest-stops, bike-extremes,
distance-histogram) keep it in ``--output``, or beside the checkpoint, and at
their end write their rows to ``<output>-result``.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.predicates import hour_between, is_weekday, on_day, within_horizon
from tramline.plans import bikes, transit
from tramline.session import build_session, fresh_dir
from tramline.sources.csv import bike_rows, bike_rows_stream, bus_rows, bus_rows_stream
from tramline.sources.schemas import STATUS_OPEN
from tramline.streaming import forms
from tramline.streaming.extremes import extremes_after, side_by_side, start_extremes
from tramline.streaming.reorder import finished, start_in_order
from tramline.streaming.runner import await_end, carried, flatten_window, read_sink, start
from tramline.streaming.state import histogram_per_batch, latest_histogram


#: A running stream: how to start it on (sink, checkpoint, trigger), and its
#: result table read from the sink.
Stream = tuple[Callable, Callable[[SparkSession, str], DataFrame]]


def _bus(spark: SparkSession, args) -> DataFrame:
    """Good readings; rejected lines are counted and told (batch)."""
    if args.stream:
        good, _ = bus_rows_stream(spark, args.input,
                                  max_files_per_trigger=args.max_files_per_trigger)
        return good.withColumn("arrival", F.current_timestamp()) if args.arrival_time else good
    good, bad = bus_rows(spark, args.input)
    _tell_rejected(bad)
    return good


def _tell_rejected(bad: DataFrame) -> None:
    for r in bad.groupBy("reason").count().collect():   # two reasons at most
        print(f"rejected lines ({r['reason']}): {r['count']}", file=sys.stderr)


def _window_ts(args) -> str | None:
    return "arrival" if args.arrival_time else None


def _plain(out: DataFrame, mode: str) -> Stream:
    """A stream whose sink is its result (in update mode folded by its keys)."""
    def begin(sink, checkpoint, trigger):
        return start(out, mode=mode, sink=sink, checkpoint=checkpoint, processing_time=trigger)
    begin.console = (out, mode)
    return begin, lambda spark, sink: read_sink(spark, sink, out.schema, mode=mode)


def _congestion(spark, args):
    box = {"north": args.north, "east": args.east, "south": args.south, "west": args.west}
    if args.stream:
        return _plain(flatten_window(forms.congestion_windows(
            _bus(spark, args), width=args.width, box=box, hours=args.hours, delay=args.delay,
            window_ts=_window_ts(args))), "append")
    return transit.congestion_by_hour(_bus(spark, args), box=box, hours=args.hours)


def _arrivals(spark, args):
    if args.stream:
        picked = _bus(spark, args).where((F.col("vehicleID") == args.vehicle)
                                         & on_day("date", args.day))
        step = forms.change_points_step(width=args.width, slide=args.slide,
                                        partition=("busLineID",), window_ts=_window_ts(args))

        checkpoints = []

        def begin(sink, checkpoint, trigger):
            checkpoints.append(checkpoint)
            if not args.lateness:
                return carried(picked, step, sink=sink, checkpoint=checkpoint,
                               processing_time=trigger)
            return start_in_order(picked, ["busLineID"], step, sink=sink, checkpoint=checkpoint,
                                  lateness=args.lateness, slice_seconds=args.slice_seconds,
                                  processing_time=trigger)

        def result(spark, sink):
            changes = (finished(spark, step, "changes", picked.schema, sink=sink,
                                checkpoint=checkpoints[-1])
                       if args.lateness else spark.read.parquet(f"{sink}/changes"))
            return forms.arrivals_of(changes, args.delay_limit)
        return begin, result
    return transit.vehicle_arrivals(_bus(spark, args), vehicle=args.vehicle, day=args.day,
                                    delay_limit=args.delay_limit)


def _busiest(spark, args):
    if args.stream:
        rows = _bus(spark, args).where(within_horizon("date", args.start, args.horizon))
        pairs = flatten_window(forms.vehicles_at_stops_windows(
            rows, width=args.width, delay=args.delay, window_ts=_window_ts(args)))
        begin, read = _plain(pairs, "update")
        del begin.console
        return begin, lambda spark, sink: forms.busiest_of_windows(read(spark, sink).distinct())
    return transit.busiest_stops(_bus(spark, args), start=args.start, horizon=args.horizon)


def _vehicles_per_stop(spark, args):
    if args.stream:
        return _plain(flatten_window(forms.vehicles_per_stop_windows(
            _bus(spark, args), start=args.start, horizon=args.horizon, width=args.width,
            delay=args.delay, window_ts=_window_ts(args))), "append")
    return transit.vehicles_per_stop(_bus(spark, args), start=args.start, horizon=args.horizon,
                                     exact=not args.approx)


def _stops_per_vehicle(spark, args):
    if args.stream:
        return _plain(forms.distinct_stops_running(_bus(spark, args), day=args.day), "complete")
    return transit.stops_per_vehicle(_bus(spark, args), day=args.day, exact=not args.approx)


def _distance_histogram(spark, args):
    if args.stream:
        day_rows = _bus(spark, args).where(on_day("date", args.day))

        def begin(sink, checkpoint, trigger):
            return histogram_per_batch(day_rows, max_speed=args.max_speed, size=args.bucket,
                                       sink=sink, checkpoint=checkpoint, processing_time=trigger)
        return begin, latest_histogram
    return transit.distance_histogram(_bus(spark, args), day=args.day, max_speed=args.max_speed,
                                      size=args.bucket)


def _bike_extremes(spark, args):
    if args.stream:
        rows, _ = bike_rows_stream(spark, args.input,
                                   max_files_per_trigger=args.max_files_per_trigger)
        picked = rows.where(is_weekday("time") & (F.col("status") == STATUS_OPEN) & hour_between(
            "time", args.first_hour, args.last_hour)).withColumn("HOUR", F.hour("time"))

        def begin(sink, checkpoint, trigger):
            return start_extremes(picked, "HOUR", "station_id", "available_bikes", sink=sink,
                                  checkpoint=checkpoint, processing_time=trigger)
        return begin, lambda spark, sink: bikes.extremes_columns(
            side_by_side(extremes_after(spark, sink), "HOUR"))
    good, bad = bike_rows(spark, args.input)
    _tell_rejected(bad)
    return bikes.bike_extremes_by_hour(good, first_hour=args.first_hour,
                                       last_hour=args.last_hour)


ANALYSES = {
    "congestion": _congestion,
    "arrivals": _arrivals,
    "busiest-stops": _busiest,
    "vehicles-per-stop": _vehicles_per_stop,
    "stops-per-vehicle": _stops_per_vehicle,
    "distance-histogram": _distance_histogram,
    "bike-extremes": _bike_extremes,
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tramline", description=__doc__.split("\n\n")[0])
    p.add_argument("analysis", choices=sorted(ANALYSES))
    p.add_argument("--input", required=True, help="folder of CSV files")
    p.add_argument("--output", help="parquet folder (default: console)")
    p.add_argument("--stream", action="store_true", help="watch the folder as a stream")
    p.add_argument("--trigger", help='processing-time interval, e.g. "10 seconds"')
    p.add_argument("--checkpoint", help="checkpoint folder (streams)")
    p.add_argument("--max-files-per-trigger", type=int)
    p.add_argument("--width", default="10 seconds", help="event-time window width (streams)")
    p.add_argument("--slide", default="5 seconds", help="window slide (sliding streams)")
    p.add_argument("--delay", default="0 seconds", help="watermark delay (streams)")
    p.add_argument("--lateness", help='put readings that arrive up to so late in order, e.g. '
                   '"1 hour" (arrivals stream; later ones are kept aside)')
    p.add_argument("--slice-seconds", type=int, default=900,
                   help="readings put in order leave in slices of this width")
    p.add_argument("--arrival-time", action="store_true",
                   help="windows on the time of arrival, not the reading's own (streams)")
    # The defaults are the box and peak hours of the congestion analysis.
    p.add_argument("--north", type=float, default=transit.CITY_BOX["north"])
    p.add_argument("--east", type=float, default=transit.CITY_BOX["east"])
    p.add_argument("--south", type=float, default=transit.CITY_BOX["south"])
    p.add_argument("--west", type=float, default=transit.CITY_BOX["west"])
    p.add_argument("--hours", nargs="+", default=transit.PEAK_HOURS)
    p.add_argument("--vehicle", type=int)
    p.add_argument("--day")
    p.add_argument("--delay-limit", type=int, default=60)
    p.add_argument("--start")
    p.add_argument("--horizon", type=int)
    p.add_argument("--approx", action="store_true", help="HLL++ distinct counts")
    p.add_argument("--max-speed", type=float, default=28.0)
    p.add_argument("--bucket", type=float, default=1.0)
    p.add_argument("--first-hour", type=int, default=7)
    p.add_argument("--last-hour", type=int, default=19)
    p.add_argument("--rows", type=int, default=20, help="rows shown on the console")
    return p


def _show(table: DataFrame, rows: int) -> None:
    """Print the first rows, and say how many there are."""
    table = table.persist()
    table.show(rows, truncate=False)
    n = table.count()
    if n > rows:
        print(f"first {rows} of {n} rows; --output writes them all", file=sys.stderr)
    table.unpersist()


def run(argv: Sequence[str] | None = None, spark: SparkSession | None = None):
    """Run one analysis; returns the batch result, or the stream's sink path."""
    args = parser().parse_args(argv)
    spark = spark or build_session()
    out = ANALYSES[args.analysis](spark, args)
    if isinstance(out, DataFrame):
        if args.output:
            out.write.mode("overwrite").parquet(args.output)
        else:
            _show(out, args.rows)
        return out
    begin, result = out
    checkpoint = args.checkpoint or fresh_dir(spark, f"cli-{args.analysis}-ckpt")
    if args.output or not hasattr(begin, "console"):
        # A sink belongs to its checkpoint, also where only the latter is named.
        sink = args.output or f"{checkpoint.rstrip('/')}-sink"
        await_end(begin(sink, checkpoint, args.trigger))
        if not args.output:
            _show(result(spark, sink), args.rows)
        elif not hasattr(begin, "console"):
            # The sink holds running state; the analysis' rows go beside it.
            result(spark, sink).write.mode("overwrite").parquet(f"{sink.rstrip('/')}-result")
        return sink
    # Console: for watching a feed interactively (rows go through the driver).
    stream, mode = begin.console
    writer = (stream.writeStream.outputMode(mode).format("console")
              .option("numRows", args.rows).option("truncate", "false")
              .option("checkpointLocation", checkpoint))
    trigger = {"processingTime": args.trigger} if args.trigger else {"availableNow": True}
    writer.trigger(**trigger).start().awaitTermination()
    return None


def main() -> None:
    run()
