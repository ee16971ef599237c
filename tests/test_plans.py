"""Physical-plan shape: the properties that matter at scale."""

import contextlib
import io

import pytest

from tramline.plans import registry
from conftest import SF_SMALL

QUERIES = registry.queries()
BATCH = [n for n in QUERIES if not n.startswith("stream") and n != "scan_csv_stream"]


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_batch_plans_stay_in_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                        "MapInPandas"):
        assert python_node not in text, name
    # No window runs without a partition key (that would be one task).
    for line in text.splitlines():
        assert "windowspecdefinition(specifiedwindowframe" not in line, name


def test_series_split_by_time_slices(spark):
    text = plan(QUERIES["change_points"](spark, SF_SMALL))
    assert "hashpartitioning(vehicleID" in text and "__slice" in text
    # The rows' window partitioning is (vehicle, line, slice), never (vehicle, line) alone.
    for line in text.splitlines():
        if "hashpartitioning(vehicleID" in line and "__slice" not in line:
            # only the small per-slice table may be keyed by the series alone
            assert "Exchange" not in line or "_w0" not in line


def test_aggregates_are_partial_before_shuffle(spark):
    text = plan(QUERIES["congestion_by_hour"](spark, SF_SMALL))
    assert "partial_count" in text
    text = plan(QUERIES["stops_per_vehicle"](spark, SF_SMALL))
    assert text.count("HashAggregate") >= 4   # distinct pairs + counts, each partial + final


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_busiest_reads_its_pairs_once(spark):
    # Both branches (lists per stop, and their maximum) start from the same
    # de-duplicated pairs; AQE reuses that shuffle.
    assert "ReusedExchange" in executed(QUERIES["busiest_stops"](spark, SF_SMALL))


def exchanges(final: str) -> list[str]:
    """What each exchange of a plan is fed by (the operator below it)."""
    lines = [ln.strip(" :+-*()0123456789") for ln in final.splitlines()]
    skip = ("AQEShuffleRead", "ShuffleQueryStage", "Exchange", "Project", "Filter", "Sort ")
    out = []
    for i, ln in enumerate(lines):
        if ln.startswith(("Exchange", "BroadcastExchange", "ReusedExchange")):
            out.append(next((x.split()[0].split("(")[0] for x in lines[i + 1:]
                             if x and not x.startswith(skip)), ""))
    return out


@pytest.mark.parametrize("name", ["change_points", "path_distance", "distance_histogram"])
@pytest.mark.parametrize("broadcasts", [True, False])
def test_series_rows_shuffled_once(spark, name, broadcasts):
    """Rows and slice ends meet in a union, which alone is exchanged whole; all
    other exchanges are of aggregates or of windows over these. No join."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in [] if broadcasts else keys:
            spark.conf.set(k, "-1")
        final = executed(QUERIES[name](spark, SF_SMALL)).split("Initial Plan")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    fed = exchanges(final)
    assert fed.count("Union") == 1 and "Join" not in final, final
    assert all(x in ("Union", "HashAggregate", "Window") for x in fed), final
    sorts = [ln for ln in final.splitlines() if "Sort [" in ln]
    assert sum("__mark" in ln for ln in sorts) == 1, final  # the rows, once


def test_bounded_sides_are_broadcast(spark):
    assert "BroadcastExchange" in plan(QUERIES["bike_extremes_by_hour"](spark, SF_SMALL))
    assert "BroadcastExchange" in plan(QUERIES["busiest_with_ties"](spark, SF_SMALL))


def test_scans_are_pruned(spark):
    text = plan(QUERIES["congestion_by_hour"](spark, SF_SMALL))
    assert ("ReadSchema: struct<date:timestamp,congestion:int,longitude:double,latitude:double>"
            in text), text


def test_day_filters_prune_partitions_and_push_down(spark):
    text = plan(QUERIES["vehicle_arrivals"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(day" in text and "(day#" in text
    assert "EqualTo(vehicleID,7)" in text
    assert "GreaterThanOrEqual(date,2024-01-08 00:00:00.0)" in text
    text = plan(QUERIES["vehicles_per_stop"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(day" in text and "EqualTo(atStop,1)" in text


def test_bike_weekday_prunes_partitions_and_status_is_pushed(spark):
    text = plan(QUERIES["bike_extremes_by_hour"](spark, SF_SMALL))
    assert "(weekday(day" in text and "PartitionFilters" in text
    assert "EqualTo(status,Open)" in text
    assert "ReadSchema: struct<station_id:int,time:timestamp,available_bikes:int,status:string>" in text
