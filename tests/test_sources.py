"""Typed scans: declared schema, quoting off, empty cells, text parse parity."""

import os

from tramline.sources.csv import read_bus_csv, read_lines, split_bus_lines, typed


def test_csv_scan_declared_schema_quote_off(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bus")
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w") as fh:
        fh.write('2013-01-07 08:00:00,7,"027B,0,-6.26,53.35,90,33304,7486,1\n')
        fh.write("2013-01-07 08:00:05,7,,1,-6.27,53.36,-30,33304,-1,0\n")
    rows = typed(read_bus_csv(spark, path)).orderBy("date").collect()
    # With quoting off a double quote is an ordinary character.
    assert rows[0].busLinePatternID == '"027B' and rows[0].congestion == 0
    assert rows[0].date.isoformat() == "2013-01-07T08:00:00"
    # The CSV reader turns an empty cell into NULL; -1 (no stop) is kept.
    assert rows[1].busLinePatternID is None and rows[1].closerStopID == -1
    assert rows[1].delay == -30


def test_text_parse_agrees_with_csv_scan_on_good_lines(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bus")
    os.makedirs(path)
    lines = [f"2013-01-07 08:00:{s:02d},{s % 3},P{s},{s % 2},-6.2{s},53.3{s},{s - 5},{s % 4},{s},1"
             for s in range(10)]
    with open(os.path.join(path, "a.csv"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    scan = typed(read_bus_csv(spark, path))
    good, bad = split_bus_lines(read_lines(spark, path))
    assert bad.count() == 0
    assert sorted(map(tuple, scan.collect())) == sorted(map(tuple, good.select(*scan.columns).collect()))


def test_sql_over_registered_views_equals_operators(spark):
    from conftest import SF_SMALL
    from tramline.plans import bikes, transit
    from tramline.sources.tables import register_views, telemetry
    register_views(spark, SF_SMALL)
    sql = spark.sql("""
        SELECT date_format(date, 'HH') AS hour,
               round(100.0D * sum(congestion) / count(*), 2) AS percentage,
               count(*) AS numMeasurements, sum(congestion) AS congestionMeasurements
        FROM telemetry
        WHERE latitude BETWEEN 53.3343619D AND 53.3702027D
          AND longitude BETWEEN -6.2886331D AND -6.2043634D
          AND weekday(date) < 5 AND hour(date) IN (7, 8, 9)
        GROUP BY 1""")
    ops = transit.congestion_by_hour(telemetry(spark, SF_SMALL))
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, ops.collect()))
    avg_sql = spark.sql("""
        SELECT station_id, hrs, round(avg(available_bikes), 2) AS bikes
        FROM (SELECT station_id, hour(time) AS hrs, available_bikes FROM bike_readings
              WHERE weekday(time) < 5 AND status = 'Open' AND hour(time) BETWEEN 7 AND 19)
        GROUP BY station_id, hrs""")
    from tramline.sources.tables import bike_readings
    avg_ops = bikes.hourly_station_average(bike_readings(spark, SF_SMALL))
    assert sorted(map(tuple, avg_sql.collect())) == sorted(map(tuple, avg_ops.collect()))


GOOD = "2024-01-08 07:00:00,1,p,0,-6.25,53.35,10,7,3,1"
BAD = [GOOD + ",extra", "2024-01-08 07:00:00,1,p", GOOD.replace(",10,", ",n/a,"),
       GOOD.replace("2024-01-08", "8 Jan")]


def test_bus_rows_reject_malformed_lines(spark, tmp_dir):
    from tramline.plans.transit import congestion_by_hour
    from tramline.sources.csv import bus_rows
    spark.createDataFrame([(x,) for x in [GOOD, *BAD]], "value string").write.text(f"{tmp_dir}/bus")
    good, bad = bus_rows(spark, f"{tmp_dir}/bus")
    row = congestion_by_hour(good).collect()
    assert [(r.hour, r.percentage, r.numMeasurements) for r in row] == [("07", 0.0, 1)]
    assert sorted(r.reason for r in bad.collect()) == ["bad_value"] * 2 + ["field_count"] * 2


def test_reading_ids_do_not_depend_on_packing(spark, tmp_dir):
    from tramline.sources.csv import bus_rows
    lines = [(GOOD.replace(",3,", f",{i},"),) for i in range(40)]
    spark.createDataFrame(lines, "value string").repartition(4).write.text(f"{tmp_dir}/bus")
    key = "spark.sql.files.maxPartitionBytes"
    before, seen = spark.conf.get(key), []
    try:
        for size in ("128m", "300b"):
            spark.conf.set(key, size)
            good, _ = bus_rows(spark, f"{tmp_dir}/bus")
            seen.append(sorted((r.reading_id, r.closerStopID) for r in good.collect()))
    finally:
        spark.conf.set(key, before)
    assert seen[0] == seen[1] and len({i for i, _ in seen[0]}) == 40


def test_bike_rows_reject_malformed_lines(spark, tmp_dir):
    from tramline.sources.csv import bike_lines, bike_rows
    from tramline.sources.tables import bike_readings
    from conftest import SF_SMALL
    lines = bike_lines(bike_readings(spark, SF_SMALL))
    one = lines.first()[0]
    dirty = [one + ",x", "a,b", one.replace(one.split(",")[1], "yesterday", 1)]
    lines.unionByName(spark.createDataFrame([(x,) for x in dirty], "value string")).write.text(
        f"{tmp_dir}/bikes")
    good, bad = bike_rows(spark, f"{tmp_dir}/bikes")
    assert good.count() == lines.count() and bad.count() == 3


def test_shared_folder_must_be_named_on_a_cluster():
    import pytest
    from tramline.session import require_local
    for master in ("local", "local[4]", "local[*]"):
        require_local(master)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            require_local(master)


def test_stored_copy_follows_its_table(spark, tmp_dir):
    import time
    from tramline.sources.tables import read_table, telemetry
    from conftest import SF_SMALL
    events = read_table(spark, SF_SMALL, "events")
    events.limit(50).write.parquet(f"{tmp_dir}/events.parquet")
    assert telemetry(spark, tmp_dir).count() == 50
    time.sleep(1.1)
    events.limit(70).write.mode("append").parquet(f"{tmp_dir}/events.parquet")
    assert telemetry(spark, tmp_dir).count() == 120


def test_extremes_in_rows(spark):
    """Ties give a row each, not a product."""
    from tramline.operators import extreme_owners
    df = spark.createDataFrame([("a", i, float(i % 2)) for i in range(600)] + [("b", 1, 5.0)],
                               "g string, e int, v double")
    got = extreme_owners(df, "g", "e", "v").collect()
    assert len(got) == 602
    assert sorted((r.which, r.value, r.owner) for r in got if r.g == "b") == [
        ("max", 5.0, 1), ("min", 5.0, 1)]
