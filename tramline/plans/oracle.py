"""DuckDB twins of the derived tables, for the oracle SQL of each query.

Each expression mirrors ``tramline.sources.tables`` term by term.
"""

TELEMETRY_SQL = """
SELECT event_id AS reading_id,
       date_trunc('second', ts) AS date,
       CAST(user_id % 3 AS INTEGER) AS busLineID,
       event_type AS busLinePatternID,
       CAST(event_type = 'error' AS INTEGER) AS congestion,
       -6.30::DOUBLE + ((event_id * 37) % 1000) / 10000.0::DOUBLE AS longitude,
       53.30::DOUBLE + ((event_id * 91) % 1000) / 10000.0::DOUBLE AS latitude,
       CAST(floor(value) AS INTEGER) - 50 AS delay,
       CAST(user_id % 25 AS INTEGER) AS vehicleID,
       TRY_CAST(props::json->>'$.k' AS INTEGER) % 8 AS closerStopID,
       CAST(event_type IN ('purchase', 'signup', 'view') AS INTEGER) AS atStop
FROM events
"""

BIKES_SQL = """
SELECT CAST(user_id % 20 AS INTEGER) AS station_id,
       ts AS time,
       TRY_CAST(props::json->>'$.k' AS INTEGER) % 30 AS available_bikes,
       CASE WHEN event_type = 'error' THEN 'Close' ELSE 'Open' END AS status
FROM events
"""

HAVERSINE_M = """(2 * 6371008.8 * asin(sqrt(
    pow(sin(radians({lat2} - {lat1}) / 2), 2)
    + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"""


def with_tables(body: str, ctes: str = "") -> str:
    """Prefix a query body with the derived-table CTEs (and extra ``ctes``,
    written as ``name AS (...), ...``)."""
    extra = f", {ctes}" if ctes else ""
    return f"WITH telemetry AS ({TELEMETRY_SQL}), bike_readings AS ({BIKES_SQL}){extra}\n{body}"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return HAVERSINE_M.format(lat1=lat1, lon1=lon1, lat2=lat2, lon2=lon2)


TS_TEXT_SQL = "%Y-%m-%d %H:%M:%S"


def texted(sql: str, cols: list[str]) -> str:
    """Wrap a query so the timestamp columns ``cols`` come out as ISO text
    (the registered Spark queries do the same), which keeps value hashes
    independent of timestamp units."""
    repl = ", ".join(f"strftime({c}, '{TS_TEXT_SQL}') AS {c}" for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) AS q"
