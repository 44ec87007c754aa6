"""Registration, the telemetry in SQL, and the stored table some queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from netvigil.operators.forecast import forecast
from netvigil.schema import HOUR, MINUTE
from netvigil.session import exists, new_path
from netvigil.sources.adapter import raw_clock, telemetry
from netvigil.sources.tables import write_daily, write_forecast

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

START_MS = 1_704_067_200_000
END_MS = START_MS + 12 * HOUR


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Adds a query under a name; ``sql`` computes the same in the oracle, after the telemetry CTEs."""

    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = EV + sql
        return query

    return add


# Telemetry as SQL: closes with the CTE ``ev``; a query goes on with ", more AS (...)" or SELECT.
EV = """
WITH RECURSIVE raw_ev AS (
  SELECT event_id, user_id, event_type, strftime(ts, '%Y.%m.%d') AS raw_day, epoch_us(ts) // 1000 AS raw_ms,
    CAST(regexp_extract(props, '-?[0-9]+') AS INTEGER) AS k,
    (epoch_us(ts) - 1704067200000000) // 60 + 1704067200000000 AS ts_us
  FROM events
), timed AS (
  SELECT *, ts_us // 1000 AS ts_ms, (ts_us // 60000000) % 60 BETWEEN 50 AND 54 AS burst,
    event_type = 'error' AS err, (user_id // 6) % 6 AS place
  FROM raw_ev
), ev AS (
  SELECT event_id, ts_ms, raw_day, raw_ms, burst, place,
    CASE WHEN burst THEN 'BR-SP-CORE-101' ELSE 'BR-SP-CORE-' || CAST(100 + user_id % 6 AS VARCHAR) END AS hostname,
    CASE WHEN burst THEN 'eth0' ELSE list_extract(
      ['GigabitEthernet0/0', 'GigabitEthernet0/1', 'TenGigE1/0', 'TenGigE1/1', 'Loopback0'],
      CAST(event_id % 5 + 1 AS INTEGER)) END AS interface,
    CASE WHEN burst THEN 'BR-SP' ELSE list_extract(
      ['SP-Capital', 'SP-Interior', 'RJ-Capital', 'MG-Capital', 'PR-Capital', 'RS-Capital'],
      CAST(place + 1 AS INTEGER)) END AS region,
    CASE WHEN NOT burst THEN list_extract(
      [-23.5505, -22.9099, -22.9068, -19.9208, -25.4284, -30.0346]::DOUBLE[], CAST(place + 1 AS INTEGER)) END AS lat,
    CASE WHEN NOT burst THEN list_extract(
      [-46.6333, -47.0626, -43.1729, -43.9378, -49.2733, -51.2177]::DOUBLE[], CAST(place + 1 AS INTEGER)) END AS lon,
    CASE WHEN burst OR err THEN 'CRITICAL' WHEN event_type = 'purchase' THEN 'WARNING' ELSE 'INFO' END AS severity,
    CASE WHEN burst THEN 'ANOMALIA INJETADA: BGP Peer Down / Link Failure'
      WHEN err THEN list_extract(['ANOMALY: Traffic Spike Detected', 'ANOMALY: High packet loss on trunk',
        'ANOMALY: CPU threshold exceeded', 'ANOMALY: Memory exhaustion warning', 'ANOMALY: Link flapping detected'],
        k % 5 + 1)
      ELSE list_extract(['Normal traffic', 'Routine health check passed', 'Interface status UP',
        'BGP session established', 'SNMP poll completed'], k % 5 + 1) END AS message,
    CAST((CASE WHEN burst THEN 9500 + 4 * k WHEN err THEN 8800 + 12 * k ELSE 1000 + 35 * k END) * 0.01
      AS DECIMAL(9, 2)) AS utilization_pct,
    CAST((CASE WHEN burst THEN 50000 + 1000 * k WHEN err THEN 20000 + 600 * k ELSE 100 + 49 * k END) * 0.01
      AS DECIMAL(9, 2)) AS latency_ms,
    CAST((CASE WHEN burst THEN 50000 + 500 * k WHEN err THEN 5000 + 200 * k ELSE 5 * k END) * 0.001
      AS DECIMAL(9, 3)) AS packet_loss_pct
  FROM timed
)
"""

UTIL = "CAST(sum(utilization_pct) AS DOUBLE) / count(utilization_pct)"
LATENCY = "CAST(sum(latency_ms) AS DOUBLE) / count(latency_ms)"
LOSS = "CAST(sum(packet_loss_pct) AS DOUBLE) / count(packet_loss_pct)"


def history_sql(as_of: str, field: str = "utilization_pct", name: str = "hist", until: str | None = None) -> str:
    """Minute means per host since an hour before ``as_of``, as a CTE."""
    upper = f" AND ts_ms <= {until}" if until else ""
    return f"""
, {name} AS (
  SELECT hostname, ts_ms - ts_ms % 60000 AS key, CAST(sum({field}) AS DOUBLE) / count(*) AS y, count(*) AS docs
  FROM ev WHERE ts_ms >= {as_of} - 3600000{upper} GROUP BY ALL
)"""


def fit_sql(history: str = "hist", name: str = "fit") -> str:
    """The line through each host's minute means, as CTEs."""
    return f"""
, {name}_x AS (
  SELECT hostname, y, min(key) OVER w AS first_key, max(key) OVER w AS last_key, (key - min(key) OVER w) / 60000.0 AS x
  FROM {history} WINDOW w AS (PARTITION BY hostname)
), {name}_s AS (
  SELECT hostname, first_key, last_key, count(*) AS n, CAST(sum(x) AS DOUBLE) AS sx, sum(y) AS sy,
    CAST(sum(x * x) AS DOUBLE) AS sxx, sum(x * y) AS sxy
  FROM {name}_x GROUP BY ALL
), {name}_m AS (
  SELECT *, CASE WHEN n >= 2 AND n * sxx - sx * sx <> 0 THEN (n * sxy - sx * sy) / (n * sxx - sx * sx)
    ELSE 0.0 END AS slope
  FROM {name}_s
), {name} AS (
  SELECT *, CASE WHEN n >= 2 AND n * sxx - sx * sx <> 0 THEN (sy - slope * sx) / n ELSE 0.0 END AS intercept
  FROM {name}_m
)"""


def points_sql(fit: str = "fit", name: str = "points") -> str:
    """The 15 predicted minutes of each host, as a CTE."""
    return f"""
, {name} AS (
  SELECT hostname, last_key + i * 60000 AS ts_ms,
    round(least(100.0, greatest(0.0, slope * ((last_key + i * 60000 - first_key) / 60000.0) + intercept)), 2)
      AS utilization_pct
  FROM {fit}, range(1, 16) AS steps(i) WHERE n >= 2
)"""


_stored: dict[tuple[str, str], str] = {}


def event_table(spark: SparkSession, sf_dir: str) -> str:
    """All telemetry in daily partitions, by uncompressed day, plus a forecast run at the end of the data.

    Written once per application into the shared folder; queries only read it.
    """
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _stored or not exists(spark, _stored[place]):
        root = new_path(spark, "events")
        events = telemetry(spark, sf_dir)
        write_daily(events, root, raw_clock(), rebalance=True)
        write_forecast(forecast(telemetry(spark, sf_dir, since=END_MS - HOUR), END_MS), root, END_MS)
        _stored[place] = root
    return _stored[place]


__all__ = [
    "END_MS", "EV", "HOUR", "LATENCY", "LOSS", "MINUTE", "ORACLES", "QUERIES", "START_MS", "UTIL",
    "event_table", "fit_sql", "history_sql", "points_sql", "register",
]
