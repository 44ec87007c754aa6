"""Dashboard panels."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from netvigil.functions.predicates import term
from netvigil.functions.times import daily_name, event_ms
from netvigil.operators.forecast import forecast, forecast_union
from netvigil.plans import panels
from netvigil.registry.aggregations import AUTO, geohash_sql, other_sql
from netvigil.registry.common import (
    END_MS,
    HOUR,
    LATENCY,
    LOSS,
    UTIL,
    event_table,
    fit_sql,
    history_sql,
    points_sql,
    register,
)
from netvigil.schema import EVENT_PREFIX, FORECAST_PREFIX
from netvigil.sources.adapter import telemetry
from netvigil.sources.tables import read_events


def band_sql(value: str, edges: tuple[int, ...]) -> str:
    cases = " ".join(f"WHEN {value} >= {a} AND {value} < {b} THEN {i}" for i, (a, b) in enumerate(zip(edges, edges[1:])))
    return f"CASE {cases} END AS band"


@register("panel_ingest_volume", "SELECT count(*) AS docs FROM ev")
def panel_ingest_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.ingest_volume(telemetry(spark, sf_dir))


@register(
    "panel_critical_count",
    ", c AS (SELECT count(*) AS critical_events FROM ev WHERE severity = 'CRITICAL') "
    f"SELECT critical_events, {band_sql('critical_events', (0, 5, 20, 1000))} FROM c",
)
def panel_critical_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.critical_count(telemetry(spark, sf_dir))


@register(
    "panel_avg_utilization",
    f", a AS (SELECT {UTIL} AS avg_utilization FROM ev) "
    f"SELECT avg_utilization, {band_sql('avg_utilization', (0, 30, 60, 100))} FROM a",
)
def panel_avg_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.avg_utilization(telemetry(spark, sf_dir))


@register(
    "panel_avg_latency",
    f", a AS (SELECT {LATENCY} AS avg_latency FROM ev) "
    f"SELECT avg_latency, {band_sql('avg_latency', (0, 50, 200, 1000))} FROM a",
)
def panel_avg_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.avg_latency(telemetry(spark, sf_dir))


def _ranked(term_column: str, metric: str, name: str, size: int) -> str:
    return AUTO + f""", g AS (SELECT key, {term_column}, {metric} AS {name} FROM evk GROUP BY 1, 2)
, top AS (SELECT * FROM g
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY {name} DESC, {term_column}) <= {size})
"""


@register(
    "panel_util_trend",
    _ranked("hostname", UTIL, "avg_utilization", 6)
    + "SELECT key, hostname, avg_utilization, avg_utilization > 80 AS above_80 FROM top",
)
def panel_util_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.util_trend(telemetry(spark, sf_dir))


@register("panel_severity_timeline", _ranked("severity", "count(*)", "count", 5) + "SELECT key, severity, count FROM top")
def panel_severity_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.severity_timeline(telemetry(spark, sf_dir))


@register(
    "panel_severity_timeline_stored",
    _ranked("severity", "count(*)", "count", 5) + "SELECT key, severity, count FROM top",
)
def panel_severity_timeline_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stored table: file footers give the interval, and the rows are read once."""
    root = event_table(spark, sf_dir)
    step = panels.stored_interval(spark, root)
    return panels.severity_timeline(read_events(spark, root, include_forecast=False), interval=step)


@register(
    "panel_host_heatmap",
    _ranked("hostname", UTIL, "avg_utilization", 10) + "SELECT key, hostname, avg_utilization FROM top",
)
def panel_host_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.host_heatmap(telemetry(spark, sf_dir))


def _shown_total(column: str) -> str:
    return f"list_reduce(list_sort(list({column})), lambda a, b: a + b)"


@register(
    "panel_top_hosts",
    f""", t AS (SELECT hostname, count(*) AS count, {UTIL} AS avg_utilization, {LATENCY} AS avg_latency,
    {LOSS} AS avg_packet_loss
  FROM ev WHERE severity = 'CRITICAL' GROUP BY hostname ORDER BY count DESC, hostname LIMIT 10)
SELECT hostname, 0 AS is_total, count, avg_utilization, avg_latency, avg_packet_loss FROM t UNION ALL
SELECT NULL, 1, CAST(sum(count) AS BIGINT), {_shown_total('avg_utilization')}, {_shown_total('avg_latency')},
  {_shown_total('avg_packet_loss')} FROM t""",
)
def panel_top_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.top_hosts(telemetry(spark, sf_dir))


@register(
    "panel_latency_histogram",
    "SELECT floor(CAST(latency_ms AS DOUBLE) / 25.0) * 25.0 AS bucket, count(*) AS count FROM ev GROUP BY 1",
)
def panel_latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.latency_histogram(telemetry(spark, sf_dir))


@register(
    "panel_latency_vs_loss",
    AUTO + f", g AS (SELECT key, {LATENCY} AS avg_latency, {LOSS} AS avg_packet_loss FROM evk GROUP BY key) "
    "SELECT key, avg_latency, avg_packet_loss, avg_latency > 200 AS above_200 FROM g",
)
def panel_latency_vs_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.latency_vs_loss(telemetry(spark, sf_dir))


@register("panel_region_share", other_sql(10))
def panel_region_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.region_share(telemetry(spark, sf_dir))


@register("panel_geo_heat", geohash_sql(2))
def panel_geo_heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.geo_heat(telemetry(spark, sf_dir))


@register(
    "panel_forecast",
    history_sql(str(END_MS)) + fit_sql() + points_sql() + """
, both_kinds AS (
  SELECT ts_ms, 'telecom-noc-2024.01.01' AS source_index, utilization_pct FROM ev UNION ALL
  SELECT ts_ms, 'telecom-noc-forecast-2024.01.01', CAST(utilization_pct AS DECIMAL(9, 2)) FROM points)
, g AS (SELECT ts_ms - ts_ms % 60000 AS key, source_index, CAST(sum(utilization_pct) AS DOUBLE) / count(*) AS a
  FROM both_kinds GROUP BY 1, 2)
, k AS (SELECT unnest(range(min(key), max(key) + 1, 60000)) AS key FROM g)
SELECT k.key, source_index, a AS avg_utilization, coalesce(a > 85, false) AS above_85
FROM k LEFT JOIN g ON k.key = g.key""",
)
def panel_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = forecast(telemetry(spark, sf_dir, since=END_MS - HOUR), END_MS).select(
        "timestamp",
        "hostname",
        F.col("utilization_pct").cast("decimal(8,2)").alias("utilization_pct"),
        F.lit(f"{FORECAST_PREFIX}2024.01.01").alias("source_index"),
    )
    actual = telemetry(spark, sf_dir).withColumn("source_index", daily_name(EVENT_PREFIX, event_ms()))
    return panels.forecast_panel(forecast_union(actual, predicted))


@register(
    "dashboard_kpis",
    "SELECT count(*) AS docs, count(*) FILTER (severity = 'CRITICAL') AS critical_events, "
    f"{UTIL} AS avg_utilization, {LATENCY} AS avg_latency FROM ev",
)
def dashboard_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.kpis(telemetry(spark, sf_dir))


@register(
    "discover_documents",
    """SELECT event_id, ts_ms, hostname, region, severity, message, CAST(utilization_pct AS DOUBLE) AS utilization_pct
FROM ev WHERE severity = 'CRITICAL' ORDER BY ts_ms DESC, event_id LIMIT 500""",
)
def discover_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = panels.discover(telemetry(spark, sf_dir), where=term("severity", "CRITICAL"))
    return newest.select(
        "event_id", event_ms().alias("ts_ms"), "hostname", "region", "severity", "message",
        F.col("utilization_pct").cast("double").alias("utilization_pct"),
    )
