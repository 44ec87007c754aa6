"""Monitors, triggers, throttling and notifications."""

from functools import reduce
from string import Formatter

from pyspark.sql import DataFrame, SparkSession, functions as F

from netvigil.operators import monitor as ops
from netvigil.registry.common import LOSS, UTIL, register
from netvigil.schema import CRITICAL_MONITOR, MONITORS, UTILIZATION_MONITOR, Monitor
from netvigil.sources.adapter import payload_bodies, telemetry


def ticks_sql(name: str, interval: int, reach: int, metrics: str, condition: str, where: str = "TRUE") -> str:
    """Metrics and trigger per tick, as CTEs ending in ``name``."""
    return f"""
, {name}_t AS (
  SELECT *, unnest(range(ts_ms + ({interval} - ts_ms % {interval}) % {interval}, ts_ms + {reach} + 1, {interval})) AS tick
  FROM ev WHERE {where}
), {name}_m AS (SELECT tick, {metrics} FROM {name}_t GROUP BY tick)
, {name} AS (SELECT *, {condition} AS fired FROM {name}_m)
"""


UTIL_TICKS = ticks_sql(
    "ut", 60000, 120000,
    f"{UTIL} AS avg_utilization, CAST(max(utilization_pct) AS DOUBLE) AS max_utilization", "avg_utilization > 85",
)
SURGE_TICKS = ticks_sql(
    "st", 120000, 300000,
    f"count(severity) AS critical_count, {LOSS} AS avg_packet_loss", "critical_count > 10", "severity = 'CRITICAL'",
)


def sends_sql(source: str, name: str, hold: int, where: str = "fired") -> str:
    """Ticks of ``source`` that survive the throttle, as a recursive CTE ``name``."""
    return f"""
, {name} AS (
  SELECT min(tick) AS tick FROM {source} WHERE {where}
  UNION ALL
  SELECT min(f.tick) FROM {name} s JOIN {source} f ON f.tick >= s.tick + {hold} AND f.{where} GROUP BY s.tick
)
"""


SENDS = UTIL_TICKS + SURGE_TICKS + sends_sql("ut", "us", 300000) + sends_sql("st", "ss", 600000)
UTIL_NAME = UTILIZATION_MONITOR.name
SURGE_NAME = CRITICAL_MONITOR.name


@register("monitor_utilization", UTIL_TICKS + "SELECT * FROM ut")
def monitor_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = ops.monitor_ticks(telemetry(spark, sf_dir), UTILIZATION_MONITOR)
    return ops.trigger_eval(ticks, UTILIZATION_MONITOR)


@register("monitor_critical_surge", SURGE_TICKS + "SELECT * FROM st")
def monitor_critical_surge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.trigger_eval(ops.monitor_ticks(telemetry(spark, sf_dir), CRITICAL_MONITOR), CRITICAL_MONITOR)


@register(
    "trigger_eval",
    UTIL_TICKS + SURGE_TICKS
    + f"SELECT '{UTIL_NAME}' AS monitor, tick FROM ut WHERE fired UNION ALL SELECT '{SURGE_NAME}', tick FROM st WHERE fired",
)
def trigger_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = telemetry(spark, sf_dir)
    return reduce(DataFrame.unionByName, [ops.firing_ticks(events, m).select("monitor", "tick") for m in MONITORS])


@register(
    "throttle",
    SENDS + f"SELECT '{UTIL_NAME}' AS monitor, tick FROM us WHERE tick IS NOT NULL UNION ALL "
    f"SELECT '{SURGE_NAME}', tick FROM ss WHERE tick IS NOT NULL",
)
def throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = telemetry(spark, sf_dir)
    sends = [
        ops.throttle(ops.firing_ticks(events, m).select("monitor", "tick"), m.interval_ms, m.throttle_ms)
        for m in MONITORS
    ]
    return reduce(DataFrame.unionByName, sends)


ISO = "strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%dT%H:%M:%SZ')"


def _text_sql(template: str) -> str:
    """SQL text of a template with ``{column}`` placeholders."""
    parts = []
    for text, name, _, _ in Formatter().parse(template):
        quoted = text.replace("'", "''")
        parts += ([f"'{quoted}'"] if text else []) + ([f"CAST({name} AS VARCHAR)"] if name else [])
    return " || ".join(parts)


def _notice_sql(sends: str, ticks: str, monitor: Monitor) -> str:
    """Everything that a notification holds, for the ticks in ``sends``."""
    fields = ",".join(f"\"{f}\":\"' || {f} || '\"" for f in ops.PAYLOAD_FIELDS)
    lines = [
        f"'{ops.TITLE_LINE.format(title='ALERTA NOC')}'", "''", *[_text_sql(line) for line in ops.NAME_LINES],
        f"'{ops.TIME_LINE}' || strftime(make_timestamp(tick * 1000), '%Y-%m-%d %H:%M:%S UTC')",
        _text_sql(ops.PERIOD_LINE), f"chr(10) || {_text_sql(ops.NOTE_LINE)}",
    ]
    value = monitor.metrics[0 if monitor is CRITICAL_MONITOR else 1].name
    return f"""SELECT tick, monitor_name, trigger_name, severity, period_start, period_end, message, value,
  '{{{fields}}}' AS payload, concat_ws(chr(10), {", ".join(lines)}) AS text
FROM (SELECT tick, '{monitor.name}' AS monitor_name, '{monitor.trigger}' AS trigger_name, '{monitor.severity}' AS severity,
  {ISO.format(ms=f'tick - {monitor.interval_ms}')} AS period_start, {ISO.format(ms='tick')} AS period_end,
  {_text_sql(monitor.message)} AS message, CAST({value} AS DOUBLE) AS value FROM {sends} JOIN {ticks} USING (tick))"""


def with_value(rows: DataFrame, monitor: Monitor) -> DataFrame:
    """Notifications of different monitors side by side: the leading metric as ``value``."""
    value = monitor.metrics[0 if monitor is CRITICAL_MONITOR else 1].name
    return rows.withColumn("value", F.col(value).cast("double")).drop(*[m.name for m in monitor.metrics])


NOTICES = _notice_sql("us", "ut", UTILIZATION_MONITOR) + " UNION ALL " + _notice_sql("ss", "st", CRITICAL_MONITOR)


@register("notifications", SENDS + NOTICES)
def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = telemetry(spark, sf_dir)
    return reduce(DataFrame.unionByName, [with_value(ops.notifications(events, m), m) for m in MONITORS])


STAMP = "strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ')"


@register(
    "parse_payloads",
    f"""SELECT event_id,
  CASE WHEN event_id % 5 IN (0, 1) THEN hostname ELSE 'Monitor' END AS monitor_name,
  CASE WHEN event_id % 5 IN (0, 1) THEN interface ELSE 'Trigger' END AS trigger_name,
  CASE WHEN event_id % 5 = 0 THEN severity ELSE 'N/A' END AS severity,
  CASE WHEN event_id % 5 = 0 THEN {STAMP} ELSE '' END AS period_start,
  CASE WHEN event_id % 5 = 0 THEN {STAMP} ELSE '' END AS period_end,
  CASE WHEN event_id % 5 < 4 THEN message WHEN event_id % 25 = 9 THEN '   '
    WHEN event_id % 25 = 14 THEN '{{"message":"a"}} trailing' ELSE '' END AS message
FROM ev""",
)
def parse_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.parse_payloads(payload_bodies(telemetry(spark, sf_dir))).drop("body")
