"""Table shapes and the settings of forecasts, detectors, monitors and retention."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SECOND = 1_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

# Partition names of the event and forecast tables.
EVENT_PREFIX = "telecom-noc-"
FORECAST_PREFIX = "telecom-noc-forecast-"

LOCATION_TYPE = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])

EVENT_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("hostname", T.StringType()),
    T.StructField("interface", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("location", LOCATION_TYPE),
    T.StructField("severity", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("utilization_pct", T.FloatType()),
    T.StructField("latency_ms", T.FloatType()),
    T.StructField("packet_loss_pct", T.FloatType()),
])
EVENT_FIELDS = EVENT_SCHEMA.fieldNames()
NUMERIC_FIELDS = ["utilization_pct", "latency_ms", "packet_loss_pct"]

# Longest message kept in the exact-match copy of the message field.
KEYWORD_LIMIT = 256


@dataclass(frozen=True)
class Metric:
    """One named aggregate: ``kind`` is avg, max, value_count or filter_count.

    ``field`` is a column, or for filter_count a SQL predicate.
    """

    name: str
    kind: str
    field: str


@dataclass(frozen=True)
class ForecastSettings:
    history_ms: int = 60 * MINUTE
    bucket_ms: int = MINUTE
    horizon: int = 15
    max_hosts: int | None = None


@dataclass(frozen=True)
class Detector:
    """Features per window (and per category), shingled over the last windows."""

    name: str
    metrics: tuple[Metric, ...]
    interval_ms: int
    shingle: int
    category: str | None = None
    delay_ms: int = MINUTE


@dataclass(frozen=True)
class ForestSettings:
    """Random cut forest over an entity's past.

    The forest is redrawn every ``refresh`` windows from at most ``sample`` of the earlier shingles, the whole past or with
    ``history`` that many windows of it; fewer than ``warmup`` give no score (null). Trees of one of the ``tree_blocks``
    share a sample of the whole past.
    """

    trees: int = 30
    sample: int = 256
    history: int | None = None
    refresh: int = 16
    warmup: int = 8
    tree_blocks: int = 5
    chunk: int = 1024


@dataclass(frozen=True)
class Monitor:
    """A scheduled query over the closed range ``[tick - range, tick]`` with a throttled trigger."""

    name: str
    trigger: str
    severity: str
    interval_ms: int
    range_ms: int
    throttle_ms: int
    metrics: tuple[Metric, ...]
    condition: str
    message: str
    where: str | None = None


@dataclass(frozen=True)
class Retention:
    warm_days: int = 7
    delete_days: int = 30
    rollover_docs: int = 100_000
    rollover_days: int = 1


# Detectors and monitors of the network-operations centre.
UTILIZATION_SPIKE = Detector(
    name="noc-utilization-spike",
    metrics=(
        Metric("avg_utilization", "avg", "utilization_pct"),
        Metric("max_utilization", "max", "utilization_pct"),
        Metric("avg_latency", "avg", "latency_ms"),
    ),
    interval_ms=MINUTE,
    shingle=8,
    category="hostname",
)
CRITICAL_SURGE = Detector(
    name="noc-critical-surge",
    metrics=(
        Metric("critical_count", "filter_count", "severity = 'CRITICAL'"),
        Metric("avg_packet_loss", "avg", "packet_loss_pct"),
    ),
    interval_ms=2 * MINUTE,
    shingle=4,
)
DETECTORS = (UTILIZATION_SPIKE, CRITICAL_SURGE)

UTILIZATION_MONITOR = Monitor(
    name="NOC - Utilização Crítica (>85%)",
    trigger="Utilização acima de 85%",
    severity="1",
    interval_ms=MINUTE,
    range_ms=2 * MINUTE,
    throttle_ms=5 * MINUTE,
    metrics=(
        Metric("avg_utilization", "avg", "utilization_pct"),
        Metric("max_utilization", "max", "utilization_pct"),
    ),
    condition="avg_utilization > 85",
    message="Utilização média: {avg_utilization}% | Máx: {max_utilization}%",
)
CRITICAL_MONITOR = Monitor(
    name="NOC - Surto de Eventos CRITICAL",
    trigger="Mais de 10 eventos CRITICAL em 5min",
    severity="CRITICAL",
    interval_ms=2 * MINUTE,
    range_ms=5 * MINUTE,
    throttle_ms=10 * MINUTE,
    metrics=(
        Metric("critical_count", "value_count", "severity"),
        Metric("avg_packet_loss", "avg", "packet_loss_pct"),
    ),
    condition="critical_count > 10",
    message="{critical_count} eventos CRITICAL nos ultimos 5min | Packet Loss medio: {avg_packet_loss}%",
    where="severity = 'CRITICAL'",
)
MONITORS = (UTILIZATION_MONITOR, CRITICAL_MONITOR)
