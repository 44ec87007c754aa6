"""Sources and sinks."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from netvigil.functions.times import event_ms
from netvigil.operators import detect
from netvigil.operators.forecast import forecast
from netvigil.registry.common import (
    END_MS,
    HOUR,
    event_table,
    fit_sql,
    history_sql,
    points_sql,
    register,
)
from netvigil.registry.detection import SPIKE_SCORED, SURGE_SCORED, in_range
from netvigil.schema import DETECTORS, KEYWORD_LIMIT, NUMERIC_FIELDS
from netvigil.session import new_path
from netvigil.sources import ingest
from netvigil.sources.adapter import documents, telemetry
from netvigil.sources.tables import (
    read_detector_results,
    read_events,
    write_daily,
    write_detector_results,
    write_forecast,
)

# Which documents are refused and why, as CTEs ending in ``docs``; a reason is null where accepted.
DOCS = """, docs AS (SELECT *, event_id // 10 AS batch_id,
  CASE WHEN event_id % 73 = 72 THEN 'not_an_object' WHEN event_id % 97 = 96 THEN 'unknown_field'
    WHEN event_id % 83 = 82 THEN 'bad_timestamp' WHEN event_id % 89 = 88 OR event_id % 61 = 60 THEN 'bad_number'
    WHEN event_id % 79 = 78 AND NOT burst THEN 'bad_location'
    WHEN event_id % 71 = 70 OR event_id % 67 = 66 THEN 'bad_structure' END AS reason FROM ev)
"""


@register(
    "scan_events",
    history_sql(str(END_MS)) + fit_sql() + points_sql() + """
SELECT 'telecom-noc-' || raw_day AS source_index, hostname, count(*) AS docs, count(lat) AS located,
  count(severity) AS graded, min(ts_ms) AS first_ms, max(ts_ms) AS last_ms FROM ev GROUP BY ALL
UNION ALL SELECT 'telecom-noc-forecast-2024.01.01', hostname, count(*), 0, 0, min(ts_ms), max(ts_ms)
FROM points GROUP BY hostname""",
)
def scan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_events(spark, event_table(spark, sf_dir))
    return events.groupBy("source_index", "hostname").agg(
        F.count("*").alias("docs"),
        F.count("location").alias("located"),
        F.count("severity").alias("graded"),
        F.min(event_ms()).alias("first_ms"),
        F.max(event_ms()).alias("last_ms"),
    )


def _single(column: str) -> str:
    return f"CAST(CAST(CAST({column} AS VARCHAR) AS FLOAT) AS DOUBLE) AS {column}"


@register(
    "normalize_events",
    DOCS + f"""SELECT event_id, ts_ms, hostname, interface, region, lat, lon, severity, message,
  CASE WHEN length(message) <= {KEYWORD_LIMIT} THEN message END AS message_keyword,
  {_single('utilization_pct')}, {_single('latency_ms')}, {_single('packet_loss_pct')}
FROM docs WHERE reason IS NULL""",
)
def normalize_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = ingest.normalize_events(documents(telemetry(spark, sf_dir)))
    return events.select(
        "event_id", event_ms().alias("ts_ms"), "hostname", "interface", "region", "location.lat", "location.lon",
        "severity", "message", "message_keyword", *[F.col(c).cast("double").alias(c) for c in NUMERIC_FIELDS],
    )


@register("validate_strict", DOCS + "SELECT event_id, coalesce(reason, 'accepted') AS outcome FROM docs")
def validate_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = ingest.parse_documents(documents(telemetry(spark, sf_dir)))
    return parsed.select("event_id", F.coalesce("reason", F.lit("accepted")).alias("outcome"))


@register(
    "write_daily",
    "SELECT 'telecom-noc-2024.02.05' AS source_index, hostname, severity, count(*) AS docs FROM ev GROUP BY ALL",
)
def write_daily_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "daily")
    write_daily(telemetry(spark, sf_dir), root, ingest_time=1_707_134_400_000)
    return read_events(spark, root).groupBy("source_index", "hostname", "severity").agg(F.count("*").alias("docs"))


@register(
    "ingest_stats",
    DOCS + """, b AS (SELECT batch_id, count(*) FILTER (reason IS NULL) AS docs_ok,
    count(*) FILTER (reason IS NOT NULL) AS docs_rejected,
    coalesce(bool_or(severity = 'CRITICAL') FILTER (event_id % 73 <> 72), false) AS has_anomaly, max(ts_ms) AS last_ms
  FROM docs GROUP BY batch_id)
, t AS (SELECT *, CAST(sum(docs_ok) OVER w AS BIGINT) AS total_ok, CAST(sum(docs_rejected) OVER w AS BIGINT)
    AS total_rejected, (last_ms - (SELECT min(ts_ms) FROM ev)) / 1000.0 AS s FROM b WINDOW w AS (ORDER BY batch_id))
SELECT batch_id, docs_ok, docs_rejected, has_anomaly, total_ok, total_rejected,
  CASE WHEN s > 0 THEN round(total_ok / s, 6) ELSE 0.0 END AS docs_per_s FROM t""",
)
def ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.ingest_stats(documents(telemetry(spark, sf_dir)))


@register(
    "write_forecast",
    history_sql(str(END_MS)) + fit_sql() + points_sql()
    + "SELECT 'telecom-noc-forecast-2024.01.01' AS source_index, hostname, ts_ms, utilization_pct FROM points",
)
def write_forecast_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "forecasts")
    write_forecast(forecast(telemetry(spark, sf_dir, since=END_MS - HOUR), END_MS), root, END_MS)
    written = read_events(spark, root)
    utilization = F.round(F.col("utilization_pct").cast("double"), 2).alias("utilization_pct")
    return written.select("source_index", "hostname", event_ms().alias("ts_ms"), utilization)


@register(
    "write_detector_results",
    SPIKE_SCORED + SURGE_SCORED + """SELECT 'noc-utilization-spike' AS detector, entity, key, key + 60000 AS until, avg_utilization AS first,
  max_utilization AS second, avg_latency AS third, scored, true AS in_range FROM spike JOIN spike_full_scored USING (entity, key)
UNION ALL SELECT 'noc-critical-surge', entity, key, key + 120000, CAST(critical_count AS DOUBLE), avg_packet_loss, NULL, scored, true
FROM surge JOIN surge_full_scored USING (entity, key)""",
)
def write_detector_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of both result tables."""
    root = new_path(spark, "detector-results")
    made = []
    for detector in DETECTORS:
        results = detect.detector_results(telemetry(spark, sf_dir), detector)
        write_detector_results(results, root, detector.name, batch="0")
        written = read_detector_results(spark, root, detector.name)
        values = [F.col(m.name).cast("double") for m in detector.metrics] + [F.lit(None).cast("double")]
        made.append(written.select(
            "detector", "entity", event_ms("data_start").alias("key"), event_ms("data_end").alias("until"),
            *[v.alias(n) for v, n in zip(values, ("first", "second", "third"))],
            F.col("anomaly_score").isNotNull().alias("scored"),
            (in_range("anomaly_score")[1] & in_range("anomaly_grade")[1]).alias("in_range"),
        ))
    return reduce(DataFrame.unionByName, made)
