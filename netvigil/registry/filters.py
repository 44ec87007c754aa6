"""Filters and predicates."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from netvigil.functions import predicates as where
from netvigil.functions.times import event_ms
from netvigil.operators.buckets import message_terms as count_terms
from netvigil.operators.monitor import monitor_ticks, trigger_eval
from netvigil.registry.common import END_MS, HOUR, MINUTE, START_MS, UTIL, event_table, register
from netvigil.schema import UTILIZATION_MONITOR
from netvigil.sources.adapter import telemetry
from netvigil.sources.tables import read_events

RANGE_END = START_MS + 54 * MINUTE
MAP_BOX = (-30.0, -60.0, -20.0, -43.5)


def _rows(events: DataFrame) -> DataFrame:
    return events.select("event_id", event_ms().alias("ts_ms"), "hostname", "severity")


ROWS = "SELECT event_id, ts_ms, hostname, severity FROM ev WHERE "


@register("filter_time_from", ROWS + f"ts_ms >= {END_MS} - 3600000")
def filter_time_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(telemetry(spark, sf_dir, since=END_MS - HOUR).where(where.from_time(END_MS, HOUR)))


@register("filter_time_closed", ROWS + f"ts_ms BETWEEN {RANGE_END} - 300000 AND {RANGE_END}")
def filter_time_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = 5 * MINUTE
    events = telemetry(spark, sf_dir, since=RANGE_END - back, until=RANGE_END)
    return _rows(events.where(where.closed_range(RANGE_END, back)))


@register("filter_exists", ROWS + "lat IS NOT NULL")
def filter_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(telemetry(spark, sf_dir).where(where.exists("location")))


@register("filter_term", ROWS + "hostname = 'BR-SP-CORE-103'")
def filter_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(telemetry(spark, sf_dir).where(where.term("hostname", "BR-SP-CORE-103")))


@register("filter_kql", ROWS + "severity = 'CRITICAL'")
def filter_kql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(telemetry(spark, sf_dir).where(where.term("severity", "CRITICAL")))


@register(
    "filter_not_wildcard",
    "SELECT 'telecom-noc-' || raw_day AS source_index, hostname, count(*) AS docs FROM ev GROUP BY ALL",
)
def filter_not_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_events(spark, event_table(spark, sf_dir)).where(where.not_from("forecast"))
    return events.groupBy("source_index", "hostname").agg(F.count("*").alias("docs"))


@register(
    "filter_bool",
    ROWS + f"ts_ms >= {END_MS} - 7200000 AND utilization_pct IS NOT NULL AND severity = 'CRITICAL'"
    " AND hostname <> 'BR-SP-CORE-101'",
)
def filter_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    condition = where.bool_query(
        must=[where.from_time(END_MS, 2 * HOUR), where.exists("utilization_pct")],
        filters=[where.term("severity", "CRITICAL")],
        must_not=[where.term("hostname", "BR-SP-CORE-101")],
    )
    return _rows(telemetry(spark, sf_dir, since=END_MS - 2 * HOUR).where(condition))


@register("filter_geo_box", ROWS + "lat BETWEEN -30.0 AND -20.0 AND lon BETWEEN -60.0 AND -43.5")
def filter_geo_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(telemetry(spark, sf_dir).where(where.geo_box(*MAP_BOX)))


WORDS = r"list_distinct(list_filter(regexp_split_to_array(lower(message), '[^\p{L}\p{N}]+'), lambda w: w <> ''))"


@register("message_search", ROWS + f"list_has_any({WORDS}, ['packet', 'peer', 'bgp'])")
def message_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(telemetry(spark, sf_dir).where(where.message_matches(["packet", "Peer", "BGP"])))


@register("message_search_all", ROWS + f"list_has_all({WORDS}, ['bgp', 'peer'])")
def message_search_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(telemetry(spark, sf_dir).where(where.message_matches(["BGP", "peer"], match_all=True)))


@register("message_terms", f", w AS (SELECT unnest({WORDS}) AS word FROM ev) SELECT word, count(*) AS docs FROM w GROUP BY word")
def message_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_terms(telemetry(spark, sf_dir))


@register(
    "trigger_predicate",
    f""", t AS (
  SELECT unnest(range(ts_ms + (60000 - ts_ms % 60000) % 60000, ts_ms + 120001, 60000)) AS tick, utilization_pct FROM ev
), m AS (SELECT tick, {UTIL} AS avg_utilization FROM t GROUP BY tick)
SELECT tick, avg_utilization > 85 AS fired FROM m""",
)
def trigger_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trigger_eval(monitor_ticks(telemetry(spark, sf_dir), UTILIZATION_MONITOR), UTILIZATION_MONITOR).select(
        "tick", "fired"
    )
