"""Lifecycle jobs on daily partitions of the uncompressed days."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from netvigil.operators import lifecycle as ops
from netvigil.registry.common import register
from netvigil.session import new_path
from netvigil.sources.adapter import raw_clock, raw_daily, telemetry
from netvigil.sources.tables import read_events, write_daily

AS_OF = date(2024, 2, 5)

INVENTORY = """, inv AS (
  SELECT 'telecom-noc-' || raw_day AS source_index, count(*) AS docs, min(raw_ms) AS first_ms, max(raw_ms) AS last_ms,
    CAST(date_diff('day', strptime(raw_day, '%Y.%m.%d')::DATE, DATE '2024-02-05') AS INTEGER) AS age_days
  FROM ev GROUP BY raw_day
), st AS (
  SELECT *, CASE WHEN age_days >= 30 THEN 'delete' WHEN age_days >= 7 THEN 'warm' ELSE 'hot' END AS state FROM inv
)
"""


def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.partition_inventory(raw_daily(spark, sf_dir), AS_OF)


@register("partition_inventory", INVENTORY + "SELECT * FROM inv")
def partition_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inventory(spark, sf_dir)


@register("lifecycle_state", INVENTORY + "SELECT * FROM st")
def lifecycle_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.lifecycle_state(_inventory(spark, sf_dir))


@register(
    "rollover_due",
    INVENTORY + "SELECT *, docs >= 100000 OR age_days >= 1 AS rollover FROM st WHERE state = 'hot'",
)
def rollover_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.rollover_due(_inventory(spark, sf_dir))


@register("compact_warm", "SELECT 'telecom-noc-' || raw_day AS source_index, hostname, count(*) AS docs FROM ev GROUP BY ALL")
def compact_warm(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "compacted")
    write_daily(telemetry(spark, sf_dir), root, raw_clock(), rebalance=True)
    ops.compact_warm(spark, root, AS_OF)
    return read_events(spark, root).groupBy("source_index", "hostname").agg(F.count("*").alias("docs"))


@register(
    "retention",
    INVENTORY + """SELECT source_index, docs, age_days,
  'Índice ' || source_index || ' será excluído por retenção de 30 dias.' AS notice FROM st WHERE state = 'delete'""",
)
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.retention_plan(_inventory(spark, sf_dir))


def _stored(spark: SparkSession, sf_dir: str) -> str:
    """A table whose events lie under their uncompressed days, with uncompressed times."""
    root = new_path(spark, "lifecycle")
    write_daily(raw_daily(spark, sf_dir), root, F.col("timestamp"), rebalance=True)
    return root


@register("stored_lifecycle", INVENTORY + "SELECT * FROM st")
def stored_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory and states of stored partitions, from file footers."""
    return ops.lifecycle_state(ops.stored_inventory(spark, _stored(spark, sf_dir), AS_OF))


@register(
    "stored_retention",
    INVENTORY + """SELECT source_index, docs, age_days,
  'Índice ' || source_index || ' será excluído por retenção de 30 dias.' AS notice FROM st WHERE state = 'delete'""",
)
def stored_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan that dropping a stored table's expired partitions follows, from file footers."""
    return ops.retention(spark, _stored(spark, sf_dir), AS_OF)


@register("stored_retention_applied", INVENTORY + "SELECT source_index, docs FROM st WHERE state <> 'delete'")
def stored_retention_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of a stored table once its expired partitions are dropped."""
    root = _stored(spark, sf_dir)
    ops.retention(spark, root, AS_OF, apply=True)
    return ops.stored_inventory(spark, root, AS_OF).select("source_index", "docs")
