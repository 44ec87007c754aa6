"""Metric and bucket aggregations."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from netvigil.functions.metrics import mean
from netvigil.operators import buckets
from netvigil.operators.forecast import forecast_history, regression_sums
from netvigil.registry.common import (
    END_MS,
    HOUR,
    LATENCY,
    LOSS,
    MINUTE,
    UTIL,
    history_sql,
    register,
)
from netvigil.schema import SECOND
from netvigil.sources.adapter import raw_daily, telemetry


@register("agg_count", "SELECT count(*) AS docs FROM ev")
def agg_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir).agg(F.count("*").alias("docs"))


@register("agg_value_count", "SELECT hostname, count(lat) AS located, count(severity) AS graded FROM ev GROUP BY hostname")
def agg_value_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir).groupBy("hostname").agg(
        F.count("location").alias("located"), F.count("severity").alias("graded")
    )


@register(
    "agg_avg",
    f"SELECT hostname, {UTIL} AS avg_utilization, {LATENCY} AS avg_latency, {LOSS} AS avg_packet_loss FROM ev GROUP BY hostname",
)
def agg_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir).groupBy("hostname").agg(
        mean("utilization_pct").alias("avg_utilization"),
        mean("latency_ms").alias("avg_latency"),
        mean("packet_loss_pct").alias("avg_packet_loss"),
    )


@register("agg_max", "SELECT hostname, CAST(max(utilization_pct) AS DOUBLE) AS max_utilization FROM ev GROUP BY hostname")
def agg_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir).groupBy("hostname").agg(
        F.max("utilization_pct").cast("double").alias("max_utilization")
    )


@register(
    "agg_filter_count",
    "SELECT ts_ms - ts_ms % 60000 AS key, hostname, count(*) FILTER (severity = 'CRITICAL') AS critical_count FROM ev GROUP BY ALL",
)
def agg_filter_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.with_date_bucket(telemetry(spark, sf_dir), MINUTE).groupBy("key", "hostname").agg(
        F.count_if(F.col("severity") == "CRITICAL").alias("critical_count")
    )


@register(
    "agg_any",
    "SELECT event_id // 10 AS batch_id, bool_or(severity = 'CRITICAL') AS has_anomaly FROM ev GROUP BY ALL",
)
def agg_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir).groupBy(F.expr("event_id div 10").alias("batch_id")).agg(
        F.bool_or(F.col("severity") == "CRITICAL").alias("has_anomaly")
    )


CENTROID = """CAST(sum(CAST(lat AS DECIMAL(10, 7))) AS DOUBLE) / count(*) AS lat,
  CAST(sum(CAST(lon AS DECIMAL(10, 7))) AS DOUBLE) / count(*) AS lon"""

# Bits of a coordinate, and the base-32 cell of two or five characters.
_GRID = """
, p AS (SELECT lat, lon, CAST(floor((lon + 180.0) / 360.0 * {x}) AS BIGINT) AS x,
    CAST(floor((lat + 90.0) / 180.0 * {y}) AS BIGINT) AS y FROM ev WHERE lat IS NOT NULL)
, g AS (SELECT lat, lon, {cell} AS geohash FROM p)
SELECT geohash, count(*) AS count, """ + CENTROID + " FROM g GROUP BY geohash"


def geohash_sql(precision: int) -> str:
    bits = 5 * precision
    x_bits, y_bits = (bits + 1) // 2, bits // 2
    letters = []
    for start in range(0, bits, 5):
        terms = []
        for offset in range(5):
            position = start + offset
            name, width = ("x", x_bits) if position % 2 == 0 else ("y", y_bits)
            terms.append(f"(({name} >> {width - 1 - position // 2}) & 1) * {1 << (4 - offset)}")
        letters.append(f"substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST({' + '.join(terms)} + 1 AS INTEGER), 1)")
    return _GRID.format(x=float(1 << x_bits), y=float(1 << y_bits), cell=" || ".join(letters))


@register("agg_geo_centroid", f"SELECT region, count(*) AS count, {CENTROID} FROM ev WHERE lat IS NOT NULL GROUP BY region")
def agg_geo_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = telemetry(spark, sf_dir).where(F.col("location").isNotNull())
    lat, lon = (F.col(f"location.{c}").cast("decimal(10,7)") for c in ("lat", "lon"))
    return located.groupBy("region").agg(F.count("*").alias("count"), mean(lat).alias("lat"), mean(lon).alias("lon"))


@register(
    "agg_regression_sums",
    history_sql(str(END_MS)) + """
, x AS (SELECT hostname, (key - 1704106800000) / 60000.0 AS x, y FROM hist)
SELECT hostname, count(*) AS n, CAST(sum(x) AS DOUBLE) AS sum_x, round(sum(y), 6) AS sum_y,
  CAST(sum(x * x) AS DOUBLE) AS sum_xx, round(sum(x * y), 6) AS sum_xy FROM x GROUP BY hostname""",
)
def agg_regression_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = forecast_history(telemetry(spark, sf_dir, since=END_MS - HOUR), END_MS)
    minutes = (F.col("key") - F.lit(END_MS - HOUR)) / F.lit(float(MINUTE))
    sums = regression_sums(history, ["hostname"], minutes, F.col("avg_utilization"))
    return sums.withColumn("sum_y", F.round("sum_y", 6)).withColumn("sum_xy", F.round("sum_xy", 6))


@register(
    "terms_topn",
    f"SELECT region, count(*) AS count, {UTIL} AS avg_utilization FROM ev WHERE region IS NOT NULL"
    " GROUP BY region ORDER BY count DESC, region LIMIT 5",
)
def terms_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = [F.count("*").alias("count"), mean("utilization_pct").alias("avg_utilization")]
    return buckets.terms_topn(telemetry(spark, sf_dir), "region", metrics, "count", 5)


def other_sql(size: int) -> str:
    return f""", g AS (SELECT region, count(*) AS c FROM ev WHERE region IS NOT NULL GROUP BY region)
, r AS (SELECT *, row_number() OVER (ORDER BY c DESC, region) AS rank FROM g)
, b AS (SELECT CASE WHEN rank <= {size} THEN region ELSE 'Outras' END AS region, CAST(sum(c) AS BIGINT) AS count
  FROM r GROUP BY 1)
SELECT region, count, count / CAST(sum(count) OVER () AS DOUBLE) AS share FROM b"""


@register("terms_other", other_sql(3))
def terms_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.terms_other(telemetry(spark, sf_dir), "region", 3)


@register(
    "date_histogram_fixed",
    f"SELECT ts_ms - ts_ms % 60000 AS key, count(*) AS count, {UTIL} AS avg_utilization FROM ev GROUP BY 1",
)
def date_histogram_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = [F.count("*").alias("count"), mean("utilization_pct").alias("avg_utilization")]
    return buckets.date_histogram(telemetry(spark, sf_dir), MINUTE, metrics)


# The automatic interval, as CTEs ending in ``evk`` with the bucket ``key``.
AUTO = """, span AS (SELECT min(ts_ms) AS lo, max(ts_ms) AS hi FROM ev)
, step AS (SELECT coalesce(min(s), 2592000000 * any_value(greatest(1, -(-(hi - lo) // (2592000000 * 98))))) AS i FROM span, unnest([1000, 5000, 10000, 30000, 60000, 300000,
  600000, 1800000, 3600000, 10800000, 43200000, 86400000, 604800000, 2592000000]) AS l(s) WHERE hi // s - lo // s + 1 <= 100)
, evk AS (SELECT ev.*, ts_ms - ts_ms % i AS key FROM ev, step)
"""


@register("date_histogram_auto", AUTO + "SELECT key, count(*) AS count FROM evk GROUP BY key")
def date_histogram_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.date_histogram(telemetry(spark, sf_dir), "auto", [F.count("*").alias("count")])


@register(
    "date_histogram_gapfill",
    f""", g AS (SELECT ts_ms - ts_ms % 1000 AS key, count(*) AS c, {UTIL} AS a FROM ev GROUP BY 1)
, k AS (SELECT unnest(range(min(key), max(key) + 1, 1000)) AS key FROM g)
SELECT k.key, coalesce(c, 0) AS count, a AS avg_utilization FROM k LEFT JOIN g ON k.key = g.key""",
)
def date_histogram_gapfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = [mean("utilization_pct").alias("avg_utilization")]
    return buckets.date_histogram_gapfill(telemetry(spark, sf_dir), SECOND, metrics)


@register(
    "numeric_histogram",
    "SELECT floor(CAST(packet_loss_pct AS DOUBLE) / 5.0) * 5.0 AS bucket, count(*) AS count FROM ev GROUP BY 1",
)
def numeric_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.numeric_histogram(telemetry(spark, sf_dir), "packet_loss_pct", 5)


@register(
    "terms_then_date",
    f""", kept AS (SELECT hostname FROM ev GROUP BY hostname ORDER BY count(*) DESC, hostname LIMIT 4)
SELECT hostname, ts_ms - ts_ms % 60000 AS key, count(*) AS count, {UTIL} AS avg_utilization
FROM ev WHERE hostname IN (SELECT hostname FROM kept) GROUP BY 1, 2""",
)
def terms_then_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    metric = [mean("utilization_pct").alias("avg_utilization")]
    return buckets.terms_then_date(telemetry(spark, sf_dir), "hostname", MINUTE, metric, 4)


@register(
    "date_then_terms_topn",
    f""", g AS (SELECT ts_ms - ts_ms % 60000 AS key, hostname, {UTIL} AS avg_utilization FROM ev GROUP BY 1, 2)
SELECT key, hostname, avg_utilization FROM g
QUALIFY row_number() OVER (PARTITION BY key ORDER BY avg_utilization DESC, hostname) <= 2""",
)
def date_then_terms_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    metric = [mean("utilization_pct").alias("avg_utilization")]
    return buckets.date_then_terms_topn(telemetry(spark, sf_dir), "hostname", MINUTE, metric, "avg_utilization", 2)


@register("geohash_grid", geohash_sql(5))
def geohash_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.geohash_grid(telemetry(spark, sf_dir), 5)


@register(
    "terms_source_index",
    """, g AS (SELECT 'telecom-noc-' || raw_day AS source_index, count(*) AS count FROM ev GROUP BY 1)
SELECT * FROM g ORDER BY count DESC, source_index LIMIT 5""",
)
def terms_source_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return buckets.terms_topn(raw_daily(spark, sf_dir), "source_index", [F.count("*").alias("count")], "count", 5)


@register(
    "totals_row",
    f""", t AS (SELECT interface, count(*) AS count, {LATENCY} AS avg_latency FROM ev
  GROUP BY interface ORDER BY count DESC, interface LIMIT 4)
SELECT interface, 0 AS is_total, count, avg_latency FROM t UNION ALL
SELECT NULL, 1, CAST(sum(count) AS BIGINT), list_reduce(list_sort(list(avg_latency)), lambda a, b: a + b) FROM t""",
)
def totals_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = [F.count("*").alias("count"), mean("latency_ms").alias("avg_latency")]
    shown = buckets.terms_topn(telemetry(spark, sf_dir), "interface", metrics, "count", 4)
    return buckets.with_totals_row(shown, "interface", ["count", "avg_latency"])
