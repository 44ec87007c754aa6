"""Forecast steps."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from netvigil.functions.times import event_ms
from netvigil.operators import forecast as steps
from netvigil.registry.common import END_MS, HOUR, MINUTE, fit_sql, history_sql, points_sql, register
from netvigil.schema import EVENT_PREFIX, FORECAST_PREFIX
from netvigil.sources.adapter import telemetry

RUNS = [END_MS - 20 * MINUTE, END_MS - 10 * MINUTE, END_MS]


def _recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry(spark, sf_dir, since=END_MS - HOUR)


@register("forecast_history", history_sql(str(END_MS)) + "SELECT hostname, key, docs AS count, y AS avg_utilization FROM hist")
def forecast_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps.forecast_history(_recent(spark, sf_dir), END_MS)


@register(
    "ols_fit",
    history_sql(str(END_MS)) + fit_sql()
    + "SELECT hostname, n, first_key, last_key, round(slope, 6) AS slope, round(intercept, 6) AS intercept FROM fit",
)
def ols_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fits = steps.ols_fit(steps.forecast_history(_recent(spark, sf_dir), END_MS))
    slope, intercept = F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept")
    return fits.select("hostname", "n", "first_key", "last_key", slope, intercept)


@register(
    "forecast_points",
    history_sql(str(END_MS)) + fit_sql() + points_sql() + "SELECT hostname, ts_ms, utilization_pct FROM points",
)
def forecast_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = steps.forecast(_recent(spark, sf_dir), END_MS)
    return points.select("hostname", event_ms().alias("ts_ms"), "utilization_pct")


@register(
    "forecast_union",
    history_sql(str(END_MS)) + fit_sql() + points_sql() + """
SELECT ts_ms, hostname, 'telecom-noc-2024.01.01' AS source_index, severity,
  CAST(utilization_pct AS DOUBLE) AS utilization_pct FROM ev UNION ALL
SELECT ts_ms, hostname, 'telecom-noc-forecast-2024.01.01', NULL, utilization_pct FROM points""",
)
def forecast_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = steps.forecast(_recent(spark, sf_dir), END_MS)
    predicted = predicted.withColumn("source_index", F.lit(f"{FORECAST_PREFIX}2024.01.01"))
    actual = telemetry(spark, sf_dir).withColumn("source_index", F.lit(f"{EVENT_PREFIX}2024.01.01"))
    return steps.forecast_union(actual, predicted).select(
        event_ms().alias("ts_ms"), "hostname", "source_index", "severity",
        F.col("utilization_pct").cast("double").alias("utilization_pct"),
    )


def _run_sql(index: int, run: int) -> str:
    names = [f"{kind}{index}" for kind in ("hist", "fit", "points")]
    return (
        history_sql(str(run), name=names[0], until=str(run)) + fit_sql(names[0], names[1]) + points_sql(names[1], names[2])
    )


@register(
    "forecast_latest",
    "".join(_run_sql(i, run) for i, run in enumerate(RUNS)) + ", runs AS ("
    + " UNION ALL ".join(f"SELECT *, {run} AS run_ms FROM points{i}" for i, run in enumerate(RUNS))
    + ") SELECT hostname, ts_ms, max_by(utilization_pct, run_ms) AS utilization_pct, max(run_ms) AS run_ms "
    "FROM runs GROUP BY hostname, ts_ms",
)
def forecast_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = [steps.forecast_run(telemetry(spark, sf_dir, since=run - HOUR, until=run), run) for run in RUNS]
    latest = steps.forecast_latest(reduce(DataFrame.unionByName, made))
    return latest.select("hostname", event_ms().alias("ts_ms"), "utilization_pct", "run_ms")
