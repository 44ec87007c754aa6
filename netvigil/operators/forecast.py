"""Per-host linear forecast of utilization."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from netvigil.functions.metrics import clamp, mean
from netvigil.functions.predicates import bool_query, exists, from_time, within
from netvigil.functions.times import to_ms
from netvigil.operators.buckets import terms_then_date, with_date_bucket
from netvigil.schema import MINUTE, ForecastSettings

SETTINGS = ForecastSettings()


def forecast_history(events: DataFrame, as_of: datetime | int, settings: ForecastSettings = SETTINGS) -> DataFrame:
    """Minute means per host since ``as_of`` less the history, without earlier forecasts.

    Open above: events later than ``as_of`` count too.
    """
    recent = bool_query(must=[from_time(as_of, settings.history_ms), exists("utilization_pct")])
    history = events.where(recent)
    if "source_index" in events.columns:
        history = history.where(bool_query(must_not=[F.col("source_index").contains("forecast")]))
    return terms_then_date(
        history, "hostname", settings.bucket_ms, [mean("utilization_pct").alias("avg_utilization")], settings.max_hosts
    )


def minute_sums(events: DataFrame, settings: ForecastSettings = SETTINGS) -> DataFrame:
    """``total`` and ``n`` of the values of every host and bucket: what minute means are made of, and can be added up."""
    rows = with_date_bucket(events.where(exists("utilization_pct") & exists("hostname")), settings.bucket_ms)
    return rows.groupBy("hostname", "key").agg(
        F.sum(F.col("utilization_pct").cast("double")).alias("total"), F.count("utilization_pct").alias("n")
    )


def means_of(sums: DataFrame) -> DataFrame:
    """Minute means from sums, of which one host and bucket may have several."""
    merged = sums.groupBy("hostname", "key").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return merged.select("hostname", "key", (F.col("total") / F.col("n")).alias("avg_utilization"))


def regression_sums(points: DataFrame, by: list[str], x: Column, y: Column) -> DataFrame:
    """n, Σx, Σy, Σx², Σxy per group."""
    return points.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sum(x).alias("sum_x"),
        F.sum(y).alias("sum_y"),
        F.sum(x * x).alias("sum_xx"),
        F.sum(x * y).alias("sum_xy"),
    )


def line(sums: DataFrame) -> DataFrame:
    """Adds ``slope`` and ``intercept`` of the least-squares line; both 0 where it is not defined."""
    n, sx, sy = F.col("n"), F.col("sum_x"), F.col("sum_y")
    determinant = n * F.col("sum_xx") - sx * sx
    defined = (n >= 2) & (determinant != 0)
    slope = F.when(defined, F.try_divide(n * F.col("sum_xy") - sx * sy, determinant)).otherwise(F.lit(0.0))
    fitted = sums.withColumn("slope", slope)
    intercept = F.when(defined, (sy - F.col("slope") * sx) / n).otherwise(F.lit(0.0))
    return fitted.withColumn("intercept", intercept)


def ols_fit(history: DataFrame) -> DataFrame:
    """Line per host through its minute means; x is minutes since the host's first bucket.

    The window runs over minute means only: a row per host and minute of the history.
    """
    host = Window.partitionBy("hostname")
    points = history.select(
        "*", F.min("key").over(host).alias("first_key"), F.max("key").over(host).alias("last_key")
    )
    minutes = (F.col("key") - F.col("first_key")) / F.lit(float(MINUTE))
    return line(regression_sums(points, ["hostname", "first_key", "last_key"], minutes, F.col("avg_utilization")))


def forecast_points(fits: DataFrame, settings: ForecastSettings = SETTINGS) -> DataFrame:
    """The next ``horizon`` minutes after each host's last bucket, within 0 to 100, to 2 decimals.

    Hosts with a single bucket are left out.
    """
    ahead = fits.where(F.col("n") >= 2).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(settings.horizon))))
    key = F.col("last_key") + F.col("step") * F.lit(settings.bucket_ms)
    minutes = (key - F.col("first_key")) / F.lit(float(MINUTE))
    predicted = clamp(F.col("slope") * minutes + F.col("intercept"), 0, 100)
    return ahead.select(
        F.timestamp_millis(key).alias("timestamp"), "hostname", F.round(predicted, 2).alias("utilization_pct")
    )


def forecast(events: DataFrame, as_of: datetime | int, settings: ForecastSettings = SETTINGS) -> DataFrame:
    """History, fit and points in one plan, with the run's ``source_index`` left to the writer."""
    return forecast_points(ols_fit(forecast_history(events, as_of, settings)), settings)


def forecast_union(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """Events and forecasts as one table; what a forecast row lacks is null."""
    return actual.unionByName(predicted, allowMissingColumns=True)


def forecast_run(events: DataFrame, run_time: datetime | int, settings: ForecastSettings = SETTINGS) -> DataFrame:
    """A forecast as it was made at ``run_time``, from what had happened by then; adds ``run_ms``."""
    run_ms = to_ms(run_time)
    return forecast(events.where(within(until=run_ms)), run_ms, settings).withColumn("run_ms", F.lit(run_ms).cast("bigint"))


def forecast_latest(runs: DataFrame) -> DataFrame:
    """Of overlapping runs, the newest prediction for every host and minute."""
    return runs.groupBy("hostname", "timestamp").agg(
        F.max_by("utilization_pct", "run_ms").alias("utilization_pct"), F.max("run_ms").alias("run_ms")
    )
