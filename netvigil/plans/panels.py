"""The dashboard's panels. Each takes events and an optional closed time range."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from netvigil.functions.metrics import above, color_band, mean
from netvigil.functions.predicates import geo_box, not_from, term, within
from netvigil.functions.times import to_ms
from netvigil.operators.buckets import (
    date_histogram,
    date_then_terms_topn,
    fill_gaps,
    geohash_grid,
    interval_between,
    interval_for,
    numeric_histogram,
    terms_other,
    terms_topn,
    top_per_bucket,
    with_date_bucket,
    with_totals_row,
)
from netvigil.operators.lifecycle import stored_inventory
from netvigil.schema import MINUTE, SECOND

Moment = datetime | int | None
Interval = Column | int | str

# Colour ranges, threshold lines and sizes of the panels.
CRITICAL_BANDS = (0, 5, 20, 1000)
UTILIZATION_BANDS = (0, 30, 60, 100)
LATENCY_BANDS = (0, 50, 200, 1000)
UTILIZATION_LINE = 80
LATENCY_LINE = 200
FORECAST_LINE = 85
DISCOVER_ROWS = 500


def _shown(events: DataFrame, since: Moment, until: Moment, where: Column | None = None) -> DataFrame:
    events = events.where(within(since, until)) if since is not None or until is not None else events
    return events if where is None else events.where(where)


def _interval(interval: Interval, since: Moment, until: Moment) -> Interval:
    """An automatic interval of a range that is known needs no pass over the data."""
    if isinstance(interval, str) and since is not None and until is not None:
        return interval_for(to_ms(until) - to_ms(since))
    return interval


def stored_interval(spark: SparkSession, root: str, as_of: date | None = None) -> int | None:
    """The automatic interval of a stored table's events, from the footers of its files: with it, a panel over the whole
    table reads the rows once. None where there are no events."""
    inventory = stored_inventory(spark, root, as_of or date.today()).where(not_from("forecast"))
    first, last = inventory.agg(F.min("first_ms"), F.max("last_ms")).first()
    return None if first is None else interval_between(first, last)


def _critical() -> Column:
    return term("severity", "CRITICAL")


def ingest_volume(events: DataFrame, since: Moment = None, until: Moment = None) -> DataFrame:
    return _shown(events, since, until).agg(F.count("*").alias("docs"))


def critical_count(events: DataFrame, since: Moment = None, until: Moment = None) -> DataFrame:
    counted = _shown(events, since, until, _critical()).agg(F.count("*").alias("critical_events"))
    return counted.withColumn("band", color_band(F.col("critical_events"), CRITICAL_BANDS))


def avg_utilization(events: DataFrame, since: Moment = None, until: Moment = None) -> DataFrame:
    averaged = _shown(events, since, until).agg(mean("utilization_pct").alias("avg_utilization"))
    return averaged.withColumn("band", color_band(F.col("avg_utilization"), UTILIZATION_BANDS))


def avg_latency(events: DataFrame, since: Moment = None, until: Moment = None) -> DataFrame:
    averaged = _shown(events, since, until).agg(mean("latency_ms").alias("avg_latency"))
    return averaged.withColumn("band", color_band(F.col("avg_latency"), LATENCY_BANDS))


def util_trend(
    events: DataFrame, since: Moment = None, until: Moment = None, interval: Interval = "auto"
) -> DataFrame:
    """Mean utilization of the 6 busiest hosts of every time bucket."""
    rows = _shown(events, since, until)
    metric = [mean("utilization_pct").alias("avg_utilization")]
    step = _interval(interval, since, until)
    trend = date_then_terms_topn(rows, "hostname", step, metric, "avg_utilization", 6)
    return trend.withColumn("above_80", above(F.col("avg_utilization"), UTILIZATION_LINE))


def severity_timeline(
    events: DataFrame, since: Moment = None, until: Moment = None, interval: Interval = "auto"
) -> DataFrame:
    rows = _shown(events, since, until)
    step = _interval(interval, since, until)
    return date_then_terms_topn(rows, "severity", step, [F.count("*").alias("count")], "count", 5)


def host_heatmap(
    events: DataFrame, since: Moment = None, until: Moment = None, interval: Interval = "auto"
) -> DataFrame:
    rows = _shown(events, since, until)
    metric = [mean("utilization_pct").alias("avg_utilization")]
    step = _interval(interval, since, until)
    return date_then_terms_topn(rows, "hostname", step, metric, "avg_utilization", 10)


def top_hosts(events: DataFrame, since: Moment = None, until: Moment = None) -> DataFrame:
    """The 10 hosts with most critical events, and a totals row that sums what is shown."""
    metrics = [
        F.count("*").alias("count"),
        mean("utilization_pct").alias("avg_utilization"),
        mean("latency_ms").alias("avg_latency"),
        mean("packet_loss_pct").alias("avg_packet_loss"),
    ]
    shown = terms_topn(_shown(events, since, until, _critical()), "hostname", metrics, "count", 10)
    return with_totals_row(shown, "hostname", ["count", "avg_utilization", "avg_latency", "avg_packet_loss"])


def latency_histogram(events: DataFrame, since: Moment = None, until: Moment = None) -> DataFrame:
    return numeric_histogram(_shown(events, since, until), "latency_ms", 25)


def latency_vs_loss(
    events: DataFrame, since: Moment = None, until: Moment = None, interval: Interval = "auto"
) -> DataFrame:
    metrics = [mean("latency_ms").alias("avg_latency"), mean("packet_loss_pct").alias("avg_packet_loss")]
    series = date_histogram(_shown(events, since, until), _interval(interval, since, until), metrics)
    return series.withColumn("above_200", above(F.col("avg_latency"), LATENCY_LINE))


def region_share(events: DataFrame, since: Moment = None, until: Moment = None, size: int = 10) -> DataFrame:
    return terms_other(_shown(events, since, until), "region", size)


def geo_heat(
    events: DataFrame,
    since: Moment = None,
    until: Moment = None,
    precision: int = 2,
    box: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """Events per geohash cell, within the map's (south, west, north, east) where given."""
    return geohash_grid(_shown(events, since, until, geo_box(*box) if box else None), precision)


def forecast_panel(events: DataFrame, since: Moment = None, until: Moment = None) -> DataFrame:
    """Minute means of actual and predicted utilization side by side; empty minutes are shown."""
    rows = _shown(events, since, until)
    minutes = with_date_bucket(rows, MINUTE).groupBy("key", "source_index").agg(
        mean("utilization_pct").alias("avg_utilization")
    )
    series = top_per_bucket(minutes, "source_index", "avg_utilization", 5)
    filled = fill_gaps(series, MINUTE, counts=())
    return filled.withColumn("above_85", above(F.col("avg_utilization"), FORECAST_LINE))


def kpis(events: DataFrame, since: Moment = None, until: Moment = None) -> DataFrame:
    """The four headline figures from one scan."""
    return _shown(events, since, until).agg(
        F.count("*").alias("docs"),
        F.count_if(_critical()).alias("critical_events"),
        mean("utilization_pct").alias("avg_utilization"),
        mean("latency_ms").alias("avg_latency"),
    )


def discover(
    events: DataFrame,
    where: Column | None = None,
    since: Moment = None,
    until: Moment = None,
    limit: int = DISCOVER_ROWS,
) -> DataFrame:
    """The newest documents; ties by ``event_id`` where there is one. Those without a time are left out.

    Rows per second are counted first: the newest ``limit`` seconds that have rows hold at least
    ``limit`` of them, and counting back finds where the wanted rows start. Only rows from there on
    are sorted, instead of ``limit`` rows of every task of a large scan.
    """
    rows = _shown(events, since, until, where)
    seconds = date_histogram(rows, SECOND, [F.count("*").alias("count")]).orderBy(F.desc("key")).limit(limit)
    newer = Window.orderBy(F.desc("key")).rowsBetween(Window.unboundedPreceding, -1)
    needed = seconds.withColumn("_newer", F.coalesce(F.sum("count").over(newer), F.lit(0)))
    start = needed.where(F.col("_newer") < limit).agg(F.timestamp_millis(F.min("key"))).scalar()
    order = [F.desc("timestamp")] + ([F.asc("event_id")] if "event_id" in events.columns else [])
    return rows.where(F.col("timestamp") >= start).orderBy(*order).limit(limit)
