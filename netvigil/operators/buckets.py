"""Bucket aggregations: terms, histograms, geohash cells and their nestings.

Date buckets are named ``key``, in epoch milliseconds. Ranking always runs on
grouped rows, never on events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from netvigil.functions.geo import geohash
from netvigil.functions.metrics import ordered_sum
from netvigil.functions.predicates import word_list
from netvigil.functions.times import bucket_start, event_ms
from netvigil.schema import DAY, HOUR, MINUTE, SECOND

# Steps an automatic interval may take, and how many buckets it aims to stay within.
AUTO_LADDER = (
    SECOND, 5 * SECOND, 10 * SECOND, 30 * SECOND,
    MINUTE, 5 * MINUTE, 10 * MINUTE, 30 * MINUTE,
    HOUR, 3 * HOUR, 12 * HOUR, DAY, 7 * DAY, 30 * DAY,
)
AUTO_BUCKETS = 100
# Fixed value: label of the bucket for the rest.
OTHER_LABEL = "Outras"


def terms_topn(
    rows: DataFrame, term: str, metrics: Sequence[Column], order_by: str, size: int
) -> DataFrame:
    """The ``size`` terms with the highest metric, ties by term; rows without the term are left out."""
    grouped = rows.where(F.col(term).isNotNull()).groupBy(term).agg(*metrics)
    return grouped.orderBy(F.desc_nulls_last(order_by), F.asc(term)).limit(size)


def terms_other(rows: DataFrame, term: str, size: int, label: str = OTHER_LABEL) -> DataFrame:
    """Counts of the top ``size`` terms plus one bucket for the rest, with each one's share.

    The rest is the grand total less the kept terms, so no ranking of all terms is needed.
    """
    grouped = rows.where(F.col(term).isNotNull()).groupBy(term).agg(F.count("*").alias("count"))
    top = grouped.orderBy(F.desc("count"), F.asc(term)).limit(size)
    total = grouped.agg(F.sum("count")).scalar()
    rest = top.agg((total - F.sum("count")).alias("count")).where(F.col("count") > 0)
    buckets = top.unionByName(rest.select(F.lit(label).alias(term), "count"))
    return buckets.withColumn("share", F.col("count") / total)


def auto_interval(rows: DataFrame, buckets: int = AUTO_BUCKETS) -> Column:
    """Smallest step that covers the rows' time range in at most ``buckets``, as a scalar subquery."""
    return rows.agg(_step(F.min(event_ms()), F.max(event_ms()), buckets)).scalar()


def _step(first: Column, last: Column, buckets: int) -> Column:
    """The ladder's smallest step that touches at most ``buckets`` epoch-aligned buckets, beyond it a multiple of its
    last step that does so whatever the alignment."""
    most = F.lit(AUTO_LADDER[-1]).cast("bigint")
    step = most * F.greatest(F.lit(1), F.ceil((last - first) / (most * (buckets - 2))))
    for width in reversed(AUTO_LADDER):
        held = F.floor(last / width) - F.floor(first / width) + 1
        step = F.when(held <= buckets, F.lit(width).cast("bigint")).otherwise(step)
    return step.cast("bigint")


def interval_between(first_ms: int, last_ms: int, buckets: int = AUTO_BUCKETS) -> int:
    """The automatic interval of rows whose first and last moment are known: the one ``auto_interval`` finds."""
    most = AUTO_LADDER[-1]
    longer = most * max(1, -(-(last_ms - first_ms) // (most * (buckets - 2))))
    return next((w for w in AUTO_LADDER if last_ms // w - first_ms // w + 1 <= buckets), longer)


def interval_for(span_ms: int, buckets: int = AUTO_BUCKETS) -> int:
    """The automatic interval of a time range known beforehand."""
    most = AUTO_LADDER[-1]
    longer = most * max(1, -(-span_ms // (most * (buckets - 2))))
    return next((width for width in AUTO_LADDER if span_ms <= width * buckets), longer)


def with_date_bucket(rows: DataFrame, interval: Column | int | str = "auto") -> DataFrame:
    """Adds ``key``, leaving out rows without a time; "auto" derives the interval from the rows."""
    if isinstance(interval, str):
        interval = auto_interval(rows)
    return rows.withColumn("key", bucket_start(event_ms(), interval)).where(F.col("key").isNotNull())


def date_histogram(rows: DataFrame, interval: Column | int | str, metrics: Sequence[Column]) -> DataFrame:
    """Metrics per date bucket that has rows."""
    return with_date_bucket(rows, interval).groupBy("key").agg(*metrics)


def bucket_keys(grouped: DataFrame, interval: int) -> DataFrame:
    """Every bucket from the first key to the last, built in day-long steps.

    The bounds are taken from whole rows, key first: reading the same columns as the caller lets
    Spark reuse the caller's shuffle instead of scanning again for the keys alone.
    """
    row = F.struct("key", *[c for c in grouped.columns if c != "key"])
    width, step = F.lit(interval).cast("bigint"), F.lit(max(interval, DAY - DAY % interval)).cast("bigint")
    bounds = grouped.agg(F.min(row)["key"].alias("first"), F.max(row)["key"].alias("last"))
    bounds = bounds.where(F.col("first").isNotNull())
    spans = bounds.select("last", F.explode(F.sequence("first", "last", step)).alias("start"))
    # The first days come from one row; the keys within them are made where these rows are dealt to.
    spans = spans.repartition("start")
    stop = F.least(F.col("last"), F.col("start") + step - width)
    return spans.select(F.explode(F.sequence("start", stop, width)).alias("key"))


def fill_gaps(grouped: DataFrame, interval: int, counts: Sequence[str] = ("count",)) -> DataFrame:
    """Adds the empty buckets between the first and the last; counts become 0, other columns null."""
    filled = bucket_keys(grouped, interval).join(grouped, "key", "left")
    return filled.fillna(0, subset=list(counts)) if counts else filled


def date_histogram_gapfill(rows: DataFrame, interval: int, metrics: Sequence[Column]) -> DataFrame:
    """Metrics per date bucket, empty ones included."""
    grouped = date_histogram(rows, interval, [F.count("*").alias("count"), *metrics])
    return fill_gaps(grouped, interval)


def numeric_histogram(rows: DataFrame, field: str, width: float) -> DataFrame:
    """Counts per ``floor(value / width) * width``; values and buckets that are absent are left out."""
    value = F.col(field).cast("double")
    bucket = (F.floor(value / F.lit(float(width))) * F.lit(float(width))).alias("bucket")
    return rows.where(F.col(field).isNotNull()).groupBy(bucket).agg(F.count("*").alias("count"))


def terms_then_date(
    rows: DataFrame, term: str, interval: int, metrics: Sequence[Column], size: int | None
) -> DataFrame:
    """Metrics per term and date bucket, for the ``size`` terms with the most rows, or with None for all terms.

    Terms are ranked by adding up the bucket counts; at most ``size`` of them are joined back.
    The ranking reads all the metrics (as a tie-break that never decides), so that both
    sides of the join need the same shuffle and events are scanned once. (A semi join would be
    pushed below the aggregation, and undo that.)
    """
    bucketed = with_date_bucket(rows.where(F.col(term).isNotNull()), interval)
    grouped = bucketed.groupBy(term, "key").agg(F.count("*").alias("count"), *metrics)
    if size is None:
        return grouped
    row = F.struct("key", *[c for c in grouped.columns if c not in (term, "key")])
    ranked = grouped.groupBy(term).agg(F.sum("count").alias("_docs"), F.max(row).alias("_row"))
    kept = ranked.orderBy(F.desc("_docs"), F.asc(term), F.asc("_row")).limit(size)
    return grouped.join(kept.select(term), term)


def top_per_bucket(grouped: DataFrame, term: str, order_by: str, size: int) -> DataFrame:
    """The ``size`` best terms within each date bucket, ties by term."""
    within = Window.partitionBy("key").orderBy(F.desc_nulls_last(order_by), F.asc(term))
    ranked = grouped.withColumn("_rank", F.row_number().over(within))
    return ranked.where(F.col("_rank") <= size).drop("_rank")


def date_then_terms_topn(
    rows: DataFrame,
    term: str,
    interval: Column | int | str,
    metrics: Sequence[Column],
    order_by: str,
    size: int,
) -> DataFrame:
    """Date buckets split by term; the top terms are chosen anew in every bucket."""
    bucketed = with_date_bucket(rows, interval).where(F.col(term).isNotNull())
    return top_per_bucket(bucketed.groupBy("key", term).agg(*metrics), term, order_by, size)


def geohash_grid(rows: DataFrame, precision: int) -> DataFrame:
    """Count and centroid per geohash cell; rows without a location are left out.

    Coordinates are added up as decimals of 1e-7 degrees, so sums do not depend on row order.
    """
    lat, lon = F.col("location.lat"), F.col("location.lon")
    located = rows.where(lat.isNotNull() & lon.isNotNull()).select(
        geohash(lat, lon, precision).alias("geohash"),
        lat.cast("decimal(10,7)").alias("lat"),
        lon.cast("decimal(10,7)").alias("lon"),
    )
    n = F.count("*")
    return located.groupBy("geohash").agg(
        n.alias("count"),
        (F.sum("lat").cast("double") / n).alias("lat"),
        (F.sum("lon").cast("double") / n).alias("lon"),
    )


def with_totals_row(shown: DataFrame, label: str, numeric: Sequence[str]) -> DataFrame:
    """A short table plus one row, its label null, that sums every numeric column as displayed.

    Meant for a table already cut to its top rows; averages are summed, not averaged again.
    """
    sums = [
        (F.sum(c) if shown.schema[c].dataType.typeName() == "long" else ordered_sum(c)).alias(c) for c in numeric
    ]
    return shown.rollup(label).agg(F.grouping_id().cast("int").alias("is_total"), *sums)


def message_terms(rows: DataFrame) -> DataFrame:
    """Number of documents whose message holds each word."""
    words = rows.select(F.explode(F.array_distinct(word_list(F.col("message")))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("docs"))
