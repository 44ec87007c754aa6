"""Event, forecast and detector-result tables: Parquet in daily partitions.

Layout of events and forecasts: ``source_index=<daily name>/generation=<number>/hour=<of intake>/batch=<name>``. A named
batch can be written again and replaces itself; unnamed appends share one batch. A day's generations are closed one after
another as they fill. Loads of many days and compacted days have one hour, ``all``. Files carry the event's time as
``event_ms`` too: unlike timestamps, whole numbers have bounds in file footers.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from netvigil.functions.predicates import not_from
from netvigil.functions.times import daily_name, event_ms, partition_date, to_ms, utc_text
from netvigil.schema import EVENT_FIELDS, EVENT_PREFIX, EVENT_SCHEMA, FORECAST_PREFIX

PARTITIONS = ["source_index", "generation", "hour", "batch"]
TABLE_SCHEMA = T.StructType([
    T.StructField("event_ms", T.LongType()), *EVENT_SCHEMA.fields,
    *[T.StructField(name, T.StringType()) for name in PARTITIONS],
])
LOAD_BATCH, WHOLE_DAY = "load", "all"


def generation_name(number: int) -> str:
    return f"{number:06d}"


def _day_names(first: datetime, last: datetime, include_forecast: bool) -> list[str]:
    days = [first.date() + timedelta(days=i) for i in range((last.date() - first.date()).days + 1)]
    prefixes = [EVENT_PREFIX, FORECAST_PREFIX] if include_forecast else [EVENT_PREFIX]
    return [f"source_index={prefix}{day:%Y.%m.%d}" for day in days for prefix in prefixes]


def table_folders(
    spark: SparkSession, root: str, include_forecast: bool = True, first: datetime | None = None,
    last: datetime | None = None, hours: bool = False,
) -> list[str]:
    """The table's folders of what was taken in from ``first`` to ``last`` (UTC), as patterns that match something.

    Between two bounds the names follow from the bounds, and nothing else is looked at; with an open end the names of days
    (not what is in them) are listed. With ``hours`` the first and the last day are cut to their hours.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    if first is not None and last is not None:
        names = _day_names(first, last, include_forecast)
    else:
        names = [s.getPath().getName() for s in files.listStatus(path(root))]
        names = [n for n in names if n.startswith("source_index=") and (include_forecast or "forecast" not in n)]
        low, high = (f"{bound:%Y.%m.%d}" if bound else None for bound in (first, last))
        names = [n for n in names if (low is None or n[-10:] >= low) and (high is None or n[-10:] <= high)]
    found = []
    for name in names:
        from_hour = first.hour if hours and first is not None and name.endswith(f"{first:%Y.%m.%d}") else 0
        to_hour = last.hour if hours and last is not None and name.endswith(f"{last:%Y.%m.%d}") else 23
        whole = (from_hour, to_hour) == (0, 23)
        wanted = [name] if whole else [
            f"{name}/generation=*/hour={h}" for h in [WHOLE_DAY, *(f"{h:02d}" for h in range(from_hour, to_hour + 1))]
        ]
        found += [f"{root}/{w}" for w in wanted if files.globStatus(path(f"{root}/{w}"))]
    return found


def read_events(
    spark: SparkSession,
    root: str,
    include_forecast: bool = True,
    since: datetime | int | None = None,
    until: datetime | int | None = None,
    ingest_lag_days: int | None = None,
    ingest_lag_hours: int | None = None,
) -> DataFrame:
    """All daily partitions below ``root`` as one table; fields a partition lacks are null.

    ``ingest_lag_days`` states how far an event's own date may lie from the date of its partition, ``ingest_lag_hours`` the
    same of its hour. With either, a time range also says which folders are listed and read; the rest of the table
    costs nothing, however many batches it holds. Without them none is assumed.
    """
    lag = None if ingest_lag_days is None else timedelta(days=ingest_lag_days)
    lag = lag if ingest_lag_hours is None else timedelta(hours=ingest_lag_hours)
    bounds = [None if b is None else datetime.fromtimestamp(to_ms(b) / 1000, timezone.utc) for b in (since, until)]
    reader = spark.read.schema(TABLE_SCHEMA).option("basePath", root)
    if lag is None or bounds == [None, None]:
        events = reader.parquet(root)
    else:
        first, last = bounds[0] and bounds[0] - lag, bounds[1] and bounds[1] + lag
        folders = table_folders(spark, root, include_forecast, first, last, hours=ingest_lag_hours is not None)
        events = reader.parquet(*folders) if folders else spark.createDataFrame([], TABLE_SCHEMA)
    events = events.drop("event_ms", *PARTITIONS[1:])
    if not include_forecast:
        events = events.where(not_from("forecast"))
    for moment, bound, earlier in zip((since, until), bounds, (True, False)):
        if moment is None:
            continue
        ms = to_ms(moment)
        time = F.timestamp_millis(F.lit(ms if earlier else ms + 1))
        events = events.where(F.col("timestamp") >= time if earlier else F.col("timestamp") < time)
        if lag is not None:
            edge = F.lit((bound - lag if earlier else bound + lag).date())
            day = partition_date(F.col("source_index"))
            events = events.where(day >= edge if earlier else day <= edge)
    return events


def stored_rows(events: DataFrame) -> DataFrame:
    """Events with the columns and types of the table's files."""
    fields = [name for name in EVENT_FIELDS if name in events.columns]
    typed = [F.col(name).cast(EVENT_SCHEMA[name].dataType) for name in fields]
    # Spark finds a column's footer by its place among the leaves of the schema, so the whole number comes before the struct.
    return events.select(event_ms().alias("event_ms"), *typed, *[c for c in events.columns if c not in fields])


def write_daily(
    events: DataFrame,
    root: str,
    ingest_time: Column | datetime | int | None = None,
    prefix: str = EVENT_PREFIX,
    batch: str | None = None,
    rebalance: bool = False,
    max_records_per_file: int = 0,
    generation: int = 1,
) -> None:
    """Files events under the UTC day and hour they are taken in (now, a fixed time, or a column).

    With ``batch`` the rows go to a sub-partition of that name, replaced as a whole
    when the same batch is written again. ``rebalance`` is for loads that span many days: it
    brings each day's rows together, large days in several tasks, to avoid small files; hours are not told apart then.
    """
    if ingest_time is None:
        ingest_time = datetime.now(timezone.utc)
    ms = F.unix_millis(ingest_time) if isinstance(ingest_time, Column) else F.lit(to_ms(ingest_time))
    rows = stored_rows(events.select(
        *[name for name in EVENT_FIELDS if name in events.columns],
        daily_name(prefix, ms).alias("source_index"),
        F.lit(generation_name(generation)).alias("generation"),
        (F.lit(WHOLE_DAY) if rebalance else utc_text(ms, "HH")).alias("hour"),
        F.lit(batch or LOAD_BATCH).alias("batch"),
    ))
    if rebalance:
        rows = rows.hint("rebalance", "source_index")
    writer = rows.write.partitionBy(*PARTITIONS).option("compression", "zstd")
    writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if batch is None:
        writer.mode("append").parquet(root)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)


def write_forecast(points: DataFrame, root: str, run_time: datetime | int, batch: str | None = None) -> None:
    """Files forecast points under the day of the run, not of the predicted minutes."""
    write_daily(points.select("timestamp", "hostname", "utilization_pct"), root, run_time, FORECAST_PREFIX, batch)


def detector_path(root: str, detector: str) -> str:
    return f"{root}/detector={detector}"


def write_detector_results(results: DataFrame, root: str, detector: str, batch: str | None = None) -> None:
    """Files scored windows in the detector's own result table.

    With ``batch`` they are a partition of that name, replaced as a whole when the same batch is written again; without
    they are appended to one that such writes share.
    """
    rows = results.drop("detector").write.option("compression", "zstd")
    mode = "append" if batch is None else "overwrite"
    rows.mode(mode).parquet(f"{detector_path(root, detector)}/batch={batch or LOAD_BATCH}")


def read_detector_results(spark: SparkSession, root: str, detector: str) -> DataFrame:
    return spark.read.option("basePath", root).parquet(detector_path(root, detector)).drop("batch")
