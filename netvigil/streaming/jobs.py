"""Continuous forms of ingest, detectors, monitors, throttling and forecasts.

The transformations take and return streaming DataFrames and share their
expressions with the batch operators; the start functions attach sinks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from netvigil.functions.metrics import aggregates
from netvigil.functions.predicates import not_from
from netvigil.functions.times import daily_name, event_ms, utc_text
from netvigil.operators import forest
from netvigil.operators.detect import FOREST, GRADE_WINDOWS, LEAST_SCORES, LEAST_SPREAD, entity_of, result_columns
from netvigil.operators.forecast import SETTINGS, forecast, forecast_points, means_of, minute_sums, ols_fit
from netvigil.operators.monitor import monitored, rendered, tick_range, trigger_eval
from netvigil.operators.lifecycle import POLICY
from netvigil.schema import (
    EVENT_FIELDS, EVENT_PREFIX, MINUTE, Detector, ForecastSettings, ForestSettings, Monitor, Retention,
)
from netvigil.session import exists, folder_names, make_folder, remove_folder, replace_folder
from netvigil.sources.ingest import LEDGER, last_row, next_row, outcome_counts, parse_documents
from netvigil.sources.tables import generation_name, read_events, stored_rows, write_detector_results, write_forecast
from netvigil.streaming import state


def _seconds(ms: int) -> str:
    return f"{ms // 1000} seconds"


def _start(writer: DataStreamWriter, checkpoint: str, once: bool, every_ms: int | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if once:
        return writer.trigger(availableNow=True).start()
    return (writer if every_ms is None else writer.trigger(processingTime=_seconds(every_ms))).start()


def start_append(
    stream: DataFrame, path: str, checkpoint: str, once: bool = False, every_ms: int | None = None
) -> StreamingQuery:
    """Appends a streaming result to Parquet; the sink's log keeps retried batches from doubling."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return _start(writer, checkpoint, once, every_ms)


def start_ingest(
    raw: DataFrame,
    root: str,
    quarantine: str,
    stats: str,
    checkpoint: str,
    once: bool = False,
    every_ms: int | None = 1000,
    policy: Retention = POLICY,
) -> StreamingQuery:
    """Files accepted documents by day and hour, refused ones apart, and one row of counts per micro-batch.

    A micro-batch is parsed and written once, by outcome, to a folder that readers skip; its counts are observed
    during that write, and its folders then move to their places. The row of counts carries the totals so far and the
    day's open generation on to the next micro-batch, which closes a generation that has ``policy.rollover_docs``
    documents or is ``policy.rollover_days`` old.

    A micro-batch that is run again replaces its own folders. Its intake time is the batch's
    recorded time, so a rerun past midnight still files it under the same day.
    ``raw`` has ``body`` and ``sent_ms``.
    """
    spark = raw.sparkSession
    for folder in (root, quarantine):
        make_folder(spark, folder)

    def store(batch: DataFrame, batch_id: int) -> None:
        name, staged = f"{batch_id:012d}", f"{root}/_arriving-{batch_id:012d}"
        parsed, observed = parse_documents(batch), Observation(f"arrivals {uuid.uuid4().hex}")
        good = F.col("reason").isNull()
        taken = F.unix_millis("_taken")
        counts = [*outcome_counts(), F.max(taken).alias("taken_ms")]
        rows = stored_rows(parsed.observe(observed, *counts).select(
            *[F.when(good, F.col(field)).alias(field) for field in EVENT_FIELDS],
            *[F.when(~good, F.col(field)).alias(field) for field in ("body", "sent_ms", "reason")],
            F.when(good, "accepted").otherwise("refused").alias("outcome"),
            daily_name(EVENT_PREFIX, taken).alias("source_index"), utc_text(taken, "HH").alias("hour"),
        ))
        writer = rows.write.mode("overwrite").option("compression", "zstd")
        writer.partitionBy("outcome", "source_index", "hour").parquet(staged)
        row = next_row(last_row(spark, stats, batch_id), batch_id, observed.get, policy)
        generation = f"generation={generation_name(row['generation'])}"
        for outcome in folder_names(spark, staged, "outcome="):
            for day in folder_names(spark, f"{staged}/{outcome}", "source_index="):
                for hour in folder_names(spark, f"{staged}/{outcome}/{day}", "hour="):
                    place = f"{root}/{day}/{generation}/{hour}/batch={name}"
                    if outcome == "outcome=refused":
                        place = f"{quarantine}/batch={name}"
                    replace_folder(spark, f"{staged}/{outcome}/{day}/{hour}", place)
        remove_folder(spark, staged)
        spark.createDataFrame([row], LEDGER).write.mode("overwrite").parquet(f"{stats}/batch={name}")

    stamped = raw.select("body", "sent_ms", F.current_timestamp().alias("_taken"))
    return _start(stamped.writeStream.foreachBatch(store), checkpoint, once, every_ms)


def tumbling_features(events: DataFrame, detector: Detector, include_forecast: bool = False) -> DataFrame:
    """A detector's features per closed window: ``entity``, ``key`` and the metrics.

    Rows later than the detector's delay are not seen; a window appears once it is that old.
    """
    if not include_forecast and "source_index" in events.columns:
        events = events.where(not_from("forecast"))
    if detector.category:
        events = events.where(F.col(detector.category).isNotNull())
    windows = F.window("timestamp", _seconds(detector.interval_ms)).alias("window")
    grouped = (
        events.withWatermark("timestamp", _seconds(detector.delay_ms))
        .groupBy(entity_of(detector).alias("entity"), windows)
        .agg(*aggregates(detector.metrics))
    )
    names = [m.name for m in detector.metrics]
    return grouped.select("entity", F.unix_millis("window.start").alias("key"), *names)


def monitor_stream(
    events: DataFrame, monitor: Monitor, lateness_ms: int = MINUTE, include_forecast: bool = False
) -> DataFrame:
    """A monitor's closed ticks with metrics and ``fired``.

    Events run ahead to the ticks that cover them, so the watermark on ``tick`` allows for
    the monitor's range on top of the lateness.
    """
    first, last = tick_range(event_ms(), monitor)
    ticks = F.sequence(first, last, F.lit(monitor.interval_ms).cast("bigint"))
    rows = monitored(events, monitor, include_forecast).where(first <= last)
    covered = rows.withColumn("tick", F.explode(F.transform(ticks, lambda t: F.timestamp_millis(t))))
    metrics = covered.withWatermark("tick", _seconds(monitor.range_ms + lateness_ms)).groupBy("tick").agg(
        *aggregates(monitor.metrics)
    )
    names = [m.name for m in monitor.metrics]
    return trigger_eval(metrics.select(F.unix_millis("tick").alias("tick"), *names), monitor)


def throttle_stream(ticks: DataFrame, monitor: Monitor, carried: Sequence[str] = ()) -> DataFrame:
    """Firing ticks that send, with the columns ``carried``; the time until which a monitor is held is kept as state.

    ``ticks`` follows the table that the monitor's closed ticks are appended to: Spark takes no
    arbitrary state behind an aggregation of the same query.
    """
    fired = ticks.where("fired").select(F.lit(monitor.name).alias("monitor"), "tick", *carried)
    return fired.groupBy("monitor").applyInPandasWithState(
        state.throttler(monitor.throttle_ms, fired.columns), fired.schema, "until bigint", "append", "NoTimeout"
    )


def notification_stream(ticks: DataFrame, monitor: Monitor) -> DataFrame:
    """Notifications of closed ticks: payload and text, as the batch job renders them, behind the throttle's state."""
    return rendered(throttle_stream(ticks, monitor, [m.name for m in monitor.metrics]), monitor)


def start_alerts(
    events: DataFrame,
    monitor: Monitor,
    ticks: str,
    notices: str,
    checkpoint: str,
    lateness_ms: int = MINUTE,
    once: bool = False,
    every_ms: int | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """A monitor from events to notifications: one job appends closed ticks to the table ``ticks``, the other follows it and
    appends payloads and texts to ``notices``. With ``once`` the first has ended before the second starts.

    The table ``ticks`` need not exist. A restarted job goes on where its checkpoint says, and the throttle with its state.
    """
    closed = monitor_stream(events, monitor, lateness_ms)
    first = start_append(closed, ticks, f"{checkpoint}/ticks", once, every_ms or monitor.interval_ms)
    if once:
        first.awaitTermination()
    spark = events.sparkSession
    make_folder(spark, ticks)
    followed = spark.readStream.schema(closed.schema).parquet(ticks)
    sent = notification_stream(followed, monitor)
    return first, start_append(sent, notices, f"{checkpoint}/notices", once, every_ms or monitor.interval_ms)


def _scorer(detector: Detector, settings: ForestSettings, parts: bool):
    return state.past_scorer(
        [m.name for m in detector.metrics], detector.shingle, detector.interval_ms, settings.tree_blocks,
        float(forest.SCORE_UNIT * settings.trees), parts, trees=settings.trees // settings.tree_blocks,
        sample=settings.sample, refresh=settings.refresh, warmup=settings.warmup,
    )


def detect_stream(features: DataFrame, detector: Detector, settings: ForestSettings = FOREST) -> DataFrame:
    """Scores of newly closed windows, equal to the batch scores; each entity keeps samples of its past windows.

    ``features`` follows the table that the closed windows are appended to.
    """
    shape, append = "entity string, key bigint, anomaly_score double", "append"
    if settings.history is None:
        return features.groupBy("entity").applyInPandasWithState(
            _scorer(detector, settings, False), shape, state.SCORER_STATE, append, "NoTimeout"
        )
    scorer = state.window_scorer(
        forest.score_windows,
        [m.name for m in detector.metrics],
        detector.shingle,
        detector.interval_ms,
        settings.tree_blocks,
        float(forest.SCORE_UNIT * settings.trees),
        trees=settings.trees // settings.tree_blocks,
        sample=settings.sample,
        history=settings.history,
        refresh=settings.refresh,
        warmup=settings.warmup,
    )
    return features.groupBy("entity").applyInPandasWithState(
        scorer, shape, "keys array<bigint>, vectors array<double>", append, "NoTimeout"
    )


def _named(detector: Detector, kind: str = "double") -> str:
    return ", ".join(f"{m.name} {kind}" for m in detector.metrics)


def partial_scores(features: DataFrame, detector: Detector, settings: ForestSettings = FOREST) -> DataFrame:
    """What each block of trees adds to the scores of newly closed windows, with the windows' features.

    The state's key is (entity, block), so a detector of one entity works in as many tasks as there are blocks.
    """
    blocks = F.explode(F.sequence(F.lit(0), F.lit(settings.tree_blocks - 1))).alias("block")
    rows = features.select("entity", blocks, "key", *[F.col(m.name).cast("double").alias(m.name) for m in detector.metrics])
    return rows.groupBy("entity", "block").applyInPandasWithState(
        _scorer(detector, settings, True), f"entity string, key bigint, block int, {_named(detector)}, units bigint",
        state.SCORER_STATE, "append", "NoTimeout",
    )


def graded_stream(parts: DataFrame, detector: Detector, settings: ForestSettings = FOREST) -> DataFrame:
    """Features, score and grade of windows, equal to the batch job's; ``parts`` follows the table of partial scores.

    An entity keeps the scores of the last ``GRADE_WINDOWS`` windows, of which each grade takes its two medians.
    """
    step = state.grader(
        [m.name for m in detector.metrics], detector.interval_ms, settings.tree_blocks,
        float(forest.SCORE_UNIT * settings.trees), GRADE_WINDOWS, LEAST_SCORES, LEAST_SPREAD,
    )
    return parts.groupBy("entity").applyInPandasWithState(
        step, f"entity string, key bigint, {_named(detector)}, anomaly_score double, anomaly_grade double",
        state.GRADER_STATE, "append", "NoTimeout",
    )


def start_detector(
    events: DataFrame,
    detector: Detector,
    tables: str,
    results: str,
    checkpoint: str,
    settings: ForestSettings = FOREST,
    once: bool = False,
    every_ms: int | None = None,
) -> list[StreamingQuery]:
    """A detector from events to its result table, by three jobs: closed windows, partial scores, graded results.

    The first two append to tables below ``tables`` that the next one follows. Results go to partitions named by micro-batch,
    which a micro-batch that is run again replaces. With ``once`` each job has ended before the next starts.
    """
    if settings.history is not None:
        raise ValueError("the continuous detector keeps samples of the whole past")
    spark, every = events.sparkSession, every_ms or detector.interval_ms
    features = tumbling_features(events, detector)
    kinds = {f.name: f.dataType for f in features.schema.fields}

    def follow(made: DataFrame, name: str) -> DataFrame:
        jobs.append(start_append(made, f"{tables}/{name}", f"{checkpoint}/{name}", once, every))
        if once:
            jobs[-1].awaitTermination()
        make_folder(spark, f"{tables}/{name}")
        return spark.readStream.schema(made.schema).parquet(f"{tables}/{name}")

    def store(batch: DataFrame, batch_id: int) -> None:
        write_detector_results(batch, results, detector.name, batch=f"{batch_id:012d}")

    jobs: list[StreamingQuery] = []
    parts = follow(partial_scores(follow(features, "windows"), detector, settings), "parts")
    graded = graded_stream(parts, detector, settings)
    typed = graded.withColumns({m.name: F.col(m.name).cast(kinds[m.name]) for m in detector.metrics})
    made = result_columns(typed, detector)
    jobs.append(_start(made.writeStream.foreachBatch(store), f"{checkpoint}/results", once, every))
    return jobs


def clock(spark: SparkSession) -> DataFrame:
    """A stream with something in every trigger, whether or not events arrive."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load()


SUMS = "hostname string, key bigint, total double, n bigint, from_ms bigint, until_ms bigint"


def _refit_sums(
    spark: SparkSession, read: Callable[..., DataFrame], now: int, settings: ForecastSettings, path: str, before: str,
    late_ms: int,
) -> DataFrame:
    """Minute sums of the history before ``now``: those of the run before, less what is too old, and of the minutes since.

    Whole minutes that lay at least ``late_ms`` before the last run are taken from it; the others, and the minute that the
    history starts in the middle of, are read again. Whole minutes go to ``path`` for the next run.
    """
    minute = settings.bucket_ms
    since = now - settings.history_ms
    whole_from = -(-since // minute) * minute
    kept, again = None, whole_from
    if exists(spark, before):
        last = spark.read.schema(SUMS).parquet(before)
        bounds = last.agg(F.min("from_ms"), F.max("until_ms")).first()
        if bounds[0] is not None and bounds[0] <= whole_from:
            again = max(whole_from, (bounds[1] - late_ms) // minute * minute)
            kept = last.where((F.col("key") >= whole_from) & (F.col("key") < again)).select("hostname", "key", "total", "n")
    sums = minute_sums(read(since=again), settings)
    sums = sums if kept is None else kept.unionByName(sums)
    stamped = sums.withColumns({"from_ms": F.lit(whole_from).cast("bigint"), "until_ms": F.lit(now).cast("bigint")})
    stamped.coalesce(1).write.mode("overwrite").parquet(path)
    stored = spark.read.schema(SUMS).parquet(path).select("hostname", "key", "total", "n")
    if since == whole_from:
        return stored
    return stored.unionByName(minute_sums(read(since=since, until=whole_from - 1), settings))


def start_forecast(
    arrivals: DataFrame | None,
    root: str,
    checkpoint: str,
    settings: ForecastSettings = SETTINGS,
    event_clock: bool = False,
    ingest_lag_days: int | None = 1,
    once: bool = False,
    every_ms: int | None = MINUTE,
    sums: str | None = None,
    late_ms: int = 5 * MINUTE,
) -> StreamingQuery:
    """Refits on the stored events at every trigger and files the points under the run's day.

    ``arrivals`` is a stream of the events (it only sets the pace and the clock), or None for a clock that ticks whether
    or not events arrive: "now" is the batch's recorded time, or with ``event_clock`` its newest event. A rerun replaces
    its points. Events of the last hour are looked for in partitions at most ``ingest_lag_days`` older than
    they are, as an event is not filed long before it happens; with None, in all partitions.

    With ``sums``, a folder, a run reads the minutes since the one before it and takes the others' sums from there; events
    that are filed more than ``late_ms`` late then count only if a run has to read everything.
    """
    if sums and settings.max_hosts:
        raise ValueError("a run from sums covers every host")

    def refit(batch: DataFrame, batch_id: int) -> None:
        now = batch.agg(F.max("_now")).first()[0]
        if now is None:
            return
        spark: SparkSession = batch.sparkSession

        def read(**bounds: int) -> DataFrame:
            return read_events(spark, root, include_forecast=False, ingest_lag_days=ingest_lag_days, **bounds)

        if sums is None:
            points = forecast(read(since=now - settings.history_ms), now, settings)
        else:
            path, before = (f"{sums}/batch={n:012d}" for n in (batch_id, batch_id - 1))
            made = _refit_sums(spark, read, now, settings, path, before, late_ms)
            points = forecast_points(ols_fit(means_of(made)), settings)
        write_forecast(points, root, now, batch=f"{batch_id:012d}")

    if arrivals is None:
        arrivals = clock(SparkSession.active())
    moment = F.col("timestamp") if event_clock else F.current_timestamp()
    paced = arrivals.select(F.unix_millis(moment).alias("_now"))
    return _start(paced.writeStream.foreachBatch(refit), checkpoint, once, every_ms)
