"""Continuous jobs, each run once over all the data at hand.

Runs with a watermark take the whole input as one micro-batch, so no result depends on
the order in which files are listed; ingest, which has none, takes it in bounded pieces.
"""

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from netvigil.functions.times import event_ms
from netvigil.registry.common import HOUR, LOSS, START_MS, fit_sql, points_sql, register
from netvigil.operators.lifecycle import POLICY, rollover_due, stored_inventory
from netvigil.operators import detect
from netvigil.registry.detection import SPIKE_SCORED, SPIKE_SQL, SURGE_SCORED, SURGE_SQL
from netvigil.registry.monitoring import NOTICES, SURGE_NAME, SURGE_TICKS, UTIL_NAME, UTIL_TICKS, sends_sql, with_value
from netvigil.registry.tables import DOCS
from netvigil.schema import CRITICAL_MONITOR, CRITICAL_SURGE, DETECTORS, MONITORS, UTILIZATION_MONITOR, UTILIZATION_SPIKE
from netvigil.session import new_path
from netvigil.sources.adapter import documents, from_events, telemetry
from netvigil.sources.ingest import LEDGER, kept_stats
from netvigil.sources.tables import read_detector_results, read_events, write_daily
from netvigil.streaming import jobs


INGEST_BYTES = 1 << 40


def event_stream(spark: SparkSession, sf_dir: str, max_bytes: int | None = None) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    reader = spark.readStream.schema(schema)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    # A stream's path must be a folder or a pattern; this one matches just the table, file or folder.
    return from_events(reader.parquet(f"{sf_dir}/[e]vents.parquet"))


def run_append(spark: SparkSession, stream: DataFrame, label: str, checkpoint: str | None = None, out: str | None = None) -> DataFrame:
    """Runs a streaming result to the end of its input and returns what it wrote."""
    out = out or new_path(spark, label)
    checkpoint = checkpoint or new_path(spark, f"{label}-checkpoint")
    jobs.start_append(stream, out, checkpoint, once=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_chain(spark: SparkSession, first: DataFrame, second: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    """Two streaming steps with the table between them that the first appends to and the second follows."""
    between = new_path(spark, f"{label}-input")
    run_append(spark, first, label, out=between)
    followed = spark.readStream.schema(first.schema).parquet(between)
    return run_append(spark, second(followed), label)


@register(
    "stream_ingest",
    DOCS + """SELECT coalesce(reason, 'accepted') AS outcome, coalesce(severity, '') AS severity, count(*) AS docs
FROM (SELECT reason, CASE WHEN reason IS NULL THEN severity END AS severity FROM docs) GROUP BY ALL""",
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = documents(event_stream(spark, sf_dir, max_bytes=INGEST_BYTES)).select("body", "sent_ms")
    root, refused, stats, checkpoint = (
        new_path(spark, f"ingest-{part}") for part in ("events", "refused", "stats", "checkpoint")
    )
    jobs.start_ingest(raw, root, refused, stats, checkpoint, once=True).awaitTermination()
    accepted = read_events(spark, root).select(F.lit("accepted").alias("outcome"), "severity")
    rejected = spark.read.schema("reason string").parquet(refused).select(
        F.col("reason").alias("outcome"), F.lit("").alias("severity")
    )
    return accepted.unionByName(rejected).groupBy("outcome", "severity").agg(F.count("*").alias("docs"))


@register(
    "stream_ingest_stats",
    DOCS + """, s AS (SELECT count(*) FILTER (reason IS NULL) AS ok, count(*) FILTER (reason IS NOT NULL) AS refused,
    coalesce(bool_or(severity = 'CRITICAL') FILTER (event_id % 73 <> 72), false) AS anomaly,
    (max(ts_ms) - min(ts_ms)) / 1000.0 AS s FROM docs)
SELECT 0::BIGINT AS batch_id, ok AS docs_ok, refused AS docs_rejected, anomaly AS has_anomaly, ok AS total_ok,
  refused AS total_rejected, CASE WHEN s > 0 THEN round(ok / s, 6) ELSE 0.0 END AS docs_per_s FROM s""",
)
def stream_ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the continuous ingest observes and keeps; the whole input is one micro-batch here."""
    raw = documents(event_stream(spark, sf_dir, max_bytes=INGEST_BYTES)).select("body", "sent_ms")
    root, refused, stats, checkpoint = (
        new_path(spark, f"kept-{part}") for part in ("events", "refused", "stats", "checkpoint")
    )
    jobs.start_ingest(raw, root, refused, stats, checkpoint, once=True).awaitTermination()
    return kept_stats(spark.read.schema(LEDGER).parquet(stats))


SMALL = replace(POLICY, rollover_docs=2500)
PART_MS = 2 * HOUR
ARRIVAL_DOCS = 50_000


@register(
    "stream_rollover",
    DOCS + f""", b AS (SELECT (ts_ms - {START_MS}) // {PART_MS} AS k, count(*) FILTER (reason IS NULL) AS ok FROM docs GROUP BY 1)
, w AS (SELECT k, 1 AS g, ok, ok AS n FROM b WHERE k = (SELECT min(k) FROM b)
  UNION ALL SELECT b.k, CASE WHEN n >= {SMALL.rollover_docs} THEN g + 1 ELSE g END, b.ok,
    CASE WHEN n >= {SMALL.rollover_docs} THEN 0 ELSE n END + b.ok FROM w JOIN b ON b.k = w.k + 1)
SELECT g AS generation, CAST(sum(ok) AS BIGINT) AS docs, sum(ok) >= {SMALL.rollover_docs} AS rollover FROM w GROUP BY g""",
)
def stream_rollover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generations of a day that arrives in pieces of two hours, and which of them file footers call full.

    A piece comes in files of bounded size, as many as it takes, and is one micro-batch: the ingest takes in all that has
    arrived, ends, and goes on from its checkpoint when the next piece is there.
    """
    arrivals, root, refused, stats, checkpoint = (
        new_path(spark, f"rollover-{part}") for part in ("arrivals", "events", "refused", "stats", "checkpoint")
    )
    raw = documents(telemetry(spark, sf_dir)).select("body", "sent_ms")
    for part in range(6):
        low, high = START_MS + part * PART_MS, START_MS + (part + 1) * PART_MS
        some = raw.where((F.col("sent_ms") >= low) & (F.col("sent_ms") < high))
        some.write.mode("append").option("maxRecordsPerFile", ARRIVAL_DOCS).parquet(arrivals)
        stream = spark.readStream.schema("body string, sent_ms bigint").parquet(arrivals)
        jobs.start_ingest(stream, root, refused, stats, checkpoint, once=True, policy=SMALL).awaitTermination()
    found = rollover_due(stored_inventory(spark, root, date.today(), generations=True), SMALL)
    return found.select(F.col("generation").cast("int").alias("generation"), "docs", "rollover")


@register(
    "stream_tumbling",
    SPIKE_SQL + """, newest AS (SELECT max(ts_ms) AS ms FROM ev)
SELECT spike.* FROM spike, newest WHERE key + 60000 <= ms - 60000""",
)
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = jobs.tumbling_features(event_stream(spark, sf_dir), UTILIZATION_SPIKE)
    return run_append(spark, features, "spike-features")


@register(
    "stream_tumbling_critical",
    SURGE_SQL + """, newest AS (SELECT max(ts_ms) AS ms FROM ev)
SELECT surge.* FROM surge, newest WHERE key + 120000 <= ms - 60000""",
)
def stream_tumbling_critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = jobs.tumbling_features(event_stream(spark, sf_dir), CRITICAL_SURGE)
    return run_append(spark, features, "surge-features")


# The last tick the watermark has passed, for each monitor: events run ahead by the range.
UTIL_CLOSED = ", uc AS (SELECT max(tick) - 180000 AS wm FROM ut) , uo AS (SELECT ut.* FROM ut, uc WHERE tick <= wm)"
SURGE_CLOSED = ", sc AS (SELECT max(tick) - 360000 AS wm FROM st) , so AS (SELECT st.* FROM st, sc WHERE tick <= wm)"


@register("stream_monitor", UTIL_TICKS + UTIL_CLOSED + "SELECT * FROM uo")
def stream_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_append(spark, jobs.monitor_stream(event_stream(spark, sf_dir), UTILIZATION_MONITOR), "util-ticks")


@register("stream_monitor_critical", SURGE_TICKS + SURGE_CLOSED + "SELECT * FROM so")
def stream_monitor_critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_append(spark, jobs.monitor_stream(event_stream(spark, sf_dir), CRITICAL_MONITOR), "surge-ticks")


LATE_EVERY = 50


@register(
    "stream_late_data",
    f""", first_mark AS (SELECT max(ts_ms) - 60000 AS ms FROM ev WHERE event_id % {LATE_EVERY} <> 0)
, last_mark AS (SELECT max(ts_ms) - 60000 AS ms FROM ev)
, seen AS (SELECT ev.* FROM ev, first_mark
  WHERE event_id % {LATE_EVERY} <> 0 OR ts_ms - ts_ms % 120000 + 120000 > first_mark.ms)
, g AS (SELECT 'all' AS entity, ts_ms - ts_ms % 120000 AS key, count(*) FILTER (severity = 'CRITICAL') AS critical_count,
  {LOSS} AS avg_packet_loss FROM seen GROUP BY 1, 2)
SELECT g.* FROM g, last_mark WHERE key + 120000 <= last_mark.ms""",
)
def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th event arrives after the others: those whose window has closed are not counted."""
    arrivals, checkpoint, out = (new_path(spark, f"late-{part}") for part in ("arrivals", "checkpoint", "result"))
    events = telemetry(spark, sf_dir).select("event_id", "timestamp", "severity", "packet_loss_pct")
    late = F.col("event_id") % LATE_EVERY == 0
    for part in (events.where(~late), events.where(late)):
        part.write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(events.schema).parquet(arrivals)
        features = run_append(spark, jobs.tumbling_features(stream, CRITICAL_SURGE), "late", checkpoint, out)
    return features


@register(
    "stream_throttle",
    UTIL_TICKS + SURGE_TICKS + UTIL_CLOSED + SURGE_CLOSED
    + sends_sql("uo", "us", 300000) + sends_sql("so", "ss", 600000)
    + f"SELECT '{UTIL_NAME}' AS monitor, tick FROM us WHERE tick IS NOT NULL UNION ALL "
    f"SELECT '{SURGE_NAME}', tick FROM ss WHERE tick IS NOT NULL",
)
def stream_throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_stream(spark, sf_dir)
    sends = [
        run_chain(spark, jobs.monitor_stream(events, m), lambda ticks, m=m: jobs.throttle_stream(ticks, m), "sends")
        for m in MONITORS
    ]
    return reduce(DataFrame.unionByName, sends)


@register(
    "stream_notifications",
    UTIL_TICKS + SURGE_TICKS + UTIL_CLOSED + SURGE_CLOSED
    + sends_sql("uo", "us", 300000) + sends_sql("so", "ss", 600000) + NOTICES,
)
def stream_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From events to payloads and texts, by two jobs for each monitor."""
    made = []
    for monitor in MONITORS:
        ticks, notices, checkpoint = (new_path(spark, f"alerts-{part}") for part in ("ticks", "notices", "checkpoint"))
        _, last = jobs.start_alerts(event_stream(spark, sf_dir), monitor, ticks, notices, checkpoint, once=True)
        last.awaitTermination()
        made.append(with_value(spark.read.parquet(notices), monitor))
    return reduce(DataFrame.unionByName, made)


@register(
    "stream_forecast",
    """, newest AS (SELECT max(ts_ms) AS ms FROM ev)
, hist AS (SELECT hostname, ts_ms - ts_ms % 60000 AS key,
    sum(CAST(CAST(CAST(utilization_pct AS VARCHAR) AS FLOAT) AS DOUBLE)) / count(*) AS y
  FROM ev, newest WHERE ts_ms >= newest.ms - 3600000 GROUP BY 1, 2)"""
    + fit_sql() + points_sql() + "SELECT hostname, ts_ms, utilization_pct FROM points",
)
def stream_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, checkpoint = new_path(spark, "forecast-events"), new_path(spark, "forecast-checkpoint")
    write_daily(telemetry(spark, sf_dir), root, ingest_time=1_704_067_200_000)
    jobs.start_forecast(event_stream(spark, sf_dir), root, checkpoint, event_clock=True, once=True).awaitTermination()
    points = read_events(spark, root).where(F.col("source_index").contains("forecast"))
    utilization = F.round(F.col("utilization_pct").cast("double"), 2).alias("utilization_pct")
    return points.select("hostname", event_ms().alias("ts_ms"), utilization)


@register("stream_detect", SURGE_SCORED + """, newest AS (SELECT max(ts_ms) AS ms FROM ev)
SELECT s.*, true AS as_batch FROM surge_full_scored s, newest WHERE key + 120000 <= ms - 60000""")
def stream_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which windows the stream scored, and whether the batch job gives the same."""
    features = jobs.tumbling_features(event_stream(spark, sf_dir), CRITICAL_SURGE)
    found = run_chain(spark, features, lambda closed: jobs.detect_stream(closed, CRITICAL_SURGE), "surge-scores")
    batch = detect.detector_features(telemetry(spark, sf_dir), CRITICAL_SURGE)
    batch = detect.rcf_score(detect.shingles(batch, CRITICAL_SURGE), CRITICAL_SURGE)
    both = found.join(batch.withColumnRenamed("anomaly_score", "again"), ["entity", "key"], "left")
    same = F.col("anomaly_score").eqNullSafe(F.col("again"))
    return both.select("entity", "key", F.col("anomaly_score").isNotNull().alias("scored"), same.alias("as_batch"))


@register(
    "stream_detector_results",
    SPIKE_SCORED + SURGE_SCORED + """, newest AS (SELECT max(ts_ms) AS ms FROM ev)
SELECT 'noc-utilization-spike' AS detector, entity, key, avg_utilization AS first, max_utilization AS second, avg_latency AS third,
  scored, true AS as_batch FROM spike JOIN spike_full_scored USING (entity, key), newest WHERE key + 60000 <= ms - 60000
UNION ALL SELECT 'noc-critical-surge', entity, key, CAST(critical_count AS DOUBLE), avg_packet_loss, NULL, scored, true
FROM surge JOIN surge_full_scored USING (entity, key), newest WHERE key + 120000 <= ms - 60000""",
)
def stream_detector_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the windows in the continuous result tables, and whether score and grade are the batch job's."""
    made = []
    results = new_path(spark, "stream-results")
    for detector in DETECTORS:
        tables, checkpoint = new_path(spark, "detector-tables"), new_path(spark, "detector-checkpoint")
        jobs.start_detector(event_stream(spark, sf_dir), detector, tables, results, checkpoint, once=True)[-1].awaitTermination()
        found = read_detector_results(spark, results, detector.name)
        batch = detect.detector_results(telemetry(spark, sf_dir), detector).select(
            "entity", "data_start", F.col("anomaly_score").alias("score"), F.col("anomaly_grade").alias("grade")
        )
        same = F.col("anomaly_score").eqNullSafe(F.col("score")) & F.col("anomaly_grade").eqNullSafe(F.col("grade"))
        values = [F.col(m.name).cast("double") for m in detector.metrics] + [F.lit(None).cast("double")]
        made.append(found.join(batch, ["entity", "data_start"], "left").select(
            F.lit(detector.name).alias("detector"), "entity", event_ms("data_start").alias("key"),
            *[v.alias(n) for v, n in zip(values, ("first", "second", "third"))],
            F.col("anomaly_score").isNotNull().alias("scored"), same.alias("as_batch"),
        ))
    return made[0].unionByName(made[1])
