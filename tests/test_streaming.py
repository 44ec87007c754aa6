"""Continuous jobs over several micro-batches against the batch operators."""

import random
from pathlib import Path

import pytest
from conftest import event_rows
from pyspark.sql import functions as F

from netvigil.operators import detect
from netvigil.operators import monitor as ops
from netvigil.schema import CRITICAL_MONITOR, CRITICAL_SURGE, MINUTE, UTILIZATION_MONITOR, UTILIZATION_SPIKE
from netvigil.session import new_path
from netvigil.sources import ingest, tables
from netvigil.sources.adapter import documents, telemetry
from netvigil.streaming import jobs

BASE = 1_704_067_200_000
COLUMNS = ["event_id", "timestamp", "hostname", "severity", "utilization_pct", "latency_ms", "packet_loss_pct"]


class Replay:
    """Files that arrive one at a time, and a stream over them, a file per micro-batch."""

    def __init__(self, spark, schema):
        self.spark, self.schema, self.folder = spark, schema, new_path(spark, "replay")

    def arrive(self, frame):
        frame.coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.folder)


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    rows = telemetry(spark, sf_dir).select(*COLUMNS)
    return spark.createDataFrame(rows.collect(), rows.schema)


@pytest.fixture(scope="module")
def replay(spark, events):
    made = Replay(spark, events.schema)
    for hour in range(0, 12, 3):
        low, high = BASE + hour * 60 * MINUTE, BASE + (hour + 3) * 60 * MINUTE
        made.arrive(events.where((F.unix_millis("timestamp") >= low) & (F.unix_millis("timestamp") < high)))
    return made


def run(spark, stream, label="out"):
    out = new_path(spark, label)
    jobs.start_append(stream, out, new_path(spark, f"{label}-checkpoint"), once=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*(columns or frame.columns)).collect())


def newest_ms(events):
    return events.agg(F.max(F.unix_millis("timestamp"))).first()[0]


@pytest.mark.parametrize("detector", [UTILIZATION_SPIKE, CRITICAL_SURGE], ids=lambda d: d.name)
def test_closed_windows_equal_batch(spark, events, replay, detector):
    batch = detect.closed_windows(detect.detector_features(events, detector), detector, newest_ms(events))
    assert rows(run(spark, jobs.tumbling_features(replay.stream(), detector))) == rows(batch)


@pytest.mark.parametrize("monitor", [UTILIZATION_MONITOR, CRITICAL_MONITOR], ids=lambda m: m.name)
def test_closed_ticks_and_sends_equal_batch(spark, events, replay, monitor):
    ticks = run(spark, jobs.monitor_stream(replay.stream(), monitor), "ticks")
    batch = ops.trigger_eval(ops.monitor_ticks(events, monitor), monitor)
    last = batch.agg(F.max("tick")).first()[0] - monitor.range_ms - MINUTE
    closed = batch.where(F.col("tick") <= last)
    assert rows(ticks) == rows(closed)

    followed = Replay(spark, closed.schema)
    for part in range(3):
        low, high = BASE + part * 240 * MINUTE, BASE + (part + 1) * 240 * MINUTE
        followed.arrive(closed.where((F.col("tick") >= low) & (F.col("tick") < high)))
    fired = closed.where("fired").select(F.lit(monitor.name).alias("monitor"), "tick")
    wanted = ops.throttle(fired, monitor.interval_ms, monitor.throttle_ms)
    assert rows(run(spark, jobs.throttle_stream(followed.stream(), monitor), "sends")) == rows(wanted)


def test_scores_equal_batch_however_windows_arrive(spark, events):
    features = detect.detector_features(events, CRITICAL_SURGE)
    features = spark.createDataFrame(sorted(features.collect(), key=lambda r: r["key"]), features.schema)
    followed = Replay(spark, features.schema)
    edges = [BASE + m * MINUTE for m in (0, 46, 48, 50, 200, 430, 720)]
    for low, high in zip(edges, edges[1:]):
        followed.arrive(features.where((F.col("key") >= low) & (F.col("key") < high)))
    scored = run(spark, jobs.detect_stream(followed.stream(), CRITICAL_SURGE), "scores")
    batch = detect.rcf_score(detect.shingles(features, CRITICAL_SURGE), CRITICAL_SURGE)
    assert rows(scored) == rows(batch)


def test_late_rows_are_not_seen(spark):
    frame = event_rows(spark, [{"ms": BASE + m * MINUTE, "hostname": "h", "utilization_pct": 10, "latency_ms": 1} for m in range(6)])
    late = event_rows(spark, [{"ms": BASE + 1, "hostname": "h", "utilization_pct": 90, "latency_ms": 1},
                              {"ms": BASE + 5 * MINUTE + 1, "hostname": "h", "utilization_pct": 90, "latency_ms": 1}])
    end = event_rows(spark, [{"ms": BASE + 30 * MINUTE, "hostname": "h", "utilization_pct": 10, "latency_ms": 1}])
    followed = Replay(spark, frame.schema)
    checkpoint, out = new_path(spark, "late-checkpoint"), new_path(spark, "late")
    for part in (frame, late, end):
        followed.arrive(part)
        stream = jobs.tumbling_features(followed.stream(), UTILIZATION_SPIKE)
        jobs.start_append(stream, out, checkpoint, once=True).awaitTermination()
    found = {(r["key"] - BASE) // MINUTE: r["avg_utilization"] for r in spark.read.parquet(out).collect()}
    assert found == {0: 10, 1: 10, 2: 10, 3: 10, 4: 10, 5: 50}


def test_ingest_splits_counts_and_survives_a_rerun(spark, events, sf_dir):
    raw = documents(telemetry(spark, sf_dir)).where("event_id < 1000").select("body", "sent_ms")
    followed = Replay(spark, raw.schema)
    for part in raw.randomSplit([1.0, 1.0, 1.0], seed=4):
        followed.arrive(part)
    root, refused, stats, checkpoint = (new_path(spark, f"ingest-{n}") for n in ("root", "refused", "stats", "checkpoint"))
    for attempt in range(2):
        jobs.start_ingest(followed.stream(), root, refused, stats, checkpoint, once=True).awaitTermination()
        accepted, rejected = tables.read_events(spark, root), spark.read.parquet(refused)
        counts = spark.read.parquet(stats)
        assert counts.count() == 3
        assert accepted.count() == ingest.normalize_events(raw).count()
        assert rejected.count() == ingest.quarantine(raw).count()
        total = counts.agg(F.sum("docs_ok"), F.sum("docs_rejected")).first()
        assert tuple(total) == (accepted.count(), rejected.count())
        running = ingest.with_running_stats(counts).orderBy("batch_id").collect()
        assert (running[-1]["total_ok"], running[-1]["total_rejected"]) == tuple(total)
        # The last batch as it is after a crash before its commit: it runs once more.
        Path(checkpoint, "commits", "2").unlink()
        Path(checkpoint, "commits", ".2.crc").unlink(missing_ok=True)


def test_each_trigger_refits_once(spark, events, replay):
    root, checkpoint = new_path(spark, "forecast-root"), new_path(spark, "forecast-checkpoint")
    tables.write_daily(events, root, ingest_time=BASE)
    jobs.start_forecast(replay.stream(), root, checkpoint, event_clock=True, once=True).awaitTermination()
    made = spark.read.parquet(root).where("source_index like '%forecast%'")
    assert made.select("batch").distinct().count() == 4
    assert made.groupBy("batch", "hostname").count().where("count <> 15").count() == 0
    assert tables.read_events(spark, root, include_forecast=False).count() == events.count()


def test_throttle_state_over_random_batches(spark):
    rng = random.Random(2)
    ticks = [BASE + t * MINUTE for t in range(200) if rng.random() < 0.6]
    frame = spark.createDataFrame([(t, True) for t in ticks], "tick bigint, fired boolean")
    followed = Replay(spark, frame.schema)
    edges = [0, 1, 7, 50, 51, 120, 200]
    for low, high in zip(edges, edges[1:]):
        followed.arrive(frame.where((F.col("tick") >= BASE + low * MINUTE) & (F.col("tick") < BASE + high * MINUTE)))
    wanted, until = [], 0
    for t in ticks:
        if t >= until:
            wanted.append(t)
            until = t + 5 * MINUTE
    sends = run(spark, jobs.throttle_stream(followed.stream(), UTILIZATION_MONITOR), "sends")
    assert [r[0] for r in rows(sends, "tick")] == wanted


@pytest.mark.parametrize("monitor", [UTILIZATION_MONITOR, CRITICAL_MONITOR], ids=lambda m: m.name)
def test_notifications_equal_batch_over_restarts(spark, events, monitor):
    """Payloads and texts of the continuous chain, with every part of the input read by jobs that are started anew."""
    followed = Replay(spark, events.schema)
    ticks, notices, checkpoint = (new_path(spark, f"alerts-{part}") for part in ("ticks", "notices", "checkpoint"))
    for part in range(4):
        low, high = BASE + part * 180 * MINUTE, BASE + (part + 1) * 180 * MINUTE
        followed.arrive(events.where((F.unix_millis("timestamp") >= low) & (F.unix_millis("timestamp") < high)))
        _, last = jobs.start_alerts(followed.stream(), monitor, ticks, notices, checkpoint, once=True)
        last.awaitTermination()
    closed = spark.read.parquet(ticks).agg(F.max("tick")).first()[0]
    batch = ops.notifications(events, monitor).where(F.col("tick") <= closed)
    made = spark.read.parquet(notices)
    assert made.count() > 1 and sorted(made.columns) == sorted(batch.columns)
    assert rows(made, *batch.columns) == rows(batch)


def test_alerts_wait_for_ticks_that_are_not_there_yet(spark):
    frame = event_rows(spark, [{"ms": BASE, "hostname": "h", "utilization_pct": 99}])
    followed = Replay(spark, frame.schema)
    ticks, notices, checkpoint = (new_path(spark, f"quiet-{part}") for part in ("ticks", "notices", "checkpoint"))
    followed.arrive(frame)
    for _ in range(2):
        _, last = jobs.start_alerts(followed.stream(), UTILIZATION_MONITOR, ticks, notices, checkpoint, once=True)
        last.awaitTermination()
    assert spark.read.schema("tick bigint").parquet(notices).count() == 0
    followed.arrive(event_rows(spark, [{"ms": BASE + 60 * MINUTE, "hostname": "h", "utilization_pct": 1}]))
    _, last = jobs.start_alerts(followed.stream(), UTILIZATION_MONITOR, ticks, notices, checkpoint, once=True)
    last.awaitTermination()
    assert [r["tick"] for r in spark.read.parquet(notices).collect()] == [BASE]


def test_a_large_day_ends_in_several_generations(spark):
    """250,000 documents in pieces: full generations are closed while writing, and the footers say the same."""
    from datetime import datetime, timezone

    from netvigil.operators import lifecycle

    raw = spark.range(250_000).select(
        F.format_string('{"timestamp":%d,"hostname":"h"}', F.lit(BASE) + F.col("id")).alias("body"),
        (F.lit(BASE) + F.col("id")).alias("sent_ms"))
    followed = Replay(spark, raw.schema)
    for part in range(5):
        followed.arrive(raw.where(f"sent_ms - {BASE} between {part * 50_000} and {part * 50_000 + 49_999}"))
    root, refused, stats, checkpoint = (new_path(spark, f"large-{n}") for n in ("root", "refused", "stats", "checkpoint"))
    jobs.start_ingest(followed.stream(), root, refused, stats, checkpoint, once=True).awaitTermination()
    today = datetime.now(timezone.utc).date()
    found = lifecycle.rollover_due(lifecycle.stored_inventory(spark, root, today, generations=True))
    assert sorted((r["generation"], r["docs"], r["rollover"]) for r in found.collect()) == [
        ("000001", 100_000, True), ("000002", 100_000, True), ("000003", 50_000, False)]
    ledger = spark.read.schema(ingest.LEDGER).parquet(stats)
    running = ingest.with_running_stats(ledger.select("batch_id", "docs_ok", "docs_rejected", "has_anomaly", "first_ms", "last_ms"))
    kept = ingest.kept_stats(ledger)
    assert rows(kept, *running.columns) == rows(running)
    assert not [p for p in Path(root).iterdir() if p.name.startswith("_arriving")]


@pytest.mark.parametrize("detector", [UTILIZATION_SPIKE, CRITICAL_SURGE], ids=lambda d: d.name)
def test_graded_results_equal_batch_and_double_nothing(spark, events, detector):
    """Three jobs that are started anew for every piece of the input; the last micro-batch of the last job runs twice."""
    followed = Replay(spark, events.schema)
    tables_at, results, checkpoint = (new_path(spark, f"graded-{part}") for part in ("tables", "results", "checkpoint"))
    # Pieces that end where stretches of windows end, and pieces that don't.
    edges = [0, 96, 97, 160, 299, 480, 720]
    for low, high in zip(edges, edges[1:]):
        ms = F.unix_millis("timestamp")
        followed.arrive(events.where((ms >= BASE + low * MINUTE) & (ms < BASE + high * MINUTE)))
        jobs.start_detector(followed.stream(), detector, tables_at, results, checkpoint, once=True)[-1].awaitTermination()
    made = tables.read_detector_results(spark, results, detector.name)
    last = made.agg(F.max("data_start")).first()[0]
    batch = detect.detector_results(events, detector).drop("detector").where(F.col("data_start") <= last)
    expected = rows(batch)
    assert len(expected) > 100 and rows(made, *batch.columns) == expected
    commits = Path(checkpoint, "results", "commits")
    number = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for name in (f"{number}", f".{number}.crc"):
        (commits / name).unlink(missing_ok=True)
    jobs.start_detector(followed.stream(), detector, tables_at, results, checkpoint, once=True)[-1].awaitTermination()
    again = tables.read_detector_results(spark, results, detector.name)
    assert rows(again, *batch.columns) == expected


def test_scores_when_pieces_end_with_stretches(spark, events):
    features = detect.detector_features(events, CRITICAL_SURGE)
    features = spark.createDataFrame(sorted(features.collect(), key=lambda r: r["key"]), features.schema)
    followed = Replay(spark, features.schema)
    for low, high in ((0, 32), (32, 96), (96, 98), (98, 128), (128, 720)):
        followed.arrive(features.where(f"key >= {BASE + low * MINUTE} and key < {BASE + high * MINUTE}"))
    scored = run(spark, jobs.detect_stream(followed.stream(), CRITICAL_SURGE), "scores")
    assert rows(scored) == rows(detect.score_features(features, CRITICAL_SURGE))


def test_grades_wait_for_all_blocks():
    from netvigil.streaming import state

    class Kept:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    import pandas as pd

    step, kept, out = state.grader(["x"], MINUTE, 2, 1e6, 120, 2, 0.05), Kept(), []
    arrivals = [[(0, 1), (0, 1), (1, 2)], [(2, 4), (2, 4)], [(1, 2)], [(3, None), (3, None), (4, 900_000), (4, 900_000)]]
    for rows_of in arrivals:
        frame = pd.DataFrame([("e", k * MINUTE, float(k), u) for k, u in rows_of], columns=["entity", "key", "x", "units"])
        made = pd.concat(list(step(("e",), [frame.astype({"units": "Int64"})], kept)))
        out.append([(r.key // MINUTE, r.x, r.anomaly_score, r.anomaly_grade) for r in made.itertuples()])
    assert [[r[0] for r in part] for part in out] == [[0], [], [1, 2], [3, 4]]
    assert out[0][0][2] == 2e-6 and pd.isna(out[3][0][2]) and pd.isna(out[3][0][3]) and out[3][1][3] == 1.0


def test_refits_from_sums_equal_whole_refits(spark, events):
    """Every run adds the minutes since the one before and drops the oldest; points are those of a fit on everything."""
    from netvigil.operators.forecast import forecast

    root, sums, checkpoint = (new_path(spark, f"sums-{part}") for part in ("root", "sums", "checkpoint"))
    followed = Replay(spark, events.schema)
    edges = [0, 50, 70, 71, 140]
    for low, high in zip(edges, edges[1:]):
        ms = F.unix_millis("timestamp")
        part = events.where((ms >= BASE + low * MINUTE) & (ms < BASE + high * MINUTE))
        tables.write_daily(part, root, ingest_time=BASE, batch=f"b{low}")
        followed.arrive(part)
        stream = followed.stream()
        jobs.start_forecast(stream, root, checkpoint, event_clock=True, once=True, sums=sums).awaitTermination()
    made = spark.read.parquet(root).where("source_index like '%forecast%'")
    for number, high in enumerate(edges[1:]):
        seen = events.where(F.unix_millis("timestamp") < BASE + high * MINUTE)
        wanted = {(r[0], r[1]): r[2] for r in forecast(seen, newest_ms(seen)).select("hostname", "timestamp", "utilization_pct").collect()}
        found = {(r["hostname"], r["timestamp"]): r["utilization_pct"] for r in made.where(f"batch = '{number:012d}'").collect()}
        assert found.keys() == wanted.keys() and len(found) > 15
        assert all(abs(found[k] - v) < 0.02 for k, v in wanted.items())


def test_refits_without_arrivals(spark):
    import time
    from datetime import datetime, timezone

    now = int(time.time() * 1000)
    rows_of = [{"ms": now - m * MINUTE, "hostname": "h", "utilization_pct": 20 + m} for m in range(2, 40)]
    root, checkpoint = new_path(spark, "clock-root"), new_path(spark, "clock-checkpoint")
    tables.write_daily(event_rows(spark, rows_of), root, datetime.now(timezone.utc))
    query = jobs.start_forecast(None, root, checkpoint, every_ms=1000, sums=new_path(spark, "clock-sums"))
    try:
        for _ in range(60):
            time.sleep(1)
            made = spark.read.parquet(root).where("source_index like '%forecast%'")
            if made.select("batch").distinct().count() >= 3:
                break
    finally:
        query.stop()
    assert made.groupBy("batch").count().where("count = 15").count() >= 2


@pytest.mark.parametrize("files,docs", [(4, 50_000), (1, 500)], ids=["several files", "one file"])
def test_a_piece_is_written_and_taken_in_by_several_tasks(spark, sf_dir, folder, monkeypatch, files, docs):
    """Whether the table has several files or one, a piece is one micro-batch of several tasks, with the generations of the SQL."""
    from oracle import compare, connect

    from netvigil.registry import ORACLES, streams

    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(files).write.parquet(f"{folder}/events.parquet")
    made = {}
    monkeypatch.setattr(streams, "new_path", lambda session, label: made.setdefault(label, new_path(session, label)))
    monkeypatch.setattr(streams, "ARRIVAL_DOCS", docs, raising=False)
    found = streams.stream_rollover(spark, folder)
    assert compare(found, connect(sf_dir), ORACLES["stream_rollover"]) is None
    assert spark.read.schema(ingest.LEDGER).parquet(made["rollover-stats"]).count() == 6
    arrived = spark.read.parquet(made["rollover-arrivals"])
    assert arrived.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= docs
    assert len(arrived.inputFiles()) >= 6 * 4
    # A task writes one file of accepted documents.
    for batch in range(6):
        assert len(list(Path(made["rollover-events"]).glob(f"*/*/*/batch={batch:012d}/*.parquet"))) >= 4
