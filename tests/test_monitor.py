import json
import random

import pytest
from conftest import dicts, event_rows
from pyspark.sql import functions as F

from netvigil.operators import monitor as ops
from netvigil.schema import CRITICAL_MONITOR, HOUR, MINUTE, UTILIZATION_MONITOR

BASE = 1_704_067_200_000


def greedy(ticks, hold):
    sent, until = [], None
    for tick in sorted(ticks):
        if until is None or tick >= until:
            sent.append(tick)
            until = tick + hold
    return sent


def test_range_is_closed_at_both_ends(spark):
    events = event_rows(spark, [{"ms": BASE, "utilization_pct": 90}, {"ms": BASE + 2 * MINUTE, "utilization_pct": 100}])
    ticks = {(r["tick"] - BASE) // MINUTE: r for r in ops.monitor_ticks(events, UTILIZATION_MONITOR).collect()}
    assert sorted(ticks) == [0, 1, 2, 3, 4]
    assert ticks[2]["avg_utilization"] == 95 and ticks[2]["max_utilization"] == 100


def test_monitor_against_brute_force(spark):
    rng = random.Random(5)
    times = [BASE + rng.choice([rng.randrange(40 * MINUTE), rng.randrange(40) * MINUTE]) for _ in range(300)]
    events = event_rows(spark, [{"ms": t, "severity": "CRITICAL" if i % 3 else "INFO", "packet_loss_pct": i % 50} for i, t in enumerate(times)])
    found = {r["tick"]: (r["critical_count"], round(r["avg_packet_loss"], 9)) for r in ops.monitor_ticks(events, CRITICAL_MONITOR).collect()}
    wanted = {}
    for tick in range(BASE, BASE + 2 * HOUR, 2 * MINUTE):
        losses = [i % 50 for i, t in enumerate(times) if i % 3 and tick - 5 * MINUTE <= t <= tick]
        if losses:
            wanted[tick] = (len(losses), round(sum(losses) / len(losses), 9))
    assert found == wanted


@pytest.mark.parametrize("value,fires", [(85, False), (85.01, True), (None, False)])
def test_trigger_is_strict(spark, value, fires):
    events = event_rows(spark, [{"ms": BASE, "hostname": "h", "utilization_pct": value}])
    assert ops.trigger_eval(ops.monitor_ticks(events, UTILIZATION_MONITOR), UTILIZATION_MONITOR).first()["fired"] is fires


def test_ten_critical_events_do_not_fire(spark):
    for n, fires in ((10, False), (11, True)):
        events = event_rows(spark, [{"ms": BASE, "severity": "CRITICAL", "packet_loss_pct": 1}] * n)
        assert (ops.firing_ticks(events, CRITICAL_MONITOR).count() > 0) is fires


def test_forecast_rows_do_not_dilute_unless_asked(spark):
    events = event_rows(spark, [{"ms": BASE, "utilization_pct": 100}]).withColumn("source_index", F.lit("telecom-noc-2024.01.01"))
    made = event_rows(spark, [{"ms": BASE, "utilization_pct": 0}]).withColumn("source_index", F.lit("telecom-noc-forecast-2024.01.01"))
    both = events.unionByName(made)
    assert ops.firing_ticks(both, UTILIZATION_MONITOR).count() == 3
    assert ops.firing_ticks(both, UTILIZATION_MONITOR, include_forecast=True).count() == 0


def test_throttle_by_hand(spark):
    fired = spark.createDataFrame([("m", BASE + m * MINUTE) for m in (0, 1, 2, 5, 6, 15)], "monitor string, tick bigint")
    sends = sorted((r["tick"] - BASE) // MINUTE for r in ops.throttle(fired, MINUTE, 5 * MINUTE).collect())
    assert sends == [0, 5, 15]


@pytest.mark.parametrize("interval,hold,chunk", [
    (MINUTE, 5 * MINUTE, 6 * MINUTE), (MINUTE, 5 * MINUTE, HOUR), (2 * MINUTE, 10 * MINUTE, 12 * MINUTE),
    (2 * MINUTE, 5 * MINUTE, 8 * MINUTE), (MINUTE, MINUTE, 2 * MINUTE), (2 * MINUTE, MINUTE, 2 * MINUTE),
])
def test_throttle_against_brute_force(spark, interval, hold, chunk):
    rng = random.Random(interval + hold + chunk)
    patterns = {f"m{i}": [BASE + t * interval for t in range(400) if rng.random() < density] for i, density in enumerate((1.0, 0.7, 0.3, 0.05))}
    fired = spark.createDataFrame([(m, t, float(t)) for m, ticks in patterns.items() for t in ticks], "monitor string, tick bigint, value double")
    sends = ops.throttle(fired.repartition(5), interval, hold, chunk_ms=chunk).collect()
    assert all(r["value"] == r["tick"] for r in sends)
    found = {m: sorted(r["tick"] for r in sends if r["monitor"] == m) for m in patterns}
    assert found == {m: greedy(ticks, hold) for m, ticks in patterns.items()}


@pytest.mark.parametrize("interval,hold", [(7 * MINUTE, 20 * MINUTE), (HOUR, 72 * HOUR), (HOUR, 0)])
def test_throttle_picks_a_chunk_for_any_schedule(spark, interval, hold):
    ticks = [t * interval for t in range(-300, 300) if t % 11]
    fired = spark.createDataFrame([("m", t) for t in ticks], "monitor string, tick bigint")
    assert sorted(r["tick"] for r in ops.throttle(fired, interval, hold).collect()) == greedy(ticks, hold)


def test_throttle_refuses_chunks_it_cannot_fold(spark):
    fired = spark.createDataFrame([("m", BASE)], "monitor string, tick bigint")
    with pytest.raises(ValueError):
        ops.throttle(fired, MINUTE, 5 * MINUTE, chunk_ms=5 * MINUTE)


def test_notification_payload(spark):
    events = event_rows(spark, [{"ms": BASE, "severity": "CRITICAL", "packet_loss_pct": 60}] * 11)
    row = ops.notifications(events, CRITICAL_MONITOR).first()
    payload = json.loads(row["payload"])
    assert payload == {
        "monitor_name": "NOC - Surto de Eventos CRITICAL", "trigger_name": "Mais de 10 eventos CRITICAL em 5min",
        "severity": "CRITICAL", "period_start": "2023-12-31T23:58:00Z", "period_end": "2024-01-01T00:00:00Z",
        "message": "11 eventos CRITICAL nos ultimos 5min | Packet Loss medio: 60.0%",
    }
    assert "📅 <b>Período:</b> 2023-12-31T23:58:00Z → 2024-01-01T00:00:00Z" in row["text"]


def test_payload_fallbacks_and_text(spark):
    bodies = ['{"monitor_name":"A","monitor":{"name":"B"}}', '{"monitor":{"name":"B"},"severity":1}', "{}", "", "down < up", '{"message":"x"}', "[1]"]
    raw = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    rows = sorted(dicts(ops.parse_payloads(raw)), key=lambda r: r["i"])
    assert [r["monitor_name"] for r in rows] == ["A", "B", "Monitor", "Monitor", "Monitor", "Monitor", "Monitor"]
    assert [r["severity"] for r in rows][:3] == ["N/A", "1", "N/A"]
    assert [r["message"] for r in rows] == ["", "", "", "", "down < up", "x", "[1]"]
    text = ops.human_message(F.lit(BASE).cast("bigint"), link="http://dashboards")
    lines = [r[0].split("\n") for r in ops.parse_payloads(raw).orderBy("i").select(text).collect()]
    assert lines[2] == [
        "🚨 <b>ALERTA NOC</b> 🚨", "", "📌 <b>Monitor:</b> Monitor", "⚡ <b>Trigger:</b> Trigger",
        "🔴 <b>Severidade:</b> N/A", "🕐 <b>Hora:</b> 2024-01-01 00:00:00 UTC", "", "🔗 <a href='http://dashboards'>Dashboard</a>",
    ]
    assert lines[4][6:9] == ["", "💬 <i>down < up</i>", ""]


def test_malformed_payloads_are_the_message(spark):
    bodies = ['{"message":"a"} trailing', "   ", '{"message":"a"},{"message":"b"}', '{"message":"a"}]', "", None]
    raw = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    rows = sorted(dicts(ops.parse_payloads(raw)), key=lambda r: r["i"])
    assert [r["message"] for r in rows] == [*bodies[:5], ""]
    assert {r["monitor_name"] for r in rows} == {"Monitor"}


def test_rows_that_send_keep_their_columns_and_types(spark):
    fired = spark.createDataFrame(
        [("m", "h1", BASE + t * MINUTE, None if t % 3 else t, [t], b"x") for t in range(0, 50, 2)],
        "monitor string, hostname string, tick bigint, maybe int, list array<int>, raw binary",
    )
    sends = ops.throttle(fired, MINUTE, 5 * MINUTE, by=("monitor", "hostname"), chunk_ms=10 * MINUTE)
    assert sends.schema == fired.schema
    assert sorted(r["list"][0] for r in sends.collect()) == [0, 6, 12, 18, 24, 30, 36, 42, 48]
    assert all(r["maybe"] == (r["list"][0] if r["list"][0] % 3 == 0 else None) for r in sends.collect())


def test_islands_do_not_wait_for_each_other(spark):
    """A gap as long as the throttle starts anew; one a minute shorter does not."""
    ticks = [0, 4, 8, 13, 17, 100, 104, 109, 2000, 2001]
    fired = spark.createDataFrame([("m", BASE + t * MINUTE) for t in ticks], "monitor string, tick bigint")
    for chunk in (6, 60, 1440):
        sends = ops.throttle(fired, MINUTE, 5 * MINUTE, chunk_ms=chunk * MINUTE)
        assert sorted((r["tick"] - BASE) // MINUTE for r in sends.collect()) == [0, 8, 13, 100, 109, 2000]


def test_throttled_events_are_scanned_once(spark, sf_dir):
    from netvigil.sources.adapter import telemetry

    frame = ops.notifications(telemetry(spark, sf_dir), UTILIZATION_MONITOR)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    final = plan[plan.index("Final Plan"):]
    assert final.count("FileScan parquet") == 1
