import json
from pathlib import Path

import pytest
from conftest import at, dicts, event_rows
from pyspark.sql import functions as F

from netvigil.plans import panels
from netvigil.sources import ingest, tables
from netvigil.sources.adapter import documents, telemetry

BASE = 1_704_067_200_000


def parse(spark, bodies):
    frame = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    return sorted(dicts(ingest.parse_documents(frame)), key=lambda r: r["i"])


def test_timestamps(spark):
    stamps = ['"2024-01-01T00:00:00.123Z"', '"2024-01-01T00:00:00.123456+00:00"', "1704067200000", '"1704067200000"', '"x"']
    frame = spark.createDataFrame([(i, f'{{"timestamp":{s}}}') for i, s in enumerate(stamps)], "i int, body string")
    parsed = ingest.parse_documents(frame).select("i", F.unix_micros("timestamp").alias("us"), "reason").orderBy("i")
    assert [(r["us"], r["reason"]) for r in parsed.collect()] == [
        (BASE * 1000 + 123_000, None), (BASE * 1000 + 123_456, None), (BASE * 1000, None), (BASE * 1000, None),
        (None, "bad_timestamp"),
    ]


def test_timestamp_forms(spark):
    wanted = {
        "2024": 1_704_067_200_000, "2024-02": 1_706_745_600_000, "2024-01-03": 1_704_240_000_000,
        "2024-01-01T10Z": BASE + 36_000_000, "2024-01-01T10:20": BASE + 37_200_000,
        "2024-01-01T10:20:30,5": BASE + 37_230_500, "2024-01-01T03:00:00+0300": BASE, "2024-01-01T03:00:00+03": BASE,
        "2024-01T10Z": None, "2024-13-01T00:00:00Z": None, "12:30": None, "": None, "2024-01-01 10:00:00": None,
        "99999999999999999999": None, "-5": -5, "24": 24,
    }
    frame = spark.createDataFrame([(s,) for s in wanted], "s string")
    found = frame.select("s", F.unix_millis(ingest.parse_timestamp(F.col("s"))).alias("ms"))
    assert {r["s"]: r["ms"] for r in found.collect()} == wanted


def test_refusals(spark):
    good = {"timestamp": "2024-01-01T00:00:00Z", "hostname": "h", "utilization_pct": 1.5, "location": "-23.5,-46.6"}
    bodies = [
        json.dumps(good), json.dumps({}), json.dumps(good | {"zz": 1}), json.dumps(good | {"latency_ms": "fast"}),
        json.dumps(good | {"latency_ms": "12.5"}), json.dumps(good | {"location": "91,0"}), json.dumps(good)[:-1],
        "[1]", "5", "", "plain", json.dumps(good | {"hostname": None}), json.dumps(good | {"utilization_pct": 900}),
    ]
    bodies += [
        '{"hostname":"a"}x', '{"hostname":"a"}{"hostname":"b"}', '{"hostname":{"a":1}}', '{"hostname":["a"]}',
        '{"utilization_pct":1e60}', "{'hostname':'a'}", ' {"message":"a \\\\\\"{[ b"} ',
    ]
    reasons = [r["reason"] for r in parse(spark, bodies)]
    assert reasons == [
        None, None, "unknown_field", "bad_number", None, "bad_location", "not_an_object",
        "not_an_object", "not_an_object", "not_an_object", "not_an_object", None, None,
        "bad_structure", "bad_structure", "bad_structure", "bad_structure", "bad_number", "not_an_object", None,
    ]


def test_quarantine_keeps_the_document(spark):
    frame = spark.createDataFrame([(1, '{"zz":1}'), (2, '{"hostname":"h"}')], "i int, body string")
    assert dicts(ingest.quarantine(frame)) == [{"i": 1, "body": '{"zz":1}', "reason": "unknown_field"}]
    assert [r["i"] for r in ingest.normalize_events(frame).collect()] == [2]


def test_exact_copy_of_long_messages_is_left_out(spark):
    rows = parse(spark, [json.dumps({"message": "m" * n}) for n in (256, 257)])
    assert rows[0]["message_keyword"] == "m" * 256 and rows[1]["message_keyword"] is None
    assert len(rows[1]["message"]) == 257


def test_written_fields_are_read_back(spark, folder):
    events = event_rows(spark, [{"ms": BASE, "hostname": "h", "location": (1.0, 2.0), "utilization_pct": 12.35}, {"ms": BASE + 1}])
    tables.write_daily(events, folder, ingest_time=at(BASE + 86_400_000))
    found = sorted(dicts(tables.read_events(spark, folder)), key=lambda r: r["timestamp"])
    assert found[0]["source_index"] == "telecom-noc-2024.01.02"
    assert found[0]["location"] == {"lat": 1.0, "lon": 2.0} and abs(found[0]["utilization_pct"] - 12.35) < 1e-5
    assert found[1]["hostname"] is None


def test_same_batch_replaces_itself_and_appends_add_up(spark, folder):
    events = event_rows(spark, [{"ms": BASE, "hostname": "h"}])
    for _ in range(2):
        tables.write_daily(events, folder, at(BASE), batch="7")
    assert tables.read_events(spark, folder).count() == 1
    for _ in range(2):
        tables.write_daily(events, folder, at(BASE))
    assert tables.read_events(spark, folder).count() == 3


def test_forecasts_lie_beside_events(spark, folder):
    tables.write_daily(event_rows(spark, [{"ms": BASE, "hostname": "h"}]), folder, at(BASE))
    points = spark.createDataFrame([(at(BASE), "h", 50.0)], "timestamp timestamp, hostname string, utilization_pct double")
    tables.write_forecast(points, folder, at(BASE))
    assert tables.read_events(spark, folder).count() == 2
    assert tables.read_events(spark, folder, include_forecast=False).count() == 1
    row = tables.read_events(spark, folder).where("source_index like '%forecast%'").first()
    assert row["source_index"] == "telecom-noc-forecast-2024.01.01" and row["severity"] is None


def test_time_range_prunes_partitions(spark, folder):
    day = 86_400_000
    for i in range(3):
        tables.write_daily(event_rows(spark, [{"ms": BASE + i * day}]), folder, at(BASE + i * day))
    ranged = tables.read_events(spark, folder, since=BASE + day, until=BASE + day + 1, ingest_lag_days=0)
    assert ranged.count() == 1
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "GreaterThanOrEqual(timestamp" in plan
    assert tables.read_events(spark, folder, since=BASE + day).count() == 2


def test_statistics_count_every_document(spark, sf_dir):
    raw = documents(telemetry(spark, sf_dir))
    stats = ingest.ingest_stats(raw)
    last = stats.orderBy(F.desc("batch_id")).first()
    assert last["total_ok"] + last["total_rejected"] == raw.count()
    assert ingest.quarantine(raw).count() == last["total_rejected"]


def test_stored_events_give_the_same_panels(spark, sf_dir, folder):
    events = telemetry(spark, sf_dir)
    tables.write_daily(events, folder, at(BASE), rebalance=True)
    stored = tables.read_events(spark, folder)
    for panel, keys in ((panels.top_hosts, ["hostname"]), (panels.util_trend, ["key", "hostname"]), (panels.geo_heat, ["geohash"]),
                        (panels.region_share, ["region"]), (panels.kpis, [])):
        both = [sorted(dicts(panel(e)), key=lambda r: [str(r[k]) for k in keys]) for e in (events, stored)]
        for one, other in zip(*both, strict=True):
            assert [one[k] for k in keys] == [other[k] for k in keys]
            assert all(other[k] == pytest.approx(v, rel=1e-6) for k, v in one.items() if isinstance(v, (int, float)))


HOUR = 3_600_000


def test_one_hour_is_listed_alone(spark, folder):
    """Nothing outside the folders that a range asks for is looked at: what lies there could not even be listed."""
    for hour in (9, 10, 11):
        tables.write_daily(event_rows(spark, [{"ms": BASE + hour * HOUR}]), folder, at(BASE + hour * HOUR), batch=f"b{hour}")
    day = Path(folder, "source_index=telecom-noc-2024.01.01", "generation=000001")
    for odd in (day / "hour=11" / "broken", Path(folder, "source_index=telecom-noc-2023.12.31", "hour=1", "generation=2")):
        odd.mkdir(parents=True)
        (odd / "part.parquet").write_bytes(b"no parquet")
    ranged = tables.read_events(
        spark, folder, since=BASE + 10 * HOUR, until=BASE + 11 * HOUR - 1, ingest_lag_hours=0, include_forecast=False)
    assert [r["source_index"] for r in ranged.collect()] == ["telecom-noc-2024.01.01"]
    assert all("hour=10" in name for name in ranged.inputFiles())
    with pytest.raises(Exception):
        tables.read_events(spark, folder).collect()


@pytest.mark.parametrize("lag,expected", [(0, [10]), (1, [9, 10, 11]), (30, [8, 9, 10, 11, 12])])
def test_lag_widens_the_listing(spark, folder, lag, expected):
    for hour in range(8, 13):
        rows = [{"ms": BASE + 10 * HOUR + hour, "hostname": str(hour)}]
        tables.write_daily(event_rows(spark, rows), folder, at(BASE + hour * HOUR), batch=f"b{hour}")
    ranged = tables.read_events(spark, folder, since=BASE + 10 * HOUR, until=BASE + 11 * HOUR - 1, ingest_lag_hours=lag)
    assert sorted(int(r["hostname"]) for r in ranged.collect()) == expected
    open_end = tables.read_events(spark, folder, since=BASE + 10 * HOUR, ingest_lag_hours=lag)
    assert sorted(int(r["hostname"]) for r in open_end.collect()) == list(range(max(8, 10 - lag), 13))


def test_whole_days_are_found_at_any_hour(spark, folder):
    tables.write_daily(event_rows(spark, [{"ms": BASE + 10 * HOUR}]), folder, at(BASE), rebalance=True)
    ranged = tables.read_events(spark, folder, since=BASE + 10 * HOUR, until=BASE + 10 * HOUR + 1, ingest_lag_hours=0)
    assert ranged.count() == 1
    nothing = tables.read_events(spark, folder, since=BASE - 99 * HOUR, until=BASE - 98 * HOUR, ingest_lag_hours=1)
    assert nothing.count() == 0 and nothing.columns == ranged.columns


def test_ledger_rows_follow_each_other():
    policy = ingest.Retention(rollover_docs=10, rollover_days=1)
    row, seen = None, []
    for batch, (ok, taken) in enumerate([(4, BASE), (7, BASE + 1), (3, BASE + 2), (0, BASE + 3), (9, BASE + 4), (1, BASE + 5), (2, BASE + 86_400_000)]):
        counts = {"docs_ok": ok, "docs_rejected": 1, "has_anomaly": False, "first_ms": taken if ok else None, "last_ms": taken if ok else None}
        row = ingest.next_row(row, batch, counts | {"taken_ms": taken}, policy)
        seen.append((row["generation"], row["generation_docs"], row["ok_so_far"]))
    assert seen == [(1, 4, 4), (1, 11, 11), (2, 3, 14), (2, 3, 14), (2, 12, 23), (3, 1, 24), (1, 2, 26)]
    assert row["rejected_so_far"] == 7 and row["began_ms"] == BASE
    nothing = {"docs_ok": 0, "docs_rejected": 0, "has_anomaly": False, "first_ms": None, "last_ms": None, "taken_ms": None}
    assert ingest.next_row(None, 0, nothing, policy)["generation"] == 1
