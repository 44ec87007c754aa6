from datetime import datetime, timezone

import pytest
from conftest import dicts, event_rows
from pyspark.sql import functions as F

from netvigil.functions import metrics, predicates, times
from netvigil.functions.geo import geohash
from netvigil.schema import MINUTE, Metric
from netvigil.sources.adapter import COORDINATES

BASE = 1_704_067_200_000


def test_geohash_known_answers(spark):
    points = spark.createDataFrame([(57.64911, 10.40744)], "lat double, lon double")
    assert points.select(geohash(F.col("lat"), F.col("lon"), 5)).first()[0] == "u4pru"
    places = spark.createDataFrame([(i, *c) for i, c in enumerate(COORDINATES.values())], "i int, lat double, lon double")
    cells = [r[1] for r in sorted(places.select("i", geohash(F.col("lat"), F.col("lon"), 2)).collect())]
    assert cells == ["6g", "6g", "75", "7h", "6g", "6f"]


def test_geohash_edges_and_longest(spark):
    points = spark.createDataFrame([(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0)], "lat double, lon double")
    cells = [r[0] for r in points.select(geohash(F.col("lat"), F.col("lon"), 12)).collect()]
    assert cells == ["zzzzzzzzzzzz", "000000000000", "s00000000000"]


@pytest.mark.parametrize("value,band", [(-1, None), (0, 0), (4, 0), (5, 1), (19, 1), (20, 2), (999, 2), (1000, None), (None, None)])
def test_color_band(spark, value, band):
    frame = spark.createDataFrame([(value,)], "v int")
    assert frame.select(metrics.color_band(F.col("v"), (0, 5, 20, 1000))).first()[0] == band


def test_clamp_and_threshold(spark):
    frame = spark.createDataFrame([(-5.0,), (50.0,), (120.0,), (None,)], "v double")
    kept = [r[0] for r in frame.select(metrics.clamp(F.col("v"), 0, 100)).collect()]
    assert kept[:3] == [0.0, 50.0, 100.0]
    assert [r[0] for r in frame.select(metrics.above(F.col("v"), 50)).collect()] == [False, False, True, False]


def test_mean_of_nothing_is_null(spark):
    frame = spark.createDataFrame([(None,)], "v double")
    assert frame.agg(metrics.mean("v")).first()[0] is None


def test_rollup_equals_direct_aggregation(spark):
    rows = [{"ms": BASE + i * 7000, "hostname": f"h{i % 3}", "utilization_pct": i * 1.5 if i % 4 else None} for i in range(60)]
    events = event_rows(spark, rows)
    wanted = (
        Metric("a", "avg", "utilization_pct"), Metric("m", "max", "utilization_pct"),
        Metric("n", "value_count", "utilization_pct"), Metric("f", "filter_count", "utilization_pct > 30"),
    )
    direct = dicts(events.groupBy("hostname").agg(*metrics.aggregates(wanted)).orderBy("hostname"))
    first = times.bucket_start(times.event_ms(), MINUTE).alias("key")
    steps = events.groupBy("hostname", first).agg(*metrics.partials(wanted))
    assert dicts(steps.groupBy("hostname").agg(*metrics.merged(wanted)).orderBy("hostname")) == direct


def test_text_of_moments_is_utc_in_any_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        frame = spark.range(1).select(F.lit(BASE + 123).alias("ms"))
        row = frame.select(
            times.iso_millis(F.col("ms")), times.daily_name("telecom-noc-", F.col("ms")), times.iso_seconds(F.col("ms"))
        ).first()
        assert tuple(row) == ("2024-01-01T00:00:00.123Z", "telecom-noc-2024.01.01", "2024-01-01T00:00:00Z")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_closed_range_holds_both_ends(spark):
    events = event_rows(spark, [{"ms": BASE - 1}, {"ms": BASE}, {"ms": BASE + 5 * MINUTE}, {"ms": BASE + 5 * MINUTE + 1}])
    assert events.where(predicates.closed_range(BASE + 5 * MINUTE, 5 * MINUTE)).count() == 2
    assert events.where(predicates.from_time(datetime(2024, 1, 1, 0, 5, tzinfo=timezone.utc), 5 * MINUTE)).count() == 3


def test_bool_query(spark):
    events = event_rows(spark, [{"ms": BASE, "hostname": "a"}, {"ms": BASE, "hostname": "b"}, {"ms": BASE}])
    assert events.where(predicates.bool_query()).count() == 3
    assert events.where(predicates.bool_query(must_not=[predicates.term("hostname", "a")])).count() == 2
    assert events.where(predicates.bool_query(must=[predicates.exists("hostname")])).count() == 2


def test_message_words(spark):
    events = event_rows(spark, [{"ms": BASE, "message": "BGP Peer Down / Link-Failure"}, {"ms": BASE, "message": "peering ok"}, {"ms": BASE}])
    assert events.where(predicates.message_matches(["PEER", "nothing"])).count() == 1
    assert events.where(predicates.message_matches(["link", "failure"], match_all=True)).count() == 1
    assert events.where(predicates.message_matches(["peer", "nothing"], match_all=True)).count() == 0


def test_trigger_condition_null_is_false(spark):
    frame = spark.createDataFrame([(85.0,), (85.01,), (None,)], "avg_utilization double")
    assert [r[0] for r in frame.select(predicates.fires("avg_utilization > 85")).collect()] == [False, True, False]
