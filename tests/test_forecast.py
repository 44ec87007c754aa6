import pytest
from conftest import dicts, event_rows
from pyspark.sql import functions as F

from netvigil.operators import forecast as ops
from netvigil.plans import panels
from netvigil.schema import MINUTE

BASE = 1_704_067_200_000


@pytest.mark.parametrize("points,line", [
    ([(0, 1), (1, 3)], (2, 1)),
    ([(0, 7)], (0, 0)),
    ([(2, 1), (2, 5)], (0, 0)),
    ([(0, 5), (1, 5), (2, 5)], (0, 5)),
])
def test_line(spark, points, line):
    frame = spark.createDataFrame([("h", float(x), float(y)) for x, y in points], "hostname string, x double, y double")
    fit = ops.line(ops.regression_sums(frame, ["hostname"], F.col("x"), F.col("y"))).first()
    assert (fit["slope"], fit["intercept"]) == line


def minutes(spark, host, values):
    return event_rows(spark, [{"ms": BASE + m * MINUTE, "hostname": host, "utilization_pct": v} for m, v in values])


def test_points_are_clamped_and_anchored_at_the_last_bucket(spark):
    points = ops.forecast(minutes(spark, "h", [(0, 10), (1, 20)]), BASE + 10 * MINUTE)
    rows = points.select(F.unix_millis("timestamp").alias("ms"), "utilization_pct").orderBy("ms").collect()
    values = {(r["ms"] - BASE) // MINUTE: r["utilization_pct"] for r in rows}
    assert list(values) == list(range(2, 17))
    assert values[2] == 30 and values[9] == 100 and values[10] == 100


def test_one_bucket_gives_no_points_and_falling_lines_stop_at_zero(spark):
    assert ops.forecast(minutes(spark, "h", [(0, 10)]), BASE).count() == 0
    falling = ops.forecast(minutes(spark, "h", [(0, 20), (1, 10)]), BASE).orderBy("timestamp").collect()
    assert [r["utilization_pct"] for r in falling[:2]] == [0, 0]


def test_history_window_is_open_above_and_skips_forecasts(spark):
    events = minutes(spark, "h", [(-61, 1), (-60, 2), (0, 3), (5, 4)]).withColumn("source_index", F.lit("telecom-noc-2024.01.01"))
    made = events.withColumn("source_index", F.lit("telecom-noc-forecast-2024.01.01"))
    history = ops.forecast_history(ops.forecast_union(events, made), BASE)
    assert sorted(((r["key"] - BASE) // MINUTE, r["count"]) for r in history.collect()) == [(-60, 1), (0, 1), (5, 1)]


def test_newest_run_wins(spark):
    events = minutes(spark, "h", [(m, 10 + m) for m in range(30)])
    runs = ops.forecast_run(events, BASE + 10 * MINUTE).unionByName(ops.forecast_run(events, BASE + 20 * MINUTE))
    latest = ops.forecast_latest(runs)
    assert runs.count() == 30 and latest.count() == 25
    assert latest.where(F.col("timestamp") >= F.timestamp_millis(F.lit(BASE + 21 * MINUTE))).select("run_ms").distinct().count() == 1


def test_panel_shows_both_series_and_empty_minutes(spark):
    actual = minutes(spark, "h", [(0, 90), (3, 10)]).withColumn("source_index", F.lit("telecom-noc-2024.01.01"))
    made = minutes(spark, "h", [(3, 20)]).withColumn("source_index", F.lit("telecom-noc-forecast-2024.01.01"))
    rows = dicts(panels.forecast_panel(ops.forecast_union(actual, made)))
    assert sorted(((r["key"] - BASE) // MINUTE, r["avg_utilization"], r["above_85"]) for r in rows if r["avg_utilization"]) == [
        (0, 90.0, True), (3, 10.0, False), (3, 20.0, False)]
    assert sum(r["source_index"] is None for r in rows) == 2


def test_a_run_knows_its_own_millisecond(spark):
    run = BASE + 10 * MINUTE
    events = event_rows(spark, [{"ms": BASE, "hostname": "h", "utilization_pct": 10}, {"ms": run + 0.5, "hostname": "h", "utilization_pct": 20},
                                {"ms": run + 1, "hostname": "h", "utilization_pct": 90}])
    first = ops.forecast_run(events, run).orderBy("timestamp").first()
    assert first["utilization_pct"] == 21
