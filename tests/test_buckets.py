import random

from conftest import dicts, event_rows
from pyspark.sql import functions as F

from netvigil.functions.metrics import mean
from netvigil.operators import buckets
from netvigil.operators.chunks import overlapping_chunks, running_total
from netvigil.plans import panels
from netvigil.schema import DAY, MINUTE

BASE = 1_704_067_200_000


def count():
    return F.count("*").alias("count")


def util():
    return mean("utilization_pct").alias("avg")


def hosts(spark, counts, ms=BASE):
    return event_rows(spark, [{"ms": ms, "hostname": h, "region": h} for h, n in counts.items() for _ in range(n)])


def test_terms_topn_ties_and_nulls(spark):
    events = hosts(spark, {"b": 2, "a": 2, "c": 3, None: 5})
    rows = [(r["hostname"], r["count"]) for r in buckets.terms_topn(events, "hostname", [count()], "count", 2).collect()]
    assert rows == [("c", 3), ("a", 2)]


def test_other_bucket(spark):
    rows = {r["region"]: (r["count"], r["share"]) for r in buckets.terms_other(hosts(spark, {"a": 3, "b": 2, "c": 1, None: 9}), "region", 1).collect()}
    assert rows == {"a": (3, 0.5), "Outras": (3, 0.5)}
    rows = {r["region"]: r["count"] for r in buckets.terms_other(hosts(spark, {"a": 3, "b": 2}), "region", 10).collect()}
    assert rows == {"a": 3, "b": 2}
    assert buckets.terms_other(hosts(spark, {None: 2}), "region", 3).count() == 0


def test_top_is_chosen_per_bucket(spark):
    rows = [{"ms": BASE, "hostname": h, "utilization_pct": v} for h, v in (("a", 2), ("b", 1), ("c", 3))]
    rows += [{"ms": BASE + MINUTE, "hostname": h, "utilization_pct": v} for h, v in (("a", 1), ("b", 9), ("c", 3))]
    top = buckets.date_then_terms_topn(event_rows(spark, rows), "hostname", MINUTE, [util()], "avg", 2)
    found = sorted((r["key"], -r["avg"], r["hostname"]) for r in top.collect())
    assert [f[2] for f in found] == ["c", "a", "b", "c"]


def test_gap_fill(spark):
    events = event_rows(spark, [{"ms": BASE, "utilization_pct": 1}, {"ms": BASE + 5 * MINUTE + 59_999, "utilization_pct": 2}])
    rows = sorted(dicts(buckets.date_histogram_gapfill(events, MINUTE, [util()])), key=lambda r: r["key"])
    assert [r["count"] for r in rows] == [1, 0, 0, 0, 0, 1]
    assert [r["avg"] for r in rows] == [1.0, None, None, None, None, 2.0]


def test_gap_fill_over_days_and_of_nothing(spark):
    span = 2 * DAY + 3 * MINUTE
    events = event_rows(spark, [{"ms": BASE + 7 * MINUTE}, {"ms": BASE + 7 * MINUTE + span}])
    keys = sorted(r["key"] for r in buckets.date_histogram_gapfill(events, MINUTE, []).collect())
    assert keys == list(range(BASE + 7 * MINUTE, BASE + 7 * MINUTE + span + 1, MINUTE))
    assert buckets.date_histogram_gapfill(events.where("hostname = 'none'"), MINUTE, []).count() == 0


def test_numeric_histogram(spark):
    events = event_rows(spark, [{"ms": BASE, "latency_ms": v} for v in (24.99, 25, 49.9, None)])
    assert {r["bucket"]: r["count"] for r in buckets.numeric_histogram(events, "latency_ms", 25).collect()} == {0.0: 1, 25.0: 2}


def test_totals_row_sums_averages(spark):
    shown = spark.createDataFrame([("a", 2, 10.0), ("b", 3, 20.0)], "hostname string, count bigint, avg double")
    rows = {r["hostname"]: r for r in buckets.with_totals_row(shown, "hostname", ["count", "avg"]).collect()}
    assert (rows[None]["is_total"], rows[None]["count"], rows[None]["avg"]) == (1, 5, 30.0)
    assert (rows["a"]["is_total"], rows["a"]["avg"]) == (0, 10.0)


def test_terms_then_date_keeps_biggest_terms(spark):
    rows = [{"ms": BASE + i * MINUTE, "hostname": "many"} for i in range(3)] + [{"ms": BASE, "hostname": "few"}]
    kept = buckets.terms_then_date(event_rows(spark, rows), "hostname", MINUTE, [util()], 1)
    assert {r["hostname"] for r in kept.collect()} == {"many"} and kept.count() == 3


def test_automatic_interval(spark):
    for span, step in ((99_000, 1000), (100_001, 5000), (12 * 3_600_000, 600_000), (DAY * 365 * 20, 90 * DAY)):
        events = event_rows(spark, [{"ms": BASE}, {"ms": BASE + span}])
        assert spark.range(1).select(buckets.auto_interval(events)).first()[0] == step == buckets.interval_for(span)


def test_geohash_grid_skips_unlocated(spark):
    events = event_rows(spark, [{"ms": BASE, "location": (-23.5505, -46.6333)}, {"ms": BASE, "location": (-25.4284, -49.2733)}, {"ms": BASE}])
    cells = dicts(buckets.geohash_grid(events, 2))
    assert len(cells) == 1 and cells[0]["count"] == 2
    assert abs(cells[0]["lat"] + 24.48945) < 1e-9 and abs(cells[0]["lon"] + 47.9533) < 1e-9


def test_panels_take_a_closed_time_range(spark):
    events = event_rows(spark, [{"ms": BASE + i * MINUTE, "severity": "CRITICAL", "utilization_pct": 50} for i in range(5)])
    assert panels.ingest_volume(events, BASE + MINUTE, BASE + 3 * MINUTE).first()["docs"] == 3
    assert panels.critical_count(events).first().asDict() == {"critical_events": 5, "band": 1}
    trend = panels.severity_timeline(events, BASE, BASE + 4 * MINUTE)
    assert trend.agg(F.sum("count")).first()[0] == 5


def test_chunks_give_every_lookback_row(spark):
    rows = spark.createDataFrame([("e", k) for k in range(0, 400, 10)], "entity string, key bigint")
    chunked = overlapping_chunks(rows, "key", 100, 30)
    own = chunked.where("not carried")
    assert own.count() == rows.count()
    carried = {(r["chunk"], r["key"]) for r in chunked.where("carried").collect()}
    assert carried == {(c, k) for c in (100, 200, 300, 400) for k in range(c - 30, c, 10) if k < 400}


def test_running_total_any_chunk_width(spark):
    rows = spark.createDataFrame([(i * 3, i % 7) for i in range(500)], "k bigint, v bigint")
    wanted, total = {}, 0
    for i in range(500):
        total += i % 7
        wanted[i * 3] = total
    for width in (2, 16, 100_000):
        summed = running_total(rows, "k", {"t": "v"}, width)
        assert {r["k"]: r["t"] for r in summed.collect()} == wanted


def test_newest_documents(spark):
    rng = random.Random(6)
    rows = [{"ms": BASE + rng.randrange(30_000), "hostname": f"h{i}"} for i in range(400)] + [{"hostname": "timeless"}]
    events = event_rows(spark, rows).withColumn("event_id", F.xxhash64("hostname"))
    wanted = sorted(dicts(events.where("timestamp is not null")), key=lambda r: r["event_id"])
    wanted.sort(key=lambda r: r["timestamp"], reverse=True)
    for limit in (1, 7, 100, 400, 1000):
        assert dicts(panels.discover(events, limit=limit)) == wanted[:limit]


def test_automatic_interval_counts_aligned_buckets(spark):
    for first, span in ((30_000, 6_000_000), (30_000, 5_999_999), (0, 5_999_999), (5, 400 * 365 * 86_400_000)):
        step = spark.range(1).select(buckets._step(F.lit(first).cast("long"), F.lit(first + span).cast("long"), 100)).first()[0]
        assert (first + span) // step - first // step + 1 <= 100


def test_known_bounds_give_the_same_interval(spark):
    from netvigil.operators import buckets

    for first, span in ((0, 0), (999, 1), (5_000, 99_000), (5_001, 100_000), (1, 86_400_000), (7, 30 * 86_400_000), (3, 4 * 10**12)):
        rows = event_rows(spark, [{"ms": first}, {"ms": first + span}])
        found = rows.agg(F.max(F.lit(1))).select(buckets.auto_interval(rows)).first()[0]
        assert buckets.interval_between(first, first + span) == found
