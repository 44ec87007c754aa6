from dataclasses import replace

import numpy as np
import pytest
from conftest import dicts, event_rows
from pyspark.sql import functions as F

from netvigil.operators import detect, forest
from netvigil.schema import CRITICAL_SURGE, HOUR, MINUTE, UTILIZATION_SPIKE, ForestSettings
from netvigil.sources.adapter import telemetry

BASE = 1_704_067_200_000


def features(spark, detector, keys, entity="e"):
    rows = [(entity, BASE + k * detector.interval_ms, *[float(k * 10 + i) for i in range(len(detector.metrics))]) for k in keys]
    names = ", ".join(f"{m.name} double" for m in detector.metrics)
    return spark.createDataFrame(rows, f"entity string, key bigint, {names}")


def test_features_by_hand(spark):
    events = event_rows(spark, [
        {"ms": BASE, "hostname": "a", "utilization_pct": 10, "latency_ms": 4, "severity": "CRITICAL", "packet_loss_pct": 2},
        {"ms": BASE + 59_999, "hostname": "a", "utilization_pct": 20, "latency_ms": 6, "severity": "INFO"},
        {"ms": BASE + MINUTE, "hostname": "b", "utilization_pct": 5},
        {"ms": BASE + 3 * MINUTE},
    ])
    spike = {(r["entity"], (r["key"] - BASE) // MINUTE): tuple(r)[2:] for r in detect.detector_features(events, UTILIZATION_SPIKE).collect()}
    assert spike == {("a", 0): (15.0, 20.0, 5.0), ("b", 1): (5.0, 5.0, None)}
    surge = {(r["key"] - BASE) // MINUTE: tuple(r)[2:] for r in detect.detector_features(events, CRITICAL_SURGE).collect()}
    assert surge == {0: (1, 2.0), 2: (0, None)}


def test_window_delay(spark):
    events = event_rows(spark, [{"ms": BASE + m * MINUTE, "hostname": "a", "utilization_pct": 1, "latency_ms": 1} for m in range(5)])
    closed = detect.detector_features(events, UTILIZATION_SPIKE, as_of=BASE + 4 * MINUTE)
    assert sorted((r["key"] - BASE) // MINUTE for r in closed.collect()) == [0, 1, 2]


def test_forecast_rows_are_left_out_unless_asked(spark):
    event = [{"ms": BASE, "hostname": "a", "utilization_pct": 100, "latency_ms": 1}]
    both = event_rows(spark, event).withColumn("source_index", F.lit("telecom-noc-2024.01.01")).unionByName(
        event_rows(spark, [{**event[0], "utilization_pct": 0}]).withColumn("source_index", F.lit("telecom-noc-forecast-2024.01.01")))
    assert detect.detector_features(both, UTILIZATION_SPIKE).first()["avg_utilization"] == 100
    assert detect.detector_features(both, UTILIZATION_SPIKE, include_forecast=True).first()["avg_utilization"] == 50


@pytest.mark.parametrize("chunk", [8, 10, 1440])
def test_shingles_need_an_unbroken_run(spark, chunk):
    keys = [*range(0, 12), *range(13, 30), 40]
    found = {r["key"]: r["shingle"] for r in detect.shingles(features(spark, CRITICAL_SURGE, keys), CRITICAL_SURGE, chunk).collect()}
    ends = [k for k in keys if all(k - j in keys for j in range(4))]
    assert sorted(found) == [BASE + k * 2 * MINUTE for k in ends]
    assert found[BASE + 6 * MINUTE] == [0, 1, 10, 11, 20, 21, 30, 31]


def test_a_missing_feature_breaks_the_run(spark):
    rows = features(spark, CRITICAL_SURGE, range(8)).withColumn(
        "avg_packet_loss", F.when(F.col("key") != BASE + 8 * MINUTE, F.col("avg_packet_loss")))
    assert sorted((r["key"] - BASE) // (2 * MINUTE) for r in detect.shingles(rows, CRITICAL_SURGE).collect()) == [3]


def test_trees_partition_their_points():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(4, 50, 3))
    points[:, :5] = points[:, 5:10]
    trees = forest.grow(points, rng)
    inner = np.flatnonzero(trees["left"] >= 0)
    left = trees["left"][inner]
    assert (trees["size"][left] + trees["size"][left + 1] == trees["size"][inner]).all()
    assert (trees["size"] > 0).all() and (trees["size"][:4] == 50).all()
    axis, cut = trees["axis"][inner], trees["cut"][inner]
    assert (trees["high"][left, axis] <= cut).all() and (trees["low"][left + 1, axis] > cut).all()
    leaves = np.flatnonzero(trees["left"] < 0)
    assert (trees["low"][leaves] == trees["high"][leaves]).all()
    assert trees["size"][leaves].sum() == 200


def test_a_far_point_displaces_the_whole_sample():
    rng = np.random.default_rng(1)
    trees = forest.grow(rng.normal(size=(20, 100, 2)), rng)
    near, far = np.zeros((1, 2)), np.full((1, 2), 1000.0)
    queries = np.concatenate([near, far])
    scores = forest.displacement(trees, 20, queries, np.array([1, 2]), 9).mean(axis=0)
    assert scores[1] > 0.95 and scores[0] < 0.3
    alone = forest.displacement(trees, 20, far, np.array([2]), 9).mean()
    assert alone == scores[1]


def test_displacement_against_a_plain_walk():
    rng = np.random.default_rng(8)
    trees = forest.grow(rng.normal(size=(3, 40, 2)), rng)
    queries, keys = rng.normal(size=(6, 2)) * 2, np.arange(100, 106)
    fast = forest.displacement(trees, 3, queries, keys, 77)
    for t in range(3):
        for q in range(6):
            node, depth, best = t, 0, 0.0
            while True:
                low, high, x = trees["low"][node], trees["high"][node], queries[q]
                grown = np.maximum(high, x) - np.minimum(low, x)
                outside = grown.sum() - (high - low).sum()
                if forest._uniform(77, keys[q], t, depth)[0] * grown.sum() < outside - 1e-12:
                    best = max(best, trees["size"][node])
                    break
                if trees["left"][node] < 0:
                    break
                right = int(x[trees["axis"][node]] > trees["cut"][node])
                child, sibling = trees["left"][node] + right, trees["left"][node] + 1 - right
                best = max(best, trees["size"][sibling] / (trees["size"][child] + 1))
                node, depth = child, depth + 1
            assert abs(fast[t, q] - best / 40) < 1e-12


def scores_of(frame):
    return {(r["entity"], r["key"]): r["anomaly_score"] for r in frame.collect()}


@pytest.fixture(scope="module")
def surge(spark, sf_dir):
    rows = detect.detector_features(telemetry(spark, sf_dir), CRITICAL_SURGE)
    return spark.createDataFrame(rows.collect(), rows.schema)


def test_scores_depend_on_neither_partitions_nor_chunks(spark, surge):
    shingled = detect.shingles(surge, CRITICAL_SURGE)
    scores = scores_of(detect.rcf_score(shingled, CRITICAL_SURGE))
    assert scores_of(detect.rcf_score(shingled.repartition(13), CRITICAL_SURGE, partitions=3)) == scores
    small = replace(detect.FOREST, chunk=32)
    assert scores_of(detect.rcf_score(shingled, CRITICAL_SURGE, small)) == scores


def test_scores_look_at_the_past_only(spark, surge):
    end = BASE + 5 * HOUR + 14 * MINUTE
    scores = scores_of(detect.rcf_score(detect.shingles(surge, CRITICAL_SURGE), CRITICAL_SURGE))
    early = surge.where(F.col("key") < end)
    assert scores_of(detect.rcf_score(detect.shingles(early, CRITICAL_SURGE), CRITICAL_SURGE)) == {
        k: v for k, v in scores.items() if k[1] < end}


def test_first_burst_stands_out(spark, surge):
    graded = detect.anomaly_grade(detect.rcf_score(detect.shingles(surge, CRITICAL_SURGE), CRITICAL_SURGE), CRITICAL_SURGE)
    rows = [r for r in dicts(graded) if r["anomaly_score"] is not None]
    minute = {r["key"]: (r["key"] - BASE) // MINUTE for r in rows}
    burst = [r for r in rows if 50 <= minute[r["key"]] < 55]
    ordinary = [r for r in rows if minute[r["key"]] % 60 < 44]
    mean = lambda values, name: sum(v[name] for v in values) / len(values)
    assert mean(burst, "anomaly_score") > 3 * mean(ordinary, "anomaly_score")
    assert max(r["anomaly_grade"] for r in burst) == 1.0
    assert all(0 <= r["anomaly_grade"] <= 1 for r in rows)
    assert sum(r["anomaly_grade"] > 0 for r in ordinary) < 0.05 * len(ordinary)


def test_grades_of_even_scores(spark):
    """Nothing stands out of even scores after a warm-up, whatever its length; a burst does, and hides no second one."""
    scores = [None] * 20 + [0.2 + 0.004 * (i % 5) / 4 for i in range(100)]
    scores[60:64] = scores[80:84] = [0.9] * 4
    rows = [("e", BASE + i * 2 * MINUTE, s) for i, s in enumerate(scores)]
    graded = detect.anomaly_grade(spark.createDataFrame(rows, "entity string, key bigint, anomaly_score double"), CRITICAL_SURGE)
    grades = [r["anomaly_grade"] for r in graded.orderBy("key").collect()]
    assert grades == [None] * 20 + [1.0 if 60 <= i < 64 or 80 <= i < 84 else 0.0 for i in range(20, 120)]


def test_every_burst_is_graded(spark, surge):
    scores = detect.rcf_score(detect.shingles(surge, CRITICAL_SURGE), CRITICAL_SURGE)
    rows = dicts(detect.anomaly_grade(scores, CRITICAL_SURGE))
    graded = {(r["key"] - BASE) // MINUTE for r in rows if r["anomaly_grade"]}
    hours = {m // 60 for m in graded if 50 <= m % 60 < 62}
    # Bursts enter the history that later ones are scored against: 6 of the 12 hourly ones are graded.
    assert len(hours) >= 6, sorted(graded)


def test_a_hot_entity_is_split(spark):
    settings = ForestSettings(trees=4, tree_blocks=2, sample=32, history=64, refresh=16, chunk=64)
    hot = features(spark, CRITICAL_SURGE, range(400), "hot")
    shingled = detect.shingles(hot, CRITICAL_SURGE, chunk_windows=64)
    assert len(scores_of(detect.rcf_score(shingled, CRITICAL_SURGE, settings))) == 397
    with pytest.raises(ValueError):
        detect.rcf_score(shingled, CRITICAL_SURGE, replace(settings, trees=5))


def test_helpers_travel_without_the_package(tmp_path):
    """Executors that lack this package can run the functions sent to them."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from netvigil.streaming import state

    sent = (forest.score_group, state.throttler(MINUTE), state.window_scorer(
        forest.score_windows, ["a"], 2, MINUTE, 1, 1.0, trees=1, sample=4, history=8, refresh=4, warmup=2))
    (tmp_path / "functions").write_bytes(cloudpickle.dumps(sent))
    code = "import pickle,sys; pickle.load(open('functions','rb')); assert 'netvigil' not in sys.modules; print('loaded')"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "loaded", done.stderr


def test_windows_travel_as_features_or_as_shingles(spark, surge):
    by_shingle = scores_of(detect.rcf_score(detect.shingles(surge, CRITICAL_SURGE), CRITICAL_SURGE))
    assert scores_of(detect.score_features(surge, CRITICAL_SURGE)) == by_shingle
    small = replace(detect.FOREST, chunk=48)
    assert scores_of(detect.score_features(surge, CRITICAL_SURGE, small, partitions=5)) == by_shingle


def test_samples_hold_the_whole_past_evenly_and_merge():
    keys = np.arange(20_000, dtype=np.int64) * MINUTE
    points = np.arange(20_000, dtype=float)[:, None]
    whole, _ = forest.drawn(keys, points, 256, ("e", 1))
    assert len(whole) == 256 and (np.diff(whole) > 0).all()
    # A window older than 1,024 before the end is as likely as any: the sample spreads over the record.
    thirds = np.histogram(whole / MINUTE, bins=4, range=(0, 20_000))[0]
    assert thirds.min() > 40
    parts = [forest.drawn(keys[a:a + 3000], points[a:a + 3000], 256, ("e", 1)) for a in range(0, 20_000, 3000)]
    merged = forest.drawn(np.concatenate([k for k, _ in parts]), np.concatenate([p for _, p in parts]), 256, ("e", 1))
    assert (merged[0] == whole).all() and (merged[1][:, 0] == whole / MINUTE).all()
    assert (forest.drawn(keys, points, 256, ("e", 2))[0] != whole).any()


def test_long_records_equal_one_walk(spark):
    """Chunks and the samples carried between them give what a single pass over the record gives."""
    settings = ForestSettings(trees=4, tree_blocks=2, sample=32, refresh=16, chunk=64)
    rng = np.random.default_rng(2)
    kept = [i for i in range(2500) if i % 501 != 500]
    rows = [("hot", BASE + i * 2 * MINUTE, float(rng.integers(9)), float(rng.normal())) for i in kept]
    frame = spark.createDataFrame(rows, "entity string, key bigint, critical_count double, avg_packet_loss double")
    found = scores_of(detect.score_features(frame, CRITICAL_SURGE, settings))
    keys = np.array([r[1] for r in rows])
    at, shingles = forest.shingle_rows(keys, np.array([r[2:] for r in rows]), 4, 2 * MINUTE)
    total = sum(forest.score_after(
        at, shingles, np.ones(len(at), dtype=bool), ("hot", block), (np.empty(0, np.int64), np.empty((0, 8))), 2 * MINUTE,
        trees=2, sample=32, refresh=16, warmup=8) for block in range(2))
    assert len(found) == len(at)
    for key, units in zip(at.tolist(), total.tolist()):
        assert found["hot", key] == (units / (4 * forest.SCORE_UNIT) if units >= 0 else None)


def test_bursts_that_are_graded(spark, surge):
    """Of the 12 hourly bursts more than half are graded, and little else is."""
    scores = detect.score_features(surge, CRITICAL_SURGE)
    rows = dicts(detect.anomaly_grade(scores, CRITICAL_SURGE))
    minutes = [(r["key"] - BASE) // MINUTE for r in rows if r["anomaly_grade"]]
    # A shingle of four windows still holds the burst six minutes after it.
    burst = {m // 60 for m in minutes if m % 60 >= 48} | {m // 60 - 1 for m in minutes if m % 60 < 2}
    other = [m for m in minutes if 2 <= m % 60 < 48]
    print("bursts", len(burst), "of 12; other windows", len(other), "of", len(rows))
    assert len(burst) > 6 and len(other) <= 0.05 * len(rows)


def test_trees_are_kept_while_their_sample_stays(monkeypatch):
    grown = []
    real = forest.grow
    monkeypatch.setattr(forest, "grow", lambda points, rng: grown.append(len(points)) or real(points, rng))
    rng = np.random.default_rng(3)
    keys = np.arange(4000, dtype=np.int64) * MINUTE
    points = rng.normal(size=(4000, 2))
    empty = np.empty(0, np.int64), np.empty((0, 2))
    options = dict(interval=MINUTE, trees=2, sample=16, refresh=16, warmup=8)
    whole = forest.score_after(keys, points, np.ones(4000, dtype=bool), ("e", 0), empty, **options)
    assert len(grown) < 120 and (whole[16:] >= 0).all()
    # In pieces, as micro-batches come: the same scores, whatever is grown again.
    for cut in (1600, 1607):
        held = forest.drawn(keys[:1600], points[:1600], 16, ("e", 0))
        wanted = keys[1600:] >= cut * MINUTE
        again = forest.score_after(keys[1600:], points[1600:], wanted, ("e", 0), held, **options)
        assert (again[wanted] == whole[1600:][wanted]).all()


def test_the_new_helpers_travel_too(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from netvigil.operators import holding
    from netvigil.streaming import state

    sent = (
        forest.score_chunk, forest.sampled_chunk, forest.samples_before, holding.stretch(["m"], 1, 2), holding.walk(["m"], 1),
        holding.send(["m"], 2), state.grader(["x"], 1, 2, 1.0, 3, 2, 0.1),
        state.past_scorer(["x"], 1, MINUTE, 1, 1.0, False, trees=2, sample=16, refresh=4, warmup=2),
    )
    (tmp_path / "functions").write_bytes(cloudpickle.dumps(sent))
    code = """
import pickle, sys
import pandas as pd
score, *_, grade, past = pickle.load(open('functions', 'rb'))
class Kept:
    exists, get = False, None
    def update(self, value): self.exists, self.get = True, value
rows = pd.DataFrame({'entity': ['e'] * 40, 'key': [60000 * i for i in range(40)], 'x': [float(i % 7) for i in range(40)]})
made = pd.concat(list(past(('e',), [rows], Kept())))
assert len(made) == 40 and made['anomaly_score'].notna().sum() == 36
assert 'netvigil' not in sys.modules
print('loaded')
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "loaded", done.stderr
