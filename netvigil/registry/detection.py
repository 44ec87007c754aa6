"""Detector features, shingles, scores and grades."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from netvigil.operators import detect
from netvigil.registry.common import HOUR, LATENCY, LOSS, START_MS, UTIL, register
from netvigil.schema import CRITICAL_SURGE, DETECTORS, UTILIZATION_SPIKE, Detector
from netvigil.sources.adapter import telemetry

HALFWAY = START_MS + 6 * HOUR + 30_000

SPIKE_SQL = f"""
, spike AS (SELECT hostname AS entity, ts_ms - ts_ms % 60000 AS key, {UTIL} AS avg_utilization,
  CAST(max(utilization_pct) AS DOUBLE) AS max_utilization, {LATENCY} AS avg_latency FROM ev GROUP BY 1, 2)
, spike_full AS (SELECT entity, key FROM spike
  QUALIFY lag(key, 7) OVER (PARTITION BY entity ORDER BY key) = key - 420000)
"""
SURGE_SQL = f"""
, surge AS (SELECT 'all' AS entity, ts_ms - ts_ms % 120000 AS key,
  count(*) FILTER (severity = 'CRITICAL') AS critical_count, {LOSS} AS avg_packet_loss FROM ev GROUP BY 1, 2)
, surge_full AS (SELECT entity, key FROM surge
  QUALIFY lag(key, 3) OVER (PARTITION BY entity ORDER BY key) = key - 360000)
"""


@register("detector_util_features", SPIKE_SQL + "SELECT * FROM spike")
def detector_util_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.detector_features(telemetry(spark, sf_dir), UTILIZATION_SPIKE)


@register("detector_critical_features", SURGE_SQL + "SELECT * FROM surge")
def detector_critical_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.detector_features(telemetry(spark, sf_dir), CRITICAL_SURGE)


def _positions(shingled: DataFrame, detector: Detector) -> DataFrame:
    """A row per window of each shingle, features side by side."""
    width = len(detector.metrics)
    windows = F.expr(f"transform(sequence(0, {detector.shingle - 1}), i -> slice(shingle, i * {width} + 1, {width}))")
    rows = shingled.select("entity", "key", F.posexplode(windows).alias("position", "window"))
    features = [F.get("window", i).alias(m.name) for i, m in enumerate(detector.metrics)]
    return rows.select("entity", "key", "position", *features)


@register(
    "shingle",
    SPIKE_SQL + """SELECT f.entity, f.key, CAST(i AS INTEGER) AS position, avg_utilization, max_utilization, avg_latency
FROM spike_full f, range(8) AS steps(i) JOIN spike s ON s.entity = f.entity AND s.key = f.key - (7 - i) * 60000""",
)
def shingle(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = detect.detector_features(telemetry(spark, sf_dir), UTILIZATION_SPIKE)
    return _positions(detect.shingles(features, UTILIZATION_SPIKE), UTILIZATION_SPIKE)


@register(
    "shingle_critical",
    SURGE_SQL + """SELECT f.entity, f.key, CAST(i AS INTEGER) AS position, CAST(critical_count AS DOUBLE) AS critical_count,
  avg_packet_loss
FROM surge_full f, range(4) AS steps(i) JOIN surge s ON s.entity = f.entity AND s.key = f.key - (3 - i) * 120000""",
)
def shingle_critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = detect.detector_features(telemetry(spark, sf_dir), CRITICAL_SURGE)
    return _positions(detect.shingles(features, CRITICAL_SURGE), CRITICAL_SURGE)


def _scores(spark: SparkSession, sf_dir: str, detector: Detector) -> DataFrame:
    features = detect.detector_features(telemetry(spark, sf_dir), detector)
    return detect.score_features(features, detector)


def scored_sql(full: str, detector: Detector) -> str:
    """CTE ``scored``: entity, key and whether enough shingles lie before the window's stretch."""
    span = detect.FOREST.refresh * detector.interval_ms
    return f"""
, {full}_scored AS (SELECT f.entity, f.key, count(p.key) >= {detect.FOREST.warmup} AS scored
  FROM {full} f LEFT JOIN {full} p ON p.entity = f.entity
    AND p.key < f.key - f.key % {span}
  GROUP BY 1, 2)
"""


SPIKE_SCORED = SPIKE_SQL + scored_sql("spike_full", UTILIZATION_SPIKE)
SURGE_SCORED = SURGE_SQL + scored_sql("surge_full", CRITICAL_SURGE)


def in_range(column: str):
    """SQL cannot draw the trees: a result tells which windows have a value, and that it lies in [0, 1]."""
    value = F.col(column)
    return [value.isNotNull().alias("scored"), F.coalesce(value.between(0, 1), F.lit(True)).alias("in_range")]


@register("rcf_score", SPIKE_SCORED + "SELECT *, true AS in_range FROM spike_full_scored")
def rcf_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir, UTILIZATION_SPIKE).select("entity", "key", *in_range("anomaly_score"))


@register("rcf_score_critical", SURGE_SCORED + "SELECT *, true AS in_range FROM surge_full_scored")
def rcf_score_critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir, CRITICAL_SURGE).select("entity", "key", *in_range("anomaly_score"))


@register(
    "anomaly_grade",
    SPIKE_SCORED + SURGE_SCORED + """SELECT 'noc-utilization-spike' AS detector, *, true AS in_range FROM spike_full_scored
UNION ALL SELECT 'noc-critical-surge', *, true FROM surge_full_scored""",
)
def anomaly_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = [
        detect.anomaly_grade(_scores(spark, sf_dir, d), d).select(
            F.lit(d.name).alias("detector"), "entity", "key", *in_range("anomaly_grade")
        ) for d in DETECTORS
    ]
    return graded[0].unionByName(graded[1])


@register(
    "anomaly_grade_latency",
    SPIKE_SQL + f"""
, past AS (SELECT entity, key, avg_latency AS score, list(avg_latency) OVER (PARTITION BY entity ORDER BY key
    RANGE BETWEEN {detect.GRADE_WINDOWS * 60000} PRECEDING AND 60000 PRECEDING) AS scores FROM spike)
, known AS (SELECT entity, key, score, list_filter(coalesce(scores, []), lambda s: s IS NOT NULL) AS scores FROM past)
, middle AS (SELECT *, list_aggregate(scores, 'median') AS median FROM known)
, deviation AS (SELECT *, greatest(
    list_aggregate(list_transform(scores, lambda s: abs(s - median)), 'median') * CAST(1.4826 AS DOUBLE),
    median * CAST({detect.LEAST_SPREAD} AS DOUBLE)) AS spread FROM middle)
SELECT entity, key, CASE WHEN score IS NULL THEN NULL WHEN len(scores) < {detect.LEAST_SCORES} OR spread = 0 THEN 0.0::DOUBLE
  ELSE round(least(greatest(((score - median) / spread - 3) / 3, 0), 1), 9) END AS anomaly_grade FROM deviation""",
)
def anomaly_grade_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grade of a value that SQL can compute."""
    features = detect.detector_features(telemetry(spark, sf_dir), UTILIZATION_SPIKE)
    scores = features.select("entity", "key", F.col("avg_latency").cast("double").alias("anomaly_score"))
    graded = detect.anomaly_grade(scores, UTILIZATION_SPIKE)
    return graded.select("entity", "key", F.round("anomaly_grade", 9).alias("anomaly_grade"))


@register(
    "detector_window_delay",
    SPIKE_SQL + f"SELECT * FROM spike WHERE key + 60000 <= {HALFWAY} - 60000",
)
def detector_window_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.detector_features(telemetry(spark, sf_dir), UTILIZATION_SPIKE, as_of=HALFWAY)
