"""Anomaly detection: features per window, shingles, random-cut-forest scores and grades."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from netvigil.functions.metrics import aggregates, clamp
from netvigil.functions.predicates import not_from
from netvigil.functions.times import to_ms
from netvigil.operators import forest
from netvigil.operators.buckets import with_date_bucket
from netvigil.operators.chunks import overlapping_chunks
from netvigil.schema import Detector, ForestSettings

FOREST = ForestSettings()
WHOLE_STREAM = "all"
GRADE_WINDOWS = 120
# A grade needs so many earlier scores; their deviation counts as this share of their median at least.
LEAST_SCORES, LEAST_SPREAD = 5, 0.05


def entity_of(detector: Detector) -> Column:
    return F.col(detector.category) if detector.category else F.lit(WHOLE_STREAM)


def detector_features(
    events: DataFrame,
    detector: Detector,
    as_of: datetime | int | None = None,
    include_forecast: bool = False,
) -> DataFrame:
    """One row per entity and window that has rows: ``entity``, ``key`` (window start) and the features.

    With ``as_of``, only windows that had closed, delay included, by then.
    """
    if not include_forecast and "source_index" in events.columns:
        events = events.where(not_from("forecast"))
    if detector.category:
        events = events.where(F.col(detector.category).isNotNull())
    windows = with_date_bucket(events, detector.interval_ms).groupBy(entity_of(detector).alias("entity"), "key")
    features = windows.agg(*aggregates(detector.metrics))
    return features if as_of is None else closed_windows(features, detector, as_of)


def closed_windows(features: DataFrame, detector: Detector, as_of: datetime | int | Column) -> DataFrame:
    """Windows whose end lies at least the delay before ``as_of``."""
    now = as_of if isinstance(as_of, Column) else F.lit(to_ms(as_of))
    return features.where(F.col("key") + F.lit(detector.interval_ms) <= now - F.lit(detector.delay_ms))


def shingles(features: DataFrame, detector: Detector, chunk_windows: int = 1440) -> DataFrame:
    """Feature vectors of the last k windows, oldest first, for windows whose k-1 predecessors exist.

    Windows in which a feature has no value break the run. Histories are cut into chunks of
    ``chunk_windows`` that overlap by k-1 windows.
    """
    k, step = detector.shingle, detector.interval_ms
    names = [m.name for m in detector.metrics]
    complete = features.where(" and ".join(f"{name} is not null" for name in names))
    vectors = complete.select("entity", "key", F.array(*[F.col(n).cast("double") for n in names]).alias("vector"))
    chunked = overlapping_chunks(vectors, "key", chunk_windows * step, (k - 1) * step)
    ordered = Window.partitionBy("entity", "chunk").orderBy("key")
    looked = chunked.select(
        "entity",
        "key",
        "carried",
        F.flatten(F.collect_list("vector").over(ordered.rowsBetween(-(k - 1), 0))).alias("shingle"),
        (F.lag("key", k - 1).over(ordered) if k > 1 else F.col("key")).alias("_oldest"),
    )
    unbroken = F.col("_oldest") == F.col("key") - F.lit((k - 1) * step)
    return looked.where(unbroken & ~F.col("carried")).select("entity", "key", "shingle")


def _unit(settings: ForestSettings) -> None:
    if settings.trees % settings.tree_blocks or settings.chunk % settings.refresh:
        raise ValueError("trees must divide into tree_blocks, chunk into refresh windows")


def rcf_score(
    shingled: DataFrame, detector: Detector, settings: ForestSettings = FOREST, partitions: int | None = None
) -> DataFrame:
    """Mean displacement of every shingle in a forest over its entity's past: ``anomaly_score``, null in the warm-up."""
    _unit(settings)
    if settings.history is None:
        vectors = shingled.select("entity", "key", F.col("shingle").alias("vector"))
        return _scores_after_all(vectors, 1, detector, settings, partitions)
    return _recent_scores(shingled, detector, settings, partitions)


def score_features(
    features: DataFrame, detector: Detector, settings: ForestSettings = FOREST, partitions: int | None = None
) -> DataFrame:
    """``rcf_score`` of a detector's features: windows travel as they are and become shingles where they are scored."""
    _unit(settings)
    if settings.history is not None:
        return _recent_scores(shingles(features, detector), detector, settings, partitions)
    names = [m.name for m in detector.metrics]
    complete = features.where(" and ".join(f"{name} is not null" for name in names))
    vectors = complete.select("entity", "key", F.array(*[F.col(n).cast("double") for n in names]).alias("vector"))
    return _scores_after_all(vectors, detector.shingle, detector, settings, partitions)


def _scores_after_all(
    vectors: DataFrame, size: int, detector: Detector, settings: ForestSettings, partitions: int | None
) -> DataFrame:
    """Scores against samples of the whole past.

    The unit of work is (entity, chunk of time, block of trees). Every chunk offers the windows of least priority to the
    samples of later chunks, ``sample`` of them for a block; a walk over these few rows gives each chunk the sample of all
    that lies before it. So a group holds a chunk and a sample however long a record is, and the walk ``sample`` rows
    for each chunk.
    """
    step, sample = detector.interval_ms, settings.sample
    options = dict(
        size=size, interval=step, trees=settings.trees // settings.tree_blocks, sample=sample,
        refresh=settings.refresh, warmup=settings.warmup,
    )
    blocks, score_chunk = settings.tree_blocks, forest.score_chunk
    sampled_chunk, samples_before = forest.sampled_chunk, forest.samples_before

    def offer(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return sampled_chunk(rows, str(group[0]), size, step, blocks, sample)

    def carry(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return samples_before(rows, str(group[0]), int(group[1]), sample)

    def score(group: tuple, rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({"entity": [], "key": [], "units": []}).astype({"key": "int64", "units": "Int64"})
        return score_chunk(rows, held, str(group[0]), int(group[2]), **options)

    if partitions is None:
        partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shape = "entity string, chunk bigint, block int, key bigint, point binary"
    work = overlapping_chunks(vectors, "key", settings.chunk * step, (size - 1) * step)
    offered = work.groupBy("entity", "chunk").applyInPandas(offer, shape)
    held = offered.groupBy("entity", "block").applyInPandas(carry, shape)
    unit = ["entity", "chunk", "block"]
    due = work.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    # The partition count is stated because the groups are small in bytes but not in work.
    parts = due.repartition(partitions, *unit).groupBy(*unit).cogroup(
        held.repartition(partitions, *unit).groupBy(*unit)
    ).applyInPandas(score, "entity string, key bigint, units bigint")
    scale = F.lit(float(forest.SCORE_UNIT * settings.trees))
    return parts.groupBy("entity", "key").agg((F.sum("units") / scale).alias("anomaly_score"))


def _recent_scores(
    shingled: DataFrame, detector: Detector, settings: ForestSettings, partitions: int | None
) -> DataFrame:
    """Scores against samples of the last ``settings.history`` windows: chunks overlap by them."""
    step = detector.interval_ms
    per_block = settings.trees // settings.tree_blocks
    options = dict(
        interval=step, trees=per_block, sample=settings.sample, history=settings.history,
        refresh=settings.refresh, warmup=settings.warmup,
    )

    score_group = forest.score_group

    def score(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return score_group(rows, str(group[0]), int(group[2]), **options)

    if partitions is None:
        partitions = int(shingled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lookback = (settings.history + settings.refresh) * step
    work = overlapping_chunks(shingled, "key", settings.chunk * step, lookback).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(settings.tree_blocks - 1)))
    )
    unit = ["entity", "chunk", "block"]
    parts = (
        work.repartition(partitions, *unit)
        .groupBy(*unit)
        .applyInPandas(score, "entity string, key bigint, units bigint")
    )
    scale = F.lit(float(forest.SCORE_UNIT * settings.trees))
    return parts.groupBy("entity", "key").agg((F.sum("units") / scale).alias("anomaly_score"))


def _middle(ordered: Column) -> Column:
    """Median of a sorted array."""
    at = lambda half: F.get(ordered, F.floor((F.size(ordered) + half) / 2).cast("int"))
    return (at(-1) + at(0)) / 2


def anomaly_grade(scores: DataFrame, detector: Detector, windows: int = GRADE_WINDOWS) -> DataFrame:
    """Adds ``anomaly_grade`` in [0, 1]: how far a score lies beyond 3 deviations of the recent ones.

    The deviation is estimated from the median distance to the median, so that anomalies do not hide the next ones;
    both medians are those of the same entity's scores in the previous ``windows`` windows of time. It
    counts as ``LEAST_SPREAD`` of the median at least; grade 1 is reached at 6 deviations. Fewer than ``LEAST_SCORES``
    earlier scores grade 0. Windows without a score have no grade and are nobody's past.
    """
    step = detector.interval_ms
    chunked = overlapping_chunks(scores, "key", 8 * windows * step, windows * step)
    recent = Window.partitionBy("entity", "chunk").orderBy("key").rangeBetween(-windows * step, -step)
    past = chunked.withColumn("_past", F.sort_array(F.collect_list("anomaly_score").over(recent)))
    past = past.where(~F.col("carried")).withColumn("_median", _middle(F.col("_past")))
    distances = F.array_sort(F.transform("_past", lambda s: F.abs(s - F.col("_median"))))
    spread = F.greatest(_middle(distances) * F.lit(1.4826), F.col("_median") * F.lit(LEAST_SPREAD))
    z = F.try_divide(F.col("anomaly_score") - F.col("_median"), spread)
    beyond = F.coalesce(clamp((z - 3) / 3, 0, 1), F.lit(0.0))
    grade = F.when(F.size("_past") < LEAST_SCORES, F.lit(0.0)).otherwise(beyond)
    graded = past.withColumn("anomaly_grade", F.when(F.col("anomaly_score").isNotNull(), grade))
    return graded.drop("chunk", "carried", "_past", "_median")


def detector_results(
    events: DataFrame,
    detector: Detector,
    settings: ForestSettings = FOREST,
    as_of: datetime | int | None = None,
) -> DataFrame:
    """Rows of a detector's result table: entity, window, features, score and grade."""
    features = detector_features(events, detector, as_of)
    scored = anomaly_grade(score_features(features, detector, settings), detector)
    return result_columns(features.join(scored, ["entity", "key"]), detector)


def result_columns(graded: DataFrame, detector: Detector) -> DataFrame:
    """The columns of a detector's result table."""
    start = F.col("key")
    return graded.select(
        F.lit(detector.name).alias("detector"),
        "entity",
        F.timestamp_millis(start).alias("data_start"),
        F.timestamp_millis(start + F.lit(detector.interval_ms)).alias("data_end"),
        *[m.name for m in detector.metrics],
        "anomaly_score",
        "anomaly_grade",
    )
