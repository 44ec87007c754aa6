"""Exact top-k by inner product: vectors in buckets of falling length, pruned by local cosine thresholds.

Vectors are ranked by length and cut into buckets; queries, a stated part of the rows, are cut into blocks in the
same order. Buckets are searched in rounds of doubling number, longest first, and after each round every query knows
the score that a new result must reach. A query enters a bucket only if its length times the bucket's largest
could reach it; lengths fall from bucket to bucket, so a block is sent to the first buckets of a round only, as far as any
of its queries needs. In the bucket that score is a cosine threshold: a high one prunes by the query's largest coordinate
(a candidate's direction must lie near the query's there), a low one by length. What is left is verified by exact
integer products.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from netvigil.llm.common import numbered
from netvigil.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Vectors of a bucket; ranks from which a block of queries is taken.
BUCKET, SPAN = 4096, 16_384
#: From this cosine threshold on a query prunes by coordinate.
STEEP = 0.6


def scaled(vector: Column, factor: int) -> Column:
    """floor(factor * x) of every component, or null for a vector that is null or holds null or non-finite values."""
    good = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(good, F.transform(vector, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("long")))


def needed(lengths: np.ndarray, least: np.ndarray) -> float:
    """The length that a bucket's longest vector must have for any of the queries to reach its score."""
    with np.errstate(divide="ignore", invalid="ignore"):
        each = (least - 1e-6) / (lengths * (1 + 1e-9))
    # A query of length zero reaches zero, with any vector.
    return float(np.where(lengths > 0, each, np.where(least <= 0, -np.inf, np.inf)).min()) * (1 - 1e-12)


def _packed(name: str):
    def rows(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["place"])
        matrix = np.array(own["vector"].tolist(), "<i8").reshape(len(own), int(key[1]))
        # Components travel in 16 bits where all of them fit.
        narrow = bool(matrix.size) and -(1 << 15) <= matrix.min() and matrix.max() < 1 << 15
        length, least = own["length"].to_numpy("<f8"), own["least"].fillna(-(1 << 62)).to_numpy("<i8")
        return pd.DataFrame({
            name: [int(key[0])], "dim": [int(key[1])], "ids": [own["vec_id"].to_numpy("<i8").tobytes()],
            "matrix": [matrix.astype("<i2").tobytes() if narrow else matrix.tobytes()], "narrow": [narrow],
            "lengths": [length.tobytes()], "least": [least.tobytes()], "top": [length.max()], "need": [needed(length, least)],
        })

    return rows


def _products(matrix: np.ndarray, queries: np.ndarray, safe: bool) -> np.ndarray:
    """Inner products, rows by queries, exact: in doubles where every sum stays below 2**53, else in Python integers."""
    if safe:
        return (matrix.astype(np.float64) @ queries.T.astype(np.float64)).astype(np.int64)
    whole = matrix.astype(object) @ queries.T.astype(object)
    return np.clip(whole, -(1 << 63) + 1, (1 << 63) - 1).astype(np.int64)


def search_bucket(
    k: int, ids: np.ndarray, matrix: np.ndarray, lengths: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
    query_lengths: np.ndarray, least: np.ndarray,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, vec_ids, scores): of the bucket's vectors (longest first) at most the k best that reach ``least``."""
    top = float(lengths[0]) if len(lengths) else 0.0
    # Lengths are doubles: a bound is let pass when it misses by rounding only.
    reach = query_lengths * top * (1 + 1e-9) + 1e-6
    safe = bool(len(queries)) and float(query_lengths.max(initial=0)) * top < 2.0**52
    active = np.flatnonzero(reach >= least)
    if not len(active):
        return
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(reach[active] > 0, least[active] / reach[active], -1.0)
        unit = np.where(lengths[:, None] > 0, matrix / lengths[:, None], 0.0)
    steep = (cosine >= STEEP) & safe
    for q, t in zip(active[steep].tolist(), cosine[steep].tolist()):
        own = queries[q] / query_lengths[q]
        focus = int(np.abs(own).argmax())
        slack = np.sqrt(max(0.0, (1 - t * t) * (1 - own[focus] ** 2))) + 1e-9
        # Within the angle of the threshold around the query a direction's part on the axis has these bounds; an axis
        # nearer to the query than that angle may be reached itself.
        along, centre = unit[:, focus] * np.sign(own[focus]), t * abs(own[focus])
        near = along >= centre - slack
        if t > abs(own[focus]):
            near &= along <= centre + slack
        rows = np.flatnonzero(near & (lengths * query_lengths[q] * (1 + 1e-9) + 1e-6 >= least[q]))
        scores = _products(matrix[rows], queries[q : q + 1], safe)[:, 0]
        yield (q, *_best(k, ids[rows], scores, query_ids[q], least[q]))
    flat = active[~steep]
    for at in range(0, len(flat), 128):
        some = flat[at : at + 128]
        with np.errstate(divide="ignore", invalid="ignore"):
            short = np.where(query_lengths[some] > 0, (least[some] - 1e-6) / (query_lengths[some] * (1 + 1e-9)), -np.inf)
        # Lengths fall, so a prefix of the bucket can reach the lowest of these thresholds.
        rows = int(np.searchsorted(-lengths, -short.min(), "right"))
        scores = _products(matrix[:rows], queries[some], safe)
        for column, q in enumerate(some.tolist()):
            yield (q, *_best(k, ids[:rows], scores[:, column], query_ids[q], least[q]))


def _best(k: int, ids: np.ndarray, scores: np.ndarray, own: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    keep = np.flatnonzero((scores >= least) & (ids != own))
    if len(keep) > k:
        bound = np.partition(scores[keep], len(keep) - k)[len(keep) - k]
        keep = keep[scores[keep] >= bound]
        keep = keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
    return ids[keep], scores[keep]


def _round(k: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                shape = lambda data, narrow: np.frombuffer(data, "<i2" if narrow else "<i8").astype("<i8").reshape(-1, int(row.dim))
                array = lambda data, kind="<i8": np.frombuffer(data, kind)
                ids, query_ids = array(row.ids), array(row.query_ids)
                matrix, queries = (
                    shape(m, narrow) if row.dim else np.zeros((n, 0), np.int64)
                    for m, narrow, n in ((row.matrix, row.narrow, len(ids)), (row.query_matrix, row.query_narrow, len(query_ids)))
                )
                found = list(search_bucket(
                    k, ids, matrix, array(row.lengths, "<f8"), query_ids, queries, array(row.query_lengths, "<f8"), array(row.query_least)
                ))
                if found:
                    yield pd.DataFrame({
                        "query_id": np.repeat(query_ids[[q for q, _, _ in found]], [len(v) for _, v, _ in found]),
                        "vec_id": np.concatenate([v for _, v, _ in found]), "score": np.concatenate([s for _, _, s in found]),
                    })

    return rows


def top_products(
    vectors: DataFrame, queries: Column, k: int = 20, factor: int = 64, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``queries`` selects the k largest inner products with other rows.

    Components are floor(factor * x) as integers; ties go to the smaller vec_id; a query with fewer than k other rows
    gets them all. Vectors that are null or hold null or non-finite components take no part, nor do rows without
    vec_id; vectors are compared with those of their own number of components only, an empty one scores 0 with others.
    Of rows that repeat a vec_id the one with the greatest vector counts, as a result names rows by it. Other columns are
    ignored; an empty table gives no rows. Scores beyond
    64 bits are held at the limit.
    """
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), scaled(F.col(vector), factor).alias("vector"), queries.alias("asks")
    ).where("vec_id IS NOT NULL AND vector IS NOT NULL")
    rows = rows.groupBy("vec_id").agg(F.max("vector").alias("vector"), F.max("asks").alias("asks"))
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = rows.withColumn("dim", F.size("vector")).withColumn("length", F.sqrt(square))
    ranked = stored(numbered(rows, [F.col("dim"), F.col("length").desc(), F.col("vec_id")], "place", "vectors"), "ranked")
    firsts = [(r[0], r[1], r[2]) for r in ranked.groupBy("dim").agg(F.min("place"), F.max("place")).collect()]
    spark = vectors.sparkSession
    if not firsts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # Each number of components starts buckets of its own; there are few.
    start = F.create_map(*[F.lit(x) for d, lo, _ in firsts for x in (d, lo)])[F.col("dim")]
    ranked = ranked.withColumn("in_dim", F.col("place") - start).withColumn("least", F.lit(None).cast("long"))
    kind = "dim int, ids binary, matrix binary, narrow boolean, lengths binary, least binary, top double, need double"
    buckets = stored(
        ranked.withColumn("bucket", F.floor(F.col("in_dim") / BUCKET)).groupBy("bucket", "dim")
        .applyInPandas(_packed("bucket"), f"bucket long, {kind}").drop("least", "need"), "buckets",
    )
    asking = stored(
        ranked.where("asks").withColumn("block", F.floor(F.col("in_dim") / SPAN))
        .select("block", "dim", "vec_id", "vector", "length", "place"), "queries",
    )
    best = spark.createDataFrame([], "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    count = max(hi - lo for _, lo, hi in firsts) // BUCKET + 1
    lo, step = 0, 1
    while lo < count:
        hi = min(count, lo + step)
        limits = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        limits = limits.where(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), "least")
        blocks = asking.join(limits, "vec_id", "left").groupBy("block", "dim")
        blocks = blocks.applyInPandas(_packed("block"), f"block long, {kind}").toDF(
            "block", "dim", "query_ids", "query_matrix", "query_narrow", "query_lengths", "query_least", "query_top", "need"
        )
        due = buckets.where(F.col("bucket").between(lo, hi - 1))
        # One number for each bucket of the round, longest first.
        tops = due.groupBy("dim").agg(F.sort_array(F.collect_list("top"), asc=False).alias("tops"))
        reached = F.size(F.filter("tops", lambda top: top >= F.col("need")))
        pairs = blocks.join(tops, "dim").withColumn("reached", reached).where("reached > 0").drop("tops")
        pairs = pairs.withColumn("bucket", F.explode(F.sequence(
            F.lit(lo).cast("long"), F.lit(lo).cast("long") + F.col("reached") - 1
        )))
        found = pairs.join(due, ["bucket", "dim"])
        found = found.mapInPandas(_round(k), "query_id long, vec_id long, score long")
        best = best.union(found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        best = stored(best.select("query_id", "vec_id", "score"), "best")
        lo, step = hi, 2 * step
    return best.withColumn("rank", F.row_number().over(order)).select("query_id", "rank", "vec_id", "score")


TOP_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS c
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.c, v.c) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id AND q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
