"""Time chunks: ordered work split into bounded groups without changing its result."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from netvigil.functions.times import bucket_start


def overlapping_chunks(rows: DataFrame, key: str, width: int, lookback: int) -> DataFrame:
    """Adds ``chunk`` (start of a stretch of ``width``) and ``carried``.

    Every row joins its own chunk and, marked ``carried``, each later chunk whose start is
    at most ``lookback`` after it. A window over (entity, chunk) that looks back no further than
    that sees all it needs, so one entity's history need not sit in one task.
    """
    own = bucket_start(F.col(key), width)
    last = bucket_start(F.col(key) + F.lit(lookback).cast("bigint"), width)
    chunks = F.sequence(own, last, F.lit(width).cast("bigint"))
    return rows.withColumn("chunk", F.explode(chunks)).withColumn("carried", F.col("chunk") > F.col(key))


def running_total(rows: DataFrame, key: str, totals: dict[str, str], width: int, levels: int = 2) -> DataFrame:
    """Running sums in ``key`` order over the whole table; ``totals`` maps new columns to summed ones.

    Sums run within stretches of ``width`` keys. What earlier stretches add up to is found the
    same way from one row per stretch, ``levels`` times over, so that only the last and shortest
    table (one row per ``width ** (2 ** levels - 1)`` keys) is summed in a single task.
    """
    plain = rows.columns
    if levels == 0:
        upto = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
        return rows.select(*plain, *[F.sum(c).over(upto).alias(name) for name, c in totals.items()])
    chunked = rows.withColumn("_chunk", bucket_start(F.col(key).cast("bigint"), width))
    inside = Window.partitionBy("_chunk").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    local = chunked.select("*", *[F.sum(c).over(inside).alias(name) for name, c in totals.items()])
    sums = chunked.groupBy("_chunk").agg(*[F.sum(c).alias(f"_own_{name}") for name, c in totals.items()])
    upto = running_total(
        sums.withColumnRenamed("_chunk", "_start"), "_start",
        {f"_upto_{name}": f"_own_{name}" for name in totals}, width * width, levels - 1,
    )
    earlier = upto.select(
        F.col("_start").alias("_chunk"),
        *[(F.col(f"_upto_{name}") - F.col(f"_own_{name}")).alias(f"_before_{name}") for name in totals],
    )
    return local.join(earlier, "_chunk").select(
        *plain, *[(F.col(name) + F.col(f"_before_{name}")).alias(name) for name in totals]
    )
