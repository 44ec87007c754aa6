"""What several operators need: row numbers, connected components, column names that clash with nothing."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def numbered(rows: DataFrame, order: Sequence[Column], name: str, label: str) -> DataFrame:
    """``rows`` with a column ``name``: 0, 1, 2 ... in the given order, in no single task.

    The rows are sorted by range and written; the driver sees only the row count of each partition. Rows that
    are equal in ``order`` get numbers in any order among themselves, fixed by what was written.
    """
    part, place = f"{name}_part", f"{name}_place"
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.withColumn(part, F.spark_partition_id())
    kept = stored(ranged.withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), label)
    sizes = sorted((r[0], r[1]) for r in kept.groupBy(part).count().collect())
    starts, total = [], 0
    for index, size in sizes:
        starts.append((index, total))
        total += size
    if not starts:
        return kept.withColumn(name, F.col(place)).drop(part, place)
    lookup = rows.sparkSession.createDataFrame(starts, f"{part} int, {name}_start long")
    kept = kept.join(F.broadcast(lookup), part)
    return kept.withColumn(name, F.col(place) + F.col(f"{name}_start")).drop(part, place, f"{name}_start")


def _least_neighbour(edges: DataFrame, label: str) -> DataFrame:
    """Edges (a, b) with ``m``, the least b of the same a; a hot a is an ordinary skewed join."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")), label)
    return edges.join(least, "a")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (a, b): the least node it can reach.

    Large-star and small-star steps in turn until nothing changes; every step is one aggregation and one join and
    is written to the shared folder, so no plan grows and a lost executor costs one step at most.
    """
    edges = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    edges = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = None
    while True:
        after = edges.agg(
            F.count(F.lit(1)), F.sum((F.xxhash64("a", "b") % 1_000_003).cast("long")),
            F.sum((F.xxhash64("b", "a") % 998_244_353).cast("long")),
        ).first()
        if after == before:
            break
        before = after
        both = stored(edges.union(edges.select("b", "a")), "edges-both")
        large = _least_neighbour(both, "edges-least").where("b > a")
        large = large.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b")
        large = stored(large.distinct(), "edges-large")
        small = _least_neighbour(large, "edges-least")
        small = small.select(
            F.explode(F.array(
                F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            )).alias("e")
        ).select("e.a", "e.b").where("a <> b")
        edges = stored(small.distinct(), "edges")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )


def partitions(frame: DataFrame) -> int:
    """The session's number of shuffle partitions: what sizes blocks, so that they follow the cluster's setting."""
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: Ids that are broadcast at most (16 MB); a longer list is joined by shuffling.
LISTED = 1 << 21


def without(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """``rows`` whose ``column`` is not among ``ids`` (one column of 64-bit integers, none null); null stays."""
    wanted = private(rows, "wanted")
    ids = stored(ids.toDF(wanted), "ids")
    listed = F.broadcast(ids) if ids.count() <= LISTED else ids
    return rows.join(listed, F.col(f"`{column}`").cast("long") == F.col(wanted), "left_anti")


#: Bytes of an Arrow batch. Spark's own default is 64 MB, of which a task holds several with what is made of them.
BATCH_BYTES = "4m"


def small_batches(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches that are bounded in bytes: rows of this package are texts of any length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


class Sent:
    """A value for tasks, broadcast as bytes that hold its classes too: executors need not have this package."""

    def __init__(self, spark: SparkSession, value: object):
        self._bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self) -> object:
        """The value, unpacked anew at each call: a task calls it once."""
        return pickle.loads(self._bytes.value)


def private(frame: DataFrame, name: str) -> str:
    """A column name that ``frame`` doesn't have, whatever its case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_mod(column: Column, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus``; null stays null."""
    return F.crc32(column.cast("string").cast("binary")) % modulus
