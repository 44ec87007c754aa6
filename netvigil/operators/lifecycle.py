"""Jobs on daily partitions: inventory, states, rollover, compaction and retention."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from netvigil.functions.times import event_ms, partition_date
from netvigil.schema import Retention
from netvigil.sources.tables import PARTITIONS, TABLE_SCHEMA, WHOLE_DAY

POLICY = Retention()
STAGED, REPLACED = "_compacting-", "_replaced-"
# Fixed value: notice of a deletion.
NOTICE = "Índice {} será excluído por retenção de {} dias."


def partition_age(as_of: date) -> Column:
    """Days from the date in the partition's name to ``as_of``; uses partition values only."""
    return F.date_diff(F.lit(as_of), partition_date(F.col("source_index")))


def state_of(age: Column, policy: Retention = POLICY) -> Column:
    return F.when(age >= policy.delete_days, "delete").when(age >= policy.warm_days, "warm").otherwise("hot")


def partition_inventory(events: DataFrame, as_of: date) -> DataFrame:
    """Per daily partition: documents, first and last event (epoch ms) and age in days."""
    grouped = events.groupBy("source_index").agg(
        F.count("*").alias("docs"), F.min(event_ms()).alias("first_ms"), F.max(event_ms()).alias("last_ms")
    )
    return grouped.withColumn("age_days", partition_age(as_of))


def stored_inventory(spark: SparkSession, root: str, as_of: date, generations: bool = False) -> DataFrame:
    """``partition_inventory`` of a stored table, or one row for each generation of a day.

    Counts and bounds come from the footers of the files; no row is read. For that the session gets
    ``spark.sql.parquet.aggregatePushdown``, which only concerns reads by Spark's newer file source, as this one is.
    """
    sources = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(sources)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    spark.conf.set(sources, ",".join(name for name in before.split(",") if name != "parquet"))
    try:
        table = spark.read.schema(TABLE_SCHEMA).parquet(root)
    finally:
        spark.conf.set(sources, before)
    # Footers answer for files, and files lie in one partition each.
    pushed = table.groupBy(*PARTITIONS).agg(
        F.count("*").alias("docs"), F.min("event_ms").alias("first_ms"), F.max("event_ms").alias("last_ms")
    )
    keys = ["source_index", "generation"] if generations else ["source_index"]
    grouped = pushed.groupBy(*keys).agg(
        F.sum("docs").alias("docs"), F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms")
    )
    return grouped.withColumn("age_days", partition_age(as_of))


def lifecycle_state(inventory: DataFrame, policy: Retention = POLICY) -> DataFrame:
    """Adds ``state``: hot, warm or delete by age."""
    return inventory.withColumn("state", state_of(F.col("age_days"), policy))


def rollover_due(inventory: DataFrame, policy: Retention = POLICY) -> DataFrame:
    """Hot partitions that are large enough or old enough to stop writing to."""
    reached = (F.col("docs") >= policy.rollover_docs) | (F.col("age_days") >= policy.rollover_days)
    states = lifecycle_state(inventory, policy)
    return states.where(F.col("state") == "hot").withColumn("rollover", reached)


def retention_plan(inventory: DataFrame, policy: Retention = POLICY) -> DataFrame:
    """Partitions due for deletion, each with its notice."""
    before, after = NOTICE.split("{}", 1)
    notice = F.concat(F.lit(before), F.col("source_index"), F.lit(after.format(policy.delete_days)))
    expired = lifecycle_state(inventory, policy).where(F.col("state") == "delete")
    return expired.select("source_index", "docs", "age_days", notice.alias("notice"))


def _folders(spark: SparkSession, root: str):
    """The table's file system, and a maker of paths below its root."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    return files, lambda *parts: path("/".join([root, *parts]))


def _names(files, folder) -> list[str]:
    return [status.getPath().getName() for status in files.listStatus(folder)]


def _move(files, source, target) -> None:
    """Renames a folder; a file system that only returns false, or would move into the target, raises here."""
    if files.exists(target) or not files.rename(source, target):
        raise OSError(f"{source} could not be moved to {target}")


def _restore(files, at) -> None:
    """Puts back partitions that an interrupted swap had moved away, and clears what it had staged."""
    for kept in [name for name in _names(files, at()) if name.startswith(REPLACED)]:
        for name in _names(files, at(kept)):
            if not files.exists(at(name)):
                _move(files, at(kept, name), at(name))
        files.delete(at(kept), True)
    for staged in [name for name in _names(files, at()) if name.startswith(STAGED)]:
        files.delete(at(staged), True)


def compact_warm(spark: SparkSession, root: str, as_of: date, policy: Retention = POLICY) -> None:
    """Rewrites every warm partition into as few files as possible, in one job.

    Rebalancing sends a small partition to one file and lets Spark split one larger than the
    advisory partition size, so that no task takes in a whole large day. Only warm partitions are
    read (a filter on the partition column), and of these only the ones that hold more than the batch
    of an earlier run. They are rewritten aside, in a folder readers skip, and then swapped in one by
    one; the old files go last, and only when every move has been made: a move that fails is undone and
    raised. Nothing else may write to them meanwhile.
    """
    files, at = _folders(spark, root)
    _restore(files, at)
    days = [name for name in _names(files, at()) if name.startswith("source_index=")]
    done = [name.partition("=")[2] for name in days if _names(files, at(name)) == ["generation=compacted"]]
    run = uuid.uuid4().hex
    staged, replaced = f"{STAGED}{run}", f"{REPLACED}{run}"
    table = spark.read.schema(TABLE_SCHEMA).parquet(root)
    warm = table.where((state_of(partition_age(as_of), policy) == "warm") & ~F.col("source_index").isin(done))
    warm = warm.withColumns({name: F.lit("compacted") for name in ("generation", "batch")}).withColumn("hour", F.lit(WHOLE_DAY))
    writer = warm.hint("rebalance", "source_index").write.partitionBy(*PARTITIONS)
    writer.option("compression", "zstd").parquet(at(staged).toString())
    files.mkdirs(at(replaced))
    for name in [n for n in _names(files, at(staged)) if n.startswith("source_index=")]:
        _move(files, at(name), at(replaced, name))
        try:
            _move(files, at(staged, name), at(name))
        except Exception:
            _move(files, at(replaced, name), at(name))
            raise
    files.delete(at(staged), True)
    files.delete(at(replaced), True)


def retention(
    spark: SparkSession, root: str, as_of: date, policy: Retention = POLICY, apply: bool = False
) -> DataFrame:
    """The retention plan of a table, from file footers; with ``apply`` also drops the expired partitions' folders.

    Only partition names reach the driver. The plan is fixed before anything is dropped.
    """
    plan = retention_plan(stored_inventory(spark, root, as_of), policy)
    if not apply:
        return plan
    decided = plan.collect()
    files, at = _folders(spark, root)
    for row in decided:
        files.delete(at(f"source_index={row.source_index}"), True)
    return spark.createDataFrame(decided, plan.schema)
