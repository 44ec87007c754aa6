from datetime import date
from pathlib import Path

import pytest
from conftest import at, dicts, event_rows
from pyspark.sql import functions as F

from netvigil.operators import lifecycle as ops
from netvigil.sources import tables

BASE = 1_704_067_200_000
DAY = 86_400_000
AS_OF = date(2024, 2, 5)


@pytest.mark.parametrize("age,state", [(0, "hot"), (6, "hot"), (7, "warm"), (29, "warm"), (30, "delete"), (400, "delete")])
def test_state(spark, age, state):
    assert spark.range(1).select(ops.state_of(F.lit(age))).first()[0] == state


def test_rollover_by_size_or_age(spark):
    rows = [("telecom-noc-2024.02.05", 99_999, 0), ("telecom-noc-2024.02.05b", 100_000, 0), ("telecom-noc-2024.02.04", 1, 1), ("telecom-noc-2024.01.01", 1, 35)]
    inventory = spark.createDataFrame(rows, "source_index string, docs bigint, age_days int")
    assert {r["source_index"]: r["rollover"] for r in ops.rollover_due(inventory).collect()} == {
        "telecom-noc-2024.02.05": False, "telecom-noc-2024.02.05b": True, "telecom-noc-2024.02.04": True}


def fill(spark, folder, days, loads=3):
    for day in days:
        for load in range(loads):
            events = event_rows(spark, [{"ms": BASE + day * DAY + load, "hostname": f"h{load}"}])
            tables.write_daily(events, folder, at(BASE + day * DAY), batch=f"b{load}")


def files(folder, name):
    return sorted(p.name for p in Path(folder, f"source_index={name}").rglob("*.parquet"))


def test_compaction_rewrites_warm_partitions_only(spark, folder):
    fill(spark, folder, (0, 20, 34))
    before = sorted(map(tuple, tables.read_events(spark, folder).collect()))
    untouched = files(folder, "telecom-noc-2024.01.01"), files(folder, "telecom-noc-2024.02.04")
    ops.compact_warm(spark, folder, AS_OF)
    assert len(files(folder, "telecom-noc-2024.01.21")) == 1
    assert (files(folder, "telecom-noc-2024.01.01"), files(folder, "telecom-noc-2024.02.04")) == untouched
    assert sorted(map(tuple, tables.read_events(spark, folder).collect())) == before
    ops.compact_warm(spark, folder, AS_OF)
    assert sorted(map(tuple, tables.read_events(spark, folder).collect())) == before
    assert not [p for p in Path(folder).iterdir() if p.name.startswith(("_compacting", "_replaced"))]


def test_interrupted_swap_is_undone(spark, folder):
    fill(spark, folder, (20,))
    aside = Path(folder, f"{ops.REPLACED}x")
    aside.mkdir()
    Path(folder, "source_index=telecom-noc-2024.01.21").rename(aside / "source_index=telecom-noc-2024.01.21")
    ops.compact_warm(spark, folder, AS_OF)
    assert tables.read_events(spark, folder).count() == 3


def test_large_partitions_split(spark, folder):
    rows = spark.range(20_000).select(
        F.timestamp_millis(F.lit(BASE) + F.col("id")).alias("timestamp"), F.sha2(F.col("id").cast("string"), 256).alias("message"))
    tables.write_daily(rows, folder, at(BASE + 20 * DAY))
    advised = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    kept = spark.conf.get(advised)
    spark.conf.set(advised, "100k")
    try:
        ops.compact_warm(spark, folder, AS_OF)
    finally:
        spark.conf.set(advised, kept)
    assert len(files(folder, "telecom-noc-2024.01.21")) > 1
    assert tables.read_events(spark, folder).count() == 20_000


def test_retention_is_a_dry_run_unless_applied(spark, folder):
    fill(spark, folder, (0, 6, 34), loads=1)
    plan = dicts(ops.retention(spark, folder, AS_OF))
    assert [r["source_index"] for r in plan] == ["telecom-noc-2024.01.01"]
    assert plan[0]["notice"] == "Índice telecom-noc-2024.01.01 será excluído por retenção de 30 dias."
    assert tables.read_events(spark, folder).count() == 3
    assert dicts(ops.retention(spark, folder, AS_OF, apply=True)) == plan
    assert tables.read_events(spark, folder).count() == 2


class Refusing:
    """A file system whose renames return false from the given one on, as Hadoop's do on failure."""

    def __init__(self, files, refused):
        self.files, self.refused, self.calls = files, refused, 0

    def __getattr__(self, name):
        return getattr(self.files, name)

    def rename(self, source, target):
        self.calls += 1
        return False if self.calls in self.refused else self.files.rename(source, target)


@pytest.mark.parametrize("refused", [{1}, {2}])
def test_a_failing_move_loses_no_row(spark, folder, monkeypatch, refused):
    fill(spark, folder, (20, 21))
    before = spark.read.parquet(folder).count()
    real = ops._folders

    def folders(session, root):
        files, at = real(session, root)
        return Refusing(files, refused), at

    monkeypatch.setattr(ops, "_folders", folders)
    with pytest.raises(OSError):
        ops.compact_warm(spark, folder, AS_OF)
    assert spark.read.parquet(folder).count() == before > 0
    monkeypatch.undo()
    ops.compact_warm(spark, folder, AS_OF)
    assert spark.read.parquet(folder).count() == before


def test_a_second_run_changes_no_file(spark, folder):
    fill(spark, folder, (20, 21))
    ops.compact_warm(spark, folder, AS_OF)
    files = sorted(spark.read.parquet(folder).inputFiles())
    ops.compact_warm(spark, folder, AS_OF)
    assert sorted(spark.read.parquet(folder).inputFiles()) == files and files


def test_inventory_comes_from_footers(spark, folder):
    fill(spark, folder, (0, 20, 34))
    inventory = ops.stored_inventory(spark, folder, AS_OF)
    plan = inventory._jdf.queryExecution().optimizedPlan().toString() + inventory._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(event_ms), MAX(event_ms)]" in plan
    rows = {r["source_index"]: (r["docs"], r["first_ms"], r["last_ms"], r["age_days"]) for r in inventory.collect()}
    assert rows == {
        f"telecom-noc-{name}": (3, BASE + day * DAY, BASE + day * DAY + 2, age)
        for name, day, age in (("2024.01.01", 0, 35), ("2024.01.21", 20, 15), ("2024.02.04", 34, 1))
    }
    assert sorted(map(tuple, ops.partition_inventory(tables.read_events(spark, folder), AS_OF).collect())) == sorted(
        map(tuple, inventory.select("source_index", "docs", "first_ms", "last_ms", "age_days").collect()))


def test_generations_are_told_apart(spark, folder):
    for generation in (1, 2):
        for load in range(generation):
            events = event_rows(spark, [{"ms": BASE + load}])
            tables.write_daily(events, folder, at(BASE), batch=f"{generation}-{load}", generation=generation)
    found = ops.stored_inventory(spark, folder, AS_OF, generations=True)
    assert {r["generation"]: r["docs"] for r in found.collect()} == {"000001": 1, "000002": 2}
    assert ops.stored_inventory(spark, folder, AS_OF).first()["docs"] == 3
