"""Session settings and the shared folder that jobs write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("netvigil")
    settings = {
        **SESSION_CONF,
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="netvigil-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/netvigil/{label}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Writes rows to the shared folder now and reads them back: for a result that is used several times."""
    path = new_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def make_folder(spark: SparkSession, path: str) -> None:
    """A folder that a stream can follow before anything is in it."""
    files, folder = _folder(spark, path)
    files.mkdirs(folder)


def folder_names(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of what lies in a folder and starts with ``prefix``; none where there is no folder."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    return sorted(n for n in (s.getPath().getName() for s in files.listStatus(folder)) if n.startswith(prefix))


def remove_folder(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Moves a folder to a place whose earlier content goes; a move that the file system refuses raises."""
    files, folder = _folder(spark, target)
    files.delete(folder, True)
    files.mkdirs(folder.getParent())
    if not files.rename(_folder(spark, source)[1], folder):
        raise OSError(f"{source} could not be moved to {target}")
