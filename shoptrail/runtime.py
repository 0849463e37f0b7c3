"""Session set-up and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "shoptrail", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the package relies on; ``conf`` keys use ``__`` for a dot."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


#: Folders stored inside ``temporary_tables``, which removes them.
_stored_inside: ContextVar[list[str] | None] = ContextVar("stored_inside", default=None)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` or, where that is unset, below the warehouse folder.

    Both are shared by all executors of a cluster. The folder is not made yet.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shoptrail-work"
    return f"{root.rstrip('/')}/{purpose.replace(' ', '-')}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def stored(df: DataFrame, purpose: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Later steps then plan with its real size and need not derive it again, also after losing executors.
    The table goes when ``temporary_tables`` around the call ends, or else with the session's process.
    """
    folder = work_folder(df.sparkSession, purpose)
    df.write.partitionBy(*partition_by).parquet(folder)
    remove_at_exit(df.sparkSession, folder)
    inside = _stored_inside.get()
    if inside is not None:
        inside.append(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Remove at the end whatever ``stored`` writes inside. Results must have been written elsewhere by then."""
    folders: list[str] = []
    token = _stored_inside.set(folders)
    try:
        yield
    finally:
        _stored_inside.reset(token)
        for folder in folders:
            remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    fs, path = _file_system(spark, folder)
    fs.delete(path, True)


def remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Let the file system drop an existing folder when the driver's process ends."""
    fs, path = _file_system(spark, folder)
    fs.deleteOnExit(path)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern with wildcards."""
    fs, path = _file_system(spark, pattern)
    return [str(status.getPath()) for status in fs.globStatus(path) or []]


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)
