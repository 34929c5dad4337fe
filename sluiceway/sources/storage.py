"""File-system moves for staged tables, through the Hadoop client Spark already uses."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, location: str):
    return spark._jvm.org.apache.hadoop.fs.Path(location)


def _fs(spark: SparkSession, location: str):
    return _path(spark, location).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, location: str) -> bool:
    return _fs(spark, location).exists(_path(spark, location))


def remove(spark: SparkSession, location: str) -> None:
    if exists(spark, location):
        _fs(spark, location).delete(_path(spark, location), True)


def move(spark: SparkSession, source: str, target: str) -> None:
    if not _fs(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"could not move {source} to {target}")


def data_files(spark: SparkSession, location: str) -> list[str]:
    listed = _fs(spark, location).listStatus(_path(spark, location))
    files = [s.getPath().toString() for s in listed if s.isFile()]
    return [f for f in files if not f.rsplit("/", 1)[-1].startswith(("_", "."))]


def folders(spark: SparkSession, location: str) -> list[str]:
    """Names of the folders in a folder."""
    if not exists(spark, location):
        return []
    listed = _fs(spark, location).listStatus(_path(spark, location))
    return sorted(s.getPath().getName() for s in listed if s.isDirectory())


def publish_files(spark: SparkSession, staged: str, target: str) -> None:
    """Move finished data files into a table folder; their names never clash."""
    if not exists(spark, target):
        move(spark, staged, target)
        return
    for f in data_files(spark, staged):
        move(spark, f, f"{target}/{f.rsplit('/', 1)[-1]}")
    remove(spark, staged)


def swap_in(df: DataFrame, path: str, backup_path: str | None = None) -> None:
    """Make ``df`` the new content of the table at ``path``.

    The rows are written beside the table first, so ``df`` may read the table it replaces.
    The old files are moved to ``backup_path``, or aside and removed last: at no moment is
    there neither an old nor a new complete copy.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    staged = f"{path.rstrip('/')}__new_{mark}"
    df.write.parquet(staged)
    if not exists(spark, path):
        move(spark, staged, path)
        return
    aside = backup_path or f"{path.rstrip('/')}__old_{mark}"
    if backup_path:
        remove(spark, backup_path)
    move(spark, path, aside)
    move(spark, staged, path)
    if not backup_path:
        remove(spark, aside)
