"""Presence, listing and deletion of folders in whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    folder, system = _open(spark, path)
    return system.exists(folder)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly below ``path``; nothing if it does not exist."""
    folder, system = _open(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(folder)) if system.exists(folder) else []


def delete(spark: SparkSession, path: str) -> None:
    folder, system = _open(spark, path)
    system.delete(folder, True)
