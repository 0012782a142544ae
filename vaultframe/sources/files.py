"""Files and folders of whatever store Spark writes to, by the store's own rename and delete."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Readers of a folder pass over names that begin with this.
HIDDEN = "_"


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _at(spark, path)
    return store.exists(where)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, hidden ones too; none if there is no such folder."""
    store, where = _at(spark, folder)
    return sorted(s.getPath().getName() for s in store.listStatus(where)) if store.exists(where) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    store, where = _at(spark, source)
    _, to = _at(spark, target)
    store.mkdirs(to.getParent())
    if not store.rename(where, to):
        raise OSError(f"{source} could not be moved to {target}")


def delete(spark: SparkSession, path: str) -> bool:
    store, where = _at(spark, path)
    return store.delete(where, True)


def swap_in(spark: SparkSession, coming: str, folder: str, aside: str) -> None:
    """Put a finished folder in the place of another, which is moved aside first and back if that fails, then deleted.

    Both moves are renames. Between them readers find neither; a process that dies there leaves both, under hidden names.
    """
    had = exists(spark, folder)
    if had:
        move(spark, folder, aside)
    try:
        move(spark, coming, folder)
    except BaseException:
        if had:
            move(spark, aside, folder)
        raise
    if had:
        delete(spark, aside)
