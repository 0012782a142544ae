"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Hot keys: AQE splits a skewed side of a sort-merge join. Forcing it covers the
# case where a window or aggregate on the same key follows the join: when the key
# is hot, Spark then adds a shuffle on the full key instead of keeping the hot
# key's rows in one task; when it is not, nothing changes.
SKEW = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
RECOMMENDED = {
    **SKEW,
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Switch the skew handling on in a session built elsewhere."""
    for name, value in SKEW.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the recommended settings; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediates: ``spark.checkpoint.dir``.

    Only a session whose driver and executors are one process may do without the setting and gets a folder beside its
    warehouse; on a cluster a folder of the driver's machine would be lost to the executors, so there it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


RUN: list[str] = []


def new_work_path(spark: SparkSession, label: str) -> str:
    """A path below the work folder that no earlier run has used."""
    parent = f"{work_dir(spark)}/{RUN[-1]}" if RUN else work_dir(spark)
    return f"{parent}/{label}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession, name: str | None = None) -> Iterator[str]:
    """Intermediates written inside the ``with`` block share one folder, which is dropped at its end.

    Results read from them must be written elsewhere before the block ends.
    """
    RUN.append(name or f"run-{uuid.uuid4().hex}")
    folder = f"{work_dir(spark)}/{RUN[-1]}"
    try:
        yield folder
    finally:
        RUN.pop()
        drop_folder(spark, folder)


def drop_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder of intermediates on whatever file system holds it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# Shuffle files of a finished write are deleted at its end, not when the driver happens to collect its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the work folder and read it back.

    Used where a result feeds several branches: it is computed once, the plan
    behind it is cut, and a lost executor rereads files instead of recomputing.
    Its shuffle files are given back when it is written.
    """
    spark, path = df.sparkSession, new_work_path(df.sparkSession, label)
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)
