"""Writing tables: overwrite, rebuild, daily replace, typed tables, compaction."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date
from math import ceil
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultframe.functions.dates import as_date
from vaultframe.sources import files
from vaultframe.sources.compaction import compact_files, table_folders
from vaultframe.sources.scan import file_manifest


def write_table(df: DataFrame, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Write a new version of a table into a folder of its own below ``path``, then point the table to it.

    Until the new files are complete the table keeps its old ones, which are left
    where they are: a failed job loses nothing.
    """
    spark = df.sparkSession
    version = f"{path}/v-{uuid.uuid4().hex}"
    df.write.format(fmt).save(version)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=version, source=fmt)
    return spark.table(name)


def rebuild_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace an intermediate table by the frame's rows, once these are all written.

    The frame must not read the table it replaces. Writing the stage cuts the
    lineage, and a lost executor reads the files again.
    """
    if path:
        return write_table(df, name, path)
    spark = df.sparkSession
    coming = f"{name}__{uuid.uuid4().hex}"
    df.write.format("parquet").saveAsTable(coming)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {coming} RENAME TO {name}")
    return spark.table(name)


def _literal(value: object) -> str:
    """A partition value in SQL; null is the partition of rows without one."""
    if value is None:
        return "NULL"
    text = value.isoformat() if isinstance(value, date) else str(value)
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _point_run(spark: SparkSession, table: str, run_col: str, run: object, folder: str) -> None:
    """Make a folder the place of one run in the catalog: readers see the old files or the new ones, never a mixture."""
    spec = f"PARTITION (`{run_col}` = {_literal(run)})"
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec} LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def replace_run(df: DataFrame, path: str, run_col: str, run_dt: date | str, table: str | None = None) -> None:
    """Replace one run; the other runs are not touched.

    The rows are written aside, and only a complete write is published: a call that is rejected,
    fails or is killed leaves the stored run as it was, and so does a concurrent call until its own turn
    (the last to publish wins). A run without rows ends up empty. A row of another run fails the write: see
    :func:`write_runs` for frames of several runs.

    With ``table``, a catalog table on ``path``, publishing points the run's partition to the new folder, in one
    step; the old folder stays for readers that still hold it (:func:`drop_replaced_runs`). Without it, the run's
    folder is swapped by renames (``files.swap_in``).
    """
    spark, day = df.sparkSession, as_date(run_dt)
    if run_col in df.columns:
        own = F.col(run_col).eqNullSafe(F.lit(day))
        df = df.filter(F.assert_true(own, F.concat(F.lit(f"row of another run than {day}: "), F.coalesce(F.col(run_col).cast("string"), F.lit("null")))).isNull())
        df = df.drop(run_col)
    version = uuid.uuid4().hex
    name = f"{run_col}={day.isoformat()}"
    coming = f"{path}/{files.HIDDEN}runs/{name}/v-{version}"
    try:
        df.write.parquet(coming)
    except BaseException:
        files.delete(spark, coming)
        raise
    if table:
        _point_run(spark, table, run_col, day, coming)
    else:
        files.swap_in(spark, coming, f"{path}/{name}", f"{path}/{files.HIDDEN}runs/{name}/old-{version}")


def write_runs(df: DataFrame, path: str, run_col: str, table: str | None = None) -> None:
    """Replace every run that the frame has rows of, in one job; runs without rows in it stay.

    With ``table`` the runs are written aside and then pointed to one by one, as in :func:`replace_run`.
    """
    if not table:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run_col).parquet(path)
        return
    spark = df.sparkSession
    version = f"{path}/{files.HIDDEN}runs/all-{uuid.uuid4().hex}"
    df.write.partitionBy(run_col).parquet(version)
    kind = df.schema[run_col].dataType
    for folder in files.names(spark, version):  # one for each run
        if folder.startswith(f"{run_col}="):
            value = unquote(folder.split("=", 1)[1])
            run = None if value == "__HIVE_DEFAULT_PARTITION__" else date.fromisoformat(value) if isinstance(kind, T.DateType) else value
            _point_run(spark, table, run_col, run, f"{version}/{folder}")


def drop_replaced_runs(spark: SparkSession, path: str, run_col: str, table: str) -> int:
    """Delete the folders of ``path`` that the table's runs no longer lie in; returns how many."""
    used = {folder.removeprefix("file:").replace("///", "/") for folder in table_folders(spark, table)}
    root, dropped = f"{path}/{files.HIDDEN}runs", 0
    for name in files.names(spark, root):
        for version in files.names(spark, f"{root}/{name}"):
            folder = f"{root}/{name}/{version}"
            if version.startswith(("v-", "old-", f"{run_col}=")) and folder.removeprefix("file:").replace("///", "/") not in used:
                files.delete(spark, folder)
                dropped += 1
    return dropped


@dataclass(frozen=True)
class TableSpec:
    """Declared table: DDL of its columns, partition columns, comment."""

    name: str
    columns: str
    partition_by: tuple[str, ...] = ()
    comment: str = ""
    options: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)


def write_clustered(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A catalog table stored in ``buckets`` by its hash key, sorted within.

    Joins and newest-version windows on that key then need no shuffle of the table, and tables of equal bucket
    counts meet bucket by bucket. One file a bucket: the rows are dealt by the key before they are written.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def bucket_count(*frames: DataFrame, least: int, rows: int = 1_000_000) -> int:
    """Buckets for tables that are to meet: ``least``, doubled until the largest has no more than ``rows`` rows a bucket.

    A bucket is written and read by one task, so their number has to grow with the tables.
    """
    most, buckets = max(df.count() for df in frames), least
    while buckets * rows < most:
        buckets *= 2
    return buckets


def create_table(spark: SparkSession, spec: TableSpec, path: str, fmt: str = "parquet") -> DataFrame:
    """An empty table with the declared types, partitions, location and comment."""
    parts = f"PARTITIONED BY ({', '.join(spec.partition_by)})" if spec.partition_by else ""
    comment = f"COMMENT '{spec.comment}'" if spec.comment else ""
    spark.sql(f"DROP TABLE IF EXISTS {spec.name}")
    spark.sql(f"CREATE TABLE {spec.name} ({spec.columns}) USING {fmt} {parts} LOCATION '{path}' {comment}")
    return spark.table(spec.name)


def fill_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Append rows to a declared table, cast to its declared types."""
    spark = df.sparkSession
    table = spark.table(spec.name)
    typed = df.select(*[F.col(f.name).cast(f.dataType) for f in table.schema.fields])
    typed.write.insertInto(spec.name)
    return spark.table(spec.name)


def truncate_table(spark: SparkSession, name: str) -> DataFrame:
    """Remove all rows, keep the schema."""
    spark.sql(f"TRUNCATE TABLE {name}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files below a folder, added up from the listing alone."""
    return file_manifest(spark, path).agg(F.sum("bytes")).first()[0] or 0


def _file_count(spark: SparkSession, path: str, target_mb: int) -> int:
    return max(1, ceil(stored_bytes(spark, path) / (target_mb * 1024 * 1024)))


def compact(spark: SparkSession, path: str, target: str, target_mb: int = 256, fmt: str = "parquet") -> int:
    """Copy a folder into files of at least about ``target_mb``; returns the file count.

    The rows go to a new folder and the old one stays as it is, so readers are
    not disturbed and a failed run loses nothing. Neighbouring input splits are joined, nothing is shuffled. See
    ``compaction.compact_files`` for merging the small files alone.
    """
    if path.rstrip("/") == target.rstrip("/"):
        raise ValueError("compaction needs a folder of its own")
    rows = spark.read.format(fmt).load(path).coalesce(_file_count(spark, path, target_mb))
    rows.write.format(fmt).mode("overwrite").save(target)
    return rows.rdd.getNumPartitions()


def table_location(spark: SparkSession, name: str) -> str:
    """Folder a catalog table's files are in."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]


def compact_tables(spark: SparkSession, names: Iterable[str], target_root: str, target_mb: float = 256) -> dict[str, int]:
    """Compact catalog tables; returns the files written for each.

    A table without partitions is copied into a new folder of this call and pointed to it; its old files stay. The
    small files of a partitioned table are merged where they lie, in one job for all partitions.
    """
    done = {}
    for name in names:
        if any(c.isPartition for c in spark.catalog.listColumns(name)):
            folders = table_folders(spark, name)
            done[name] = compact_files(spark, table_location(spark, name), folders, target_mb)[1] if folders else 0
        else:
            target = f"{target_root}/{name.replace('.', '/')}-{uuid.uuid4().hex}"
            done[name] = compact(spark, table_location(spark, name), target, target_mb)
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{target}'")
        spark.catalog.refreshTable(name)
    return done
