"""Merging the small files of stored tables, in place.

The listing decides: files below half the wanted size are packed, folder by folder, into bins of about that
size. Only bins of two files or more are rewritten, all of them in one job that moves the rows of these
files and of no others; larger files keep their names and bytes. Folders are addressed by path, so
partition values may be anything a path can hold.

The merged files are written to a hidden folder. A plan of the moves is written there before the first one, then every merged file is
renamed into its folder and the files it replaces are deleted. A job that dies before the plan changed nothing, and one
that dies after it is completed by the next call (or by :func:`finish`). A reader between the
rename and the delete of a bin can see its rows twice: compact where nobody reads.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultframe.sources import files
from vaultframe.sources.scan import file_manifest

_WORK = f"{files.HIDDEN}compact-"
#: Files below this share of the wanted size are small.
SMALL = 0.5


def bins(manifest: DataFrame, target_bytes: int) -> DataFrame:
    """``directory``, ``file_name``, ``bytes`` and ``bin`` of the small files that belong together."""
    small = manifest.filter(F.col("bytes") < target_bytes * SMALL)
    before = Window.partitionBy("directory").orderBy("file_name").rowsBetween(Window.unboundedPreceding, -1)
    number = F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target_bytes)
    packed = small.select("directory", "file_name", "bytes", number.alias("__n"))
    some = Window.partitionBy("directory", "__n")
    packed = packed.withColumn("__files", F.count(F.lit(1)).over(some)).filter("__files > 1")
    return packed.select("directory", "file_name", "bytes", F.xxhash64("directory", "__n").alias("bin"))


def _moves(spark: SparkSession, work: str) -> list[tuple[str, str, list[str]]]:
    """Merged file, its place, and the files it replaces, as planned."""
    rows = spark.read.schema("merged string, place string, replaced array<string>").json(f"{work}/{files.HIDDEN}plan").collect()
    return [(r["merged"], r["place"], r["replaced"]) for r in rows]


def _apply(spark: SparkSession, work: str) -> None:
    for merged, place, replaced in _moves(spark, work):
        if files.exists(spark, merged):
            files.move(spark, merged, place)
        for old in replaced:
            files.delete(spark, old)
    files.delete(spark, work)


def finish(spark: SparkSession, root: str) -> int:
    """Complete compactions below ``root`` that died after their plan, drop those that died before it; how many there were."""
    left = [name for name in files.names(spark, root) if name.startswith(_WORK)]
    for name in left:
        if files.exists(spark, f"{root}/{name}/{files.HIDDEN}plan/_SUCCESS"):
            _apply(spark, f"{root}/{name}")
        else:
            files.delete(spark, f"{root}/{name}")
    return len(left)


def compact_files(spark: SparkSession, root: str, directories: list[str] | None = None, target_mb: float = 256, fmt: str = "parquet") -> tuple[int, int]:
    """Merge the small files below ``root`` (or of the given directories); returns the files replaced and written.

    ``root`` holds the hidden work folder, on the store of the directories. Files of one bin may differ in columns: the
    merged file has all of them.
    """
    finish(spark, root)
    manifest = file_manifest(spark, directories or root).filter(F.col("file_name").endswith(f".{fmt}"))
    chosen = bins(manifest, int(target_mb * 1024 * 1024))
    rows = chosen.collect()  # names of the files to be replaced, a share of the listing
    if not rows:
        return 0, 0
    sources: dict[int, list] = {}
    for row in rows:
        sources.setdefault(row["bin"], []).append(f"{row['directory']}/{row['file_name']}")
    work = f"{root}/{_WORK}{uuid.uuid4().hex}"
    data = spark.read.format(fmt).option("mergeSchema", True).load([path for paths in sources.values() for path in paths])
    own = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    name = F.regexp_replace(own, "^[a-z0-9]+:/*", "/")  # the listing and the reader write the store's prefix differently
    bin_of = spark.createDataFrame([(path, key) for key, paths in sources.items() for path in paths], "__path string, __bin long")
    bin_of = bin_of.select(F.regexp_replace("__path", "^[a-z0-9]+:/*", "/").alias("__path"), "__bin")
    merged = data.withColumn("__name", name).join(bin_of, F.col("__name") == F.col("__path")).drop("__name", "__path")
    merged.repartition("__bin").write.format(fmt).partitionBy("__bin").save(f"{work}/data")
    plan = []
    for key, paths in sources.items():
        folder = f"{work}/data/__bin={key}"
        for n, part in enumerate(files.names(spark, folder)):
            place = f"{paths[0].rsplit('/', 1)[0]}/part-compacted-{uuid.uuid4().hex}.{fmt}"
            plan.append((f"{folder}/{part}", place, paths if n == 0 else []))
    kept = spark.read.format(fmt).load(f"{work}/data").count()
    if kept != data.count():
        raise OSError(f"{kept} rows were written, the files to be replaced hold another number")
    spark.createDataFrame(plan, "merged string, place string, replaced array<string>").coalesce(1).write.json(f"{work}/{files.HIDDEN}plan")
    _apply(spark, work)
    return len(rows), len(plan)


def table_folders(spark: SparkSession, name: str) -> list[str]:
    """Folders that hold a catalog table's files, wherever its partitions lie."""
    return sorted({unquote(path).rsplit("/", 1)[0] for path in spark.table(name).inputFiles()})
