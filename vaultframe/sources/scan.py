"""Reading tables: files, catalog, JDBC, and what lies in a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_path(spark: SparkSession, fmt: str, path: str, view: str | None = None, **options: str) -> DataFrame:
    """Any file format by path, optionally exposed as a view."""
    df = spark.read.format(fmt).options(**options).load(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def scan_parquet(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    return scan_path(spark, "parquet", path, view)


def scan_csv(
    spark: SparkSession,
    path: str,
    header: bool = False,
    infer: bool = False,
    schema: T.StructType | str | None = None,
    view: str | None = None,
) -> DataFrame:
    """CSV: all strings by default, named by a header, typed by schema or inference.

    Inference reads the files twice; give a schema for anything large.
    """
    reader = spark.read.option("header", header).option("inferSchema", infer)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


class VaultCatalog:
    """Catalog tables of one environment: ``im<env>_<layer>.<name>``."""

    def __init__(self, spark: SparkSession, env: str):
        self.spark = spark
        self.env = env

    def schema_name(self, layer: str) -> str:
        return f"im{self.env}_{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.schema_name(layer)}.{table}"

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def create_schema(self, layer: str, location: str) -> None:
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema_name(layer)} LOCATION '{location}'")


def jdbc_options(
    url: str,
    dbtable: str | None = None,
    query: str | None = None,
    partition: tuple[str, object, object, int] | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC read: a whole table, or a query the database runs.

    ``partition`` is (column, lower, upper, parts) and makes the read parallel;
    Spark allows it only with ``dbtable``, so a query is wrapped as one.
    """
    if (dbtable is None) == (query is None):
        raise ValueError("give either dbtable or query")
    options = {"url": url, **extra}
    if partition is None:
        options.update({"dbtable": dbtable} if dbtable else {"query": query})
        return options
    column, lower, upper, parts = partition
    options.update(
        dbtable=dbtable or f"({query}) part",
        partitionColumn=column,
        lowerBound=str(lower),
        upperBound=str(upper),
        numPartitions=str(parts),
    )
    return options


def scan_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    """JDBC read; filters, columns and limits added later are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **kwargs)).load()


def jdbc_tables(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    """The remote catalogue's table list."""
    return scan_jdbc(spark, url, query="SELECT * FROM INFORMATION_SCHEMA.TABLES", **kwargs)


def file_manifest(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files below a folder (or several) with directory and size; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.regexp_replace("path", "/[^/]*$", "").alias("directory"),
        F.regexp_extract("path", "([^/]*)$", 1).alias("file_name"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def directory_summary(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per directory."""
    return file_manifest(spark, path).groupBy("directory").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    """Row count of every file a file-based frame reads."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("row_count"))


def staged_vs_landed(staged: DataFrame, landed: DataFrame) -> DataFrame:
    """Row counts of the landed files and of the staging table made from them."""
    counts = staged.agg(F.count(F.lit(1)).alias("n")).select(F.lit("staged").alias("side"), "n")
    other = landed.agg(F.count(F.lit(1)).alias("n")).select(F.lit("landed").alias("side"), "n")
    both = counts.unionByName(other)
    return both.groupBy().agg(
        F.sum(F.when(F.col("side") == "staged", F.col("n"))).alias("staged_rows"),
        F.sum(F.when(F.col("side") == "landed", F.col("n"))).alias("landed_rows"),
    )
