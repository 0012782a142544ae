"""Helpers the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultframe.session import tune

#: A word: a run of anything but ASCII white space. Python's ``bytes.split()`` cuts at the same bytes.
WORD = r"[^\x20\x09-\x0D]+"
#: Lower-cases A-Z in UTF-8 bytes and leaves every other byte alone.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


#: What a task hands to Python at a time. Long texts make batches of Spark's own size (64 MB) heavy on both sides.
ARROW_BYTES = 4 << 20


def ready(spark: SparkSession) -> SparkSession:
    """The session settings of the operators that hand whole texts to Python."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(column: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(column, upper, upper.lower())


def packed(docs: DataFrame, **named: Column) -> DataFrame:
    """The whole row as one struct ``row`` beside named columns, so that no name of the input can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, *[column.alias(name) for name, column in named.items()])


def unpacked(frame: DataFrame) -> DataFrame:
    return frame.select("row.*")


def remainder(column: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``: a split that depends on the id alone."""
    return F.pmod(F.crc32(column.cast("string")), F.lit(divisor))
