"""Token counts of flat token files: identifiers back to back, no index, each document closed by an end identifier.

Method: a file is cut into blocks; in each block a vectorised search finds the end
identifiers. What reaches over
block edges is stitched by a prefix scan, first over the blocks of a file, then
over the files of a stream: tokens before a block, and the last end before it.

Files are written by Spark's text writer, so any store that Spark writes to will do: a row
is the identifiers of some documents, and the line separator is the end identifier of its last one. A
row is closed at the first document that takes it to ``ROW_TOKENS`` and a file after ``FILE_ROWS`` rows, so
their sizes are bounded by these and a document for each row. Files are read by their bytes (``binaryFile``) and handed to
the scan in ranges of ``RANGE_BYTES``, never whole.

The scan's levels - block, file, the files of one writer task, stream - keep every window short: a
stream's last level has one row for each ``GROUP_FILES`` numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultframe.llm.bpe import Encoder, Vocabulary, few_at_a_time, shared_vocabulary
from vaultframe.session import stage

BLOCK_TOKENS = 1 << 20
ROW_TOKENS = 1 << 17
FILE_ROWS = 16
RANGE_BYTES = 1 << 18  # a multiple of every width
GROUP_FILES = 1 << 16
#: Bytes of an identifier -> the encoding in which one character is one identifier.
ENCODINGS = {2: "UTF-16LE", 4: "UTF-32LE"}


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end: int, width: int = 2) -> None:
    """Files of whole documents, a document's identifiers and ``end`` for each row of ``text``.

    Null and empty texts are just the end. ``end`` must be no identifier of a text
    and, with two bytes, no surrogate. No rows give empty files or none.
    """
    vocabulary = shared_vocabulary(docs.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*[*vocabulary.value[:3], {}]))
        closing = np.array([end], f"<u{width}").tobytes()
        parts: list[bytes] = []
        held = 0
        for batch in batches:
            for texts in few_at_a_time(batch["text"]):
                for ids in encoder.encode_all(texts):
                    parts.append(np.array(ids, f"<u{width}").tobytes())
                    held += len(ids) + 1
                    if held >= ROW_TOKENS:
                        yield pa.RecordBatch.from_arrays([pa.array([closing.join(parts)], pa.binary())], ["ids"])
                        parts, held = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([closing.join(parts)], pa.binary())], ["ids"])

    ids = docs.select("text").mapInArrow(run, "ids binary").select(F.col("ids").cast("string"))
    ids.write.option("encoding", ENCODINGS[width]).option("lineSep", chr(end)).option("maxRecordsPerFile", FILE_ROWS).text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``stream``, ``file`` (its number in the stream: that of the writer's task, then that in the task), ``content``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    task = F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("long")
    within = F.regexp_extract("path", r"[-.]c(\d+)\.[^/]*$", 1)
    number = task * GROUP_FILES + F.when(within == "", 0).otherwise(within.cast("long"))
    return files.select(F.lit("all").alias("stream"), number.alias("file"), "content")


def _ranges(files: DataFrame, width: int, range_bytes: int) -> DataFrame:
    """``stream``, ``file``, ``range``, ``content``: the bytes of a file in pieces; bytes after the last whole identifier are left."""
    usable = F.length("content") - F.length("content") % width
    starts = F.when(usable > 0, F.sequence(F.lit(0), usable - 1, F.lit(range_bytes)))
    pieces = F.transform(starts, lambda at: F.substring(F.col("content"), at + 1, F.least(F.lit(range_bytes), usable - at)))
    cut = files.select(F.col("stream").cast("string").alias("stream"), F.col("file").cast("long").alias("file"), pieces.alias("pieces"))
    return cut.select("stream", "file", F.posexplode("pieces").alias("range", "content"))


def summaries(files: DataFrame, end: int, width: int = 2, block_tokens: int = BLOCK_TOKENS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A row for each block: ``n`` tokens, the places of its ``ends``, and of the ``last`` (null: none).
    A null content or file without tokens gives no block; bytes beyond the last whole identifier are ignored.
    A block ends where its range does."""
    blocks_a_range = -(-range_bytes // (width * block_tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stream, file, which, content in zip(*batch.columns, strict=True):
                raw = content.as_buffer()
                ids = np.frombuffer(raw, f"<u{width}", len(raw) // width)
                rows = []
                for block, at in enumerate(range(0, len(ids), block_tokens)):
                    part = ids[at : at + block_tokens]
                    ends = np.flatnonzero(part == end)
                    rows.append((stream.as_py(), file.as_py(), which.as_py() * blocks_a_range + block, len(part), int(ends[-1]) if len(ends) else None, ends))
                types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                columns = zip(*rows, strict=True) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["stream", "file", "block", "n", "last", "ends"])

    return _ranges(files, width, range_bytes).mapInArrow(run, "stream string, file long, block long, n long, last long, ends array<long>")


def _scanned(rows: DataFrame, keys: list[str], order: str, n: str, last: str, offset: str, before: str) -> DataFrame:
    """Exclusive prefix scan: ``offset``, the tokens before a row, and ``before``, the place of the last end before it."""
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(offset, F.coalesce(F.sum(n).over(earlier), F.lit(0)))
    return rows.withColumn(before, F.max(F.col(offset) + F.col(last)).over(earlier))


def _summed(rows: DataFrame, keys: list[str], n: str, last: str, offset: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum(n).alias("n"), F.max(F.col(offset) + F.col(last)).alias("last"))


def documents_of(files: DataFrame, end: int, width: int = 2, block_tokens: int = BLOCK_TOKENS, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``stream``, ``file`` and ``block`` where the document's end was found, ``start`` (token of the stream at which
    it begins), ``n_tokens`` (without the end), ``ended`` (false: the stream stops inside it)."""
    group = F.floor(F.col("file") / GROUP_FILES).alias("group")
    blocks = stage(summaries(files, end, width, block_tokens, range_bytes), "summaries").select("*", group)
    blocks = _scanned(blocks, ["stream", "file"], "block", "n", "last", "offset", "before")
    per_file = _summed(blocks, ["stream", "group", "file"], "n", "last", "offset")
    per_file = _scanned(per_file, ["stream", "group"], "file", "n", "last", "file_offset", "file_before")
    per_group = _summed(per_file, ["stream", "group"], "n", "last", "file_offset")
    per_group = _scanned(per_group, ["stream"], "group", "n", "last", "group_offset", "group_before")
    groups = per_group.select(F.col("stream").alias("gs"), F.col("group").alias("gg"), "group_offset", "group_before")
    per_file = per_file.join(groups, F.expr("stream <=> gs and group <=> gg"))
    per_file = per_file.select(
        F.col("stream").alias("s"), F.col("file").alias("f"), (F.col("group_offset") + F.col("file_offset")).alias("file_offset"),
        F.coalesce(F.col("group_offset") + F.col("file_before"), "group_before").alias("file_before"),
    )
    joined = blocks.join(per_file, F.expr("stream <=> s and file <=> f"))
    start = F.coalesce(F.col("file_offset") + F.col("before"), F.col("file_before"), F.lit(-1)) + 1
    at = F.col("file_offset") + F.col("offset")
    closed = joined.select("stream", "file", "block", start.alias("from"), at.alias("at"), "ends", F.posexplode("ends").alias("k", "end"))
    begins = F.when(F.col("k") == 0, F.col("from")).otherwise(F.col("at") + F.get("ends", F.col("k") - 1) + 1)
    closed = closed.select("stream", "file", "block", begins.alias("start"), (F.col("at") + F.col("end") - begins).alias("n_tokens"), F.lit(True).alias("ended"))
    edge = F.col("group_offset")
    tails = per_group.groupBy("stream").agg(F.max(edge + F.col("n")).alias("all"), F.max(edge + F.col("last")).alias("last"))
    last_file = blocks.groupBy("stream").agg(F.max("file").alias("file")).select(F.col("stream").alias("s"), "file")
    tails = tails.join(last_file, F.expr("stream <=> s"))
    tail_start = F.coalesce(F.col("last") + 1, F.lit(0))
    open_ = tails.select("stream", "file", F.lit(None).cast("long").alias("block"), tail_start.alias("start"), (F.col("all") - tail_start).alias("n_tokens"), F.lit(False).alias("ended"))
    return closed.union(open_.where("n_tokens > 0"))
