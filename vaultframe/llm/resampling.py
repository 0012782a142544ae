"""Importance resampling towards a target distribution, with exact ranks by regular sampling.

Weights: a text's features are its runs of 1 to 3 words, hashed into buckets; a
bucket's gain compares its share in the target texts with its share in the documents, and a
text's weight is the sum of its features' gains. Corpus counts are arrays of one number a
bucket, added up in every task and then over the tasks; only these arrays reach the driver.
Hashes of runs come from the words' hashes by arithmetic on whole arrays: the CRC of two strings
end to end is that of the first, moved on by the second's length, xor that of the second.

Draw: a Gumbel number from the id's hash is added to the weight and the highest scores
are drawn, which draws without replacement in proportion to the exponentiated weights.

Ranks: parallel sorting by regular sampling. Each partition of the scored rows is sorted where it lies (a run). Rows at
regular distances in the runs are gathered, and every so many of them is a splitter. Each run is
cut at the splitters, the pieces of one segment meet in one task and are merged, and the rows in
all segments before give the rank of a segment's first row. Splitters order whole rows
(score, id, and the row's number last), so equal scores can't make a segment heavy.
Segments wholly behind the last drawn row are not exchanged.

Null and blank texts have no features and weight 0. A null id is hashed as an empty one and
ranks before others of its score. Repeated rows are separate documents with ranks of their own. Without target texts, or
without documents, counts are 0 and the formulas hold. No rows give no rows; other columns are
ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultframe.llm.terms import LOWER_SQL, WORD_SQL, pieces, texts_of
from vaultframe.session import stage

BUCKETS = 10_000
MOST_WORDS = 3
LEAST_WORDS = 20
RUN_WORDS = 150_000
SEGMENT_ROWS = 200_000
MOST_SEGMENTS = 8192  # beyond it segments grow; a segment is sorted with spilling, so memory does not
SAMPLES = 8  # regular samples for each splitter
SPACE = np.uint32(zlib.crc32(b" "))
SHORT = 64


class WordCrcs(dict):
    """CRCs of words, remembered up to a bound."""

    MOST = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = zlib.crc32(word)
        return value


class Moves:
    """Moves CRCs on by a number of bytes: tables for 0 to 63 bytes and for 64 times the powers of two."""

    def __init__(self) -> None:
        byte = np.arange(256, dtype=np.uint32)
        one = byte.copy()
        for _ in range(8):
            one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1)  # the reflected CRC-32 polynomial
        steps = [np.stack([byte << np.uint32(8 * k) for k in range(4)])]
        for _ in range(SHORT):
            steps.append((steps[-1] >> np.uint32(8)) ^ one[steps[-1] & np.uint32(255)])
        self.short = np.stack(steps[:SHORT])
        self.long = [steps[SHORT]]
        for _ in range(25):
            self.long.append(self._apply(self.long[-1], self.long[-1]))

    @staticmethod
    def _apply(table: np.ndarray, crcs: np.ndarray) -> np.ndarray:
        low = np.uint32(255)
        return table[0][crcs & low] ^ table[1][crcs >> np.uint32(8) & low] ^ table[2][crcs >> np.uint32(16) & low] ^ table[3][crcs >> np.uint32(24)]

    def by_one(self, crcs: np.ndarray) -> np.ndarray:
        return self._apply(self.short[1], crcs)

    def by(self, crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        low, rest = np.uint32(255), lengths % SHORT
        flat = self.short.reshape(-1)
        at = rest.astype(np.intp) << 10
        out = flat[at + (crcs & low)] ^ flat[at + 256 + (crcs >> np.uint32(8) & low)]
        out ^= flat[at + 512 + (crcs >> np.uint32(16) & low)] ^ flat[at + 768 + (crcs >> np.uint32(24))]
        far = np.flatnonzero(lengths >= SHORT)
        for k, table in enumerate(self.long if len(far) else []):
            some = far[(lengths[far] // SHORT) >> k & 1 == 1]
            out[some] = self._apply(table, out[some])
        return out


class Features:
    """Turns texts into arrays of bucket numbers, a run of texts at a time."""

    def __init__(self) -> None:
        self.known, self.moves = WordCrcs(), Moves()

    def runs(self, texts: Iterator[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
        """Runs of (text number, whether the word is new, for n = 1, 2, 3 the bucket of the n words that end here, -1: none)."""
        words: list[bytes] = []
        owner: list[int] = []
        sizes: list[int] = []
        fresh: list[int] = []
        for number, text in enumerate(texts):
            before: list[bytes] = []
            for part in pieces(text):
                words += before
                words += part
                owner.append(number), sizes.append(len(before) + len(part)), fresh.append(len(part))
                before = (before + part)[1 - MOST_WORDS :]
                if len(words) >= RUN_WORDS:
                    yield self._run(words, owner, sizes, fresh)
                    words, owner, sizes, fresh = [], [], [], []
        if words:
            yield self._run(words, owner, sizes, fresh)

    def _run(self, words: list[bytes], owner: list[int], sizes: list[int], fresh: list[int]) -> tuple:
        total = len(words)
        crcs = np.fromiter(map(self.known.__getitem__, words), np.uint32, total)
        lengths = np.fromiter(map(len, words), np.int64, total)
        starts = np.cumsum([0, *sizes[:-1]])
        place = np.arange(total) - np.repeat(starts, sizes)
        new = place >= np.repeat(np.array(sizes) - np.array(fresh), sizes)
        out, grams = [], crcs
        for n in range(1, MOST_WORDS + 1):
            if n > 1:
                before = self.moves.by_one(grams[:-1]) ^ SPACE
                grams = np.concatenate([np.zeros(1, np.uint32), self.moves.by(before, lengths[1:]) ^ crcs[1:]])
            buckets = (grams % np.uint32(BUCKETS)).astype(np.int64)
            out.append(np.where(new & (place >= n - 1), buckets, -1))
        return np.repeat(np.array(owner), sizes), new, out


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all ``text`` in every bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, grams in features.runs(texts_of(batch["text"])):
                for buckets in grams:
                    total += np.bincount(buckets + 1, minlength=BUCKETS + 1)[1:]
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], ["bucket", "n"])

    rows = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(BUCKETS, np.int64)
    for row in rows:  # one for each bucket at most
        counts[row["bucket"]] = row["n"]
    return counts


def gains(of_target: np.ndarray, of_documents: np.ndarray) -> np.ndarray:
    most_target, most_documents = int(of_target.sum()), int(of_documents.sum())
    pairs = zip(of_target.tolist(), of_documents.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1) * (most_documents + BUCKETS) / ((s + 1) * (most_target + BUCKETS)))) for t, s in pairs], np.int64)


def gumbel(doc_id: object, seed: int) -> int:
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: np.ndarray, seed: int = 42) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, gain = Features(), np.append(shared.value, 0)
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for owner, new, grams in features.runs(texts_of(batch["text"])):
                gained = gain[grams[0]] + gain[grams[1]] + gain[grams[2]]
                number = sum((buckets >= 0).astype(np.int64) for buckets in grams)
                edges = np.flatnonzero(np.diff(owner, prepend=-1))
                for total, values in ((n_words, new), (n_features, number), (weight, gained)):
                    total[owner[edges]] += np.add.reduceat(values, edges, dtype=np.int64)
            noise = [gumbel(x.as_py(), seed) for x in batch["doc_id"]]
            columns = [pa.array(x) for x in (n_words, n_features, weight, weight + np.array(noise, np.int64))]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def _key(score: int, doc_id: object, at: int) -> tuple:
    """Python's order of rows; Spark's is ``score`` descending, ``doc_id`` with nulls first, ``at``."""
    return -score, doc_id is not None, doc_id, at


def _splitters(runs: DataFrame, gap: int) -> list[tuple]:
    """Keys at regular distances of the sorted runs, every ``SAMPLES``-th of them."""
    kind = runs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = gap // 2
        for batch in batches:
            places = np.arange(-passed % gap, batch.num_rows, gap)
            passed += batch.num_rows
            yield batch.take(pa.array(places))

    taken = runs.select("score", "doc_id", "at").mapInArrow(run, f"score long, doc_id {kind}, at long").collect()
    return sorted(_key(*row) for row in taken)[SAMPLES // 2 :: SAMPLES]


def _cut(runs: DataFrame, splitters: list[tuple]) -> DataFrame:
    """``segment`` of each row: the number of splitters up to it, found by bisecting each batch of a sorted run."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema)
    shared = runs.sparkSession.sparkContext.broadcast(splitters)  # MOST_SEGMENTS keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        for batch in batches:
            score, ids, at = batch["score"], batch["doc_id"], batch["at"]

            def key(k: int) -> tuple:
                return _key(score[k].as_py(), ids[k].as_py(), at[k].as_py())  # noqa: B023

            segment = np.zeros(batch.num_rows, np.int32)
            first = bisect.bisect_right(marks, key(0)) if batch.num_rows else 0
            last = bisect.bisect_right(marks, key(batch.num_rows - 1)) if batch.num_rows else 0
            for mark in marks[first:last]:
                segment[bisect.bisect_left(range(batch.num_rows), mark, key=key) :] += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment + np.int32(first))], [*batch.schema.names, "segment"])

    return runs.mapInArrow(run, f"{schema}, segment int")


def ranked(rows: DataFrame, drawn: int, total: int) -> DataFrame:
    """``rows`` (with ``score``, ``doc_id``, ``at``, ``of_age``) with ``rank`` of the ``drawn`` first of the ``total`` of age."""
    none = F.lit(None).cast("long").alias("rank")
    left_out = rows.where("not of_age").select("*", none)
    if not drawn:
        return rows.select("*", none)
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("at")]
    runs = rows.where("of_age").sortWithinPartitions(*order)
    parallel = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = min(MOST_SEGMENTS, max(-(-total // SEGMENT_ROWS), -(-parallel * total // drawn)))
    cut = stage(_cut(runs, _splitters(runs, max(1, total // (segments * SAMPLES)))), "segments")
    sizes = sorted((r["segment"], r["n"]) for r in cut.groupBy("segment").agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for segment, n in sizes:  # prefix counts
        if before < drawn:
            starts.append((segment, before))
        before += n
    last = starts[-1][0]
    offsets = rows.sparkSession.createDataFrame(starts, "segment int, before long")
    within = F.row_number().over(Window.partitionBy("segment").orderBy(*order))
    merged = cut.where(F.col("segment") <= last).withColumn("place", within).join(F.broadcast(offsets), "segment")
    place = F.col("place") + F.col("before")
    merged = merged.select(*rows.columns, F.when(place <= drawn, place).alias("rank"))
    return merged.union(cut.where(F.col("segment") > last).select(*rows.columns, none)).union(left_out)


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (5, 100), seed: int = 42, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null: not drawn) of every document.

    Draws ``share`` of the documents of ``least_words`` or more, like those of ``target``.
    """
    gain = gains(bucket_counts(target), bucket_counts(docs))
    rows = weighed(docs, gain, seed).withColumn("of_age", F.col("n_words") >= least_words).drop("n_words")
    rows = stage(rows.withColumn("at", F.monotonically_increasing_id()), "weighed")
    total = rows.where("of_age").count()
    return ranked(rows, share[0] * total // share[1], total).select("doc_id", "n_features", "weight", "score", "rank")


#: The CRC byte by byte, continued from a word to the words after it.
SQL = rf"""
with crc_table as (
  select list(v order by n) as t from (
    select n, list_reduce([n::bigint] || [0::bigint for i in range(8)],
      lambda a, z: xor(a >> 1, case when a & 1 = 1 then 3988292384::bigint else 0::bigint end)) as v
    from range(256) r(n))),
texts as (
  select 's' as side, doc_id as id, regexp_extract_all({LOWER_SQL.format("text")}, '{WORD_SQL}') as w from documents
  union all
  select 't', item_id, regexp_extract_all({LOWER_SQL.format("text")}, '{WORD_SQL}') from benchmark),
starts as (select side, id, unnest(w) as a, unnest(w[2:]) as b, unnest(w[3:]) as c from texts),
spelled as (
  select word, [('0x' || substr(h, 2 * i + 1, 2))::bigint for i in range(len(h) // 2)] as bytes
  from (select distinct a as word, hex(a) as h from starts where a is not null)),
one as (select word, bytes, list_reduce([4294967295::bigint] || bytes, lambda r, x: xor(r >> 8, t[(xor(r, x) & 255) + 1])) as r from spelled, crc_table),
pairs as (
  select a, b, list_reduce([one.r, 32::bigint] || two.bytes, lambda r, x: xor(r >> 8, t[(xor(r, x) & 255) + 1])) as r
  from (select distinct a, b from starts where b is not null) join one on a = one.word join one two on b = two.word, crc_table),
triples as (
  select a, b, c, list_reduce([pairs.r, 32::bigint] || one.bytes, lambda r, x: xor(r >> 8, t[(xor(r, x) & 255) + 1])) as r
  from (select distinct a, b, c from starts where c is not null) join pairs using (a, b) join one on c = one.word, crc_table),
features as (
  select side, id, xor(r, 4294967295::bigint) % 10000 as bucket from starts join one on a = word
  union all select side, id, xor(r, 4294967295::bigint) % 10000 from starts join pairs using (a, b)
  union all select side, id, xor(r, 4294967295::bigint) % 10000 from starts join triples using (a, b, c)),
counts as (select side, id, bucket, count(*) as n from features group by all),
sums as (
  select bucket, coalesce(sum(n) filter (side = 's'), 0)::bigint as s, coalesce(sum(n) filter (side = 't'), 0)::bigint as t
  from counts group by bucket),
gains as (
  select bucket, floor(1000 * ln(((t + 1) * (all_s + 10000))::double / ((s + 1) * (all_t + 10000))::double))::bigint as gain
  from sums, (select sum(s)::bigint as all_s, sum(t)::bigint as all_t from sums)),
weights as (
  select id, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight
  from counts join gains using (bucket) where side = 's' group by id),
scored as (
  select doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    len(w) >= 20 as of_age,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::bigint + 0.5)::double / 4294967296)))::bigint as score
  from documents left join weights on doc_id = weights.id left join (select id, w from texts where side = 's') x on doc_id = x.id),
drawn as (
  select doc_id, row_number() over (order by score desc, doc_id) as place, (5 * count(*) over ()) // 100 as quota
  from scored where of_age)
select scored.doc_id, n_features, weight, score, case when place <= quota then place end as rank
from scored left join drawn using (doc_id)
"""
