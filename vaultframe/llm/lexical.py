"""Ranked lexical search over all documents: accumulators for short lists, skipping over long ones.

Index: documents are read in blocks; a block keeps, for each term that some query
asks for, the documents that hold it and how often, in document order. Corpus counts
(documents, terms, document frequencies) are sums over the blocks. Then each block answers every
query and passes on its best ``k``, and the best over all blocks are the answer.

Method within a block, the hybrid of term-at-a-time and document-at-a-time:

* Term at a time: the short lists of a query are added up into accumulators, which are
  then one more iterator in document order, with the largest sum as its bound.
* Document at a time over that iterator and the long lists: lists whose bounds together can't
  reach the ``k``-th best score found so far bring no candidate of their own. A range of
  documents whose range maxima can't reach it is skipped whole; in other ranges, candidates of the
  essential iterators are completed by probing the others, largest bound first, and dropped
  as soon as their bound falls below.

Pruning never drops a score equal to the ``k``-th, so ties by id are exact. The threshold goes
with a task from block to block.

Queries are read in groups of bounded vocabulary (``VOCABULARY``), one pass over the
index for each group, so what is sent to the tasks is bounded. Documents and queries without a
term find nothing; a document counts in the averages only if it has a term. Rows of one query id
are one query with the terms of all its texts. Repeated documents are found repeatedly. Null ids are
ids that sort first. Empty tables give no rows; other columns are ignored. Numbers beyond 64 bits
in a length's share are computed without overflow.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultframe.llm.terms import LOWER_SQL, WORD_SQL, pieces, texts_of
from vaultframe.session import stage

VOCABULARY = 400_000
RUN_WORDS = 150_000
BLOCK_POSTINGS = 1_500_000
BLOCK_DOCS = 100_000
#: A list is short up to this share of a block's documents.
SHORT_SHARE = 1 / 16
RANGE = 2048
INDEX = "docs long, words long, ids array<{kind}>, lengths binary, terms binary, starts binary, holders binary, times binary"


class Numbers(dict):
    """Numbers of the terms asked for, -1 for others; other words are remembered up to a bound."""

    MOST = 600_000

    def __init__(self, terms: list[bytes]) -> None:
        super().__init__((t, k) for k, t in enumerate(terms))
        self.terms = terms

    def __missing__(self, word: bytes) -> int:
        if len(self) >= len(self.terms) + self.MOST:
            self.clear()
            self.update((t, k) for k, t in enumerate(self.terms))
        self[word] = -1
        return self.get(word, -1)


def terms_of(texts: DataFrame, key: str) -> DataFrame:
    """``key`` and ``term`` (bytes), once each."""
    kind = texts.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, text in enumerate(texts_of(batch["text"])):
                for words in pieces(text):
                    own = sorted(set(words))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([number] * len(own))), pa.array(own, pa.binary())], ["key", "term"])

    found = texts.select(F.col(key).alias("key"), "text").mapInArrow(run, f"key {kind}, term binary")
    return found.distinct()


def indexed(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """The blocks: totals over all documents, and of those that hold an asked term their ids, lengths and lists."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = INDEX.format(kind=kind)
    names = [part.split()[0] for part in schema.split(", ")]
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # VOCABULARY terms at most, or one query's

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers(shared.value)
        block = _Block()
        for batch in batches:
            for number, text in enumerate(texts_of(batch["text"])):
                doc = block.start(batch["doc_id"][number])
                for words in pieces(text):
                    block.add(doc, np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                if block.full():
                    yield block.batch(batch.schema.field("doc_id").type, names)
                    block = _Block()
        if block.ids:
            yield block.batch(block.kind, names)

    return stage(docs.select("doc_id", "text").mapInArrow(run, schema), "index")


class _Block:
    def __init__(self) -> None:
        self.ids: list = []
        self.lengths: list[int] = []
        self.found: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.waiting: list[np.ndarray] = []
        self.held = self.postings = 0
        self.kind: pa.DataType = pa.null()

    def start(self, doc_id: pa.Scalar) -> int:
        self.kind = doc_id.type
        self.ids.append(doc_id.as_py())
        self.lengths.append(0)
        return len(self.ids) - 1

    def add(self, doc: int, numbers: np.ndarray) -> None:
        self.lengths[doc] += len(numbers)
        self.waiting.append(numbers[numbers >= 0] << 32 | doc)
        self.held += len(numbers)
        if self.held >= RUN_WORDS:
            self.settle()

    def settle(self) -> None:
        if self.waiting:
            found, times = np.unique(np.concatenate(self.waiting), return_counts=True)
            self.found.append(found), self.times.append(times)
            self.postings += len(found)
        self.waiting, self.held = [], 0

    def full(self) -> bool:
        return self.postings >= BLOCK_POSTINGS or len(self.ids) >= BLOCK_DOCS

    def batch(self, kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
        self.settle()
        found = np.concatenate([np.zeros(0, np.int64), *self.found])
        times = np.concatenate([np.zeros(0, np.int64), *self.times])
        order = np.argsort(found, kind="stable")
        found, times = found[order], times[order]
        first = np.flatnonzero(np.diff(found, prepend=-1))  # a long text may have come in several runs
        times, found = (np.add.reduceat(times, first), found[first]) if len(first) else (times, found)
        lengths = np.array(self.lengths, np.int64)
        holders, number = np.unique(found & 0xFFFFFFFF, return_inverse=True)
        terms, starts = np.unique(found >> 32, return_index=True)
        starts = np.append(starts, len(found))
        values = [
            [int(np.count_nonzero(lengths))], [int(lengths.sum())], [[self.ids[k] for k in holders]], [lengths[holders].tobytes()],
            [terms.astype(np.int32).tobytes()], [starts.astype(np.int64).tobytes()], [number.astype(np.int32).tobytes()], [np.minimum(times, 2**31 - 1).astype(np.int32).tobytes()],
        ]
        types = [pa.int64(), pa.int64(), pa.list_(kind), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)


def frequencies(index: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            for own, starts in zip(batch["terms"], batch["starts"], strict=True):
                total[np.frombuffer(own.as_py(), np.int32)] += np.diff(np.frombuffer(starts.as_py(), np.int64))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], ["term", "n"])

    rows = index.select("terms", "starts").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(terms, np.int64)
    for row in rows:  # one for each term of the group
        out[row["term"]] = row["n"]
    return out


def term_weights(held: np.ndarray, docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)


def damping(lengths: np.ndarray, docs: int, words: int) -> np.ndarray:
    """100 - 90 + (90 * n * N) div L."""
    if len(lengths) and 90 * int(lengths.max()) * docs >= 2**63:
        return np.array([10 + 90 * n * docs // words for n in lengths.tolist()], np.int64)
    return 10 + 90 * lengths * docs // max(words, 1)


class Lists:
    """The posting lists of a block with their score shares, computed when first asked for."""

    def __init__(self, row: dict, weights: np.ndarray, docs: int, words: int) -> None:
        self.ids = row["ids"]
        self.damped = 8 * damping(np.frombuffer(row["lengths"], np.int64), docs, words)
        self.place = {t: k for k, t in enumerate(np.frombuffer(row["terms"], np.int32).tolist())}
        self.starts = np.frombuffer(row["starts"], np.int64)
        self.holders = np.frombuffer(row["holders"], np.int32)
        self.times = np.frombuffer(row["times"], np.int32)
        self.weights, self.made = weights, {}

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray] | None:
        at = self.place.get(term)
        if at is None or not self.weights[term]:
            return None
        if term not in self.made:
            part = slice(self.starts[at], self.starts[at + 1])
            holders, times = self.holders[part], self.times[part].astype(np.int64)
            self.made[term] = holders, self.weights[term] * (1_000_000_000 * times // (1000 * times + self.damped[holders]))
        return self.made[term]


class Best:
    """The k best of a query: pairs of score and id; ``least`` is the score to reach."""

    def __init__(self, k: int) -> None:
        self.k, self.rows, self.least = k, [], 1

    def take(self, scores: np.ndarray, ids: list) -> None:
        rows = self.rows + list(zip(scores.tolist(), ids, strict=True))
        rows.sort(key=lambda r: (-r[0], r[1] is not None, r[1]))
        self.rows = rows[: self.k]
        if len(self.rows) == self.k:
            self.least = max(self.least, self.rows[-1][0])


def accumulated(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: short lists added up, in document order."""
    docs, at = np.unique(np.concatenate([d for d, _ in lists]), return_inverse=True)
    sums = np.zeros(len(docs), np.int64)
    np.add.at(sums, at, np.concatenate([s for _, s in lists]))
    return docs, sums


def search_block(lists: list[tuple[np.ndarray, np.ndarray]], ids: list, best: Best) -> int:
    """Brings the block's documents that belong to the best; returns the documents scored."""
    short = [x for x in lists if len(x[0]) <= max(64, SHORT_SHARE * len(ids))]
    long = [x for x in lists if len(x[0]) > max(64, SHORT_SHARE * len(ids))]
    iterators = ([accumulated(short)] if short else []) + long
    iterators.sort(key=lambda x: int(x[1].max()))
    for _, scores in iterators:  # any iterator's k-th share is a score that k documents reach
        if len(scores) >= best.k:
            best.least = max(best.least, int(np.partition(scores, -best.k)[-best.k]))
    edges = np.arange(0, len(ids) + RANGE, RANGE)
    cuts = [np.searchsorted(d, edges) for d, _ in iterators]
    most = np.zeros((len(iterators), len(edges) - 1), np.int64)
    for k, (_, scores) in enumerate(iterators):
        filled = np.flatnonzero(np.diff(cuts[k]))
        most[k, filled] = np.maximum.reduceat(scores, cuts[k][filled])
    scored = 0
    for r in np.argsort(-most.sum(0), kind="stable").tolist():  # promising ranges first
        upto = np.cumsum(most[:, r])
        if upto[-1] < best.least:
            break  # the ranges after it promise less
        first = int(np.searchsorted(upto, best.least))  # iterators before it can't reach the threshold together
        sums = np.zeros(RANGE, np.int64)
        for k in range(first, len(iterators)):
            part = slice(cuts[k][r], cuts[k][r + 1])
            sums[iterators[k][0][part] - edges[r]] += iterators[k][1][part]
        found = np.flatnonzero(sums)
        totals = sums[found]
        scored += len(found)
        for k in range(first - 1, -1, -1):
            alive = totals + upto[k] >= best.least
            found, totals = found[alive], totals[alive]
            docs, scores = (x[cuts[k][r] : cuts[k][r + 1]] for x in iterators[k])
            if not len(docs) or not len(found):
                continue
            at = np.minimum(np.searchsorted(docs, found + edges[r]), len(docs) - 1)
            totals = totals + np.where(docs[at] == found + edges[r], scores[at], 0)
        alive = totals >= best.least
        found, totals = found[alive], totals[alive]
        if len(totals) > best.k:
            alive = totals >= np.partition(totals, -best.k)[-best.k]
            found, totals = found[alive], totals[alive]
        best.take(totals, [ids[k] for k in (found + edges[r]).tolist()])
    return scored


def _answers(index: DataFrame, queries: list[list[int]], weights: np.ndarray, docs: int, words: int, k: int, kind: str) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        best = [Best(k) for _ in queries]
        field = None
        for batch in batches:
            field = batch.schema.field("ids").type.value_type
            for at in range(batch.num_rows):
                block = Lists(batch.slice(at, 1).to_pylist()[0], weights, docs, words)
                for own, terms in zip(best, queries, strict=True):
                    lists = [x for x in map(block.of, terms) if x is not None]
                    if lists:
                        search_block(lists, block.ids, own)
        rows = [(number, *row) for number, own in enumerate(best) for row in own.rows]
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int32(), pa.int64(), field), strict=True)], ["query", "score", "doc_id"])

    lists = index.drop("docs", "words")
    return lists.mapInArrow(run, f"query int, score long, doc_id {kind}")


def search(docs: DataFrame, queries: DataFrame, key: str = "item_id", k: int = 10, vocabulary: int = VOCABULARY) -> DataFrame:
    """``key``, ``rank`` (from 1), ``doc_id``, ``score`` of the ``k`` best documents with a score above 0 for each query."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    asked = stage(terms_of(queries, key), "asked")
    passes = max(1, -(-asked.count() // vocabulary))
    total = None
    for number in range(passes):
        rows = asked.where(F.pmod(F.xxhash64("key"), F.lit(passes)) == number).collect()  # about ``vocabulary`` rows
        if not rows:
            continue
        terms = sorted({bytes(r["term"]) for r in rows})
        place = {t: n for n, t in enumerate(terms)}
        own: dict = {}
        for row in rows:
            own.setdefault(row["key"], []).append(place[bytes(row["term"])])
        index = indexed(docs, terms)
        sums = index.agg(F.sum("docs"), F.sum("words")).first()
        n_docs, n_words = sums[0] or 0, sums[1] or 0
        weights = term_weights(frequencies(index, len(terms)), n_docs)
        found = _answers(index, list(own.values()), weights, n_docs, n_words, k, kind)
        order = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
        best = found.withColumn("rank", order).where(F.col("rank") <= k)
        schema = f"query int, `{key}` {queries.schema[key].dataType.simpleString()}"
        names = spark.createDataFrame(list(enumerate(own)), schema)
        part = best.join(F.broadcast(names), "query").select(key, "rank", "doc_id", "score")
        total = part if total is None else total.union(part)
    if total is None:
        return queries.select(key, F.lit(0).alias("rank"), F.lit(None).cast(kind).alias("doc_id"), F.lit(0).cast("long").alias("score")).where(F.lit(False))
    return total


SQL = rf"""
with words as (
  select doc_id, unnest(regexp_extract_all({LOWER_SQL.format("text")}, '{WORD_SQL}')) as term from documents),
counts as (select doc_id, term, count(*) as tf from words group by all),
lengths as (select doc_id, sum(tf)::bigint as n from counts group by doc_id),
totals as (select count(*)::bigint as docs, sum(n)::bigint as all_words from lengths),
dfs as (select term, count(*) as df from counts group by term),
asked as (select distinct item_id, term from (
  select item_id, unnest(regexp_extract_all({LOWER_SQL.format("text")}, '{WORD_SQL}')) as term from benchmark)),
scores as (
  select item_id, counts.doc_id,
    sum(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)))::bigint
      * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // all_words))))::bigint as score
  from asked join counts using (term) join dfs using (term) join lengths using (doc_id), totals
  group by item_id, counts.doc_id),
ranked as (select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
  from scores where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""
