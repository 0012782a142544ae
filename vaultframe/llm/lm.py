"""LM scoring by deleted interpolation of word n-gram estimates.

Model: P(w | v) = a(b) * c(v, w) / c(v) + u(b) * c(w) / N + z(b) / (V + 1), where b is
the bucket of the context's frequency c(v) (powers of two) and the three weights of
a bucket sum to 1. The weights are learned by expectation-maximisation on held-out
counts: one slice of the training documents is deleted from the counts, and its
tokens are explained with what is left. Scoring uses the counts of all training
documents.

Counts are gathered by request and answer (``blocks``): each block of documents
asks for its distinct words and word pairs and gets the corpus counts back. A
text's evidence - the counts of its words and pairs - is written to the shared
folder once; EM and scoring read it. For EM the evidence of the deleted slice is
summed on a fixed grid of ratios of the estimates (half powers of two), so the
driver gets a bounded table whatever the corpus; only the weights depend on the
grid, not the probabilities.

A text's tokens are its words, A-Z lower-cased, and one end; null and blank texts
are just the end. The end also stands before the first word. Words and pairs are
told apart by hashes of 64 and 48 bits. Repeated rows are separate texts, other
columns are ignored. Without training texts N = V = 0 and every token scores 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultframe.llm import blocks as B
from vaultframe.llm.common import remainder
from vaultframe.session import stage

FOLDS, HELD_OUT, DELETED = 7, 2, 3
END = np.array([0x9D39247E33776D41], np.uint64)
BUCKETS = 24
ROUNDS = 60
LEAST = 1e-6
EVIDENCE = "doc_id {kind}, part string, words array<int>, pairs array<int>, words_deleted array<int>, pairs_deleted array<int>, told array<long>"


def tokens_of(text: bytes | None, known: B.WordHashes) -> np.ndarray:
    return np.concatenate([B.hashes_of(text, known), END])


def pairs_of(tokens: np.ndarray) -> np.ndarray:
    return B.short_key(B.grams(np.concatenate([END, tokens]), 2))


def evidence(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``part`` ('train', 'deleted', 'held_out') -> a row for each document, and rows with
    ``part`` null that tell the number of words (``told``: distinct, all) of each key range."""
    n = B.block_count(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    dealt = docs.select("doc_id", F.encode("text", "UTF-8").alias("text"), "part", B.block_of(F.col("doc_id"), n).alias("block"))

    def ask(table: pa.Table) -> pa.Table:
        known, each, parts = B.WordHashes(), [], []
        for text, part in zip(table["text"], table["part"], strict=True):
            each.append(tokens_of(text.as_py(), known))
            parts.append(part.as_py())
        block, rows = table["block"][0].as_py(), []
        sizes = [len(x) for x in each]
        train = np.repeat([p != "held_out" for p in parts], sizes)
        deleted = np.repeat([p == "deleted" for p in parts], sizes)
        for offset, bits, keys in ((0, 64, np.concatenate(each)), (n, B.KEY_BITS, np.concatenate([pairs_of(x) for x in each]))):
            distinct, at = np.unique(keys, return_inverse=True)
            counts, marks = (np.bincount(at, x, len(distinct)).astype(np.int64) for x in (train, deleted))
            rows += [r | {"range": r["range"] + offset} for r in B.asks(block, n, distinct, counts, marks, bits)]
        return B.as_table(rows, B.ASK_ARROW)

    def tell(docs: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["doc_id", "part", "words", "pairs", "words_deleted", "pairs_deleted", "told"]
        types = [None, pa.string(), *[pa.list_(pa.int32())] * 4, pa.list_(pa.int64())]
        if not docs.num_rows:
            told = [B.unpack_counts(x.as_py()).tolist() for x, r in zip(answers["counts"], answers["range"], strict=True) if r.as_py() < n]
            nothing = [None] * len(told)
            columns = [pa.array(nothing, docs.schema.field("doc_id").type), *[pa.array(nothing, t) for t in types[1:-1]], pa.array(told, types[-1])]
            return pa.Table.from_arrays(columns, names)
        known = B.WordHashes()
        each = [tokens_of(x.as_py(), known) for x in docs["text"]]
        ends = np.cumsum([len(x) for x in each])[:-1]
        is_pair = np.array(answers["range"].to_numpy() >= n)
        found = []
        for keys, which in ((np.concatenate(each), ~is_pair), (np.concatenate([pairs_of(x) for x in each]), is_pair)):
            counts, marks = B.read_answers(answers.filter(pa.array(which)))
            at = np.unique(keys, return_inverse=True)[1]
            found += [np.split(np.minimum(counts[at], 2**31 - 1).astype(np.int32), ends), np.split(np.minimum(marks[at], 2**31 - 1).astype(np.int32), ends)]
        words, words_deleted, pairs, pairs_deleted = found
        parts = docs["part"].to_pylist()
        columns = [
            docs["doc_id"].combine_chunks(), pa.array(parts, pa.string()), pa.array(words, types[2]), pa.array(pairs, types[2]),
            *[pa.array([x if p == "deleted" else [] for x, p in zip(y, parts, strict=True)], types[2]) for y in (words_deleted, pairs_deleted)],
            pa.array([None] * len(parts), types[-1]),
        ]
        return pa.Table.from_arrays(columns, names)

    answered = B.answers(dealt.groupBy("block").applyInArrow(ask, B.ASK))
    told = dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(tell, EVIDENCE.format(kind=kind))
    return stage(told, "evidence")


def estimates(words: np.ndarray, pairs: np.ndarray, ends: int, all_words: int, distinct: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Pair, word and uniform estimates of a text's tokens, and the buckets of their contexts.
    A context's frequency is its count as a word; before the first word stands the end."""
    context = np.concatenate([[ends], words[:-1]])
    bucket = np.minimum(np.frexp(context)[1], BUCKETS - 1)
    return pairs / np.maximum(context, 1), words / max(all_words, 1), bucket, 1 / (distinct + 1)


def learned_weights(grid: np.ndarray) -> np.ndarray:
    """EM over rows of bucket, pair/uniform ratio, word/uniform ratio (half powers of two, -1 for nought), tokens."""
    weights = np.tile([0.4, 0.4, 0.2], (BUCKETS, 1))
    if len(grid):
        bucket, times = grid[:, 0].astype(int), grid[:, 3]
        ratio = np.stack([np.where(grid[:, k] < 0, 0.0, 2.0 ** ((grid[:, k] - 20) / 2)) for k in (1, 2)] + [np.ones(len(grid))], 1)
        for _ in range(ROUNDS):
            shares = weights[bucket] * ratio
            shares *= (times / shares.sum(1))[:, None]
            gained = np.stack([np.bincount(bucket, shares[:, k], BUCKETS) for k in range(3)], 1)
            seen = gained.sum(1) > 0
            weights[seen] = gained[seen] / gained[seen].sum(1, keepdims=True)
    weights[0] = [0, weights[0, 1] + weights[0, 0], weights[0, 2]]  # an unseen context has no pair estimate
    weights = np.maximum(weights, LEAST)
    return weights / weights.sum(1, keepdims=True)


def _grid(found: DataFrame, ends: int, ends_deleted: int, all_words: int, distinct: int) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, int] = {}
        for batch in batches:
            for row in batch.to_pylist():
                w, p, wd, pd = (np.array(row[k], np.int64) for k in ("words", "pairs", "words_deleted", "pairs_deleted"))
                pair, word, bucket, flat = estimates(w - wd, p - pd, ends - ends_deleted, all_words, distinct)
                with np.errstate(divide="ignore"):
                    cells = [np.where(x > 0, np.clip(np.round(2 * np.log2(x / flat)) + 20, 0, 200), -1).astype(np.int64) for x in (pair, word)]
                codes, times = np.unique((bucket * 256 + cells[0] + 1) * 256 + cells[1] + 1, return_counts=True)
                for code, n in zip(codes.tolist(), times.tolist(), strict=True):
                    total[code] = total.get(code, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array([*total], pa.int64()), pa.array([*total.values()], pa.int64())], ["code", "n"])

    rows = found.where("part = 'deleted'").drop("doc_id", "part", "told").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    return np.array([(r["code"] >> 16, (r["code"] >> 8 & 255) - 1, (r["code"] & 255) - 1, r["n"]) for r in rows], float).reshape(-1, 4)


def score(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of every text.

    Learns from the documents whose crc32(doc_id) modulo 7 is not 2; of these, remainder 3 is the deleted slice.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    fold = remainder(F.col("doc_id"), FOLDS)
    part = F.when(fold == HELD_OUT, "held_out").when(fold == DELETED, "deleted").otherwise("train")
    found = evidence(docs.select("doc_id", "text", part.alias("part")))
    totals = found.agg(F.sum(F.get("told", F.lit(0))), F.sum(F.get("told", F.lit(1)))).first()
    distinct, all_words = totals[0] or 0, totals[1] or 0
    texts = found.where("part is not null")
    lost = texts.agg(F.count_if(F.col("part") != "held_out"), F.count_if(F.col("part") == "deleted"), F.sum(F.when(F.col("part") == "deleted", F.size("words")))).first()
    ends, ends_deleted, words_deleted = lost[0] or 0, lost[1] or 0, lost[2] or 0
    weights = learned_weights(_grid(texts, ends, ends_deleted, all_words - words_deleted, distinct))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for words, pairs, part in zip(batch["words"], batch["pairs"], batch["part"], strict=True):
                w, p = (x.values.to_numpy(zero_copy_only=False).astype(np.int64) for x in (words, pairs))
                pair, word, bucket, flat = estimates(w, p, ends, all_words, distinct)
                mixed = weights[bucket]
                chance = mixed[:, 0] * pair + mixed[:, 1] * word + mixed[:, 2] * flat if all_words else np.ones(len(w))
                values = (part.as_py() == "held_out", len(w), int(np.count_nonzero(w)), float(np.log10((w + 1) / (all_words + distinct + 1)).sum()), float(np.log10(chance).sum()))
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            types = (pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            arrays = [pa.array(x, t) for x, t in zip(out, types, strict=True)]
            n = pa.array([all_words] * batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *arrays[:3], n, *arrays[3:]], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.select("doc_id", "part", "words", "pairs").mapInArrow(run, schema)
