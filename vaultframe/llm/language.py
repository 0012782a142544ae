"""Language ID: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

Subwords are the windows of two, three and four bytes of a word with its edges
(ASCII lower-cased, ASCII non-letters count as edges), hashed into ``BUCKETS``
rows. A text is the mean of its subwords' embeddings; a linear softmax over it
gives the languages. Training is on the driver, on a bounded sample of labelled
rows; a fifth of the sample calibrates: a temperature by least log loss, and a
rejection threshold that turns away at most ``TURNED_AWAY`` of the rightly named.

Whole texts are scored, in slices, with the embeddings already multiplied by the
softmax weights. A null text or one without a letter is ``und`` with score 0 and
is rejected, as is every text if nothing could be learned. Repeated rows stay,
other columns are ignored, no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultframe.llm.common import packed, unpacked

BUCKETS = 1 << 15
WIDTHS = (2, 3, 4)
DIMENSIONS = 16
SAMPLE_ROWS = 3000
TRAIN_SUBWORDS = 600  # drawn from each training text
EPOCHS = 6
LEAST_STEPS = 400  # so that few labelled texts are gone over more often
BATCH = 32
RATE = 4.0
TURNED_AWAY = 0.001
SLICE = 1 << 20
UNDETERMINED = "und"
_EDGES = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


@dataclass(frozen=True)
class Model:
    """``table``: score of each language for each bucket; ``bias``; ``temperature``; ``threshold`` of the top score."""

    langs: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def has_letter(text: bytes) -> bool:
    plain = text.translate(_EDGES).replace(b" ", b"")
    if any(97 <= b <= 122 for b in plain[:64]):
        return True
    return any(c.isalpha() for c in plain.decode("utf-8", "ignore"))


def subwords(text: bytes) -> Iterator[np.ndarray]:
    """Bucket numbers of a text's subwords, slice by slice."""
    whole = b" " + text.translate(_EDGES) + b" "
    for at in range(0, len(whole), SLICE):
        part = np.frombuffer(whole, np.uint8, min(SLICE + max(WIDTHS) - 1, len(whole) - at), at).astype(np.uint32)
        edge = part == 32
        for width in WIDTHS:
            n = min(SLICE, len(part) - width + 1)
            if n <= 0:
                continue
            code = np.full(n, width, np.uint32)
            bad = edge[:n] & edge[width - 1 : width - 1 + n]
            for k in range(width):
                code = code * np.uint32(0x01000193) ^ part[k : k + n]
                if 0 < k < width - 1:
                    bad |= edge[k : k + n]
            code ^= code >> np.uint32(15)
            yield (code % np.uint32(BUCKETS))[~bad]


def text_scores(text: bytes, table: np.ndarray) -> np.ndarray:
    """Mean score of each language over a text's subwords."""
    total, count = np.zeros(table.shape[1]), 0
    for codes in subwords(text):
        total += table[codes].sum(0, dtype=np.float64)
        count += len(codes)
    return total / max(1, count)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(rows: list[tuple[bytes, str]], seed: int = 5) -> Model | None:
    """None if there is nothing to learn from."""
    rows = [r for r in rows if has_letter(r[0])]
    langs = tuple(sorted({lang for _, lang in rows}))
    if not langs:
        return None
    if len(langs) == 1:
        return Model(langs, np.zeros((BUCKETS, 1), np.float32), np.zeros(1), 1.0, 0.0)
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(rows))
    held = max(1, len(rows) // 5)
    number = {lang: k for k, lang in enumerate(langs)}
    bags, truth = [], np.array([number[rows[k][1]] for k in order[held:]])
    for k in order[held:]:
        codes = np.concatenate([*subwords(rows[k][0])])
        bags.append(draw.choice(codes, TRAIN_SUBWORDS, replace=False) if len(codes) > TRAIN_SUBWORDS else codes)
    embed = draw.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    weights, bias = np.zeros((DIMENSIONS, len(langs)), np.float32), np.zeros(len(langs))
    steps = max(LEAST_STEPS, EPOCHS * (len(bags) + BATCH - 1) // BATCH)
    for step in range(steps):
        rate = RATE * (1 - step / steps)
        own = draw.integers(0, len(bags), BATCH)
        sizes = np.array([len(bags[k]) for k in own])
        codes, text = np.concatenate([bags[k] for k in own]), np.repeat(np.arange(BATCH), sizes)
        mean = np.add.reduceat(embed[codes], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0) / sizes[:, None]
        error = softmax(mean @ weights + bias)
        error[np.arange(BATCH), truth[own]] -= 1
        into = (error @ weights.T) / sizes[:, None]
        weights -= (rate / BATCH) * (mean.T @ error).astype(np.float32)
        bias -= (0.1 * rate / BATCH) * error.sum(0)
        np.subtract.at(embed, codes, (rate * into[text]).astype(np.float32))
    table = embed @ weights
    scores = np.array([text_scores(rows[k][0], table) + bias for k in order[:held]])
    right = np.array([number[rows[k][1]] for k in order[:held]])
    heats = np.geomspace(0.1, 10, 41)
    losses = [-np.log(np.maximum(softmax(scores / h)[np.arange(held), right], 1e-12)).mean() for h in heats]
    heat = float(heats[int(np.argmin(losses))])
    p = softmax(scores / heat)
    sure = p.max(1)[p.argmax(1) == right]
    threshold = float(np.quantile(sure, TURNED_AWAY, method="lower")) * 0.9 if len(sure) else 0.0
    return Model(langs, table.astype(np.float32), bias, heat, min(threshold, 0.5))


def sample_ids(labelled: DataFrame, rows: int) -> DataFrame:
    """The ``rows`` pairs of id and language that come first by a hash of the id.

    A cut through the hashes leaves about twice as many before any are gathered, so what tasks send to the driver
    does not grow with the table.
    """
    ids = labelled.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    share = 2 * rows / max(1, ids.count())
    order = ("h", "doc_id", "lang")
    if share < 1:
        few = ids.where(F.col("h") < int(-(2**63) + share * 2**64)).orderBy(*order).limit(rows)
        found = few.collect()
        if len(found) == rows:
            return labelled.sparkSession.createDataFrame(found, few.schema)
    return ids.orderBy(*order).limit(rows)


def learn(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """From ``doc_id``, ``text``, ``lang``: the ``rows`` labelled rows that come first by a hash of the id.

    Ids are chosen first and only their texts are fetched. Of a longer text, training takes ``TRAIN_SUBWORDS`` subwords
    drawn from all of it; prediction always reads all. Repeated rows of one id and language count as often as they are chosen,
    each time with one of the id's texts (the first by hash).
    """
    usable = labelled.where("lang is not null and text is not null").select("doc_id", F.encode("text", "UTF-8").alias("text"), "lang")
    chosen = sample_ids(usable, rows).groupBy(F.col("doc_id").alias("id"), F.col("lang").alias("l")).agg(F.count("*").alias("n"))  # ``rows`` rows at most
    found = usable.join(F.broadcast(chosen), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("lang") == F.col("l")))
    first = found.groupBy("doc_id", "lang", "n").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    taken = sorted(first.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"], r["lang"]))
    return train([(bytes(r["text"]), r["lang"]) for r in taken for _ in range(r["n"])])


def predicted(docs: DataFrame, model: Model | None, **carried: Column) -> DataFrame:
    """The carried columns with ``lang_pred``, ``score`` and ``rejected`` of each row's ``text``."""
    kept = docs.select(*[c.alias(n) for n, c in carried.items()], F.encode("text", "UTF-8").alias("__text"))
    fields = (model.langs, model.table, model.bias, model.temperature, model.threshold) if model else None
    shared = docs.sparkSession.sparkContext.broadcast(fields)  # BUCKETS rows, a number for each language

    names = [*carried, "lang_pred", "score", "rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value) if shared.value else None
        for batch in batches:
            langs, scores, rejected = [], [], []
            for x in batch.column(batch.num_columns - 1):
                text = x.as_py()
                if m is None or text is None or not has_letter(text):
                    langs.append(UNDETERMINED), scores.append(0.0), rejected.append(True)
                    continue
                p = softmax((text_scores(text, m.table) + m.bias) / m.temperature)
                best = int(p.argmax())
                langs.append(m.langs[best]), scores.append(float(p[best])), rejected.append(bool(p[best] < m.threshold))
            arrays = [*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = ", ".join(f"`{n}` {kept.schema[n].dataType.simpleString()}" for n in carried)
    return kept.mapInArrow(run, f"{schema}, lang_pred string, score double, rejected boolean")


def keep_named(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents whose language is recognised, with all their columns."""
    frame = packed(docs, text=F.col("text"))
    return unpacked(predicted(frame, model, row=F.col("row")).where("not rejected"))
