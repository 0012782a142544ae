"""Exact top-k, lexical search and importance resampling against brute force and awkward rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from vaultframe.llm import lexical, resampling, terms, topk

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, rank string, score string, at string, segment string, key string, term string"
ITEMS = "item_id long, text string, rank string, query string"
WORD = re.compile(terms.WORD_SQL)
TEXTS = [
    "the mit license and the rest", "the mit license and the rest", None, "", " \t\n", "one", "One TWO", "naïve café ☃ 12345 x_y",
    "spam " * 500, "x" * 300_000, " ".join(f"w{k % 700}" for k in range(60_000)), "İstanbul ß MIT", "¡ hola !", "a-b-c the license",
    "long" * 50 + " word " + "q" * 64 + " " + "r" * 63 + " " + "s" * 129,
]


def lower(text):
    return text.translate({k: k + 32 for k in range(65, 91)})


def words(text):
    return WORD.findall(lower(text or ""))


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(k, t, "r", "s", "a", "g", "k", "t") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[0], (None, TEXTS[0], *rows[0][2:])], DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(0, "The MIT license"), (1, None), (2, ""), (3, "w1 w2 w699 spam"), (0, "rest"), (None, "istanbul ß ☃"), (4, "nowhere found"), (5, "one one one")]
    return spark.createDataFrame([(*r, "r", "q") for r in rows], ITEMS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def null_first(value):
    return value is not None, value


def brute_search(docs, items, k=10):
    bags = [(d, Counter(words(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    total = sum(sum(b.values()) for _, b in bags)
    held = Counter(t for _, b in bags for t in b)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(words(text))
    out = []
    for item, own in asked.items():
        scores = []
        for d, bag in bags:
            m = 10 + 90 * sum(bag.values()) * len(bags) // total
            score = sum(math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * held[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m)) for t in own if t in bag)
            if score > 0:
                scores.append((-score, null_first(d), d))
        out += [(item, n + 1, d, -score) for n, (score, _, d) in enumerate(sorted(scores)[:k])]
    return out


def test_search_equals_brute_force(docs, benchmark, awkward, items):
    for frame, asked in ((docs, benchmark), (awkward, items), (docs.unionByName(docs.limit(50)), benchmark)):
        want = brute_search(rows_of(frame, "doc_id", "text"), rows_of(asked, "item_id", "text"))
        for vocabulary in (lexical.VOCABULARY, 7):
            if vocabulary == 7 and asked is benchmark:
                continue
            got = rows_of(lexical.search(frame, asked, vocabulary=vocabulary), "item_id", "rank", "doc_id", "score")
            assert sorted(got, key=str) == sorted(want, key=str)


def test_search_of_empty_tables(spark, nothing, items, docs):
    assert lexical.search(nothing, items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(docs, spark.createDataFrame([(1, None)], "item_id long, text string")).count() == 0


def test_block_search_skips_and_stays_exact():
    draw = np.random.default_rng(5)
    for trial in range(60):
        size = int(draw.integers(1, 9000))
        lists = []
        for _ in range(int(draw.integers(1, 9))):
            docs = np.flatnonzero(draw.random(size) < draw.choice([0.002, 0.05, 0.6])).astype(np.int32)
            if len(docs):
                lists.append((docs, draw.integers(1, draw.choice([3, 5000]), len(docs))))
        if not lists:
            continue
        total = np.zeros(size, np.int64)
        for docs, scores in lists:
            total[docs] += scores
        want = sorted((-s, d) for d, s in enumerate(total.tolist()) if s)[:10]
        best = lexical.Best(10)
        scored = lexical.search_block(lists, list(range(size)), best)
        assert [(-s, d) for s, d in best.rows] == want
        assert scored <= np.count_nonzero(total) or trial < 0
    hot = [(np.arange(50_000, dtype=np.int32), np.r_[np.full(2000, 900), np.full(48_000, 1)]), (np.arange(0, 50_000, 9000, dtype=np.int32), np.full(6, 40))]
    best = lexical.Best(10)
    assert lexical.search_block(hot, list(range(50_000)), best) <= 4096  # the other ranges are skipped


def test_words_in_pieces_are_the_whole_text():
    for text in TEXTS:
        raw = text.encode() if text is not None else None
        for size in (1, 50, 1 << 20):
            assert [w.decode() for part in terms.pieces(raw, size) for w in part] == words(text)


def test_run_hashes_are_crcs(monkeypatch):
    monkeypatch.setattr(resampling, "RUN_WORDS", 40)
    features = resampling.Features()
    got, want = Counter(), Counter()
    for owner, _, grams in features.runs(t and t.encode() for t in TEXTS):
        for buckets in grams:
            got.update((int(d), int(b)) for d, b in zip(owner, buckets, strict=True) if b >= 0)
    for number, text in enumerate(TEXTS):
        w = words(text)
        want.update((number, zlib.crc32(" ".join(w[k : k + n]).encode()) % 10000) for n in (1, 2, 3) for k in range(len(w) - n + 1))
    assert got == want


def brute_resample(docs, target, least=20):
    def buckets(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[k : k + n]).encode()) % 10000 for n in (1, 2, 3) for k in range(len(w) - n + 1)]

    own = [(d, len(words(t)), buckets(t)) for d, t in docs]
    s, t = Counter(b for _, _, bs in own for b in bs), Counter(b for _, x in target for b in buckets(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    rows = []
    for d, n, bs in own:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in bs)
        rows.append((d, n >= least, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    of_age = sorted((r for r in rows if r[1]), key=lambda r: (-r[4], null_first(r[0])))
    drawn = 5 * len(of_age) // 100
    ranks = {id(r): k + 1 for k, r in enumerate(of_age[:drawn])}
    return sorted(((r[0], *r[2:], ranks.get(id(r))) for r in rows), key=str)


def test_resampling_equals_brute_force(docs, benchmark, awkward, items, nothing):
    names = ["doc_id", "n_features", "weight", "score", "rank"]
    thrice = docs.unionByName(docs).unionByName(docs)
    for frame, target in ((docs, benchmark), (awkward, items), (thrice, benchmark), (docs, nothing)):
        got = sorted(rows_of(resampling.resample(frame, target), *names), key=str)
        assert got == brute_resample(rows_of(frame, "doc_id", "text"), rows_of(target, target.columns[0], "text"))
    assert resampling.resample(nothing, benchmark).count() == 0


def test_ranks_by_regular_sampling_with_ties(spark):
    draw = np.random.default_rng(2)
    rows = [(int(k), int(s), int(a), bool(o)) for k, s, a, o in zip(draw.integers(0, 40, 6000), draw.integers(0, 4, 6000), range(6000), draw.random(6000) < 0.9, strict=True)]
    frame = spark.createDataFrame(rows, "doc_id long, score long, at long, of_age boolean").repartition(7)
    order = sorted((r for r in rows if r[3]), key=lambda r: (-r[1], r[0], r[2]))
    for drawn in (0, 1, 777, len(order)):
        want = {r[2]: k + 1 for k, r in enumerate(order[:drawn])}
        got = {r["at"]: r["rank"] for r in resampling.ranked(frame, drawn, len(order)).collect()}
        assert len(got) == len(rows) and {k: v for k, v in got.items() if v is not None} == want


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string, range string")


def brute_top(rows, every=20, k=20):
    rows = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q in sorted({i for i, _ in rows if i % every == 0}):
        own = min(v for i, v in rows if i == q)
        scores = sorted((-sum(a * b for a, b in zip(own, v, strict=False)), i) for i, v in rows if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def top(frame, **options):
    return sorted(rows_of(topk.top_products(frame, **options), "query_id", "rank", "vec_id", "score"))


def test_top_products_equal_brute_force(spark, monkeypatch):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = brute_top(rows_of(table, "vec_id", "embedding"))
    assert top(table) == want
    for name, value in (("ROWS_PER_PIVOT", 40), ("RANGE_ROWS", 30), ("BLOCK_ROWS", 8), ("CHUNK_QUERIES", 9)):
        monkeypatch.setattr(topk, name, value)
    assert top(table) == want
    monkeypatch.setattr(topk, "SENT_BOUNDS", 0)
    assert top(table) == want


def test_top_products_of_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [nan, 1.0]), (3, [None, 1.0]), (20, [inf, 1.0]), (None, [1.0, 1.0]), (4, []), (5, [0.0, 0.0]), (6, [2.0]), (60, [])]
    rows += [(k, [1.0, -0.5]) for k in range(40, 80)] + [(40, [1.0, -0.5]), (40, [0.5, 0.5]), (7, [1.0, 2.0, 3.0])]
    assert top(vectors(spark, [(*r, "v", "g") for r in rows])) == brute_top(rows)
    huge = [(0, [1e7, 1e7]), (1, [1e7, -3.0]), (2, [2e7, 1e8]), (20, [1e7, 2e6])]
    assert top(vectors(spark, [(*r, "v", "g") for r in huge])) == brute_top(huge)
    beyond = [(0, [1e300, 1.0], "v", "g"), (1, [1e300, 2.0], "v", "g"), (3, [-1e300, 0.0], "v", "g")]
    assert top(vectors(spark, beyond)) == [(0, 1, 1, 2**63 - 1), (0, 2, 3, -(2**63))]
    for few in ([], [(0, [1.0], "v", "g")], [(1, [1.0], "v", "g")]):
        assert top(vectors(spark, few)) == []


def test_blocks_below_the_threshold_are_left_out():
    draw = np.random.default_rng(1)
    blocks = []
    for k in range(40):
        values = draw.integers(-3, 4, (50, 8)) + np.where(np.arange(8) == k % 8, 60, 0) * (1 if k < 8 else 0)
        blocks.append((np.arange(50 * k, 50 * k + 50), values, values.max(0), values.min(0)))
    query = np.where(np.arange(8) == 3, 50, 0)
    q, v, s, scored = topk.walk([query], np.array([-1]), np.array([-(2**63)]), blocks, 5)
    scores = [(-int(values[r] @ query), int(ids[r])) for ids, values, _, _ in blocks for r in range(50)]
    assert [(-a, b) for a, b in zip(s.tolist(), v.tolist(), strict=True)] == sorted(scores)[:5] and scored == 1
