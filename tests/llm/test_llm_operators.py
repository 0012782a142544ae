"""The training-data operators against brute force, the tokenizers library, and awkward rows."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from vaultframe.llm import bpe, jaccard, language, licenses, lm, mixing, neighbours, quality, queries, sharding, tokenfiles
from vaultframe.session import new_work_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, row string, n_tokens string, k string"
EN = "the license of this work is the mit license and nothing else was said about the rest of it at all"
FR = "le chat est sur la table et il ne veut pas descendre parce que la nuit est encore longue"
TEXTS = [
    EN, EN, EN + " today", FR, FR + " ici", None, "", " \t\n", "one two", "One TWO", "a b c", "naïve café ☃ <|endoftext|> 12345  x",
    "spam spam spam spam spam " * 40, "x" * 3000, "General Public License, Apache License: 2.0", "!!! ### $$$ %%% 1 2 3 4 5 6 7",
    "line one is here\nline one is here\nline two is there and it goes on", " ".join(f"w{i}" for i in range(4000)), "İstanbul ß",
]


@pytest.fixture(scope="module")
def awkward(spark):
    """Texts of every kind, one row repeated, and columns whose names the operators use inside."""
    lang = ["en", "en", "en", "fr", "fr"]
    rows = [(k, t, lang[k] if k < 5 else None, None if k % 4 == 3 else f"s{k % 3}", "r", "n", "k") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[0]], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def lower_words(text):
    table = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    return (text or "").encode().translate(table).split()


def oracle(sql, df):
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text").toPandas())
    found = con.sql(sql)
    return sorted(map(str, found.select(*sorted(found.columns)).fetchall()))


def ours(df):
    return sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def test_quality_rules_equal_sql_in_any_order(awkward, nothing):
    want = oracle(quality.SQL, awkward)
    assert ours(quality.judged(awkward)) == want
    assert ours(quality.judged(awkward, quality.OWN[::-1])) == want
    assert quality.judged(nothing).count() == 0


def test_quality_filter_keeps_what_no_rule_rejects(awkward, nothing):
    kept = quality.keep_good(awkward)
    assert kept.columns == awkward.columns
    judged = sorted(r["doc_id"] for r in quality.judged(awkward).where("kept").collect())
    assert sorted(r["doc_id"] for r in kept.collect()) == judged and {0, 17} <= set(judged)
    assert quality.keep_good(nothing).count() == 0


def test_quality_cascade_orders_by_rejection_per_cost(awkward):
    found = quality.measured(quality.with_words(awkward.select("text")), quality.BASE + quality.OWN)
    gains = [rejected / seconds for _, seconds, rejected in found]
    assert gains == sorted(gains, reverse=True)
    assert {rule.name for rule, _, _ in found} == {rule.name for rule in quality.BASE + quality.OWN}


def test_quality_cost_is_that_of_the_rule_and_not_of_the_job(docs):
    """A rule that does the same work many times costs more, and rejections are shares of the sample, not of its copies."""
    cheap = quality.Rule("cheap", lambda: F.size("words") < 100)
    dear = quality.Rule("dear", lambda: (sum((F.length(F.translate("text", c, "")) for c in "abcdefghijklmnop"), F.lit(0)) >= 0) & (F.size("words") < 100))
    sample = quality.with_words(docs.select("text"))
    few = sample.where(F.size("words") < 100).count() / sample.count()
    found = quality.measured(sample, (dear, cheap), copies=40)
    assert 0 < few < 1
    assert [rule.name for rule, _, _ in found] == ["cheap", "dear"]
    assert found[1][1] > 3 * found[0][1] and all(share == few for _, _, share in found)


def test_bpe_equals_the_tokenizers_library(awkward, docs, nothing):
    from tokenizers import Tokenizer

    path = queries.tokenizer_file()
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    for frame in (awkward, docs):
        want = []
        for doc_id, text in pairs(frame):
            ids = library.encode(text or "", add_special_tokens=False).ids
            decoded = library.decode(ids, skip_special_tokens=False)
            sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded)]
            want.append((doc_id, len(ids), *sha))
        got = [tuple(r) for r in bpe.encode_digests(frame, path).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
        assert sorted(got) == sorted(want)
    assert bpe.encode_digests(nothing, path).count() == 0
    assert all(r["decoded"] == (t or "") for r, (_, t) in zip(bpe.encode(awkward, path).collect(), pairs(awkward), strict=True))


def test_bpe_scan_and_heap_merge_alike():
    vocabulary = bpe.load_vocabulary(queries.tokenizer_file())
    draw = np.random.default_rng(1)
    for n in (1, 2, 9, 200):
        ids = [vocabulary.byte_ids[b] for b in draw.choice(list(b"aeithns "), n)]
        assert bpe.merge_scanning([*ids], vocabulary.merges) == bpe.merge_heaped([*ids], vocabulary.merges)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, v string, h string")


def test_neighbours_recall_and_scores(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    mine = {}
    for r in neighbours.nearest(table).collect():
        mine.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    want = dict(neighbours.exact(table))
    assert mine.keys() == want.keys()
    hits = sum(len({v for _, v in mine[q]} & set(w)) for q, w in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert all(sorted(k for k, _ in got) == [1, 2, 3, 4, 5] for got in mine.values())


def hits(table, **settings):
    mine = {}
    for r in neighbours.nearest(table, **settings).collect():
        mine.setdefault(r["query_id"], []).append(r["vec_id"])
    want = dict(neighbours.exact(table))
    assert mine.keys() == want.keys() and all(len(v) == 5 for v in mine.values())
    return sum(len({*mine[q]} & {*w}) for q, w in want.items()) / sum(map(len, want.values()))


def test_neighbours_recall_where_little_is_searched(spark):
    """20,000 vectors around 2,000 centres, in small buckets, leaves split by hash and queries in slices."""
    few = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    many = few.crossJoin(spark.range(10).withColumnRenamed("id", "copy"))
    moved = F.transform("embedding", lambda x: x + 0.05 * (F.pmod(F.xxhash64("vec_id", "copy", x), F.lit(1000)) / 1000 - 0.5))
    table = many.select((F.col("vec_id") * 10 + F.col("copy")).alias("vec_id"), moved.alias("embedding"))
    points = np.array([r["embedding"] for r in table.select("embedding").collect()])
    forest = neighbours.grow(points)
    sizes = np.bincount(neighbours.leaves_of(forest, points).ravel(), minlength=forest.ends[-1])
    reach = neighbours.measured_reach(neighbours._classes(neighbours.usable(table, "embedding"), 50, 5), forest, 5)
    searched = [sizes[neighbours.leaves_for(forest, sizes, q, reach, 6)].sum() for q in neighbours.unit(points[:200])]
    assert np.mean(searched) < 0.1 * len(points)
    assert hits(table) >= 0.9
    assert hits(table, chunk=20, asks=2) >= 0.9


def test_reach_is_where_the_queue_meets_a_vector():
    points = neighbours.unit(np.random.default_rng(1).standard_normal((3000, 12)))
    forest = neighbours.grow(points, trees=3)
    leaves = neighbours.leaves_of(forest, points)
    sizes = np.bincount(leaves.ravel(), minlength=forest.ends[-1])
    assert sizes.sum() == 3 * len(points) and all(part.sum() == len(points) for part in np.split(sizes, forest.ends[:-1]))
    for query, vector in zip(range(0, 40), range(100, 140), strict=True):
        need = neighbours.reach_of(forest, points[[query]], points[[vector]])[0]
        there = set(neighbours.leaves_for(forest, sizes, points[query], need * (1 + 1e-9), 1))
        before = set(neighbours.leaves_for(forest, sizes, points[query], need * (1 - 1e-9) - 1e-12, 0))
        assert there & {*leaves[vector]} and not before & {*leaves[vector]}


def test_buckets_hold_leaves_of_one_tree_and_no_more_than_a_chunk():
    sizes, ends = np.array([3, 4, 25, 1, 2, 9, 0, 5, 6]), np.array([4, 9])
    first, parts = neighbours.buckets_of(sizes, ends, 10)
    assert first.tolist() == [0, 0, 1, 4, 5, 6, 6, 7, 8] and parts.tolist() == [1, 1, 3, 1, 1, 1, 1, 1, 1]


def test_neighbours_of_awkward_vectors(spark):
    nan = float("nan")
    odd = [(1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [None, 1.0]), (50, [float("inf"), 1.0])]
    same = [(k, [1.0, 0.0]) for k in (0, 5, 6, 7, 8, 9, 10, 11)]
    got = neighbours.nearest(vectors(spark, [(k, v, "v", "h") for k, v in odd + same])).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(0, k + 1, v, 1.0) for k, v in enumerate((5, 6, 7, 8, 9))]
    assert neighbours.nearest(vectors(spark, [(0, [1.0, 0.0], "v", "h")])).count() == 0
    assert neighbours.nearest(vectors(spark, [])).count() == 0


def test_lm_base_score_and_held_out_gain(docs, awkward, nothing):
    for frame in (docs, awkward):
        rows = [(d, [*lower_words(t), None], zlib.crc32(str(d).encode()) % 7 == 2) for d, t in pairs(frame)]
        counts = Counter(w for _, ws, held in rows if not held for w in ws)
        total = sum(counts.values())
        bottom = total + len(counts) + 1
        want = sorted((d, held, len(ws), sum(counts[w] > 0 for w in ws), total, sum(math.log10((counts[w] + 1) / bottom) for w in ws)) for d, ws, held in rows)
        got = sorted((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in lm.score(frame).collect())
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert all(math.isclose(g[5], w[5], rel_tol=1e-9) for g, w in zip(got, want, strict=True))
        assert all(math.isfinite(g[6]) and g[6] < 0 for g in got)
        if frame is docs:
            assert sum(g[6] for g in got if g[1]) > sum(g[5] for g in got if g[1])
    assert lm.score(nothing).count() == 0


def brute_interpolation(rows):
    """Deleted interpolation in plain Python: rows of id, words and remainder."""
    texts = [(d, [*lower_words(t), None], f) for d, t, f in rows]
    words, pairs, gone, gone_pairs = Counter(), Counter(), Counter(), Counter()
    for _, ws, fold in texts:
        if fold != 2:
            words.update(ws), pairs.update(zip([None, *ws], ws, strict=False))
        if fold == 3:
            gone.update(ws), gone_pairs.update(zip([None, *ws], ws, strict=False))
    n_words, distinct, flat = sum(words.values()), len(words), 1 / (len(words) + 1)
    bucket = lambda n: min(math.frexp(n)[1], lm.BUCKETS - 1)
    cells = Counter()
    for _, ws, fold in texts:
        for v, w in zip([None, *ws], ws, strict=False) if fold == 3 else ():
            context = words[v] - gone[v]
            ratios = ((pairs[v, w] - gone_pairs[v, w]) / max(context, 1) / flat, (words[w] - gone[w]) / max(n_words - sum(gone.values()), 1) / flat)
            cells[bucket(context), *(2 ** (float(np.clip(np.round(2 * np.log2(r)), -20, 180)) / 2) if r > 0 else 0.0 for r in ratios)] += 1
    weights = {b: [0.4, 0.4, 0.2] for b in range(lm.BUCKETS)}
    for _ in range(lm.ROUNDS):
        gained = {}
        for (b, *ratios), n in cells.items():
            parts = [w * r for w, r in zip(weights[b], [*ratios, 1.0], strict=True)]
            for k in range(3):
                gained.setdefault(b, [0, 0, 0])[k] += n * parts[k] / sum(parts)
        weights |= {b: [x / sum(g) for x in g] for b, g in gained.items()}
    weights[0] = [0, weights[0][0] + weights[0][1], weights[0][2]]
    for b, w in weights.items():
        w = [max(x, lm.LEAST) for x in w]
        weights[b] = [x / sum(w) for x in w]
    out = []
    for d, ws, _ in texts:
        total = 0.0
        for v, w in zip([None, *ws], ws, strict=False):
            a, u, z = weights[bucket(words[v])]
            total += math.log10(a * pairs[v, w] / max(words[v], 1) + u * words[w] / max(n_words, 1) + z * flat)
        out.append((d, total))
    return sorted(out)


def test_lm_score_equals_plain_interpolation(docs, awkward):
    for frame in (docs, awkward):
        want = brute_interpolation([(d, t, zlib.crc32(str(d).encode()) % 7) for d, t in pairs(frame)])
        got = sorted((r["doc_id"], r["score"]) for r in lm.score(frame).collect())
        assert [d for d, _ in got] == [d for d, _ in want]
        assert all(math.isclose(a, b, rel_tol=1e-6) for (_, a), (_, b) in zip(got, want, strict=True))


def test_token_files_give_every_document_back(spark, awkward):
    path = new_work_path(spark, "tokens")
    tokenfiles.write_token_files(awkward.repartition(3, "doc_id"), path, queries.tokenizer_file(), queries.END_OF_TEXT)
    files = tokenfiles.read_token_files(spark, path)
    no_special = bpe.load_vocabulary(queries.tokenizer_file())
    encoder = bpe.Encoder(bpe.Vocabulary(no_special.byte_ids, no_special.merges, no_special.token_bytes, {}))
    want = sorted(len(ids) for ids in encoder.encode_all([t for _, t in pairs(awkward)]))
    for block in (7, 1 << 20):
        found = tokenfiles.documents_of(files, queries.END_OF_TEXT, block_tokens=block).collect()
        assert sorted(r["n_tokens"] for r in found) == want
        starts = sorted((r["start"], r["n_tokens"]) for r in found)
        assert starts[0][0] == 0 and all(a + n + 1 == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))


def test_token_files_are_bounded_and_read_in_ranges(spark, docs, monkeypatch):
    monkeypatch.setattr(tokenfiles, "ROW_TOKENS", 1500)
    monkeypatch.setattr(tokenfiles, "FILE_ROWS", 3)
    path = new_work_path(spark, "tokens")
    tokenfiles.write_token_files(docs.repartition(3, "doc_id"), path, queries.tokenizer_file(), queries.END_OF_TEXT)
    files = tokenfiles.read_token_files(spark, path)
    assert files.select("file").distinct().count() == files.count() > 20
    want = sorted(r["n_tokens"] for r in bpe.encode_digests(docs, queries.tokenizer_file()).collect())
    for range_bytes, block in ((1 << 20, 1 << 20), (64, 7), (4096, 100)):  # files of many ranges, ranges of many blocks
        found = tokenfiles.documents_of(files, queries.END_OF_TEXT, block_tokens=block, range_bytes=range_bytes).collect()
        assert sorted(r["n_tokens"] for r in found) == want and all(r["ended"] for r in found)
        starts = sorted((r["start"], r["n_tokens"]) for r in found)
        assert starts[0][0] == 0 and all(a + n + 1 == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))


def test_token_scan_stitches_groups_of_files(spark, monkeypatch):
    monkeypatch.setattr(tokenfiles, "GROUP_FILES", 2)
    files = [[5, 5], [7], [0, 7, 7], [], [8], [8], [8, 0, 9]]
    rows = [("a", k, np.array(ids, "<u2").tobytes()) for k, ids in enumerate(files)]
    got = tokenfiles.documents_of(spark.createDataFrame(rows, "stream string, file long, content binary"), 0).select("start", "n_tokens", "ended").collect()
    assert sorted(map(tuple, got)) == [(0, 3, True), (4, 5, True), (10, 1, False)]


def test_token_scan_stitches_blocks_files_and_open_ends(spark):
    streams = {"a": [[5, 5, 0, 0, 7], [7, 7], [], [7, 0, 9]], "b": [[1, 2, 3]], "c": [[0]]}
    rows = [(s, k, np.array(ids, "<u2").tobytes()) for s, files in streams.items() for k, ids in enumerate(files)]
    files = spark.createDataFrame([*rows, ("d", 0, None)], "stream string, file long, content binary")
    want = [("a", 0, 2, True), ("a", 3, 0, True), ("a", 4, 4, True), ("a", 9, 1, False), ("b", 0, 3, False), ("c", 0, 0, True)]
    for block in (1, 2, 100):
        got = tokenfiles.documents_of(files, 0, block_tokens=block).select("stream", "start", "n_tokens", "ended").collect()
        assert sorted(map(tuple, got)) == want
    assert tokenfiles.documents_of(files.limit(0), 0).count() == 0


def brute_components(rows, like):
    sets = {}
    for k, (_, text) in enumerate(rows):
        w = lower_words(text)
        n = like.words
        sets[k] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and like.per * shared >= like.of * (len(sets[a]) + len(sets[b]) - shared):
                parent[root(a)] = root(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least[root(k)] = min(doc_id, least.get(root(k), doc_id))
    return sorted((doc_id, len(sets[k]), least[root(k)]) for k, (doc_id, _) in enumerate(rows))


@pytest.mark.parametrize("like", [jaccard.Likeness(3, 90, 100), jaccard.Likeness(5, 80, 100), jaccard.Likeness(2, 50, 100)])
def test_jaccard_join_equals_brute_force(docs, awkward, nothing, like):
    for frame in (docs, awkward):
        got = jaccard.joined(frame, like).select("doc_id", "n_shingles", "component_id").collect()
        assert sorted(map(tuple, got)) == brute_components(pairs(frame), like)
    assert jaccard.joined(nothing, like).count() == 0


def test_jaccard_join_of_long_texts_with_one_passage(spark):
    """Long unrelated texts share a rare passage: no links, and the join brings hardly a pair; a near copy of one is found."""
    draw = np.random.default_rng(8)
    passage = [f"p{k}" for k in range(60)]
    texts = [[f"w{n}" for n in draw.integers(0, 60, 2400)] for _ in range(30)]
    texts = [t[:900] + passage + t[900:] for t in texts]
    near = [*texts[3][:-40], *texts[4][:40]]
    rows = [(k, " ".join(t)) for k, t in enumerate([*texts, near])]
    like = jaccard.Likeness(1, 80, 100)  # single words: all texts are alike
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["component_id"] for r in jaccard.joined(frame, like).collect()} == {0}
    like = jaccard.Likeness(3, 80, 100)
    got = jaccard.joined(frame, like).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute_components(rows, like)
    assert [r["doc_id"] for r in got if r["doc_id"] != r["component_id"]] == [30]


def test_signatures_tell_long_sets_apart():
    draw = np.random.default_rng(4)
    for size in (100, 1000, 9000):
        a, b = (np.unique(draw.integers(0, 2**63, size).astype(np.uint64)) for _ in range(2))
        near = np.union1d(a[: -size // 20], b[: size // 20])
        differ = lambda x, y: sum(int(p ^ q).bit_count() for p, q in zip(*(jaccard.signature_of(z).view(np.uint64).tolist() for z in (x, y)), strict=True))
        assert differ(a, near) <= len(np.setxor1d(a, near)) < 0.222 * size < differ(a, b)
        wide, half = jaccard.signature_of(np.concatenate([a, b])), len(jaccard.signature_of(np.concatenate([a, b]))) // 2
        assert len(jaccard.signature_of(a)) in (half, 2 * half)
        if len(jaccard.signature_of(a)) == half:
            bits = np.unpackbits(wide.view(np.uint8))
            folded = np.packbits(bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]).view(np.int64)
            x = jaccard.B.mixed(np.concatenate([a, b])) & np.uint64(64 * half - 1)
            assert (np.unpackbits(folded.view(np.uint8)) == np.bincount(x.astype(np.int64), minlength=64 * half) % 2).all()


def test_one_document_of_each_group_stays(awkward, nothing):
    like = jaccard.Likeness(5, 80, 100)
    kept = jaccard.keep_one(awkward, like)
    assert kept.columns == awkward.columns
    want = sorted({d for d, n, c in brute_components(pairs(awkward), like) if d == c or not n})
    assert sorted(r["doc_id"] for r in kept.collect()) == want
    assert jaccard.keep_one(nothing, like).count() == 0


def test_sharding_law_groups_and_slots(docs, awkward, nothing):
    for frame, shards in ((docs, 24), (awkward, 5)):
        got = sharding.shard(frame, shards).collect()
        texts = pairs(frame)
        size = lambda t: len((t or "").encode()) + 8
        assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sorted((d, size(t), zlib.crc32((t or "").encode())) for d, t in texts)
        of, shard_of = dict(texts), {}
        for r in got:
            shard_of.setdefault(of[r["doc_id"]] or "", set()).add(r["shard"])
            assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        assert all(len(x) == 1 for x in shard_of.values())
        slots = {}
        for r in got:
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(nothing, 24).count() == 0


def test_longest_first_is_within_a_group_of_even():
    draw = np.random.default_rng(3)
    sizes = {f"g{k}": int(n) for k, n in enumerate(draw.integers(1, 1000, 400))}
    loads = Counter()
    for item, shard in sharding.longest_first(sizes, 24).items():
        loads[shard] += sizes[item]
    assert max(loads.values()) - min(loads.values()) <= 100


def test_language_held_out_accuracy(spark, docs):
    right = docs.select("doc_id", "lang")
    held = queries.op8_language_id(spark, SF).where("held_out").join(right, "doc_id").collect()
    assert held and sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in held)


def test_language_sample_is_that_of_the_whole_order(spark, docs):
    rows = [(k, "x", "en" if k % 3 else "fr") for k in range(5000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = [tuple(r) for r in frame.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).orderBy("h").limit(40).collect()]
    assert [tuple(r) for r in language.sample_ids(frame, 40).collect()] == want
    assert language.sample_ids(frame, 9000).count() == 5000


def test_language_of_awkward_rows(awkward, nothing):
    model = language.learn(awkward)
    got = {r["doc_id"]: r for r in language.predicted(awkward, model, doc_id=F.col("doc_id")).collect()}
    assert len(got) == len(TEXTS) and all(got[k]["lang_pred"] == "und" and got[k]["rejected"] for k in (5, 6, 7))
    assert (got[0]["lang_pred"], got[3]["lang_pred"]) == ("en", "fr")
    kept = language.keep_named(awkward, model)
    assert kept.columns == awkward.columns and {0, 3} <= {r["doc_id"] for r in kept.collect()}
    assert language.learn(nothing) is None
    assert language.keep_named(nothing, None).count() == 0
    assert {r["lang_pred"] for r in language.predicted(awkward, None, doc_id=F.col("doc_id")).collect()} == {"und"}


def test_license_scan_equals_sql(docs, awkward, nothing):
    for frame in (docs, awkward):
        assert ours(licenses.scan(frame).drop("detections")) == oracle(licenses.SQL, frame)
    row = licenses.scan(awkward).where("doc_id = 14").first()
    assert (row["base_labels"], row["n_base"], row["first_word"], row["last_word"]) == ("apache,gpl", 2, 0, 3)
    assert licenses.scan(nothing).count() == 0


def test_every_spelling_of_every_signature_is_found(spark):
    rows = []
    draw = np.random.default_rng(6)
    for k, signature in enumerate(licenses.SIGNATURES):
        found = sorted(licenses.spellings(signature.pattern.removeprefix("^").removesuffix("(?: |$)")))
        assert all(len(x.split()) <= licenses.SPAN for x in found)
        for x in found if len(found) <= 12 else draw.choice(found, 12, replace=False):
            rows.append((len(rows), f"xx {x} yy", k))
    rows += [(len(rows) + n, f"xx {x} yy", -1) for n, x in enumerate(("gplv3 license", "agplv3 license", "lgplv2 license"))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, k long")
    got = {r["doc_id"]: r["detections"] for r in licenses.scan(frame).collect()}
    assert len(rows) > 1500 and [t for d, t, _ in rows if not any(x["start"] == 1 for x in got[d])] == []


def test_mixing_meets_its_limit_and_loses_nothing(docs, awkward, nothing):
    for frame in (docs, awkward):
        target = mixing.Target(max_repeats=2.0)
        rows = mixing.mixed(frame, target).collect()
        words = {(r["doc_id"], r["source"]): r["n_words"] for r in frame.select("doc_id", "source", F.coalesce(mixing.n_words(), F.lit(0)).alias("n_words")).collect()}
        assert {(r["doc_id"], r["source"]) for r in rows} == set(words)
        used, there = Counter(), Counter()
        for r in rows:
            used[r["source"]] += r["n_tokens"]
        for r in frame.select("source", mixing.n_words().alias("n")).collect():
            there[r["source"]] += r["n"]
        assert all(there[s] <= used[s] <= 2 * there[s] for s in there)
        uses = Counter((r["doc_id"], r["source"], r["epoch"]) for r in rows)
        repeated = Counter((r["doc_id"], r["source"]) for r in frame.collect())
        assert all(n <= repeated[d, s] for (d, s, _), n in uses.items())
    assert mixing.mixed(nothing).count() == 0


def test_mixing_equals_a_replay_of_its_plan(spark, docs, monkeypatch):
    """Budget, epochs, block order and the cut replayed in Python from the documents alone."""
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 2000)
    target = mixing.Target(max_repeats=3.0)
    extra = docs.limit(40)  # repeated rows
    frame = docs.unionByName(extra).unionByName(docs.limit(3).withColumn("source", F.lit(None).cast("string")))
    rows = frame.select("doc_id", "source", mixing.n_words().alias("n"), F.pmod(F.xxhash64("doc_id", F.lit(mixing.SEED)), F.lit(mixing.CELLS)).alias("cell"))
    rows = [(r["doc_id"], r["source"], r["n"], r["cell"]) for r in rows.collect()]
    tokens = Counter()
    for _, s, n, _ in rows:
        tokens[s] += n
    named = {"null" if s is None else f"={s}": n for s, n in tokens.items()}
    _, w = mixing.solve(named, target)
    budget = mixing.budget_of(named, w, target)

    def hashes(values, columns):
        return [r["h"] for r in spark.createDataFrame(values, columns).coalesce(1).selectExpr(f"xxhash64({', '.join(c.split()[0] for c in columns.split(', '))}, {mixing.SEED}) AS h").collect()]

    want = Counter()
    for s, n in tokens.items():
        k = "null" if s is None else f"={s}"
        blocks = max(1, min(mixing.CELLS, math.ceil(n / mixing.BLOCK_TOKENS)))
        epochs = math.floor(w[k] * budget / n + 1e-9)
        rest = max(0, math.floor(w[k] * budget - epochs * n + 1e-6))
        own = [(d, m, c % blocks) for d, source, m, c in rows if source == s]
        sizes = Counter()
        for _, m, b in own:
            sizes[b] += m
        for d, _, _ in own:
            want.update({(d, s, e): 1 for e in range(epochs)})
        there = sorted(sizes)
        order = sorted(zip(hashes([(k, b, epochs) for b in there], "kind string, block int, epoch int"), there, strict=True))
        for _, b in order:
            if rest <= 0:
                break
            inside = [(d, m) for d, m, c in own if c == b]
            if rest >= sizes[b]:
                want.update((d, s, epochs) for d, _ in inside)
            else:
                turns = hashes([(d, epochs) for d, _ in inside], "doc_id long, epoch int")
                groups = Counter(zip(turns, inside, strict=True))
                used = 0
                for (_, (d, m)), times in sorted(groups.items()):
                    used += m * times
                    if used > rest:
                        break
                    want[d, s, epochs] += times
            rest -= sizes[b]
    got = Counter((r["doc_id"], r["source"], r["epoch"]) for r in mixing.mixed(frame, target).collect())
    assert got == want


def test_mixing_weights_follow_the_target():
    tokens = {"a": 900_000, "b": 90_000, "c": 10_000}
    alpha, w = mixing.solve(tokens, mixing.Target(max_repeats=None, entropy=0.8))
    assert 0 < alpha < 1 and math.isclose(-sum(x * math.log(x) for x in w.values()), 0.8, abs_tol=1e-9)
    target = mixing.Target(max_repeats=4.0)
    alpha, w = mixing.solve(tokens, target)
    budget = mixing.budget_of(tokens, w, target)
    assert math.isclose(max(w[k] * budget / n for k, n in tokens.items()), 4.0, rel_tol=1e-6) and math.isclose(sum(w.values()), 1)


def test_stages_on_awkward_and_empty_rows(spark, awkward, nothing):
    for frame in (awkward, nothing):
        for name, work in corpus_pipeline.STAGES:
            out = work(spark, frame, SF)
            assert name == "bpe" or out.columns == frame.columns
            assert out.count() <= 2 * frame.count()


def test_pipeline_equals_its_stages_by_hand(spark, docs):
    """Language and quality decide row by row; near copies and mixture are held against brute force."""
    named = language.keep_named(docs, language.learn(docs))
    good = quality.keep_good(named, quality.BASE + quality.OWN)
    rows = pairs(good)
    stay = {d for d, n, c in brute_components(rows, corpus_pipeline.NEAR_COPIES) if d == c}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == stay
    assert max(Counter(r["doc_id"] for r in got).values()) <= 2


def test_every_operator_is_registered():
    for n in range(1, 14):
        assert sum(key.startswith(f"op{n}_") for key in entry.queries()) == 1
    assert "pipeline" in entry.queries()
