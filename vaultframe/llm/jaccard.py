"""Set similarity join of documents on word shingles, with adaptive multi-match prefixes.

A set's shingles are put in one order for all documents, rarest first. Two sets of
the wanted similarity that both take a prefix of ``size - overlap + m`` shingles
share at least ``m`` of them. Each document chooses its own ``m`` by the estimated
cost of its candidates (postings to read, and candidates left to verify, at most
postings / m); a pair must share the smaller of the two numbers.

Steps, all exact but the first choice of links in 4:

1. Corpus frequencies of all shingles, by request and answer (``blocks``).
2. Documents with equal sets form a class with one representative.
3. Prefixes. A shingle that no other block or document has finds no partner and is
   not posted, so most documents post nothing.
4. Hubs: of the representatives that share a posted shingle with it, each is compared
   with that of fewest unique shingles (the middle of a group of near copies) among
   those it shares most with. The links found give first groups.
5. Pairs of different groups meet in the join on posted shingles, where shingles with the
   same holders (those of one shared passage) are one entry. In the join's condition a pair is dropped by size,
   by the shingles that no other document has, or by parity signatures that grow with the sets
   (sets differ in at least as many shingles as signatures in bits). What is left and shares
   enough is compared in full. Pairs inside one group need no comparison: they add nothing to
   the components.

Links are whole sets compared; classes, links and labels never leave Spark.

Words are runs of anything but ASCII white space, A-Z lower-cased; shingles are told
apart by 64-bit hashes. A text of fewer words than a shingle is one shingle; null
and blank texts have an empty set and stand alone. Repeated rows fall in one
class; rows of one id with different texts are linked as different texts.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultframe.llm import blocks as B
from vaultframe.llm.common import packed, unpacked
from vaultframe.llm.components import components
from vaultframe.session import stage

MOST_MATCHES = 6
LEAST_SIGNATURE = 4  # in words of 64 bits
SETS = (
    "doc_id {kind}, digest string, n_shingles long, uniques int, matches int, prefix array<long>, "
    "signature array<long>, shingles array<long>"
)


@dataclass(frozen=True)
class Likeness:
    """Sets link when ``per * intersection >= of * union``."""

    words: int = 5
    of: int = 80
    per: int = 100

    def overlap(self, size: int) -> int:
        """Shingles that a partner of a set of this size must share at least."""
        return -(-self.of * size // self.per)


def set_of(text: bytes | None, words: int, known: B.WordHashes) -> np.ndarray:
    hashes = B.hashes_of(text, known)
    if not len(hashes):
        return hashes
    return np.unique(B.grams(hashes, min(words, len(hashes))))


def digest_of(shingles: np.ndarray) -> str:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).hexdigest()


def signature_of(shingles: np.ndarray) -> np.ndarray:
    """Parities of the numbers of shingles in hash buckets, two to four buckets a shingle.

    The number of buckets is a power of two, so that xor of its halves is the signature of half the width.
    """
    bits = 64 * LEAST_SIGNATURE
    while bits < 2 * len(shingles):
        bits *= 2
    odd = np.bincount((B.mixed(shingles) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def chosen_prefix(shingles: np.ndarray, counts: np.ndarray, like: Likeness) -> tuple[int, np.ndarray]:
    """Number of matches asked for, and the shingles to post (those that others have)."""
    size = len(shingles)
    order = np.lexsort((shingles, counts))
    shortest = size - like.overlap(size) + 1
    reads = np.cumsum(counts[order] - 1)
    longest = min(MOST_MATCHES, size - shortest + 1)
    cost = [reads[shortest + m - 2] * (1 + size / (16 * m)) for m in range(1, longest + 1)]
    matches = int(np.argmin(cost)) + 1
    prefix = order[: shortest + matches - 1]
    return matches, shingles[prefix[counts[prefix] > 1]]


def sets(docs: DataFrame, like: Likeness) -> DataFrame:
    """A row for each document; prefix, signature and shingles only where something is posted, once a block and set."""
    n = B.block_count(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    words = like.words
    dealt = docs.select("doc_id", F.encode("text", "UTF-8").alias("text"), B.block_of(F.col("doc_id"), n).alias("block"))

    def ask(table: pa.Table) -> pa.Table:
        known = B.WordHashes()
        own = {digest_of(s): s for s in (set_of(x.as_py(), words, known) for x in table["text"]) if len(s)}
        if not own:
            return B.as_table([], B.ASK_ARROW)
        keys, counts = np.unique(B.short_key(np.concatenate([*own.values()])), return_counts=True)
        return B.as_table([*B.asks(table["block"][0].as_py(), n, keys, counts, None)], B.ASK_ARROW)

    def tell(docs: pa.Table, answers: pa.Table) -> pa.Table:
        known, done, rows = B.WordHashes(), set(), []
        own = [set_of(x.as_py(), words, known) for x in docs["text"]]
        keys = np.unique(B.short_key(np.concatenate(own))) if own else np.zeros(0, np.uint64)
        counts = B.read_answers(answers)[0] if own else None
        for s in own:
            digest = digest_of(s)
            row: tuple = (digest, len(s), None, None, None, None, None)
            if len(s) and digest not in done:
                done.add(digest)
                own_counts = counts[np.searchsorted(keys, B.short_key(s))]
                matches, prefix = chosen_prefix(s, own_counts, like)
                if len(prefix):
                    row = (digest, len(s), int((own_counts == 1).sum()), matches, prefix.view(np.int64), signature_of(s), s.view(np.int64))
            rows.append(row)
        longs = pa.list_(pa.int64())
        columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.int32(), longs, longs, longs))]
        names = ["doc_id", "digest", "n_shingles", "uniques", "matches", "prefix", "signature", "shingles"]
        return pa.Table.from_arrays([docs["doc_id"], *columns], names)

    answered = B.answers(dealt.groupBy("block").applyInArrow(ask, B.ASK)).where("block >= 0")
    return stage(dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(tell, SETS.format(kind=kind)), "sets")


def linked(pairs: DataFrame, posted: DataFrame, like: Likeness) -> DataFrame:
    """Of pairs ``a``, ``b`` of digests, those whose whole sets are alike enough."""
    x = posted.select(F.col("digest").alias("a"), F.col("shingles").alias("sa"))
    y = posted.select(F.col("digest").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(x, "a").join(y, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.where(like.per * shared >= like.of * (F.size("sa") + F.size("sb") - shared)).select("a", "b")


def _halved(signature: Column) -> Column:
    half = F.shiftright(F.size(signature), 1)
    return F.zip_with(F.slice(signature, F.lit(1), half), F.slice(signature, half + 1, half), lambda a, b: a.bitwiseXOR(b))


def _far_apart(like: Likeness) -> Column:
    """True where sizes, shingles that nobody shares, or signatures alone rule a pair out. With union =
    (size + size + difference) / 2, a linking pair has difference <= (per - of) / (per + of) * (size + size);
    signatures differ in no more places than sets in shingles."""
    sizes = F.col("xn") + F.col("yn")
    too_uneven = like.per * F.least("xn", "yn") < like.of * F.greatest("xn", "yn")
    shareable = F.least(F.col("xn") - F.col("xu"), F.col("yn") - F.col("yu"))
    too_lonely = (like.per + like.of) * shareable < like.of * sizes
    a, b = F.size("xs"), F.size("ys")
    xs = F.when(a == 2 * b, _halved(F.col("xs"))).otherwise(F.col("xs"))
    ys = F.when(b == 2 * a, _halved(F.col("ys"))).otherwise(F.col("ys"))
    differing = F.aggregate(F.zip_with(xs, ys, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    comparable = (a == b) | (a == 2 * b) | (b == 2 * a)
    too_different = comparable & ((like.per + like.of) * differing > (like.per - like.of) * sizes)
    return too_uneven | too_lonely | too_different


def links(posted: DataFrame, like: Likeness) -> DataFrame:
    """Links ``u``, ``v`` of representatives that give the components of all links."""
    post = posted.select("digest", "uniques", F.explode("prefix").alias("shingle"))
    post = post.withColumn("key", F.xxhash64("digest"))  # orders representatives with equal uniques at random
    hub = post.groupBy("shingle").agg(F.min(F.struct("uniques", "key", "digest")).alias("hub"), F.count("*").alias("n")).where("n > 1")
    to_hub = post.select("digest", "shingle").join(hub, "shingle").where("digest <> hub.digest")
    shared = to_hub.groupBy("digest", "hub").agg(F.count("*").alias("n"))
    best = shared.groupBy("digest").agg(F.max_by("hub", F.struct("n", -F.col("hub.uniques"), F.col("hub.key"))).alias("hub"))
    first = stage(linked(best.select(F.col("digest").alias("a"), F.col("hub.digest").alias("b")), posted, like).select(F.col("a").alias("u"), F.col("b").alias("v")), "first")
    groups = components(first)
    post = post.join(groups, post.digest == groups.node, "left").withColumn("root", F.coalesce("root", "digest"))
    # shingles with the same holders, such as those of one shared passage, are one list
    holders = F.struct(F.bit_xor("key"), F.sum(F.shiftright("key", 20)), F.count("*"))
    lists = post.groupBy("shingle").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), holders.alias("list")).where("r0 <> r1")
    post = post.join(lists.select("shingle", "list"), "shingle").groupBy("digest", "root", "list").agg(F.count("*").alias("n"))
    post = post.join(posted.select("digest", "n_shingles", "uniques", "matches", "signature"), "digest")
    post = stage(post.select("digest", "root", "list", "n", "n_shingles", "uniques", "matches", "signature"), "post")
    named = (("digest", "{}"), ("root", "{}r"), ("n_shingles", "{}n"), ("uniques", "{}u"), ("matches", "{}m"), ("signature", "{}s"))
    x = post.select("list", F.col("n").alias("n"), *[F.col(c).alias(a.format("x")) for c, a in named])
    y = post.select(F.col("list").alias("ylist"), *[F.col(c).alias(a.format("y")) for c, a in named])
    near = x.join(y, (F.col("list") == F.col("ylist")) & (F.col("x") < F.col("y")) & (F.col("xr") != F.col("yr")) & ~_far_apart(like))
    pairs = near.groupBy(F.col("x").alias("a"), F.col("y").alias("b")).agg(F.sum("n").alias("n"), F.first(F.least("xm", "ym")).alias("least")).where("n >= least").select("a", "b")
    second = linked(pairs, posted, like).select(F.col("a").alias("u"), F.col("b").alias("v"))
    return first.union(second)


def joined(docs: DataFrame, like: Likeness) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links), for every row."""
    found = sets(docs.select("doc_id", "text"), like)
    first = F.row_number().over(Window.partitionBy("digest").orderBy("doc_id"))
    posted = stage(found.where("prefix is not null").withColumn("k", first).where("k = 1").drop("k"), "posted")
    groups = components(links(posted, like))
    labelled = found.select("doc_id", "digest", "n_shingles")
    # one row a class, so a class of a third of all rows is one row in the joins
    classes = labelled.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("least"))
    classes = classes.join(groups, classes.digest == groups.node, "left").withColumn("root", F.coalesce("root", "digest"))
    ids = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = classes.select("digest", "root").join(ids, "root").select("digest", "component_id")
    named = labelled.join(of_class, "digest", "left")
    return named.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:  # noqa: B008
    """One document of each group, that of the smallest id; documents without words are all kept."""
    kept = joined(docs, like).where("doc_id = component_id").select("doc_id", "n_shingles").distinct()
    frame = packed(docs, doc_id=F.col("doc_id"), text=F.col("text"))
    wanted = kept.select(F.col("doc_id").alias("kept_id"), "n_shingles")
    alike = frame.join(wanted, F.col("doc_id").eqNullSafe(F.col("kept_id")))
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    once = alike.withColumn("k", first).where((F.col("k") == 1) | (F.col("n_shingles") == 0))
    return unpacked(once)
