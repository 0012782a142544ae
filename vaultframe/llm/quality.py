"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

Method: on a bounded sample every rule is timed, beyond what a job takes by itself, and
its rejections counted; rules then run in the order of rejections per second. Documents that a rule rejects
never reach the rules behind it. All rules are built-in functions.

Null texts count as empty; an empty text has no words and fails ``few_words``.
Rows are judged one by one, so repeated rows stay repeated, and an empty table
gives no rows. The order of the rules changes the time taken, never a verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultframe.llm.common import WORD, packed, unpacked

SYMBOLS = "#*$%&|<>"
WINDOW = 5
SAMPLE_ROWS = 1000
#: The sample lies in so many parts, whatever the table's, and is read so many times over for each timing.
SAMPLE_PARTS = 4
COPIES = 4
#: What a rule takes at least; below it, timings tell nothing.
LEAST_SECONDS = 0.002


@dataclass(frozen=True)
class Rule:
    """``rejects`` is built on the columns ``text`` and ``words``, and on those ``prepare`` adds."""

    name: str
    rejects: Callable[[], Column]
    prepare: Callable[[DataFrame], DataFrame] = lambda frame: frame


def with_words(frame: DataFrame) -> DataFrame:
    """Needs ``text``; a null text becomes an empty one."""
    filled = frame.withColumn("text", F.coalesce("text", F.lit("")))
    return filled.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))


def count_of(characters: str) -> Column:
    return (F.length("text") - F.length(F.translate("text", characters, ""))).cast("long")


def word_chars() -> Column:
    return F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long")


def _worded_lines() -> Column:
    return F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))


def n_dup_lines() -> Column:
    lines = _worded_lines()
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, also where a filter is pushed below the column's definition
    and the optimizer puts the whole expression in place of the name, inside loops too."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def _windows(w: Column) -> Column:
    n = F.size(w)
    hashes = F.transform(F.slice(w, F.lit(1), n - (WINDOW - 1)), lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WINDOW)]))
    return F.when(n >= WINDOW, hashes)


def _repeated_starts(windows: Column) -> Column:
    """Starts of the windows found twice or more: equal neighbours among the sorted hashes."""
    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def of(o: Column) -> Column:
        def repeated(x: Column, k: Column) -> Column:
            beside = [F.coalesce(F.get(o, k + step).getField("h") == x.getField("h"), F.lit(False)) for step in (-1, 1)]
            return beside[0] | beside[1]

        return F.array_sort(F.transform(F.filter(o, repeated), lambda x: x.getField("i")))

    return F.when(F.size(windows) > F.size(F.array_distinct(windows)), bound(ordered, of))


def _covered(starts: Column) -> Column:
    reach = F.transform(starts, lambda x, k: F.when(k == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), x - F.get(starts, k - 1))))
    return F.aggregate(reach, F.lit(0), lambda a, x: a + x)


def with_repeats(frame: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words inside a window of five words that the text holds at least twice.

    Windows are compared by a 64-bit hash, inside the row: a text's windows are
    sorted only where some are equal, equal neighbours give the repeated starts,
    and each start adds the words its window reaches beyond the one before.
    """
    total = bound(F.col("words"), lambda w: bound(_windows(w), lambda x: bound(_repeated_starts(x), _covered)))
    return frame.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long"))


def few_words() -> Column:
    return F.size("words") < 10


def repetitive() -> Column:
    return 100 * F.col("n_repeat_words") > 20 * F.size("words")


#: The rules every text is held to.
BASE = (Rule("few_words", few_words), Rule("repetitive", repetitive, with_repeats))
#: The cascade's own rules.
OWN = (
    Rule("symbols", lambda: 100 * count_of(SYMBOLS) > 30 * F.size("words")),
    Rule("shouting", lambda: 100 * count_of("!") > 50 * F.size("words")),
    Rule("capitals", lambda: 100 * count_of("".join(map(chr, range(65, 91)))) > 40 * word_chars()),
    Rule("duplicate_lines", lambda: 100 * n_dup_lines() > 50 * F.size(_worded_lines())),
    Rule("long_words", lambda: word_chars() > 25 * F.size("words")),
    Rule("no_letters", lambda: 2 * F.size(F.filter("words", lambda x: x.rlike(r"\p{L}"))) < F.size("words")),
)


def bounded_sample(frame: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``rows`` rows of the whole frame, whatever its size."""
    there = frame.count()
    return frame.sample(min(1.0, rows / max(1, there)), seed=7)


def _seconds(frame: DataFrame, rejects: Column, rounds: int) -> tuple[float, int]:
    """Least time of counting the rejections in ``rounds`` runs, after one run to warm up, and the rejections."""
    took = []
    for _ in range(rounds + 1):
        began = time.perf_counter()
        rejected = frame.agg(F.count_if(rejects)).first()[0]
        took.append(time.perf_counter() - began)
    return min(took[1:]), rejected


def measured(sample: DataFrame, rules: tuple[Rule, ...], copies: int = COPIES, rounds: int = 2) -> list[tuple[Rule, float, float]]:
    """Each rule with its seconds and its share of rejections on ``sample`` (``text``, ``words``), best first.

    The sample is read ``copies`` times over, so that evaluation outweighs what a job costs by itself; that is
    measured with a rule that rejects nothing and subtracted.
    """
    kept = sample.repartition(SAMPLE_PARTS).persist()
    rows = max(1, kept.count())
    often = kept.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    timed = [(rule, *_seconds(rule.prepare(often), rule.rejects(), rounds)) for rule in rules]
    idle, _ = _seconds(often, F.col("text").isNull() & F.col("words").isNull(), rounds)  # last, when the session is warm
    kept.unpersist()
    found = [(rule, max(took - idle, LEAST_SECONDS) / copies, rejected / copies / rows) for rule, took, rejected in timed]
    return sorted(found, key=lambda x: -x[2] / x[1])


def ordered_rules(docs: DataFrame, rules: tuple[Rule, ...]) -> tuple[Rule, ...]:
    sample = bounded_sample(docs.select("text"))
    return tuple(rule for rule, _, _ in measured(with_words(sample), rules))


def first_rejection(rules: tuple[Rule, ...]) -> Column:
    """Name of the first rule that rejects, else null; later rules aren't evaluated."""
    chain = None
    for rule in rules:
        chain = (F.when if chain is None else chain.when)(rule.rejects(), rule.name)
    return F.lit(None).cast("string") if chain is None else chain


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """The documents that no rule rejects, with all their columns.

    A chain of filters: what a rule needs is computed only for rows that passed
    the rules before it.
    """
    rules = ordered_rules(docs, BASE + OWN) if rules is None else rules
    frame = with_words(packed(docs, text=F.col("text")))
    for rule in rules:
        frame = rule.prepare(frame).where(~F.coalesce(rule.rejects(), F.lit(False)))
    return unpacked(frame)


def judged(docs: DataFrame, rules: tuple[Rule, ...] | None = None) -> DataFrame:
    """Every document with its measures and verdict: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept``. Base failures skip the cascade."""
    rules = ordered_rules(docs, OWN) if rules is None else rules
    frame = with_repeats(with_words(docs.select("doc_id", "text")))
    frame = frame.withColumn("base_failed", few_words() | repetitive())
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(first_rejection(rules).isNull())
    return frame.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), word_chars().alias("word_chars"), count_of(SYMBOLS).alias("n_symbols"),
        n_dup_lines().alias("n_dup_lines"), "n_repeat_words", "base_failed", kept.alias("kept"),
    )


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
each AS (SELECT r, unnest(words) AS a, unnest(range(1, len(words) + 1)) AS i FROM w),
five AS (SELECT r, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c, lead(a, 3) OVER o AS d, lead(a, 4) OVER o AS e
    FROM each WINDOW o AS (PARTITION BY r ORDER BY i)),
hit AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c, d, e) AS times FROM five WHERE e IS NOT NULL),
reach AS (SELECT r, least(5, i - coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -5)) AS n FROM hit WHERE times > 1),
rep AS (SELECT r, sum(n)::BIGINT AS n_repeat_words FROM reach GROUP BY r),
f AS (SELECT doc_id, t, words, lines, len(words)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM w LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT (100 * n_symbols > 30 * n_words
        OR 100 * (length(t) - length(replace(t, '!', ''))) > 50 * n_words
        OR 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 40 * word_chars
        OR 100 * n_dup_lines > 50 * len(lines)
        OR word_chars > 25 * n_words
        OR 2 * len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) < n_words) AS kept
FROM b
"""
