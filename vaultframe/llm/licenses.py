"""License scan by ordered signature rules, in built-in functions only.

Method: a keyword prefilter lets only texts holding ``licen`` through (every rule
contains it). In these, each word that can start a rule opens a window of sixteen
words; the rules of that word are tried in order, and the first that matches at
the window's start is a detection with an interval of words. A detection whose
interval lies inside that of an earlier one is suppressed. Detections are at most
sixteen words long and one a start, so only the fifteen before it can hold it.

The rules are every form of speech times every license below: some hundreds of
regular expressions, each behind a keyword test of its own.

Null and empty texts have no words and no labels. Rows are judged one by one;
repeated rows stay, other columns are ignored, no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultframe.llm.common import lower_ascii

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = 16
#: Base phrases and their labels (fixed values).
PHRASES = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))
#: Licenses in order of priority: label, keyword, name as a pattern over lower-case words.
LICENSES = (
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public"),
    ("lgpl-2.0", "library", r"(?:gnu )?library general public"),
    ("gpl", "general public", r"(?:gnu )?general public"),
    ("agpl", "agpl", r"(?:gnu )?agpl(?: ?v?3(?: 0)?)?"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl(?: ?v?[23](?: [01])?)?"),
    ("gpl", "gpl", r"(?:gnu )?gpl(?: ?v?[23](?: 0)?)?"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation"),
    ("apache-2.0", "apache", r"apache (?:software )?(?:version )?2(?: 0)?"),
    ("apache-1.1", "apache", r"apache (?:software )?(?:version )?1 1"),
    ("apache", "apache", r"apache(?: software)?"),
    ("mit-0", "mit", r"mit (?:no attribution|0)"),
    ("mit", "mit", r"mit"),
    ("mit", "expat", r"expat"),
    ("x11", "x11", r"(?:mit )?x11"),
    ("bsd-4-clause", "bsd", r"(?:4 clause bsd|bsd 4 clause)"),
    ("bsd-3-clause", "bsd", r"(?:3 clause bsd|bsd 3 clause|new bsd|modified bsd)"),
    ("bsd-2-clause", "bsd", r"(?:2 clause bsd|bsd 2 clause|simplified bsd|freebsd)"),
    ("0bsd", "bsd", r"(?:0bsd|zero clause bsd|bsd zero clause)"),
    ("bsd", "bsd", r"bsd"),
    ("isc", "isc", r"isc"),
    ("mpl-2.0", "mozilla", r"mozilla public(?: 2 0)?"),
    ("mpl-2.0", "mpl", r"mpl(?: ?2 0)?"),
    ("epl", "eclipse", r"eclipse public(?: [12] 0)?"),
    ("eupl", "european union", r"european union public"),
    ("cddl", "common development", r"common development and distribution"),
    ("cpl", "common public", r"common public"),
    ("ms-pl", "microsoft public", r"microsoft public"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal"),
    ("artistic", "artistic", r"(?:perl )?artistic(?: 2 0)?"),
    ("boost", "boost", r"boost software"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("cc0", "cc0", r"cc0(?: 1 0)?"),
    ("cc-by-nc-nd", "noncommercial", r"creative commons attribution noncommercial noderiv(?:s|atives)"),
    ("cc-by-nc-sa", "noncommercial", r"creative commons attribution noncommercial sharealike"),
    ("cc-by-nc", "noncommercial", r"creative commons attribution noncommercial"),
    ("cc-by-sa", "sharealike", r"creative commons attribution sharealike"),
    ("cc-by", "attribution", r"creative commons attribution"),
    ("cc", "creative commons", r"creative commons"),
    ("ofl", "open font", r"(?:sil )?open font"),
    ("python", "python", r"python software foundation"),
    ("postgresql", "postgresql", r"postgresql"),
    ("ruby", "ruby", r"ruby"),
    ("php", "php", r"php"),
    ("openssl", "openssl", r"openssl"),
    ("vim", "vim", r"vim"),
    ("qpl", "q public", r"q public"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa"),
)


@dataclass(frozen=True)
class Form:
    """``{name}`` is filled in."""

    pattern: str
    score: float


_NOUN = "licen[sc]e"
_LED = r"(?:licensed|licenced|released|distributed|available|provided|published)"
#: Forms of speech in order of priority.
FORMS = (
    Form(r"spdx license identifier {name}", 1.0),
    Form(r"licen[sc]ed under (?:the )?(?:terms of )?(?:the )?{name}(?: licen[sc]e)?", 0.95),
    Form(rf"(?:released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?{{name}} {_NOUN}", 0.95),
    Form(rf"(?:subject to|under) (?:the )?terms of (?:the )?{{name}} {_NOUN}", 0.9),
    Form(rf"{_NOUN} {{name}}(?: {_NOUN})?", 0.7),
    Form(rf"{{name}} {_NOUN}(?: version [0-9]+(?: [0-9]+)?)?", 0.8),
)
BASE_SCORE = 0.6


def spellings(pattern: str, whole: bool = True) -> set[str]:
    """The strings a pattern of letters, ``(?:a|b)``, ``[ab]`` and ``?`` matches; of ``[0-9]+`` one digit stands for all.

    ``whole=False`` gives their first words only.
    """

    def glued(heads: set[str], tails: set[str]) -> set[str]:
        return {h if not whole and " " in h else h + t for h in heads for t in tails}

    def alternatives(at: int) -> tuple[set[str], int]:
        every: set[str] = set()
        heads = {""}
        while at < len(pattern) and pattern[at] != ")":
            if pattern[at] == "|":
                every, heads, at = every | heads, {""}, at + 1
                continue
            if pattern.startswith("(?:", at):
                part, at = alternatives(at + 3)
                at += 1
            elif pattern[at] == "[":
                end = pattern.index("]", at)
                inside = pattern[at + 1 : end]
                part, at = {inside[0]} if "-" in inside else set(inside), end + 1
            else:
                part, at = {pattern[at]}, at + 1
            if pattern[at : at + 1] == "?":
                part, at = part | {""}, at + 1
            elif pattern[at : at + 1] == "+":
                at += 1
            heads = glued(heads, part)
        return every | heads, at

    found = alternatives(0)[0]
    return found if whole else {x.split(" ")[0] for x in found}


@dataclass(frozen=True)
class Signature:
    words: tuple[str, ...]
    keyword: str
    pattern: str
    label: str
    score: float


SIGNATURES = tuple(
    Signature(tuple(sorted(spellings(pattern, whole=False))), keyword, f"^{pattern}(?: |$)", label, form.score)
    for form in FORMS
    for label, keyword, name in LICENSES
    for pattern in [form.pattern.format(name=f"(?:{name})")]
)
OPENERS = tuple(sorted({word for s in SIGNATURES for word in s.words}))


def _rule_of(window: Column, word: Column) -> Column:
    """Number of the first rule that matches the window, else null."""
    by_opener: dict[tuple[str, ...], list[int]] = {}
    for k, signature in enumerate(SIGNATURES):
        by_opener.setdefault(signature.words, []).append(k)
    found = []
    for words, numbers in by_opener.items():
        chain = None
        for k in numbers:
            s = SIGNATURES[k]
            chain = (F.when if chain is None else chain.when)(window.contains(s.keyword) & window.rlike(s.pattern), k)
        found.append(F.when(word.isin(*words), chain))
    return F.coalesce(*found)


def _detection(x: Column) -> Column:
    """Start, end (exclusive), label and score of a window whose rule ``k`` has matched."""
    of_rule = lambda values: F.get(F.split(F.lit("\n".join(values)), "\n"), x.getField("k"))
    hit = F.trim(F.regexp_substr(x.getField("s"), of_rule([s.pattern for s in SIGNATURES])))
    length = F.length(hit) - F.length(F.replace(hit, F.lit(" "), F.lit(""))) + 1
    start = x.getField("i")
    label, score = of_rule([s.label for s in SIGNATURES]), of_rule([str(s.score) for s in SIGNATURES]).cast("double")
    return F.struct(start.alias("start"), (start + length).alias("end"), label.alias("label"), score.alias("score"))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``,
    ``detections`` (array of start, end, label, score; what was not suppressed)."""
    text = lower_ascii(F.coalesce("text", F.lit("")))
    frame = docs.select("doc_id", text.alias("t"))
    frame = frame.select("doc_id", F.contains("t", F.lit("licen")).alias("gate"), F.regexp_extract_all("t", F.lit(WORDS), F.lit(0)).alias("w"))
    w = F.col("w")
    places = F.when(F.col("gate") & (F.size(w) > 0), F.sequence(F.lit(0), F.size(w) - 1))

    def is_phrase(i: Column, phrase: tuple[str, ...]) -> Column:
        test = F.get(w, i) == phrase[0]
        for k, word in enumerate(phrase[1:], 1):
            test = test & F.coalesce(F.get(w, i + k) == word, F.lit(False))
        return test

    def base_label(i: Column) -> Column:
        chain = None
        for phrase, label in PHRASES:
            chain = (F.when if chain is None else chain.when)(is_phrase(i, phrase), label)
        return chain

    frame = frame.select("doc_id", "w", F.filter(places, lambda i: F.get(w, i).isin(*OPENERS, *{p[0] for p, _ in PHRASES})).alias("starts"))
    frame = frame.select("doc_id", "w", "starts", F.filter("starts", lambda i: base_label(i).isNotNull()).alias("base"))
    windows = F.transform("starts", lambda i: F.struct(i.alias("i"), F.array_join(F.slice(w, i + 1, SPAN), " ").alias("s")))
    frame = frame.withColumn("windows", windows)
    ruled = F.transform("windows", lambda x: x.withField("k", _rule_of(x.getField("s"), F.substring_index(x.getField("s"), " ", 1))))
    frame = frame.withColumn("ruled", F.filter(ruled, lambda x: x.getField("k").isNotNull()))
    frame = frame.withColumn("found", F.transform("ruled", _detection))
    f = F.col("found")

    def free(x: Column, k: Column) -> Column:
        from_ = F.greatest(k - (SPAN - 1), F.lit(0))
        earlier = F.slice(f, from_ + 1, k - from_)
        return ~F.exists(earlier, lambda y: y.getField("end") >= x.getField("end"))

    frame = frame.withColumn("detections", F.coalesce(F.filter(f, free), F.array()))
    base = F.coalesce(F.array_distinct(F.transform("base", base_label)), F.array().cast("array<string>"))
    own = F.transform("detections", lambda x: x.getField("label"))
    best = F.coalesce(F.array_max(F.transform("detections", lambda x: x.getField("score"))), F.lit(0.0))
    n_base = F.coalesce(F.when(F.col("base").isNotNull(), F.size("base")), F.lit(0)).cast("long")
    return frame.select(
        "doc_id", F.size(w).cast("long").alias("n_words"), n_base.alias("n_base"),
        F.get("base", F.lit(0)).cast("long").alias("first_word"), F.element_at(F.when(F.size("base") > 0, F.col("base")), -1).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        F.greatest(best, F.when(n_base > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0))).alias("score"), "detections",
    )


def _sql() -> str:
    """The same rules as SQL, tried at every word with "licen" in its window: which words open a rule is not assumed."""
    tests = []
    for s in SIGNATURES:
        tests.append(f"WHEN contains(s, '{s.keyword}') AND regexp_matches(s, '{s.pattern}') THEN {len(tests)}")
    rows = ", ".join(f"({k}, '{s.label}', {s.score}, '{s.pattern}')" for k, s in enumerate(SIGNATURES))
    phrases = " ".join(f"WHEN {' AND '.join(f"coalesce(w[i + {k + 1}], '') = '{x}'" for k, x in enumerate(p))} THEN '{label}'" for p, label in PHRASES)
    return rf"""
WITH sig(k, label, score, pattern) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT r, i, w, array_to_string(w[i + 1:i + {SPAN}], ' ') AS s
    FROM (SELECT r, w, unnest(range(0, len(w))) AS i FROM d) WHERE contains(s, 'licen')),
b AS (SELECT r, i, CASE {phrases} END AS label FROM p),
h AS (SELECT r, i, s, CASE {' '.join(tests)} END AS k FROM p),
e AS (SELECT r, i, label, score, i + len(string_split(trim(regexp_extract(s, pattern)), ' ')) AS stop FROM h JOIN sig USING (k)),
x AS (SELECT a.* FROM e a WHERE NOT EXISTS (SELECT 1 FROM e y WHERE y.r = a.r AND y.i < a.i AND y.stop >= a.stop)),
bs AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels FROM b WHERE label IS NOT NULL GROUP BY r),
xs AS (SELECT r, list(DISTINCT label) AS labels, max(score) AS score FROM x GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
    coalesce(array_to_string(list_sort(bs.labels), ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bs.labels, []), coalesce(xs.labels, [])))), ','), '') AS labels,
    greatest(coalesce(xs.score, 0), CASE WHEN n_base > 0 THEN {BASE_SCORE} ELSE 0 END)::DOUBLE AS score
FROM d LEFT JOIN bs USING (r) LEFT JOIN xs USING (r)
"""


SQL = _sql()
