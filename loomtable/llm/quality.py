"""Quality rules as a short-circuit cascade, in DataFrame operations only.

Each rule is a Column that says whether a text fails. On a bounded sample, drawn by a hash of the texts, each rule's
selectivity (share rejected) is measured, and its cost: what the rule reads there (characters, words, lines) times what
one of these costs, a stated figure. Rules then run in order of rejections per cost, and a row that fails one skips the
rest. The order changes the work, never the verdict: a row is kept if no rule rejects it. One sample gives one order,
whatever else the machine does.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtable.llm.common import SPACES, let, words

SYMBOLS = "#*$%&|<>"
GRAM = 5
#: Rows, and characters of each, on which costs are estimated; results never depend on them.
SAMPLE_ROWS, SAMPLE_CHARS = 400, 20_000


def count_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, SPACES, ""))


def full_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)


def line_counts(text: Column) -> Column:
    """n, dup: lines with a word, and those of them that are equal to an earlier one."""
    return let(full_lines(text), lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))


def gram_hashes(w: Column) -> Column:
    """A 64-bit hash of each window of five words, made of pairs: two of two words, and one more."""
    n = F.size(w)
    both = lambda a, b: F.xxhash64(a, b)
    pairs = F.zip_with(F.slice(w, F.lit(1), n - 1), F.slice(w, F.lit(2), n - 1), both)
    fours = let(pairs, lambda p: F.zip_with(F.slice(p, F.lit(1), n - 3), F.slice(p, F.lit(3), n - 3), both))
    return F.when(n >= GRAM, F.zip_with(fours, F.slice(w, F.lit(GRAM), n - GRAM + 1), both)).otherwise(F.array().cast("array<bigint>"))


def repeat_words(w: Column) -> Column:
    """Words covered by five-word windows that are found twice or more in the word array ``w``.

    Windows are compared by a 64-bit hash. Texts without a repeated window, most of them, end at the distinct count;
    the others sort (hash, place) once, so the work is n log n in the text's length.
    """

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = lambda s: F.filter(s, lambda e, j: (e["h"] == F.get(s, j - 1)["h"]).eqNullSafe(True) | (e["h"] == F.get(s, j + 1)["h"]).eqNullSafe(True))
        at = let(pairs, lambda s: F.sort_array(F.transform(twice(s), lambda e: e["i"])))
        steps = let(at, lambda p: F.transform(p, lambda v, j: F.least(F.lit(GRAM), F.coalesce(F.get(p, j + 1) - v, F.lit(GRAM)))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return let(gram_hashes(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def upper(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"\P{Lu}+", ""))


def letters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"\P{L}+", ""))


@dataclass(frozen=True)
class Facts:
    """What rules ask of a text (never null) and its words; where ``known`` has a count it is not made again."""

    text: Column
    words: Column
    known: Column | None = None

    def _of(self, name: str, make: Callable[[], Column]) -> Column:
        return make() if self.known is None else self.known[name]

    @property
    def n(self) -> Column:
        return self._of("n", lambda: F.size(self.words))

    @property
    def chars(self) -> Column:
        return self._of("chars", lambda: word_chars(self.text))

    @property
    def marks(self) -> Column:
        return self._of("marks", lambda: count_of(self.text, SYMBOLS))

    @property
    def lines(self) -> Column:
        return self._of("lines", lambda: line_counts(self.text))

    @property
    def repeated(self) -> Column:
        return self._of("repeated", lambda: repeat_words(self.words))


@dataclass(frozen=True)
class Rule:
    """Whether a text fails, and what that costs: nanoseconds for a character and for a word, as timed on one core."""

    fails: Callable[[Facts], Column]
    char_ns: float = 0.0
    word_ns: float = 0.0


RULES: dict[str, Rule] = {
    "few_words": Rule(lambda x: x.n < 10, word_ns=0.1),
    "word_length": Rule(lambda x: let(x.chars, lambda c: (c < 2 * x.n) | (c > 20 * x.n)), char_ns=25),
    "symbols": Rule(lambda x: 10 * x.marks > x.n, char_ns=25),
    "dup_lines": Rule(lambda x: let(x.lines, lambda y: 100 * y["dup"] > 50 * y["n"]), char_ns=30),
    "stutter": Rule(lambda x: 100 * F.size(F.filter(x.words, lambda v, i: (i > 0) & (v == F.get(x.words, i - 1)))) > 30 * x.n, word_ns=250),
    "upper": Rule(lambda x: 2 * upper(x.text) > letters(x.text), char_ns=60),
    "repeats": Rule(lambda x: 100 * x.repeated > 20 * x.n, word_ns=900),
}
#: Rules that decide ``base_failed`` of ``report``.
BASE = ("few_words", "repeats")


def estimate(docs: DataFrame, text: str = "text", rules: Mapping[str, Rule] = RULES) -> list[tuple[str, float, float]]:
    """(rule, nanoseconds a row, share rejected) on the sample, in the order of the cascade: most rejections for their cost first.

    The sample are ``SAMPLE_ROWS`` different texts, first by their hash among those whose hash falls into a share of about
    four times as many, their beginnings alone: what is sorted is as much at every size. Equal ranks keep the rules' own
    order; an empty table keeps it throughout.
    """
    share = max(1, docs.count() // (4 * SAMPLE_ROWS))
    t = F.coalesce(F.col(text), F.lit(""))
    drawn = docs.select(F.substring(t, 1, SAMPLE_CHARS).alias("t"), F.xxhash64(t).alias("h")).where(F.pmod("h", F.lit(share)) == 0).dropDuplicates(["h"])
    sample = drawn.orderBy("h").limit(SAMPLE_ROWS).withColumn("w", words(F.col("t")))
    x = Facts(F.col("t"), F.col("w"))
    cost = lambda r: F.length("t") * F.lit(float(r.char_ns)) + F.size("w") * F.lit(float(r.word_ns))
    found = sample.agg(*[F.avg(r.fails(x).cast("int")).alias(f"share_{n}") for n, r in rules.items()], *[F.avg(cost(r)).alias(f"cost_{n}") for n, r in rules.items()]).first()
    ranks = [(n, float(found[f"cost_{n}"] or 0), float(found[f"share_{n}"] or 0)) for n in rules]
    return sorted(ranks, key=lambda r: -r[2] / max(r[1], 1e-9))


def verdict(x: Facts, order: Sequence[str], rules: Mapping[str, Rule] = RULES) -> Column:
    """True if no rule rejects; later rules run only for what the earlier ones passed."""
    kept = F.lit(True)
    for name in reversed(order):
        kept = F.when(rules[name].fails(x), F.lit(False)).otherwise(kept)
    return kept


def keep_good(docs: DataFrame, text: str = "text", rules: Mapping[str, Rule] = RULES) -> DataFrame:
    """The rows that no rule rejects, with all columns as they were. Null and empty texts have no words and go.

    Texts of any length are judged whole. Rows that repeat an id are judged each by its own text; an empty table stays
    empty; no column is added, so names can't clash. Nothing hangs on order, so there are no ties.
    """
    order = [r[0] for r in estimate(docs, text, rules)]
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.where(let(words(t), lambda w: verdict(Facts(t, w), order, rules)))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Mapping[str, Rule] = RULES) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every row.

    Null and empty texts count 0 throughout and fail; texts of any length are counted whole. kept is false where
    base_failed, else the cascade's verdict over the other rules, which only then run, on the counts that are there
    anyway. Rows that repeat an id are judged each; an empty table gives no rows; other columns are ignored.
    """
    order = [r[0] for r in estimate(docs, text, rules) if r[0] not in BASE]
    t = F.col("t")
    seen = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))

    def counts(w: Column) -> Column:
        return F.struct(
            F.size(w).alias("n"), word_chars(t).alias("chars"), count_of(t, SYMBOLS).alias("marks"), line_counts(t).alias("lines"), repeat_words(w).alias("repeated"),
        )

    def judged(w: Column, k: Column) -> Column:
        x = Facts(t, w, k)
        base = rules["few_words"].fails(x) | rules["repeats"].fails(x)
        return let(base, lambda b: F.struct(k.alias("k"), b.alias("failed"), F.when(b, F.lit(False)).otherwise(verdict(x, order, rules)).alias("kept")))

    rows = seen.withColumn("x", let(words(t), lambda w: let(counts(w), lambda k: judged(w, k))))
    long = lambda name: F.col(f"x.k.{name}").cast("long")
    return rows.select(
        "doc_id", long("n").alias("n_words"), long("chars").alias("word_chars"), long("marks").alias("n_symbols"), long("lines.dup").alias("n_dup_lines"),
        long("repeated").alias("n_repeat_words"), F.col("x.failed").alias("base_failed"), F.col("x.kept").alias("kept"),
    )


SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS gram
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT i + o) AS r FROM d, (SELECT unnest([0, 1, 2, 3, 4]) AS o) GROUP BY doc_id),
s AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.r, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
         len(list_filter(ws, lambda x, i: i > 1 AND ws[i - 1] = x)) AS n_stutter,
         length(regexp_replace(t, '\P{Lu}', '', 'g')) AS up, length(regexp_replace(t, '\P{L}', '', 'g')) AS let
  FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (word_chars < 2 * n_words OR word_chars > 20 * n_words OR 10 * n_symbols > n_words
         OR 100 * n_dup_lines > 50 * n_lines OR 2 * up > let OR 100 * n_stutter > 30 * n_words) AS kept
FROM b
"""
