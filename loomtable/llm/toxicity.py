"""Toxicity after noisy-channel deobfuscation.

A character language model, four-grams over all documents, restores tokens that look disguised: leetspeak inside a
word, letters set apart by spaces or marks, letters drawn out. Each such token is a lattice: every written character
may stand for itself or for letters that it resembles, a drawn-out letter for one or two, a mark between letters for
nothing, a gap for nothing or a gap. Viterbi decoding takes the likeliest path. A token without a choice has one path,
itself, so only the others are decoded, once for each spelling in a task.

Texts are then scored on restored words. The words that count are learned: those that stand in toxic training rows
clearly more often than elsewhere, weighed by a logistic fit.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtable.llm.common import crc_mod, written

#: Labelled rows that the classifier is fitted on, the first by a hash of their id: its only sample.
FIT_ROWS = 20_000
#: Lengths of word beginnings that may be features, and the share of a text's words from which they are.
STEMS, DENSE = (4, 5, 6, 7, 8), 0.005
ORDER = 4
BASE = 32  # character classes: 0 gap, 1-26 letters, 27 beyond ASCII

_CLASS = bytes(c - 96 if 97 <= c <= 122 else c - 64 if 65 <= c <= 90 else 27 if c >= 128 else 0 for c in range(256))

#: What a written character may stand for (fixed by the look of the characters), with the cost of each reading.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
    "à": "a", "á": "a", "â": "a", "ä": "a", "è": "e", "é": "e", "ê": "e", "ë": "e", "ì": "i", "í": "i", "î": "i", "ï": "i",
    "ò": "o", "ó": "o", "ô": "o", "ö": "o", "ù": "u", "ú": "u", "û": "u", "ü": "u", "*": "abcdefghijklmnopqrstuvwxyz", "#": "abcdefghijklmnopqrstuvwxyz",
}
LOOK_COST, WILD_COST, DROP_COST, RUN_COST = 0.5, 1.0, 0.3, 0.2
WILD = "*#"
_MARKS = "-_.*~'`·,"
_UNSEEN = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
LONGEST = 40
_LEET = r"0-9@$!|+(<€£¡*#"
_LETTER = r"a-zà-öø-ÿ"
#: Letters of other scripts that look like Latin ones (fixed by the look of the characters). They are read as such in words that have Latin letters too.
ALIKE = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "ғ": "f", "һ": "h", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "п": "n", "о": "o", "р": "p",
    "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i",
}
#: Tokens with a choice: look-alikes beside a letter, three or more single characters set apart, a character thrice.
DISGUISED = re.compile(
    rf"(?<![{_LETTER}{_LEET}])(?:"
    rf"(?=[{_LEET}]*[{_LETTER}])[{_LETTER}{_LEET}]*[{_LEET}][{_LETTER}{_LEET}]*[{_LETTER}$@!013457][{_LETTER}{_LEET}]*"
    rf"|[{_LETTER}{_LEET}](?:[ {re.escape(_MARKS)}]{{1,2}}[{_LETTER}{_LEET}]){{2,}}"
    rf"|[{_LETTER}]*([{_LETTER}])\1\1[{_LETTER}]*"
    rf")(?![{_LETTER}])"
)
#: Words of letters of any script. A mark that combines with a letter is part of its word.
_WORDS = re.compile(r"(?:[^\W\d_][\u0300-\u036f]*)+")
_FOREIGN = re.compile("[" + "".join(ALIKE) + "]")
_LATIN = re.compile("[a-z]")
_TO_LATIN = str.maketrans(ALIKE)


def char_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of all character four-grams of all texts, by code (its classes as digits to the base 32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BASE**ORDER, np.int64)
        for b in batches:
            raw = "\n".join(t for t in b.column(0).to_pylist() if t).encode().translate(_CLASS)
            x = np.frombuffer(b"\0\0\0" + raw + b"\0", np.uint8)
            for at in range(0, len(x) - 3, 1 << 20):
                y = x[at : at + (1 << 20) + 3].astype(np.int32)
                total += np.bincount(((y[:-3] * BASE + y[1:-2]) * BASE + y[2:-1]) * BASE + y[3:], minlength=len(total))
        code = np.flatnonzero(total)
        yield pa.record_batch([pa.array(code.astype(np.int32)), pa.array(total[code])], names=["code", "n"])

    sums = docs.select(F.col(text).alias("t")).mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
    out = np.zeros(BASE**ORDER, np.int64)  # 28^4 rows at most, whatever the corpus
    rows = sums.toArrow()
    out[rows.column("code").to_numpy()] = rows.column("n").to_numpy()
    return out


def language_model(counts: np.ndarray) -> np.ndarray:
    """Log-probability of each character after three others; each order backs off to the shorter by interpolation."""
    c = counts.reshape((BASE,) * ORDER).astype(np.float64)
    p = np.full(BASE, 1 / 28)
    for k in range(1, ORDER + 1):
        n = c.sum(axis=tuple(range(ORDER - k))) if k < ORDER else c
        all_ = n.sum(axis=-1, keepdims=True)
        p = (n + 5 * p) / (all_ + 5)
    return np.log(p).astype(np.float32)


class Restorer:
    """Viterbi decoding of disguised tokens under a character model."""

    def __init__(self, model: np.ndarray):
        self.lm = model.reshape(BASE**3, BASE)
        self.restore = lru_cache(200_000)(self._restore)

    def lattice(self, token: str) -> list[list[tuple[tuple[int, ...], float]]]:
        """For each written place its readings: (character classes, cost)."""
        places, at = [], 0
        while at < len(token):
            c, end = token[at], at + 1
            while end < len(token) and token[end] == c and c not in WILD:  # each wildcard is a letter of its own
                end += 1
            run, at = end - at, end
            reads: dict[tuple[int, ...], float] = {}
            letters = []
            if "a" <= c <= "z":
                letters.append((ord(c) - 96, 0.0))
            elif ord(c) >= 128 and c not in "€£¡·":
                letters.append((27, 0.0))
            for x in LOOKS.get(c, ""):
                letters.append((ord(x) - 96, WILD_COST if c in WILD else LOOK_COST))
            for x, cost in letters:
                reads[(x,)] = cost + RUN_COST * (run > 1)
                if run > 1:
                    reads[(x, x)] = cost + RUN_COST * (run > 2)
            if c == " ":
                reads[(0,)] = 0.0
            if c == " " or c in _MARKS or not letters:
                reads[()] = DROP_COST
                reads.setdefault((0,), DROP_COST)
            places.append(list(reads.items()))
        return places

    def _restore(self, token: str) -> str:
        token = token[: -(n := len(token) - len(token.rstrip("!.,")))] if (n := len(token) - len(token.rstrip("!.,"))) > 1 else token
        lattice = self.lattice(token)
        out = self._wide(lattice) if any(c in token for c in WILD) else self._narrow(lattice)
        return token if out is None else "".join(" " if x == 0 else "\x7f" if x == 27 else chr(96 + x) for x in out)

    def _wide(self, lattice: list) -> list[int] | None:
        """The likeliest characters of a lattice with wildcards. All states of three characters are kept in one array, so a place costs
        one pass over it for each reading: about 0.1 ms, and a place has 54 readings at most, whatever stands before it."""
        lm, size = self.lm, BASE**3
        score = np.full(size, -np.inf)
        score[0] = 0.0
        back: list[tuple[np.ndarray, np.ndarray, list]] = []
        tail = np.arange(BASE * BASE)
        for reads in lattice:
            best, came, by = np.full(size, -np.inf), np.zeros(size, np.int32), np.zeros(size, np.int16)
            for k, (chars, cost) in enumerate(reads):
                if not chars:
                    to, value, source = np.arange(size), score - cost, np.arange(size)
                else:
                    x = chars[0]
                    each = (score + lm[:, x]).reshape(BASE, BASE * BASE) - cost
                    lead = each.argmax(0)
                    to, value, source = tail * BASE + x, each[lead, tail], lead * BASE * BASE + tail
                    if len(chars) == 2:
                        twice = (value + lm[to, chars[1]]).reshape(BASE, BASE)
                        lead = twice.argmax(0)
                        at = lead * BASE + tail[:BASE]
                        to, value, source = (to[at] * BASE + chars[1]) % size, twice[lead, tail[:BASE]], source[at]
                better = value > best[to]
                best[to[better]], came[to[better]], by[to[better]] = value[better], source[better], k
            score = best
            back.append((came, by, reads))
        last = score + lm[:, 0]
        state = int(last.argmax())
        if last[state] == -np.inf:
            return None
        out: list[int] = []
        for came, by, reads in reversed(back):
            out += reversed(reads[by[state]][0])
            state = int(came[state])
        return out[::-1]

    def _narrow(self, lattice: list) -> list[int] | None:
        """The likeliest characters of a lattice with few readings a place."""
        best: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
        lm, keep = self.lm, BASE**3
        for reads in lattice:
            new: dict[int, tuple[float, tuple]] = {}
            for state, (score, path) in best.items():
                for chars, cost in reads:
                    s, state2 = score - cost, state
                    for x in chars:
                        s += float(lm[state2, x])
                        state2 = (state2 * BASE + x) % keep
                    if state2 not in new or new[state2][0] < s:
                        new[state2] = (s, (path, chars))
            best = new
        if not best:
            return None
        _, path = max(((s + float(lm[state, 0]), p) for state, (s, p) in best.items()), key=lambda x: x[0])
        out: list[tuple] = []
        while path:
            path, chars = path
            out.append(chars)
        return [x for chars in reversed(out) for x in chars]

    def words(self, text: str | None) -> list[str]:
        """The words of a text in lower case as written, then the disguised ones as restored.

        Forms of a character that differ in width or style count as the plain one. In words that mix Latin letters with
        look-alikes of another script, each look-alike has one reading, the Latin letter, so they need no lattice.
        """
        if not text:
            return []
        low = (text if text.isascii() else unicodedata.normalize("NFKC", text)).lower()
        if not low.isascii():
            for c in _UNSEEN:
                if c in low:
                    low = low.replace(c, "")
            if _FOREIGN.search(low):
                low = _WORDS.sub(lambda m: m.group().translate(_TO_LATIN) if _LATIN.search(m.group()) else m.group(), low)
        found = _WORDS.findall(low)
        for m in DISGUISED.finditer(low):
            token = m.group()
            step = len(token) if len(token) <= LONGEST else LONGEST // 2  # a long row of single letters, piece by piece
            for at in range(0, len(token), step):
                found += self.restore(token[at : at + max(step, LONGEST)]).split()
        return found


def features(words: list[str]) -> set[str]:
    """Each word; and each beginning of ``STEMS`` letters that makes up a ``DENSE`` share of the words, with * for one word and ** for more."""
    found = set(words)
    least = max(1, math.ceil(DENSE * len(words)))
    for k in STEMS:
        for stem, n in Counter(w[:k] for w in words if len(w) >= k).items():
            if n >= least:
                found.add(stem + "*")
                if n >= 2:
                    found.add(stem + "**")
    return found


def known_features(words: list[str], known: dict[str, float], roots: set[str], stems: set[str]) -> set[str]:
    """The features that have a weight: ``features(words) & known.keys()`` without making the others."""
    found = known.keys() & set(words)
    counts: Counter[str] = Counter()
    for w in words:
        if w[: STEMS[0]] in roots:
            counts.update(x for k in STEMS if len(w) >= k and (x := w[:k]) in stems)
    least = max(1, math.ceil(DENSE * len(words)))
    for stem, n in counts.items():
        if n >= least:
            found |= {stem + "*"} & known.keys()
            if n >= 2:
                found |= {stem + "**"} & known.keys()
    return found


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, out: int, rows: int) -> DataFrame:
    """text, y of the first ``rows`` labelled documents by a hash of their id, without the held-out fold ``out``.

    One row for each id, whatever the number of rows that repeat it, so ``rows`` bounds the sample: the shortest text that is
    not null, of those of one length the first in order.
    """
    ids = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), folds) != out))
        .groupBy("doc_id").agg(F.max(label).alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # ``rows`` ids at most
    least = F.min(F.when(F.col("text").isNotNull(), F.struct(F.length("text").alias("n"), "text")))
    return found.groupBy("doc_id").agg(least["text"].alias("text"), F.max("y").alias("y")).select("text", "y")


def fit(docs: DataFrame, labels: DataFrame, lm: np.ndarray, rows: int = FIT_ROWS) -> tuple[dict[str, float], float]:
    """Weights of words, and the bias."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = Restorer(lm)
        for b in batches:
            ws = [sorted(features(r.words(t))) for t in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array(ws, pa.list_(pa.string())), b.column(1).cast(pa.int32())], names=["ws", "y"])

    seen = written(training_rows(docs, labels, "toxic", 3, 1, rows).mapInArrow(spread, "ws array<string>, y int"))
    n, pos = seen.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not pos or pos == n:
        return {}, math.log((pos + 0.5) / (n - pos + 0.5))
    z2 = 1.96**2  # lower end of Wilson's interval of the share of toxic rows
    share = F.col("pos") / F.col("n")
    low = (share + z2 / (2 * F.col("n")) - 1.96 * F.sqrt((share * (1 - share) + z2 / (4 * F.col("n"))) / F.col("n"))) / (1 + z2 / F.col("n"))
    seen = seen.withColumn("row", F.xxhash64("ws", "y").cast("decimal(38,0)"))
    by = seen.select("y", "row", F.explode("ws").alias("w")).groupBy("w").agg(F.count("*").alias("n"), F.sum("y").alias("pos"), F.sum("row").alias("where"))
    by = by.where("pos >= 4").where(low > max(0.3, min(0.9, 2 * pos / n)))
    same = by.groupBy("where").agg(F.max_by("w", F.struct(F.length("w"), "w")).alias("w"), F.max("n").alias("n"), F.max("pos").alias("pos"))  # of those found in the same rows, the longest
    lexicon = [r.w for r in same.orderBy(low.desc(), "w").collect()]  # words of four of the sample's toxic rows or more
    index = {w: k for k, w in enumerate(lexicon)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ks = [sorted(index[w] for w in ws if w in index) for ws in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array(ks, pa.list_(pa.int32())), b.column(1)], names=["ks", "y"])

    table = seen.mapInArrow(cut, "ks array<int>, y int").groupBy("ks", "y").agg(F.count("*").alias("n")).orderBy("ks", "y").toArrow()  # ``rows`` rows at most
    weights, bias = logistic(table.column("ks").to_pylist(), *(table.column(c).to_numpy().astype(float) for c in ("y", "n")), len(index))
    return {w: float(weights[k]) for w, k in index.items() if weights[k] > 0}, bias


def wilson(ones: np.ndarray, n: np.ndarray, z: float = 1.96) -> np.ndarray:
    """Lower end of Wilson's interval of a share."""
    n = np.maximum(n, 1e-9)
    p = ones / n
    return (p + z * z / (2 * n) - z * np.sqrt((p * (1 - p) + z * z / (4 * n)) / n)) / (1 + z * z / n)


def logistic(rows: list[list[int]], y: np.ndarray, n: np.ndarray, width: int, l2: float = 0.02, sweeps: int = 60) -> tuple[np.ndarray, float]:
    """Weights of indicators, not below 0, and a bias: Newton steps on one coordinate after another.

    The weight of an indicator that is nearly sure is drawn, by ``l2``, to the value with which it alone gives the share
    of ones among its rows: one telling word is enough, though most rows of the sample hold several. The others are
    drawn to 0.
    """
    who = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    what = np.fromiter((k for r in rows for k in r), np.int64, len(who))
    order = np.argsort(what, kind="stable")
    columns = np.split(who[order], np.searchsorted(what[order], np.arange(1, width)))
    bare = np.bincount(who, minlength=len(rows)) == 0
    b = math.log(((y * n)[bare].sum() + 0.5) / (((1 - y) * n)[bare].sum() + 0.5))
    ones, all_ = np.bincount(what, (y * n)[who], width), np.bincount(what, n[who], width)
    alone = np.where(wilson(ones, all_) >= 0.8, np.maximum(0, np.log((ones + 0.5) / (all_ - ones + 0.5)) - b), 0.0)
    w = np.zeros(width)
    z = np.full(len(rows), b)
    for _ in range(sweeps):
        p = 1 / (1 + np.exp(-z))
        db = -float((n * (p - y)).sum() / max((n * p * (1 - p)).sum(), 1e-9))
        db = max(-1.0, min(1.0, db))
        b, z, most = b + db, z + db, abs(db)
        for k in range(width):
            r = columns[k]
            p = 1 / (1 + np.exp(-z[r]))
            grad, curve = (n[r] * (p - y[r])).sum() + l2 * (w[k] - alone[k]), (n[r] * p * (1 - p)).sum() + l2
            step = max(-w[k], max(-1.0, min(1.0, -grad / curve)))
            if step:
                w[k] += step
                z[r] += step
                most = max(most, abs(step))
        if most < 1e-3:
            break
    return w, float(b)


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Words are of any script; a text of any length is read whole. Null and empty texts have no words and score the bias alone. Without both kinds of label all rows score the share
    of toxic labels. Labels with a null id or value are left out; of several for an id the largest counts. Rows that
    repeat an id are scored each; a null id is not held out. An empty table gives no rows; other columns are ignored.
    """
    lm = language_model(char_counts(docs))
    weights, bias = fit(docs, labels, lm, rows)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = Restorer(lm)
        stems = {w.rstrip("*") for w in weights if w[-1] == "*"}
        roots = {w[: STEMS[0]] for w in stems}
        for b in batches:
            z = [bias + sum(weights[f] for f in sorted(known_features(r.words(t), weights, roots, stems))) for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(1 / (1 + np.exp(-np.array(z, float))))], names=["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    held = F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
