import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from loomtable.llm import fmindex, graph, rlz, simhash, templates
from tests.llm.conftest import keyed

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_fingerprint(t):
    w = WORD.findall(low(t))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(fps, tau):
    """Smallest index reachable."""
    group = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= tau:
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    return group


@pytest.mark.parametrize("cap", [0, 64])
def test_simhash(spark, corpus, cap):
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    fps = [brute_fingerprint(t) for _, t in rows]
    group = brute_groups(fps, 2)
    least = defaultdict(list)
    for (i, _), g in zip(rows, group, strict=True):
        least[g].append(i)
    want = sorted(((i, f"{f:016x}", min((x for x in least[g] if x is not None), default=None)) for (i, _), f, g in zip(rows, fps, group, strict=True)), key=repr)
    assert keyed(simhash.near_duplicates(corpus, cap=cap), "doc_id", "fingerprint", "component_id") == want
    assert simhash.near_duplicates(corpus.limit(0)).count() == 0


@pytest.mark.parametrize("tau", [0, 1, 2])
@pytest.mark.parametrize("cap", [0, 4, 100])
def test_links_near_one_another(spark, tau, cap):
    import random

    rng = random.Random(tau)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    fps = sorted({s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for s in seeds for _ in range(25)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = graph.components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), tau, cap))
    root = {r.node: r.root for r in found.collect()}
    got = [root.get(x, x) for x in signed]
    want = brute_groups(fps, tau)
    assert [[g == h for h in got] for g in got] == [[g == h for h in want] for g in want]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 202), (5, 5), (None, 3)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200, 202: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_spans(rows, window):
    first = defaultdict(lambda: float("inf"))
    words = [WORD.findall(t or "") for _, t in rows]
    late = 1 << 62
    for (i, _), w in zip(rows, words, strict=True):
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            first[k] = min(first[k], late if i is None else i)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (late if i is None else i):
                gone.update(range(s, s + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("window", "sample"), [(50, 16), (50, 1), (4, 1), (1, 16)])
def test_rlz(corpus, window, sample, monkeypatch):
    monkeypatch.setattr(rlz, "SAMPLE", sample)
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    got = keyed(rlz.dedup(corpus, window=window), "doc_id", "n_words", "n_removed", "kept_text")
    assert got == brute_spans(rows, window)
    assert any(r[2] for r in got)


def test_rlz_takes_text_ids(spark):
    import random

    rng = random.Random(1)
    w = [f"w{rng.randrange(10**5)}" for _ in range(90)]
    rows = [("b", " ".join(w)), ("a", " ".join(w[10:75])), ("c", " ".join(w)), (None, " ".join(w[30:] + ["x"])), ("c", " ".join(w))]
    got = keyed(rlz.dedup(spark.createDataFrame(rows, "doc_id string, text string")), "doc_id", "n_words", "n_removed")
    assert got == sorted([("a", 65, 0), ("b", 90, 65), ("c", 90, 90), ("c", 90, 90), (None, 61, 60)], key=repr)


def test_rlz_empty(corpus):
    assert rlz.dedup(corpus.limit(0)).count() == 0
    assert keyed(rlz.dedup(corpus.where("text is null")), "n_words", "n_removed", "kept_text") == [(0, 0, "")] * 2
    with pytest.raises(ValueError):
        rlz.dedup(corpus, window=100)


TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("most", [1 << 20, 300])
def test_fm_index(spark, corpus, most):
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    ws = [TOKEN.findall(low(t)) for _, t in rows]
    items = [(1, " ".join(ws[0][:14])), (2, "two-WORDS!"), (3, ""), (4, None), (5, "zzz never there"), (12, " ".join(ws[-4][5:30])), (12, "Ünï"), (7, "la la la la la la la la la la la la"), (None, "one"), (8, "two words")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    windows = defaultdict(set)
    for i, t in items:
        w = TOKEN.findall(low(t))
        for s in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[s : s + 10])] |= {str(i)} - {"None"}  # an item without an id has no name
    want = []
    for (i, _), w in zip(rows, ws, strict=True):
        hit, found = set(), set()
        for p, owners in windows.items():
            for s in range(len(w) - len(p) + 1):
                if tuple(w[s : s + len(p)]) == p:
                    hit.update(range(s, s + len(p)))
                    found |= owners
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    from pyspark.sql import functions as F

    got = fmindex.scan(corpus, bench, most=most).select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("s"), (F.col("n_hit") > 0).alias("c"))
    assert keyed(got, "doc_id", "n_words", "n_hit", "n_items", "s", "c") == sorted(want, key=repr)
    assert sum(w[5] for w in want) > 5
    clean = fmindex.scan(corpus, bench, most=most, cut=True, keep=("lang",))
    assert fmindex.scan(clean.selectExpr("doc_id", "clean_text as text"), bench).agg(F.max("n_words")).first()[0] > 0
    assert fmindex.scan(corpus, bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0 and fmindex.scan(corpus.limit(0), bench).count() == 0


def test_cut_keeps_the_rest():
    import numpy as np

    assert fmindex.without("Aa, bb-cc dd! Ee", np.array([0, 1, 1, 0, 0], bool)) == "Aa,  dd! Ee"
    assert fmindex.without("x", np.array([True])) == ""


def brute_templates(rows, min_docs=5, alike=0.6):
    late = 1 << 62
    key = lambda i: late if i is None else i
    lines = []
    for i, t in rows:
        for p, x in enumerate(t.split("\n") if t is not None else []):
            w = tuple("<*>" if re.search("[0-9]", v) else v for v in WORD.findall(x))
            if w:
                lines.append((i, t, p, w))
    by = defaultdict(set)
    for i, _, _, w in lines:
        by[w].add(key(i))
    constant = {w: min(d) for w, d in by.items() if len(d) >= min_docs}
    gone = {(i, t, p) for i, t, p, w in lines if w in constant and key(i) > constant[w]}
    leaves = defaultdict(list)
    for x in lines:
        if x[3] not in constant and len(x[3]) > 3:
            leaves[(len(x[3]), x[3][:3])].append(x)
    for (n, _), xs in leaves.items():
        if len({key(x[0]) for x in xs}) < min_docs:
            continue
        counts = defaultdict(int)
        for x in xs:
            for p in range(3, n):
                counts[p, x[3][p]] += 1
        level = {pt: next(k for k in range(50) if c < min_docs * 2**k) for pt, c in counts.items()}
        templates_ = defaultdict(list)
        for x in xs:
            mine = {(p, x[3][p]): level[p, x[3][p]] for p in range(3, n)}
            for least in set(mine.values()) - {0}:
                constants = tuple(pt for pt, v in mine.items() if v >= least)
                if len(constants) >= alike * (n - 3):
                    templates_[constants].append(x)
        for ys in templates_.values():
            docs = {key(y[0]) for y in ys}
            if len(docs) >= min_docs:
                gone |= {y[:3] for y in ys if key(y[0]) > min(docs)}
    out = []
    for i, t in rows:
        ls = t.split("\n") if t is not None else []
        out.append((i, None if t is None else "\n".join(x for p, x in enumerate(ls) if (i, t, p) not in gone), len(ls), sum((i, t, p) in gone for p in range(len(ls)))))
    return sorted(out, key=repr)


def test_templates(corpus):
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    got = keyed(templates.drop_templates(corpus, keep=("lang", "source")), "doc_id", "text", "n_lines", "n_dropped")
    assert got == brute_templates(rows)
    assert sum("logged in" in (r[1] or "") for r in got) == 2 and sum("fixed footer" in (r[1] or "") for r in got) == 1
    assert templates.drop_templates(corpus.limit(0)).count() == 0


def test_templates_share_a_leaf(spark):
    """Two families of one length and beginning, lines that share no more than those, and text ids."""
    rng = __import__("random").Random(4)
    name = lambda: "".join(rng.choices("abcdefghijklmnop", k=9))
    texts = [f"Alert from node worker {name()} lost its link to storage now" for _ in range(10)]
    texts += [f"Alert from node master {name()} gained new lease on memory today" for _ in range(10)]
    texts += [" ".join(["Alert from node", *[name() for _ in range(8)]]) for _ in range(60)]
    texts += [f"There is no {name()}" for _ in range(12)] + [f"There is no {name()} {name()}" for _ in range(12)]
    texts += [f"Job run on {rng.choice(['alpha', 'beta'])} by {name()} ended well at last" for _ in range(9)]
    texts += [f"Job run on {name()} by {name()} ended well at last" for _ in range(9)]
    rows = [(f"{i:03}", t) for i, t in enumerate(texts)]
    got = keyed(templates.drop_templates(spark.createDataFrame(rows, "doc_id string, text string")), "doc_id", "text", "n_lines", "n_dropped")
    late = {f"{i:03}": i for i in range(len(texts))}
    assert got == [(f"{i:03}", *r) for i, *r in sorted(brute_templates([(late[i], t) for i, t in rows]))]
    dropped = [r[3] for r in got]
    assert sum(dropped[:20]) == 18 and sum(dropped[20:104]) == 0 and sum(dropped[104:]) == 17


def brute_alike(rows):
    """component_id of each row by links of two bits or 0.8 of the five-word shingles."""
    group = brute_groups([brute_fingerprint(t) for _, t in rows], 2)
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := low(t).split()) else set() for _, t in rows]
    for i, a in enumerate(sets):
        for j in range(i):
            if a and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                x, y = sorted((group[i], group[j]))
                group = [x if g == y else g for g in group]
    least = defaultdict(list)
    for (i, _), g in zip(rows, group, strict=True):
        least[g] += [] if i is None else [i]
    return sorted(((i, min(least[g], default=None)) for (i, _), g in zip(rows, group, strict=True)), key=repr)


@pytest.mark.parametrize("hot", [3, 32])
def test_no_similar_pair_is_lost(spark, monkeypatch, hot):
    """Pairs about 0.8, alone, beside a family that shares their key, in long texts, with equal fingerprints and without ids."""
    import random

    monkeypatch.setattr(simhash, "HOT", hot)
    monkeypatch.setattr(simhash, "SAMPLE", 1 if hot == 3 else 16)
    rng = random.Random(8)
    line = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]

    def edited(w, edits):
        w = list(w)
        for at in rng.sample(range(0, len(w) // 6), edits):
            w[6 * at] = f"x{rng.randrange(10**6)}"
        return w

    texts = []
    base, head = line(120), line(30)
    texts += [edited(base, rng.randrange(2, 9)) for _ in range(45)]  # a family, not all of it within 0.8
    texts += [head + line(100) for _ in range(40)]  # a common passage in texts that are not alike
    for n, edits in [(300, 6), (300, 7), (1200, 26), (1200, 27), (60, 1)]:
        for _ in range(12):
            w = line(n)
            texts += [w, edited(w, edits)]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    w = line(300)
    rows += [(None, " ".join(w)), (None, " ".join(edited(w, 5))), (None, "one"), (9000, "ONE"), (9001, "one  two"), (9002, ""), (9003, None)]
    got = keyed(simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), similarity=0.8), "doc_id", "component_id")
    assert got == brute_alike(rows)


def test_verdict_is_on_whole_texts(spark):
    """Long texts just beside 0.8, where a sample of their shingles errs."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        w = [f"w{x}" for x in rng.integers(0, 10**7, 2000)]
        v = list(w)
        for at in rng.choice(330, 44 + i % 2, replace=False):  # 1996 shingles, five lost an edit: 0.801 and 0.797
            v[6 * at + 5] = f"x{rng.integers(10**7)}"
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v))]
    got = keyed(simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), similarity=0.8), "doc_id", "component_id")
    assert got == brute_alike(rows) and 60 < len({c for _, c in got}) < 120
