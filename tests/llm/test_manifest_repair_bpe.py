"""Merkle manifest, conversation repair and BPE against plain forms of the same rules."""

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomtable.llm import bpe, merkle, queries, repair

SF = "/root/testdata/sf0.001"

# --- BPE ---------------------------------------------------------------------------------------------------------------

ODD = [
    None, "", "  \n\n  a", "don't we'll I'M", "x<|endoftext|>y <|endoftext|>", "hello <|endoftext|> \n", "<|endoftext|><|endoftext|>", "<|endof", "՘a\x1cb\x85c　 d\U0001f600\xe9  ",
    "\x00\x01 a", "1\xb2\xbd 三 四", " " * 50 + "a", "A" * 9000, "͸₏ mix \U0001fae8", "tab\t\tend\t", "é combining",
]


@pytest.fixture(scope="module")
def source():
    return bpe.tokenizer_source(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_bpe_is_the_library(spark, source, library, corpus):
    docs = spark.createDataFrame([(i % 7 or None, t, "k") for i, t in enumerate(ODD)], "doc_id long, text string, ids string")
    for given, keep, block in ((docs, ("text",), 40), (corpus, ("text", "source"), 5000)):
        got = bpe.decode(bpe.encode(given, source, keep=keep, block_bytes=block), source).collect()
        assert sorted(map(repr, ((r.doc_id, r.text) for r in got))) == sorted(map(repr, ((r.doc_id, r.text) for r in given.select("doc_id", "text").collect())))
        for r in got:
            wanted = library.encode(r.text or "", add_special_tokens=False).ids
            assert r.ids == wanted, r.text
            assert r.decoded == library.decode(wanted, skip_special_tokens=False) == (r.text or "")


def test_bpe_query(spark, library):
    got = {r.doc_id: r for r in queries.op13_bpe(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(rows)
    for d in rows:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_any_ids_decode(spark, source, library):
    rows = [(1, [220, 222, 10263]), (2, [50256, 13, 50256]), (3, []), (4, None), (5, [999999, 13, -4]), (6, [161, 226, 198]), (7, list(range(0, 50257, 97)))]
    got = {r.k: r.decoded for r in bpe.decode(spark.createDataFrame(rows, "k int, ids array<int>"), source).collect()}
    for k, ids in rows:
        assert got[k] == library.decode([i for i in ids or [] if 0 <= i < 50257], skip_special_tokens=False), k
    assert {r.id: bytes(r.piece) for r in bpe.pieces(spark, source).where("id in (13, 220, 50256)").collect()} == {13: b".", 220: b" ", 50256: b"<|endoftext|>"}


def test_bpe_of_nothing(spark, source):
    none = spark.createDataFrame([], "doc_id string, text string")
    assert bpe.decode(bpe.encode(none, source), source).count() == 0
    named = spark.createDataFrame([("b", "one two"), (None, "one two"), ("b", None)], "doc_id string, text string")
    got = sorted(map(repr, ((r.doc_id, r.ids) for r in bpe.encode(named, source).collect())))
    assert got == sorted(map(repr, [("b", [505, 734]), (None, [505, 734]), ("b", [])]))


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(bpe.tokenizer_source(public_tokenizers.path("word_bpe_49k.json")))


# --- Merkle manifest -----------------------------------------------------------------------------------------------------


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain_leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """The root, and for each node its siblings level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = i // 16 * 16
            paths[k].append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + 16])))
        nodes, at = [h("".join(nodes[r:r + 16])) for r in range(0, len(nodes), 16)], [i // 16 for i in at]
    return nodes[0], paths


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault((r[1] is not None, (r[1] or "").encode()), []).append(r)
    trees, tops = [], []
    for key in sorted(groups):
        placed = sorted(((r[0] is not None, r[0] or 0, plain_leaf(r), r[0]) for r in groups[key]))
        top, paths = plain_tree([x[2] for x in placed])
        trees.append((placed, top, paths))
        tops.append(top)
    root, above = plain_tree(tops)
    return [(x[3], x[2], top, root, p + above[k]) for k, (placed, top, paths) in enumerate(trees) for x, p in zip(placed, paths, strict=True)]


def fields(r):
    return (r.doc_id, r.source, r.lang, r.n_chars, r.text)


def found(df):
    return sorted(map(repr, ((r.doc_id, r.leaf, r.subroot, r.root, [(p.before, p.after) for p in r.proof]) for r in df.collect())))


def test_fractal_paths_are_the_plain_ones():
    for n in (1, 2, 15, 16, 17, 31, 256, 257, 300, 4095, 4096):
        leaves = [h(str(i)) for i in range(n)]
        levels = merkle.levels_of(n)
        top, paths = plain_tree(leaves)
        raw = [x.encode() for x in leaves]
        assert merkle.block_root(raw, levels).decode() == top
        assert [[(b.decode(), a.decode()) for b, a in p] for p in merkle.fractal(raw, levels)] == paths, n


def test_last_block_of_a_large_tree_climbs_all_its_levels():
    assert merkle.block_root([b"a" * 64], 3).decode() == h(h(h("a" * 64)))
    assert list(merkle.fractal([b"a" * 64], 2)) == [[(b"", b""), (b"", b"")]]


@pytest.mark.parametrize("block_levels", [1, 3])
def test_manifest_is_the_plain_tree(spark, corpus, block_levels):
    got = merkle.manifest(corpus, block_levels=block_levels)
    assert found(got) == sorted(map(repr, plain_manifest([fields(r) for r in corpus.collect()])))
    folded = got.select((merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok"))
    assert folded.where("ok").count() == folded.count() == corpus.count()


def test_manifest_of_sources_of_many_sizes(spark):
    sizes = {None: 1, "": 3, "a": 16, "b": 17, "é": 300, "z": 4700, **{f"s{i:03}": 1 for i in range(40)}}
    rows = [(i, s, "en", i % 5 or None, f"Text {i}") for s, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    assert found(merkle.manifest(docs)) == sorted(map(repr, plain_manifest(rows)))


def test_manifest_of_nothing(spark):
    assert merkle.manifest(spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")).count() == 0


def test_manifest_query_finds_what_was_tampered_with(spark):
    rows = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    plain = {d: (leaf, sub, root, proof) for d, leaf, sub, root, proof in plain_manifest([fields(r) for r in rows.values()])}
    got = queries.op11_merkle_manifest(spark, SF).collect()
    assert len(got) == len(rows)
    caps = str.maketrans(merkle.UPPER, merkle.LOWER)
    for g in got:
        r = rows[g.doc_id]
        seen = r.text.translate(caps) if r.text and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 else r.text
        leaf, sub, root, proof = plain[g.doc_id]
        node = plain_leaf([r.doc_id, r.source, r.lang, r.n_chars, seen])
        for b, a in proof:
            node = h(b + node + a)
        assert (g.leaf, g.subroot, g.root, g.proof_sha256, g.folded_root, g.verified) == (leaf, sub, root, h("".join(b + a for b, a in proof)), node, node == root)
        assert g.verified == (seen == r.text)


# --- Conversation repair -------------------------------------------------------------------------------------------------

GAP = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        s = lambda v: " " if v is None else str(v)
        kind, role, text = zlib.crc32(f"{s(conv)}:{s(turn)}".encode()) % 20, s(role), s(text)
        text = "" if kind == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def key_of(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def plain_repair(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit and lines of one conversation, by the best way to each state (no bound, no queue)."""
    rows = sorted(((turn is not None, turn or 0, role, key_of(role, text), text) for _, turn, role, text in rows))
    turns = [t for known, t, *_ in rows if known]
    faults, seen = [], set()
    for _, _, role, _, text in rows:
        body = text.strip(GAP)
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    due = lambda q: "a" if q == "u" else "u"
    name = {"u": "user", "a": "assistant"}

    def closed(ways):
        for _ in range(4):
            for q, (c, a, lines) in list(ways.items()):
                to = (c + 3, a + "I", [*lines, name[due(q)] + ":"])
                ways[due(q)] = min(ways.get(due(q), to), to)
        return ways

    ways = {"": (0, "", [])}
    for (_, _, role, _, text), fault in zip(rows, faults, strict=True):
        after = {}
        for q, (c, a, lines) in closed(ways).items():
            moves = [(q, c + 4, "D", lines)]
            if fault not in ("b", "d"):
                more = 3 if fault == "t" else 0
                to = q if role == "" else step.get((q, role[0]))
                moves += [(to, c + more, "K", [*lines, f"{role}:{text}"])] if to is not None else []
                moves.append((due(q), c + 3 + more, "R", [*lines, f"{name[due(q)]}:{text}"]))
            for to, cost, letter, kept in moves:
                after[to] = min(after.get(to, (cost, a + letter, kept)), (cost, a + letter, kept))
        ways = after
    cost, audit, lines = min(w for q, w in closed(ways).items() if q in ("", "a"))
    initials = [r[2][:1] for r in rows]
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:], strict=False))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in "bdt"], illegal, cost, audit, lines)


@pytest.fixture(scope="module")
def talks(spark):
    rng = random.Random(3)
    rows = []
    for conv in [None, *range(40)]:
        for k in range(rng.randrange(1, 14)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "usher"])
            text = rng.choice(["Hello there.", "So?", "cut off", "A\nB!", "", " \t", None, "é — ok.", f"n {k}.", f"n {k}"])
            rows.append((conv, rng.choice([k, k, k, k - 1, None, 3]), role, text))
    rows += [(500, 0, "user", "Only row is dropped")] * 3 + [(501, None, None, None)] + rows[5:9] + [(502, t, ("user", "assistant")[t % 2], f"Turn {t}. " + "la " * 3000 + ".") for t in range(30)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, g string, i int").repartition(4)


def told(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


@pytest.mark.parametrize(("damage", "chunk"), [(True, 512), (False, 512), (True, 3), (False, 1)])
def test_repair_is_the_cheapest(spark, talks, damage, chunk):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in talks.collect()]
    seen = plain_damage(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    by = {r[0]: [] for r in rows}
    for r in seen:
        by[r[0]].append(r)
    wanted = {}
    for conv, of in by.items():
        *figures, lines = plain_repair(of) if of else (0, 0, 0, 0, 0, 0, "", [])
        wanted[conv] = (*figures, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    assert told(repair.audited(talks, damage=damage, chunk=chunk)) == wanted


def test_search_takes_the_least_of_all_ways():
    """Against every sequence of edits up to two insertions between rows."""
    rng = random.Random(8)

    def every(run, i, state, cost, audit, idle):
        if 2 * i == len(run) and state in (0, 3):
            yield cost, audit
        role = repair.wanted(state)
        if idle < 2:
            yield from every(run, i, repair.NEXT[state][role], cost + 3, audit + "I", idle + 1)
        if 2 * i < len(run):
            initial, fault = run[2 * i:2 * i + 2]
            yield from every(run, i + 1, state, cost + 4, audit + "D", 0)
            if fault not in "bd":
                more = 3 if fault == "t" else 0
                yield from every(run, i + 1, repair.NEXT[state][role], cost + 3 + more, audit + "R", 0)
                if initial == "e" or initial in repair.NEXT[state]:
                    yield from every(run, i + 1, state if initial == "e" else repair.NEXT[state][initial], cost + more, audit + "K", 0)

    for n in [0, 1, 1, 2, 2, 3, 3, 3, 4, 4, 4, 4]:
        for _ in range(4):
            run = "".join(rng.choice("suauaxe") + rng.choice("00bdt") for _ in range(n))
            assert repair.search(run, 0, True)[0] == min(every(run, 0, 0, 0, "", 0)), run


def test_repaired_rows_have_no_faults_left(spark, talks):
    rows = repair.repair(repair.damaged(talks))
    by = {}
    for r in sorted(rows.collect(), key=lambda r: r.step):
        by.setdefault(r.conv_id, []).append(r)
    assert len(by) > 30
    for conv in by.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in conv))
        kept = [(r.role, r.text) for r in conv if r.edit == "K"]
        assert len(kept) == len(set(kept)) and all(t.strip(GAP) for _, t in kept)
        assert all(r.text == "" for r in conv if r.edit == "I")


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.audited(none).count() == repair.repair(none).count() == 0
