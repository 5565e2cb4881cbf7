"""Conversation structure repair: the cheapest edits that leave system?, (user, assistant)* turns without faults.

Each conversation's rows are placed in order without a rank in one task, and get their first fault. A row is then two letters, its
role's initial and its fault, and a run of ``CHUNK`` rows is one short text. A* searches the edit lattice of such a run: a node is
(rows consumed, role state), an edge keeps, reroles or deletes a row or inserts one. A run in the middle of a long conversation is
searched from every state it can be entered in; the runs' results are then put together in order, so a conversation of any length is
spread over tasks, and only four costs a run pass through one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtable.llm.common import CRC_TABLE, SPACES, beside, crc_sql, placed, text_key, written

#: Rows searched at once.
CHUNK = 512
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Role states: nothing yet, after system, after user, after assistant. Rows may end in the first and the last.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
#: A step's number is its run's number times this, and its place in the run: a run has at most three inserted rows beside each of its own.
STEPS = 1 << 20


def wanted(state: int) -> str:
    """The initial of the role that a row gets in a state: an assistant answers a user, anything else is a user's."""
    return "a" if state == 2 else "u"


def search(run: str, start: int, last: bool) -> dict[int, tuple[int, str]]:
    """Cheapest edits of a run (two letters a row) from a state: for each state that it can be left in, cost and audit.

    A*: what is ahead costs at least a deletion for each blank or repeated row and a charge for each truncated one, and the
    queue is keyed (cost plus that, audit), so of equally cheap edits the ASCII-least come first. Both parts only grow along an edge,
    so the first visit of a node is its best. The last run ends in a state in which rows may end, given under 0; runs before it end
    with a row of theirs, so an insertion between two runs belongs to the second.
    """
    n = len(run) // 2
    least = [{"b": DELETE, "d": DELETE, "t": min(TRUNCATED, DELETE)}.get(run[2 * i + 1], 0) for i in range(n)]
    ahead = list(accumulate(reversed(least), initial=0))[::-1]
    queue, seen, found = [(ahead[0], "", 0, start)], set(), {}
    while queue:
        bound, audit, i, state = heappop(queue)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == n and last and state in ENDS:
            return {0: (bound, audit)}
        if i == n and not last:
            found[state] = (bound, audit)
            continue
        spent, role = bound - ahead[i], wanted(state)
        heappush(queue, (spent + INSERT + ahead[i], audit + "I", i, NEXT[state][role]))
        if i == n:
            continue
        initial, fault = run[2 * i], run[2 * i + 1]
        heappush(queue, (spent + DELETE + ahead[i + 1], audit + "D", i + 1, state))
        if fault in "bd":
            continue
        charge = spent + ahead[i + 1] + (TRUNCATED if fault == "t" else 0)
        heappush(queue, (charge + REROLE, audit + "R", i + 1, NEXT[state][role]))
        to = state if initial == "e" else NEXT[state].get(initial)
        if to is not None:
            heappush(queue, (charge + KEEP, audit + "K", i + 1, to))
    return found


def illegal_pairs(run: str, after: str | None) -> int:
    """Neighbours whose initials are not su, ua or au; ``after`` is the initial of the row after the run."""
    initials = run[::2] + (after or "")
    return sum(initials[i:i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


def replay(run: str, start: int, audit: str) -> Iterator[tuple[str, int | None, str | None]]:
    """The edits of a run that leave a row: letter, the row's place in the run (none if inserted) and its new role (none if kept)."""
    i, state = 0, start
    for letter in audit:
        role = wanted(state)
        if letter == "K":
            yield letter, i, None
            state = NEXT[state].get(run[2 * i], state)
        elif letter != "D":
            yield letter, None if letter == "I" else i, ROLES[role]
            state = NEXT[state][role]
        i += letter != "I"


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with damage by crc32 of conv_id:turn: dropped, emptied, unpunctuated, repeated or rerolled rows. Nulls are one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    copies = F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))
    return (
        rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(spaced("role")).alias("role"), text.alias("text"), kind.alias("__kind"), copies.alias("__copies"))
        .where("__kind <> 0").withColumn("__copy", F.explode("__copies")).drop("__kind", "__copies", "__copy")
    )


def _keyed(rows: DataFrame) -> DataFrame:
    """g (the conversation), turn, role, text with nulls as one space, and key, which tells role and text apart by 128 bits."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    named = rows.select(text_key(F.col("conv_id")).alias("g"), "turn", role.alias("role"), text.alias("text"))
    return named.withColumn("key", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))))


def faulted(rows: DataFrame) -> DataFrame:
    """Rows without their texts: g, i (place in the conversation), size, turn, key, initial and fault (b, d, t or 0). Written.

    Order is by turn, null first; rows of one turn stand by role, then by key. A row is blank without any character but spaces,
    else a duplicate of an earlier one with its role and text, else truncated if its last such character ends no sentence.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    first = F.when(F.ltrim(trimmed, F.lit(SPACES)) == "", "b").when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "t").otherwise("0")
    initial = F.when(F.col("role") == "", "e").when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("x")
    slim = _keyed(rows).select("g", "turn", "role", "key", initial.alias("initial"), first.alias("first"))
    nodes = placed(written(slim), "g", [F.asc_nulls_first("turn"), F.asc("role"), F.asc("key")])
    many = written(nodes.groupBy("g", "key").agg(F.min("i").alias("least"), F.count("*").alias("n")).where("n > 1"))
    again = beside(nodes.select("g", "key", "i"), many, ["g", "key"]).where("i > least").select("g", "i", F.lit(True).alias("again"))
    fault = F.when(F.col("first") == "b", "b").when(F.col("again"), "d").otherwise(F.col("first"))
    return written(nodes.join(again, ["g", "i"], "left").select("g", "i", "size", "turn", "key", "initial", fault.alias("fault")))


def _searched(rows: DataFrame, chunk: int) -> DataFrame:
    """Every run with what A* found: g, run, runs, codes, illegal, and by from * 4 + to: costs (-1 if there is no way), ranks of the audits, audits. Written."""
    at = F.floor(F.col("i") / chunk)
    own = F.struct(at.alias("run"), F.concat("initial", "fault").alias("code"), F.lit(None).cast("string").alias("after"))
    next_to = F.struct((at - 1).alias("run"), F.lit(None).cast("string").alias("code"), F.col("initial").alias("after"))
    both = F.when((F.col("i") % chunk == 0) & (F.col("i") > 0), F.array(own, next_to)).otherwise(F.array(own))
    codes = F.array_sort(F.collect_list(F.when(F.col("x.code").isNotNull(), F.struct("i", "x.code"))))  # a run's rows
    runs = rows.select("g", "i", "size", F.explode(both).alias("x")).groupBy("g", "x.run").agg(
        F.ceil(F.max("size") / chunk).alias("runs"), F.array_join(F.transform(codes, lambda c: c["code"]), "").alias("codes"), F.max("x.after").alias("after")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            illegal, costs, ranks, audits = [], [], [], []
            for k, of, text, after in zip(*[b.column(c).to_pylist() for c in ("run", "runs", "codes", "after")], strict=True):
                found = {(s, t): x for s in (range(4) if k else (0,)) for t, x in search(text, s, k + 1 == of).items()}
                order = {a: r for r, a in enumerate(sorted({a for _, a in found.values()}))}
                none = (-1, "")
                each = [found.get((s, t), none) for s in range(4) for t in range(4)]
                illegal.append(illegal_pairs(text, after))
                costs.append([c for c, _ in each])
                ranks.append([order.get(a, 0) for _, a in each])
                audits.append([a for _, a in each])
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("g", "run", "runs", "codes")], pa.array(illegal, pa.int64()), pa.array(costs, pa.list_(pa.int64())), pa.array(ranks, pa.list_(pa.int32())), pa.array(audits, pa.list_(pa.string()))],
                names=["g", "run", "runs", "codes", "illegal", "costs", "ranks", "audits"],
            )

    return written(runs.mapInArrow(run, "g string, run long, runs long, codes string, illegal long, costs array<long>, ranks array<int>, audits array<string>"))


def _way(runs: list[tuple[list[int], list[int]]]) -> Iterator[tuple[int, int]]:
    """The states in which a conversation's cheapest edits enter and leave each run, from the costs and ranks of all its runs.

    Ways to the same place have used up the same rows and end with a row, so neither audit is the beginning of the other:
    they are equal or differ in a letter, and the ranks of their parts, compared in order, compare them.
    """
    best: dict[int, tuple[int, int]] = {0: (0, 0)}  # state: cost, rank of its audit
    back: list[dict[int, int]] = []
    for costs, ranks in runs:
        ways: dict[int, tuple[int, int, int, int]] = {}
        for s, (cost, rank) in best.items():
            for t in range(4):
                if costs[s * 4 + t] >= 0:
                    ways[t] = min(ways.get(t, (1 << 62, 0, 0, 0)), (cost + costs[s * 4 + t], rank, ranks[s * 4 + t], s))
        order = {key: r for r, key in enumerate(sorted({w[1:3] for w in ways.values()}))}
        best = {t: (w[0], order[w[1:3]]) for t, w in ways.items()}
        back.append({t: w[3] for t, w in ways.items()})
    t, way = 0, []
    for step in reversed(back):
        way.append((step[t], t))
        t = step[t]
    return reversed(way)


def _chosen(searched: DataFrame) -> DataFrame:
    """g, run, start, cost, audit, codes, illegal of each run as the whole conversation's cheapest edits pass it. Written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(g: str, runs: list) -> pa.RecordBatch:
            way = list(_way(runs))
            return pa.RecordBatch.from_arrays(
                [pa.array([g] * len(way)), pa.array(range(len(way)), pa.int64()), pa.array([s for s, _ in way], pa.int32()), pa.array([t for _, t in way], pa.int32())],
                names=["g", "run", "start", "end"],
            )

        now, runs = None, []
        for b in batches:
            for g, costs, ranks in zip(*[b.column(c).to_pylist() for c in ("g", "costs", "ranks")], strict=True):
                if g != now and runs:
                    yield told(now, runs)
                    runs = []
                now = g
                runs.append((costs, ranks))
        if runs:
            yield told(now, runs)

    long = searched.where("runs > 1")
    ways = long.select("g", "run", "costs", "ranks").repartition("g").sortWithinPartitions("g", "run").select("g", "costs", "ranks").mapInArrow(run, "g string, run long, start int, end int")
    state = F.col("start") * 4 + F.col("end")
    pick = lambda c: F.get(F.col(c), state)
    columns = ["g", "run", "start", pick("costs").alias("cost"), pick("audits").alias("audit"), "codes", "illegal"]
    short = searched.where("runs = 1").withColumn("start", F.lit(0)).withColumn("end", F.lit(0))
    return written(short.select(*columns).unionByName(long.join(ways, ["g", "run"]).select(*columns)))


def plan(rows: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """The rows with their faults, and the edits of each run: what ``report`` and ``repaired`` share."""
    found = faulted(rows)
    return found, _chosen(_searched(found, chunk))


def report(found: DataFrame, edits: DataFrame) -> DataFrame:
    """g, gaps, blank, duplicate, truncated, illegal, cost and audit of each conversation."""
    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = found.groupBy("g").agg(
        F.coalesce(turns, F.lit(0)).cast("long").alias("gaps"), *[F.count_if(F.col("fault") == f).alias(name) for f, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))]
    )
    told = edits.groupBy("g").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    return counts.join(told, "g")


def repaired(rows: DataFrame, found: DataFrame, edits: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The rows of the repaired conversations: g, step (their order), edit (K, R or I), role, text.

    A row that stays is the first with its role and text, so texts are looked up by that, one copy each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [
                (g, k * STEPS + n, letter, None if i is None else k * chunk + i, role)
                for g, k, start, audit, codes in zip(*[b.column(c).to_pylist() for c in ("g", "run", "start", "audit", "codes")], strict=True)
                for n, (letter, i, role) in enumerate(replay(codes, start, audit))
            ]
            if rows:
                columns = zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=["g", "step", "edit", "i", "given"])

    steps = written(edits.select("g", "run", "start", "audit", "codes").mapInArrow(run, "g string, step long, edit string, i long, given string"))
    texts = _keyed(rows).select("g", "key", "role", "text").dropDuplicates(["g", "key"])
    held = steps.where("i is not null").join(found.select("g", "i", "key"), ["g", "i"]).join(texts, ["g", "key"])
    made = steps.where("i is null").select("g", "step", "edit", F.col("given").alias("role"), F.lit("").alias("text"))
    return held.select("g", "step", "edit", F.coalesce("given", "role").alias("role"), "text").unionByName(made)


def digests(rows: DataFrame) -> DataFrame:
    """g, sha256 of each conversation's role:text lines. One digest has to read its conversation in order: rows stream through it, none are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            names, ends = [], []
            for g, role, text in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if g != now:
                    if state is not None:
                        names.append(now)
                        ends.append(state.hexdigest())
                    now, state = g, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(ends)], names=["g", "sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], names=["g", "sha256"])

    return rows.select("g", "step", "role", "text").repartition("g").sortWithinPartitions("g", "step").select("g", "role", "text").mapInArrow(run, "g string, sha256 string")


def named(g: Column, kind: str) -> Column:
    """The conversation's id again."""
    return F.when(g == "-", F.lit(None)).otherwise(F.substring(g, 2, 1 << 30)).cast(kind)


def repair(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv_id, step, edit, role, text: every conversation (conv_id, turn, role, text) with the cheapest edits done.

    Kept rows stay (K), others get the role that is due (R), and rows with an empty text are inserted (I); blank rows and those that
    repeat an earlier role and text go. A null role or text is one space, so it is blank or has a role that can't stay; rows without a
    conv_id are a conversation. An empty role has no initial, so such a row fits anywhere. A conversation that holds nothing else goes. Texts of any
    length are read whole, equal rows are interchangeable, an empty table gives an empty table and other columns don't matter.
    """
    found, edits = plan(rows, chunk)
    return repaired(rows, found, edits, chunk).select(named(F.col("g"), rows.schema["conv_id"].dataType.simpleString()).alias("conv_id"), "step", "edit", "role", "text")


def audited(conversations: DataFrame, damage: bool = True, chunk: int = CHUNK) -> DataFrame:
    """A row for every conv_id of the table before damage: what was wrong, the edits that mend it, and a digest of the result."""
    rows = damaged(conversations) if damage else conversations
    found, edits = plan(rows, chunk)
    told = report(found, edits).join(digests(repaired(rows, found, edits, chunk)), "g", "left")
    every = conversations.select(text_key(F.col("conv_id")).alias("g"), "conv_id").distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return every.join(told, "g", "left").select(
        "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


#: The same in SQL: not A* but the best way to each role state, row by row; two insertions in a row are the most that can pay.
SQL = f"""
WITH RECURSIVE {CRC_TABLE}, crc AS (
  SELECT *, {crc_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations, crc_table
), hurt AS (
  SELECT coalesce('=' || conv_id, '-') AS g, turn, CASE kind WHEN 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
  FROM crc, range(CASE WHEN kind = 0 THEN 0 WHEN kind = 3 THEN 2 ELSE 1 END)
), keyed AS (SELECT *, md5(length(role) || ':' || role || text) AS key, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM hurt
), numbered AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, key) AS i, count(*) OVER (PARTITION BY g) AS n FROM keyed
), again AS (
  SELECT *, CASE WHEN role = '' THEN 'e' WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'x' END AS initial,
    CASE WHEN body = '' THEN 'b' WHEN row_number() OVER (PARTITION BY g, key ORDER BY i) > 1 THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '0' END AS fault
  FROM numbered
), pairs AS (SELECT *, lag(initial) OVER (PARTITION BY g ORDER BY i) || initial AS pair FROM again
), counts AS (
  SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM pairs GROUP BY g
), inserts(q, t, letters, cost, lines) AS (
  VALUES (0, 0, '', 0, []), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []), (0, 2, 'I', 3, ['user:']), (0, 3, 'II', 6, ['user:', 'assistant:']),
    (1, 2, 'I', 3, ['user:']), (1, 3, 'II', 6, ['user:', 'assistant:']), (2, 3, 'I', 3, ['assistant:']), (2, 2, 'II', 6, ['assistant:', 'user:']), (3, 2, 'I', 3, ['user:']), (3, 3, 'II', 6, ['user:', 'assistant:'])
), moves(q, initial, t, letter, cost, given) AS (
  VALUES (0, 's', 1, 'K', 0, NULL), (0, 'u', 2, 'K', 0, NULL), (1, 'u', 2, 'K', 0, NULL), (2, 'a', 3, 'K', 0, NULL), (3, 'u', 2, 'K', 0, NULL),
    (0, 'e', 0, 'K', 0, NULL), (1, 'e', 1, 'K', 0, NULL), (2, 'e', 2, 'K', 0, NULL), (3, 'e', 3, 'K', 0, NULL),
    (0, NULL, 2, 'R', 3, 'user'), (1, NULL, 2, 'R', 3, 'user'), (2, NULL, 3, 'R', 3, 'assistant'), (3, NULL, 2, 'R', 3, 'user'),
    (0, NULL, 0, 'D', 4, NULL), (1, NULL, 1, 'D', 4, NULL), (2, NULL, 2, 'D', 4, NULL), (3, NULL, 3, 'D', 4, NULL)
), ways AS (
  SELECT g, 0::BIGINT AS i, 0 AS q, {{'c': 0::BIGINT, 'a': '', 'o': []::VARCHAR[]}} AS w FROM again GROUP BY g
  UNION ALL
  SELECT ways.g, ways.i + 1, m.t, min({{'c': w.c + x.cost + m.cost + CASE WHEN r.fault = 't' AND m.letter <> 'D' THEN 3 ELSE 0 END, 'a': w.a || x.letters || m.letter,
    'o': w.o || x.lines || CASE WHEN m.letter = 'D' THEN [] ELSE [coalesce(m.given, r.role) || ':' || r.text] END}})
  FROM ways JOIN again r ON r.g = ways.g AND r.i = ways.i + 1 JOIN inserts x ON x.q = ways.q JOIN moves m ON m.q = x.t AND coalesce(m.initial, r.initial) = r.initial
  WHERE m.letter = 'D' OR r.fault NOT IN ('b', 'd') GROUP BY ways.g, ways.i, m.t
), best AS (
  SELECT ways.g, min({{'c': w.c + x.cost, 'a': w.a || x.letters, 'o': w.o || x.lines}}) AS w
  FROM ways JOIN (SELECT DISTINCT g, n FROM again) s ON s.g = ways.g AND s.n = ways.i JOIN inserts x ON x.q = ways.q AND x.t IN (0, 3) GROUP BY ways.g
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(w.c, 0) AS cost, coalesce(w.a, '') AS audit, sha256(coalesce(array_to_string(w.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '-') AS g FROM conversations) o LEFT JOIN counts USING (g) LEFT JOIN best USING (g)
"""
