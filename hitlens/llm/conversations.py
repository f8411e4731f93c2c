"""Conversation structure repair by lightest derivations.

A repaired conversation is a system turn or none, then user and assistant in
turn. Every row may be kept, given another role or deleted, and empty turns
may be inserted, each at a cost. A derivation item is a span of rows with the
grammar state before and after it; Knuth's agenda finalises items in the order
of (cost, audit), joining a finalised span with those that border on it, until
the goal item is finalised. Long conversations are cut into chunks: the items
over each chunk are found apart and are the axioms of the next agenda.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlens.llm.common import BLANKS, bounded_batches, stored
from hitlens.llm.crc_sql import CRC_TABLE, crc_sql
from hitlens.llm.positions import with_positions

#: Rows of a conversation that one agenda takes, and chunks that the next one joins.
CHUNK, JOIN = 1024, 16
#: Grammar states: nothing yet, after the system turn, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
GOALS = (START, ASSISTANT)
#: (state before, initial of the turn, state after)
STEPS = ((START, "s", SYSTEM), (START, "u", USER), (SYSTEM, "u", USER), (ASSISTANT, "u", USER), (USER, "a", ASSISTANT))
LEGAL = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

Edge = tuple[int, int, int, str]  # state before, state after, cost, audit


def row_edges(initial: str, fault: str) -> list[Edge]:
    """What one row can do. ``fault``: "" or the name of its first fault."""
    edges = [(p, p, DELETE, "D") for p in STATES]
    if fault in ("", "truncated"):
        extra = TRUNCATED if fault else 0
        for p, turn, q in STEPS:
            if turn == initial:
                edges.append((p, q, KEEP + extra, "K"))
            elif turn != "s":
                edges.append((p, q, REROLE + extra, "R"))
    return edges


#: Inserted turns span no row.
INSERTED = [(p, q, INSERT, "I") for p, turn, q in STEPS if turn != "s"]


def lightest(spans: list[list[Edge]], start: int, goals: Iterable[int] | None = None) -> dict[int, tuple[int, str]]:
    """State at the end -> (cost, audit) of the lightest derivation over all spans from state ``start``.

    ``spans[i]`` holds the axioms between borders i and i + 1; an insertion is
    an axiom at every border. With ``goals`` the search ends at the first goal
    item and returns only that. Costs and audits grow along every rule, and two
    derivations of one item with the same cost never have audits of which one
    begins the other (that takes one more insertion), so the order by (cost,
    audit) is kept by every rule and an item's first value is its least.
    """
    last = len(spans)
    agenda: list[tuple] = [(cost, audit, i, p, i + 1, q) for i, edges in enumerate(spans) for p, q, cost, audit in edges]
    agenda += [(cost, audit, i, p, i, q) for i in range(last + 1) for p, q, cost, audit in INSERTED]
    agenda.append((0, "", -1, start, 0, start))  # the empty prefix; prefixes are marked by -1
    heapify(agenda)
    prefixes: dict[tuple[int, int], tuple[int, str]] = {}
    axioms = defaultdict(list)  # finalised ones by (border, state) before them
    found: dict[int, tuple[int, str]] = {}
    wanted = set(goals) if goals is not None else None
    while agenda:
        cost, audit, i, p, j, q = heappop(agenda)
        if i < 0:
            if (j, q) in prefixes:
                continue
            prefixes[j, q] = cost, audit
            if j == last:
                found[q] = cost, audit
                if wanted is not None and q in wanted:
                    return {q: (cost, audit)}
                if len(found) == len(STATES):
                    return found
            for c, a, k, r in axioms[j, q]:
                if (k, r) not in prefixes:
                    heappush(agenda, (cost + c, audit + a, -1, start, k, r))
        else:
            axioms[i, p].append((cost, audit, j, q))
            if (i, p) in prefixes and (j, q) not in prefixes:
                c, a = prefixes[i, p]
                heappush(agenda, (c + cost, a + audit, -1, start, j, q))
    return found


#: What is known of a chunk of a conversation; chunks that follow each other are joined.
SUMMARY = (
    "chunk long, first_turn long, last_turn long, n_turns long, blank long, duplicate long, truncated long, illegal long, "
    "first_role string, last_role string, edges array<struct<p:int,q:int,cost:long,audit:string>>"
)
_FIELDS = [f.split()[0] for f in SUMMARY.split(", ")]
_EDGES = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_TYPES = [pa.int64()] * 8 + [pa.string()] * 2 + [_EDGES]


def _edges(spans: list[list[Edge]], first: bool, final: bool) -> list[dict]:
    """Items over the whole of ``spans``: from the start state only if they open the conversation, goals only if they end it."""
    out = []
    for p in (START,) if first else STATES:
        for q, (cost, audit) in lightest(spans, p, GOALS if first and final else None).items():
            out.append({"p": p, "q": q, "cost": cost, "audit": audit})
    return out


def chunk_summary(chunk: int, rows: list[tuple], final: bool) -> tuple:
    """``rows``: (turn, initial, fault) in order."""
    turns = [t for t, _, _ in rows if t is not None]
    initials = [x for _, x, _ in rows]
    faults = [f for _, _, f in rows]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    return (chunk, turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)), faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), illegal, initials[0], initials[-1], _edges([row_edges(x, f) for _, x, f in rows], chunk == 0, final))


def joined_summary(chunk: int, parts: list[dict], final: bool) -> tuple:
    """One summary for chunks that follow each other."""
    with_turns = [p for p in parts if p["n_turns"]]
    shared = sum(a["last_turn"] == b["first_turn"] for a, b in zip(with_turns, with_turns[1:]))
    illegal = sum(a["last_role"] + b["first_role"] not in LEGAL for a, b in zip(parts, parts[1:]))
    spans = [[(e["p"], e["q"], e["cost"], e["audit"]) for e in p["edges"]] for p in parts]
    total = {c: sum(p[c] for p in parts) for c in ("n_turns", "blank", "duplicate", "truncated", "illegal")}
    return (chunk, with_turns[0]["first_turn"] if with_turns else None, with_turns[-1]["last_turn"] if with_turns else None, total["n_turns"] - shared,
            total["blank"], total["duplicate"], total["truncated"], total["illegal"] + illegal, parts[0]["first_role"], parts[-1]["last_role"],
            _edges(spans, chunk == 0, final))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _batch(keys: list, kind: pa.DataType, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_FIELDS)
    arrays = [pa.array(keys, kind), *[pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)]]
    return pa.RecordBatch.from_arrays(arrays, ["conv", *_FIELDS])


def _summaries(batches: Iterator[pa.RecordBatch], join: bool) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv, chunk, n_chunks, ...) to one summary per (conv, chunk); groups hold a bounded number of rows."""
    kind, keys, out = None, [], []

    def peeked() -> Iterator[pa.RecordBatch]:
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field(0).type
            yield batch

    for (conv, chunk, n_chunks), rows in groupby(_rows(peeked()), key=lambda r: r[:3]):
        keys.append(conv)
        if join:
            out.append(joined_summary(chunk, [dict(zip(_FIELDS, r[3:], strict=True)) for r in rows], n_chunks == 1))
        else:
            out.append(chunk_summary(chunk, [r[3:] for r in rows], n_chunks == 1))
        if sum(len(e["audit"]) for e in out[-1][-1]) > 1 << 20 or len(out) == 1000:
            yield _batch(keys, kind, out)
            keys, out = [], []
    if out:
        yield _batch(keys, kind, out)


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows (conv, turn, role, text) after the deterministic damage of the contract."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat(or_space(conv), F.lit(":"), or_space(turn)).cast("binary")), F.lit(20))
    given = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), or_space(role).alias("role"), or_space(text).alias("text"), fate.alias("fate"))
    left = given.where("fate <> 0").select(
        "conv", "turn", F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("copy"))
    return left.drop("copy")


def _identity(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def _faults(rows: DataFrame) -> DataFrame:
    """conv, turn, same (hash of role and text), initial, fault (blank, truncated or none yet)."""
    stripped = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(stripped == "", "blank").when(~F.right(stripped, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    return rows.select("conv", "turn", _identity(F.col("role"), F.col("text")).alias("same"), F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"))


def lightest_repairs(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv, turn, role, text): conv, gaps, blank, duplicate, truncated, illegal, cost, audit.

    Rows count in the order of turn (nulls first); rows of one turn in the
    order of a hash of role and text, so equal ones are neighbours. A null
    conversation id is a conversation; roles other than system, user and
    assistant can only be given another role or deleted. An empty table gives
    an empty one.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    narrow = stored(_faults(rows).withColumn("uid", F.monotonically_increasing_id()), "turns")
    placed = stored(with_positions(narrow, "conv", [F.col("turn").asc_nulls_first(), "same", "uid"], "turns-ranged").drop("uid"), "turns-placed")
    first = placed.groupBy("conv", "same").agg(F.min("pos").alias("first")).select(F.col("conv").alias("c"), F.col("same").alias("s"), "first")
    marked = placed.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")))
    fault = F.when(F.col("fault") == "blank", "blank").when(F.col("pos") > F.col("first"), "duplicate").otherwise(F.col("fault"))
    chunk, chunks = F.expr(f"pos DIV {CHUNK}"), F.expr(f"(n + {CHUNK - 1}) DIV {CHUNK}")
    turns = marked.select("conv", chunk.alias("chunk"), chunks.alias("n_chunks"), "turn", "initial", fault.alias("fault"), "pos")
    kind = narrow.schema["conv"].dataType.simpleString()
    ordered = turns.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "pos").drop("pos")
    summaries = stored(ordered.mapInArrow(lambda b: _summaries(b, False), f"conv {kind}, {SUMMARY}"), "turn-chunks")
    while summaries.agg(F.max("chunk")).first()[0]:
        last = summaries.groupBy("conv").agg(F.max("chunk").alias("last")).select(F.col("conv").alias("c"), F.expr(f"last DIV {JOIN} + 1").alias("n_chunks"))
        dealt = summaries.join(last, F.col("conv").eqNullSafe(F.col("c"))).withColumn("to", F.expr(f"chunk DIV {JOIN}"))
        ordered = dealt.repartition("conv", "to").sortWithinPartitions("conv", "to", "chunk").select("conv", "to", "n_chunks", *_FIELDS)
        summaries = stored(ordered.mapInArrow(lambda b: _summaries(b, True), f"conv {kind}, {SUMMARY}"), "turn-chunks")
    goals = F.filter("edges", lambda e: e["q"].isin(*GOALS))
    best = F.array_min(F.transform(goals, lambda e: F.struct(e["cost"].alias("cost"), e["audit"].alias("audit"))))
    gaps = F.coalesce(F.expr("last_turn - first_turn + 1 - n_turns"), F.lit(0)).alias("gaps")
    return summaries.select("conv", gaps, "blank", "duplicate", "truncated", "illegal", best["cost"].alias("cost"), best["audit"].alias("audit"))


def _repaired(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted (conv, turn, role, text, audit), each conversation led by the row that has its audit.

    Yields (conv, None, None) for it and (conv, role, text) for every turn of
    the repaired conversation. Holds one audit and one row.
    """
    audit, at, place, opened = "", 0, 0, False
    roles = ("user", "assistant")
    for conv, _, role, text, led in rows:
        if led is not None:
            audit, at, place, opened = led, 0, 0, False
            opened = (len(audit) - audit.count("D")) % 2 == 1  # a system turn comes first
            yield conv, None, None
        else:
            edit = audit[at]
            at += 1
            if edit != "D":
                yield conv, role if edit == "K" else roles[(place - opened) % 2], text
                place += 1
        while at < len(audit) and audit[at] == "I":
            yield conv, roles[(place - opened) % 2], ""
            place, at = place + 1, at + 1


def _in_order(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """Rows and audits by conversation: one task streams a conversation, as its text is one sequence."""
    same = _identity(F.col("role"), F.col("text"))
    led = repairs.select("conv", F.lit(0).alias("after"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("same"),
                         F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "audit")
    given = rows.select("conv", F.lit(1).alias("after"), "turn", same.alias("same"), "role", "text", F.lit(None).cast("string").alias("audit"))
    dealt = led.union(given).repartition("conv")
    return dealt.sortWithinPartitions("conv", "after", F.col("turn").asc_nulls_first(), "same").select("conv", "turn", "role", "text", "audit")


def repaired_turns(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """(conv, place, role, text) of the repaired conversations; ``repairs`` comes from ``lightest_repairs(rows)``."""
    kind = rows.schema["conv"].dataType.simpleString()

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches_of(_repaired(peek(batches))):
            out = []
            for conv, role, text in batch:
                place = 0 if role is None else place + 1
                if role is not None:
                    out.append((conv, place - 1, role, text))
            columns = list(zip(*out, strict=True)) or [()] * 4
            types = (peek.kind, pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["conv", "place", "role", "text"])

    peek = _Peek()
    return _in_order(rows, repairs).mapInArrow(render, f"conv {kind}, place long, role string, text string")


class _Peek:
    """Rows of batches, remembering the type of the first column."""

    kind: pa.DataType | None = None

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            self.kind = batch.schema.field(0).type
            yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def batches_of(rows: Iterator[tuple], size: int = 1 << 20) -> Iterator[list[tuple]]:
    """Lists of rows with about ``size`` characters of text in the last field."""
    held, load = [], 0
    for row in rows:
        held.append(row)
        load += 50 + len(row[-1] or "")
        if load > size:
            yield held
            held, load = [], 0
    if held:
        yield held


def repaired_hashes(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): hash of the repaired turns as ``role:text``, joined by newlines."""
    kind = rows.schema["conv"].dataType.simpleString()
    peek = _Peek()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs, found, digest, joint = [], [], None, b""

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(convs, peek.kind), pa.array(found, pa.string())], ["conv", "repaired_sha256"])

        for conv, role, text in _repaired(peek(batches)):
            if role is None:
                if digest is not None:
                    found.append(digest.hexdigest())
                if len(found) >= 10_000:
                    yield out()
                    convs, found = [], []
                convs.append(conv)
                digest, joint = sha256(), b""
            else:
                digest.update(joint + f"{role}:{text}".encode())
                joint = b"\n"
        if digest is not None:
            found.append(digest.hexdigest())
            yield out()

    return _in_order(rows, repairs).mapInArrow(hashes, f"conv {kind}, repaired_sha256 string")


def repair_digest(conversations: DataFrame) -> DataFrame:
    """One row per conversation; one without rows after the damage has zeros, an empty audit and the hash of nothing."""
    rows = damaged(conversations)
    repairs = stored(lightest_repairs(rows), "repairs")
    hashes = repaired_hashes(rows, repairs).withColumnRenamed("conv", "h")
    known = repairs.join(hashes, F.col("conv").eqNullSafe(F.col("h"))).drop("h").withColumnRenamed("conv", "c")
    every = conversations.select("conv_id").distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(known, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256"))


_WRITTEN = "coalesce({}::VARCHAR, ' ')"
_ACTS = ", ".join(f"({p}, '{turn}', {q})" for p, turn, q in STEPS)
_INSERTS = ", ".join([f"({p}, {p}, 0, '')" for p in STATES] + [f"({p}, {q}, {c}, '{a}')" for p, q, c, a in INSERTED]
                     + [f"({p}, {ASSISTANT}, {2 * INSERT}, 'II')" for p in (START, SYSTEM)])
REPAIR_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
given AS (
  SELECT conv_id, turn, {_WRITTEN.format("role")} AS role, {_WRITTEN.format("text")} AS text,
    {crc_sql(f"{_WRITTEN.format('conv_id')} || ':' || {_WRITTEN.format('turn')}")} % 20 AS fate
  FROM conversations, crc
),
convs AS (SELECT conv_id, row_number() OVER () AS cid FROM (SELECT DISTINCT conv_id FROM conversations)),
kept AS (
  SELECT cid, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM given JOIN convs ON given.conv_id IS NOT DISTINCT FROM convs.conv_id WHERE fate <> 0
),
ord AS (
  SELECT *, row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) - 1 AS pos,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM kept
),
r AS (
  SELECT cid, pos, turn, role, text, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY cid ORDER BY pos) AS prior,
    CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY cid, role, text ORDER BY pos) > 1 THEN 'duplicate'
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM ord
),
ins(p, q, cost, audit) AS (VALUES {_INSERTS}),
act(p, turn, q) AS (VALUES {_ACTS}),
edge AS (
  SELECT cid, pos, p, q, CASE WHEN initial = turn THEN {KEEP} ELSE {REROLE} END + CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END AS cost,
    CASE WHEN initial = turn THEN 'K' ELSE 'R' END AS audit
  FROM (SELECT r.*, act.p, act.turn, act.q FROM r, act WHERE fault IN ('', 'truncated') AND (initial = act.turn OR act.turn <> 's')) AS moves(cid, pos, no, role, text, initial, prior, fault, p, turn, q)
  UNION ALL SELECT cid, pos, p, p, {DELETE}, 'D' FROM r, (SELECT DISTINCT unnest({list(STATES)}) AS p)
),
best AS (
  SELECT cid, 0::BIGINT AS pos, {START} AS q, lpad('0', 12, '0') AS value FROM convs
  UNION ALL
  SELECT b.cid, b.pos + 1, edge.q, min(lpad((left(value, 12)::BIGINT + ins.cost + edge.cost)::VARCHAR, 12, '0') || substr(value, 13) || ins.audit || edge.audit)
  FROM best b JOIN ins ON ins.p = b.q JOIN edge ON edge.cid = b.cid AND edge.pos = b.pos AND edge.p = ins.q
  GROUP BY b.cid, b.pos, edge.q
),
stat AS (
  SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (prior IS NOT NULL AND prior || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM r GROUP BY cid
),
won AS (
  SELECT b.cid, min(lpad((left(value, 12)::BIGINT + ins.cost)::VARCHAR, 12, '0') || substr(value, 13) || ins.audit) AS value
  FROM best b JOIN stat ON stat.cid = b.cid AND stat.n = b.pos JOIN ins ON ins.p = b.q AND ins.q IN {GOALS} GROUP BY b.cid
),
spelled AS (SELECT cid, substr(value, 13) AS audit, unnest(generate_series(1, length(value) - 12)) AS i FROM won),
placed AS (
  SELECT cid, i, substr(audit, i, 1) AS edit, length(replace(left(audit, i - 1), 'I', '')) AS pos,
    length(replace(left(audit, i - 1), 'D', '')) - length(replace(audit, 'D', '')) % 2 AS place
  FROM spelled
),
text AS (
  SELECT placed.cid, string_agg(CASE WHEN edit = 'K' THEN role WHEN place % 2 = 0 THEN 'user' ELSE 'assistant' END || ':'
    || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS whole
  FROM placed LEFT JOIN r ON r.cid = placed.cid AND r.pos = placed.pos WHERE edit <> 'D' GROUP BY placed.cid
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(left(value, 12)::BIGINT, 0) AS cost,
  coalesce(substr(value, 13), '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM convs LEFT JOIN stat USING (cid) LEFT JOIN won USING (cid) LEFT JOIN text USING (cid)
"""
