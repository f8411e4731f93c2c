"""Conversation repair against a plain dynamic programme and SQL."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from hitlens.llm import conversations
from tests.llm.data import SMALL, against_sql, as_rows, with_clashes

BLANKS = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
SCHEMA = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repaired(rows):
    """rows: (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(BLANKS)
        faults.append("blank" if not bare.strip(BLANKS) else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {"": (0, "", ())}

    def take(into, state, value):
        if state not in into or value[:2] < into[state][:2]:
            into[state] = value

    def inserted(now):
        for _ in range(3):
            for state, (cost, audit, out) in list(now.items()):
                for role in ("user", "assistant"):
                    if (state, role[0]) in NEXT:
                        take(now, NEXT[state, role[0]], (cost + 5, audit + "I", (*out, (role, ""))))
        return now

    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for state, (cost, audit, out) in inserted(best).items():
            take(after, state, (cost + 2, audit + "D", out))
            if fault in ("", "truncated"):
                extra = 5 if fault else 0
                if (state, role[:1]) in NEXT:
                    take(after, NEXT[state, role[:1]], (cost + extra, audit + "K", (*out, (role, text))))
                for other in ("user", "assistant"):
                    if (state, other[0]) in NEXT:
                        take(after, NEXT[state, other[0]], (cost + 1 + extra, audit + "R", (*out, (other, text))))
        best = after
    best = inserted(best)
    cost, audit, out = min(best[s] for s in ("", "a") if s in best)
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    whole = "\n".join(f"{r}:{t}" for r, t in out)
    return gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest(), out


def restated(rows):
    """rows: (conv_id, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 0:
            continue
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        kept += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    tie = lambda r: hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).hexdigest()
    return {c: repaired(sorted(k, key=lambda r: (r[0] is not None, r[0] or 0, tie(r)))) for c, k in convs.items()}


def awkward_conversations(spark, n=60, seed=3):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(0, 14)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "User"])
            text = rng.choice(["Yes.", "No!", "And so on", "", None, " \t", "é?\n", "x " * rng.randrange(1, 400) + "."])
            rows += [(conv, rng.choice([turn, turn, turn * 3, None]), role, text)] * rng.choice([1, 1, 1, 2])
    rows += [(None, t, r, "hm.") for t, r in enumerate(["user", "assistant", "user"])]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def check(spark, frame):
    got = conversations.repair_digest(with_clashes(frame))
    want = restated([tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()])
    assert as_rows(got, *[f.split()[0] for f in SCHEMA.split(", ")]) == as_rows(spark.createDataFrame([(c, *v[:-1]) for c, v in want.items()], SCHEMA))


def test_repairs_match_restatement_and_sql(spark):
    small = spark.read.parquet(f"{SMALL}/conversations.parquet")
    for frame in (awkward_conversations(spark), small):
        check(spark, frame)
        pandas = frame.toPandas().astype({"conv_id": "Int64", "turn": "Int64"})
        ours, theirs = against_sql(conversations.repair_digest(frame), conversations.REPAIR_SQL, conversations=pandas)
        assert ours == theirs
    assert conversations.repair_digest(small.limit(0)).count() == 0


@pytest.mark.parametrize("chunk, join", [(1, 2), (3, 2), (5, 16)])
def test_chunks_joined_over_levels_change_nothing(spark, monkeypatch, chunk, join):
    monkeypatch.setattr(conversations, "CHUNK", chunk)
    monkeypatch.setattr(conversations, "JOIN", join)
    check(spark, awkward_conversations(spark, 25, seed=chunk))


def test_conversation_of_many_chunks(spark):
    rng = random.Random(1)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "c!", f"{t}."])) for t in range(2600)]
    check(spark, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))


def test_repaired_turns_follow_the_grammar(spark):
    frame = awkward_conversations(spark, 30, seed=9)
    rows = conversations.damaged(frame)
    turns = conversations.repaired_turns(rows, conversations.lightest_repairs(rows)).collect()
    want = restated([tuple(r) for r in frame.collect()])
    got = {}
    for r in sorted(turns, key=lambda r: (r.conv is not None, r.conv or 0, r.place)):
        got.setdefault(r.conv, []).append((r.role, r.text))
    assert got == {c: list(v[-1]) for c, v in want.items() if v[-1]}


def test_first_goal_is_the_lightest(spark):
    rng = random.Random(4)
    for _ in range(300):
        spans = [conversations.row_edges(rng.choice("suat "), rng.choice(["", "", "blank", "truncated"])) for _ in range(rng.randrange(0, 8))]
        every = conversations.lightest(spans, conversations.START)
        first = conversations.lightest(spans, conversations.START, conversations.GOALS)
        assert list(first.values()) == [min(every[q] for q in conversations.GOALS if q in every)]
