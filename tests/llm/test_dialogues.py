"""Conversation repair against dynamic programming and plain definitions."""

import hashlib
import random
import zlib
from collections import defaultdict
from functools import reduce

import pytest
from oracle import SF_DIR
from pyspark.sql import functions as F

from tallystream.llm import dialogues
from tallystream.llm.auction import ENDS, NONE, Lattice, matrix, paid, turn_code
from tallystream.llm.dialogues import op13_auction_repair, repaired_blocks, reports
from tallystream.llm.workload import QUERIES

TURNS = "conv_id long, turn long, role string, text string"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
WANTED = {"": "u", "s": "u", "u": "a", "a": "u"}


def plain_audit(turns):
    """Cheapest (cost, letters) of (initial, fault) turns, from the last place back."""
    best = {"": (0, ""), "a": (0, "")}
    for place in range(len(turns), -1, -1):
        if place < len(turns):
            initial, fault = turns[place]
            more = 5 if fault == 3 else 0
            column = {}
            for state in NEXT:
                ways = [(2, "D", state)]
                if fault in (0, 3):
                    ways.append((1 + more, "R", WANTED[state]))
                    if initial in NEXT[state]:
                        ways.append((more, "K", NEXT[state][initial]))
                column[state] = [(c + best[to][0], a + best[to][1]) for c, a, to in ways if to in best]
            best = {state: min(ways) for state, ways in column.items() if ways}
        for _ in range(3):  # turns put in, in any number
            for state, to in WANTED.items():
                if to in best:
                    here = (5 + best[to][0], "I" + best[to][1])
                    best[state] = min(best.get(state, here), here)
    return best[""]


def some_codes(rng, n):
    return [(rng.choice(["s", "u", "a", "x", ""]), rng.randrange(4)) for _ in range(n)]


def as_bytes(turns):
    return bytes(turn_code(*t) for t in turns)


def test_auction_against_dynamic_programming():
    rng = random.Random(0)
    for _ in range(4_000):
        turns = some_codes(rng, rng.randrange(0, 14))
        audit, _, cost = Lattice(as_bytes(turns)).audit(0)
        assert (cost, audit) == plain_audit(turns)
        assert paid(audit, as_bytes(turns)) == cost


def test_blocks_give_the_edits_of_the_whole():
    rng = random.Random(1)
    for _ in range(500):
        blocks = [some_codes(rng, rng.randrange(0, 8)) for _ in range(4)]
        ends = [list(ENDS)]
        for block in reversed(blocks[1:]):
            costs = matrix(as_bytes(block))
            ends.append([min(NONE, *(costs[4 * s + t] + ends[-1][t] for t in range(4))) for s in range(4)])
        state, letters = 0, ""
        for block, end in zip(blocks, reversed(ends), strict=True):
            audit, state, _ = Lattice(as_bytes(block), end).audit(state)
            letters += audit
        assert letters == plain_audit(reduce(list.__add__, blocks))[1]


def plain_reports(rows):
    """``rows`` as they are after damage; a row of None names a conversation only."""
    conversations = defaultdict(list)
    for conv, turn in rows:
        conversations[conv] += [turn] if turn else []
    out = []
    for conv, turns in conversations.items():
        turns = sorted(turns, key=lambda t: ((0, 0) if t[0] is None else (1, t[0]), t[1], t[2]))
        numbers = {n for n, _, _ in turns if n is not None}
        seen, faults = set(), []
        for _, role, text in turns:
            body = text.strip(" \t\n\v\f\r")
            faults.append(1 if not body else 2 if (role, text) in seen else 0 if body[-1] in ".!?" else 3)
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in turns]
        cost, audit = plain_audit(list(zip(initials, faults, strict=True)))
        state, lines, place = "", [], 0
        for letter in audit:
            if letter in "IR":
                state = WANTED[state]
                name = {"u": "user", "a": "assistant"}[state]
                lines.append(f"{name}:{'' if letter == 'I' else turns[place][2]}")
            elif letter == "K":
                state = NEXT[state][initials[place]]
                lines.append(f"{turns[place][1]}:{turns[place][2]}")
            place += letter != "I"
        pairs = zip(initials, initials[1:], strict=False)
        out.append((
            conv, max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
            faults.count(1), faults.count(2), faults.count(3),
            sum(a + b not in ("su", "ua", "au") for a, b in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def damaged_rows(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fate = zlib.crc32(key.encode()) % 20
        text = "" if fate == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if fate == 2 else text
        role = "user" if fate == 4 else role
        yield conv, None if fate == 0 else (turn, role, text)
        if fate == 3:
            yield conv, (turn, role, text)


def got(df):
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("block", [3, 128])
def test_query_against_plain_definition(spark, monkeypatch, block):
    monkeypatch.setattr(dialogues, "BLOCK", block)
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert got(QUERIES["op13_auction_repair"](spark, SF_DIR)) == plain_reports(damaged_rows(rows))


def odd_conversations(rng):
    texts = ["Hi.", "Well?", "no end", "", " \n", None, "é!", "Hi.", "a.b.c"]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "ultra"]
    rows = [(7, t, rng.choice(roles), rng.choice(texts)) for t in [*range(300), None, None]]  # copies far apart
    rows += [(c, t, rng.choice(roles[:3]), rng.choice(texts)) for c in range(10, 60) for t in range(rng.randrange(1, 9))]
    rows += [(None, t, "user", "Hi.") for t in (1, 1, 5, None)] + [(8, None, "user", "Hi.")] * 3
    return rows + [(9, 0, "user", "x" * 300_000 + ".")] + [(9, 0, "user", "x" * 300_000 + ".")]


@pytest.mark.parametrize("block", [1, 5, 128])
def test_odd_rows(spark, monkeypatch, tmp_path, block):
    monkeypatch.setattr(dialogues, "BLOCK", block)
    rows = odd_conversations(random.Random(3))
    extra = spark.createDataFrame([(*r, 1, "k") for r in rows], TURNS + ", conv int, audit string")
    extra.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(op13_auction_repair(spark, str(tmp_path))) == plain_reports(damaged_rows(rows))


def test_all_turns_of_a_conversation_may_be_gone(spark):
    frame = spark.createDataFrame([(1, 0, "user", "Hi.")], TURNS)
    lost = reports(repaired_blocks(frame, absent=F.lit(True)))
    assert got(lost) == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert reports(repaired_blocks(frame.limit(0))).collect() == []


def test_a_hot_conversation_lies_in_several_tasks(spark):
    turns = spark.range(3_000).selectExpr(
        "1L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role",
        "IF(id % 7 = 0, 'again.', concat('turn ', id, '.')) AS text",
    )
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # so little would be merged into one task
    try:
        blocks = repaired_blocks(turns)
        assert blocks.select("part").distinct().count() > 1
    finally:
        spark.conf.unset(setting)
    assert blocks.agg(F.max("n")).first()[0] <= dialogues.BLOCK
    rows = [(r[0], (r[1], r[2], r[3])) for r in turns.collect()]
    assert got(reports(blocks)) == plain_reports(rows)
