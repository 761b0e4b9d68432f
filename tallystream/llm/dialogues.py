"""Conversation structure repair: faults of turns, and the cheapest edits to a well-formed dialogue.

Turns are sorted by range over all tasks and cut into blocks, so a long conversation lies in
several tasks. A conversation within one block is solved there. Of others, each block gives the
costs of crossing it (16 numbers), what lies behind each block follows from these, each block
then gives its edits for each state it may be entered in, and the true ones are picked. What
passes through one task for one conversation is these numbers and, for its digest, its repaired
blocks one after the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby, pairwise

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tallystream.llm.auction import (
    BLANK,
    DUPLICATE,
    ENDS,
    NONE,
    SOUND,
    START,
    STATES,
    TRUNCATED,
    Lattice,
    apply,
    matrix,
    paid,
    turn_code,
)
from tallystream.llm.tables import id_of, key_of, store, table

#: Turns, and characters of text, that end a block.
BLOCK = 128
BLOCK_CHARS = 1 << 20
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_LEGAL = {"su", "ua", "au"}
_FAULTS = ("blank", "duplicate", "truncated")

_KEY = [("conv", pa.int64()), ("part", pa.int32()), ("seq", pa.int64())]
_COUNTS = [
    ("n", pa.int64()), ("turns", pa.int64()), ("first_turn", pa.int64()), ("last_turn", pa.int64()),
    ("first_role", pa.string()), ("last_role", pa.string()), ("illegal", pa.int64()),
    *((name, pa.int64()) for name in _FAULTS),
]
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_BLOCK = pa.schema(
    [*_KEY, ("whole", pa.bool_()), *_COUNTS, ("codes", pa.binary()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
)
_CROSSED = pa.schema([*_KEY, ("codes", pa.binary()), ("costs", pa.list_(pa.int64()))])
_ENDS = pa.schema([*_KEY, ("codes", pa.binary()), ("ends", pa.list_(pa.int64()))])
_ENTERED = pa.schema([*_KEY, ("audits", pa.list_(pa.string())), ("states", pa.list_(pa.int64()))])
_PICKED = pa.schema([*_KEY, ("entry", pa.int32()), ("audit", pa.string())])
_SOLVED = pa.schema([*_KEY, *_COUNTS, ("audit", pa.string()), ("cost", pa.int64()), ("repaired", _TURNS)])
_REPORT = pa.schema(
    [
        ("conv", pa.int64()), ("gaps", pa.int64()), *((name, pa.int64()) for name in _FAULTS),
        ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string()),
    ]
)


def _map(df: DataFrame, function, schema: pa.Schema) -> DataFrame:
    return df.mapInArrow(function, from_arrow_schema(schema))


def _batches(schema: pa.Schema, rows: Iterator[dict], size: int = 500) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded length; ``chars`` of a row says how much text it has."""
    waiting: list[dict] = []
    chars = 0
    for row in rows:
        waiting.append(row)
        chars += row.pop("chars", 0)
        if len(waiting) >= size or chars >= BLOCK_CHARS:
            yield pa.RecordBatch.from_pylist(waiting, schema)
            waiting, chars = [], 0
    if waiting:
        yield pa.RecordBatch.from_pylist(waiting, schema)


def _fault(text: str, repeated: bool) -> int:
    body = text.rstrip(_SPACE)
    if not body:
        return BLANK
    if repeated:
        return DUPLICATE
    return SOUND if body[-1] in ".!?" else TRUNCATED


def _block(conv: int, part: int, seq: int, turns: list[dict], whole: bool) -> dict:
    there = [t for t in turns if not t["absent"]]
    numbers = [t["turn"] for t in there if t["turn"] is not None]  # in order
    faults = [_fault(t["text"], t["repeated"]) for t in there]
    initials = [t["role"][:1] for t in there]
    ends = {"first_role": initials[0], "last_role": initials[-1]} if there else {"first_role": None, "last_role": None}
    return {
        "conv": conv, "part": part, "seq": seq, "whole": whole, "n": len(there),
        "turns": len(set(numbers)),
        "first_turn": numbers[0] if numbers else None, "last_turn": numbers[-1] if numbers else None,
        **ends,
        "illegal": sum(a + b not in _LEGAL for a, b in pairwise(initials)),
        **{name: faults.count(i) for i, name in enumerate(_FAULTS, BLANK)},
        "codes": bytes(map(turn_code, initials, faults)),
        "roles": [t["role"] for t in there], "texts": [t["text"] for t in there],
        "chars": sum(len(t["text"]) for t in there),
    }


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a sorted partition. A conversation is whole if it begins and ends inside."""

    def blocks() -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        seq, chars, inside, turns = 0, 0, False, []
        for batch in batches:
            for turn in batch.to_pylist():
                if turns and turn["conv"] != turns[0]["conv"]:
                    yield _block(turns[0]["conv"], part, seq, turns, inside)
                    seq, chars, inside, turns = seq + 1, 0, True, []
                elif len(turns) >= BLOCK or chars >= BLOCK_CHARS:
                    yield _block(turns[0]["conv"], part, seq, turns, False)
                    seq, chars, inside, turns = seq + 1, 0, False, []
                turns.append(turn)
                chars += len(turn["text"])
        if turns:
            yield _block(turns[0]["conv"], part, seq, turns, False)

    return _batches(_BLOCK, blocks())


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for batch in batches for row in batch.to_pylist())
    return _batches(_CROSSED, ({**row, "costs": matrix(row["codes"])} for row in rows))


def _ends(group: pd.DataFrame) -> pd.DataFrame:
    """What it costs to go on from each state behind each block of a conversation."""
    group = group.sort_values(["part", "seq"], ignore_index=True)
    ends = [list(ENDS)]
    for costs in reversed(group["costs"].tolist()[1:]):
        behind = ends[-1]
        crossed = [[c + e for c, e in zip(costs[s * STATES : (s + 1) * STATES], behind, strict=True)] for s in range(STATES)]
        ends.append([int(min(NONE, *c)) for c in crossed])
    return group[["conv", "part", "seq", "codes"]].assign(ends=ends[::-1])


def _entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def solved() -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                lattice = Lattice(row.pop("codes"), row.pop("ends"))
                audits, states, _ = zip(*map(lattice.audit, range(STATES)), strict=True)
                yield {**row, "audits": list(audits), "states": list(states)}

    return _batches(_ENTERED, solved())


def _picked(group: pd.DataFrame) -> pd.DataFrame:
    """The edits of each block, entered in the state that the one before it ends in."""
    group = group.sort_values(["part", "seq"], ignore_index=True)
    state, entry, audits = START, [], []
    for row in group.itertuples():
        entry.append(state)
        audits.append(row.audits[state])
        state = int(row.states[state])
    return group[["conv", "part", "seq"]].assign(entry=entry, audit=audits)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their edits done; those of whole conversations are solved here."""

    def solved() -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, state = row.pop("codes"), row.pop("entry")
                if row.pop("whole"):
                    row["audit"] = Lattice(codes).audit(START)[0]
                audit = row["audit"]
                cost = paid(audit, codes)
                repaired = apply(audit, state, row.pop("roles"), row.pop("texts"))
                chars = sum(len(t["text"]) for t in repaired)
                yield {**row, "cost": cost, "repaired": repaired, "chars": chars}

    return _batches(_SOLVED, solved())


def repaired_blocks(turns: DataFrame, absent: Column | None = None) -> DataFrame:
    """Blocks of conversations with the cheapest edits that give each the form ``(s?(ua)+)?``.

    ``turns`` has conv_id, turn, role, text. Returns conv, part, seq (the order of a conversation's
    blocks), n turns, audit (a letter per edit), cost, repaired (role and text of what is left)
    and counts, which ``reports`` adds up. Turns go by number, null first, then by role, text.
    A turn is at fault as blank, else as duplicate of an earlier one, else as truncated. Keeping
    it costs 0, another role 1, deleting it 2, a truncated one left in 5 more, an empty turn put
    in 5; blank and duplicate turns must go. Of the cheapest edits those least in ASCII are taken.

    Null roles and texts are empty. Rows without a conversation are one conversation of their own,
    with conv 2^63 - 1. Equal rows are duplicates of the first of them. Rows for which ``absent`` holds
    only name their conversation; without turns it gives an empty audit. Other columns are not
    read. No rows give no rows.
    """
    rows = store(
        turns.select(
            key_of("conv_id").alias("conv"),
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
            (F.lit(False) if absent is None else F.coalesce(absent, F.lit(False))).alias("absent"),
            F.monotonically_increasing_id().alias("row"),
        ).withColumn("same", F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)),
        "turns",
    )
    # Equal turns meet as counts of two numbers, so many copies of one cost a task little.
    first = (
        rows.filter(~F.col("absent")).groupBy("conv", "same")
        .agg(F.min(F.struct("turn", "row")).alias("first"), F.count("*").alias("times"))
        .filter("times > 1").select("conv", "same", "first")
    )
    order = ["conv", "turn", "role", "start", "same", "row"]
    flagged = rows.join(first, ["conv", "same"], "left").select(
        "conv", "turn", "role", F.substring("text", 1, 64).alias("start"), "same", "row", "text", "absent",
        F.coalesce(F.col("first.row") != F.col("row"), F.lit(False)).alias("repeated"),
    )
    ranged = flagged.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = ranged.select("conv", "turn", "role", "text", "absent", "repeated")
    blocks = store(_map(cut, _cut, _BLOCK), "turn-blocks")
    torn = blocks.filter("NOT whole")
    crossed = _map(torn.select("conv", "part", "seq", "codes"), _crossed, _CROSSED)
    ends = crossed.groupBy("conv").applyInPandas(_ends, from_arrow_schema(_ENDS))
    entered = _map(ends.repartition("conv", "part", "seq"), _entered, _ENTERED)
    picked = entered.groupBy("conv").applyInPandas(_picked, from_arrow_schema(_PICKED))
    whole = blocks.filter("whole").withColumns(
        {"entry": F.lit(START), "audit": F.lit(None).cast("string")}
    )
    both = whole.unionByName(torn.join(picked, ["conv", "part", "seq"]))
    return _map(both, _edited, _SOLVED)


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation, whose blocks come one after the other."""
    blocks = (block for batch in batches for block in batch.to_pylist())
    return _batches(_REPORT, (_report(conv, own) for conv, own in groupby(blocks, lambda b: b["conv"])))


def _report(conv: int, blocks: Iterator[dict]) -> dict:
    report = dict.fromkeys(("illegal", "cost", *_FAULTS), 0)
    audits, digest, separator = [], hashlib.sha256(), ""
    role = low = high = None
    distinct = 0
    for block in blocks:
        for name in report:
            report[name] += block[name]
        if block["n"]:
            report["illegal"] += role is not None and role + block["first_role"] not in _LEGAL
            role = block["last_role"]
        if block["turns"]:
            distinct += block["turns"] - (high == block["first_turn"])
            low = block["first_turn"] if low is None else low
            high = block["last_turn"]
        audits.append(block["audit"])
        for turn in block["repaired"]:
            digest.update(f"{separator}{turn['role']}:{turn['text']}".encode())
            separator = "\n"
    gaps = 0 if low is None else high - low + 1 - distinct
    return {"conv": conv, "gaps": gaps, **report, "audit": "".join(audits), "repaired_sha256": digest.hexdigest()}


def reports(blocks: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 per conversation.

    ``gaps`` are the numbers missing between the first and the last turn, ``illegal`` the neighbours
    whose roles do not follow each other. The digest is that of the repaired ``role:text`` lines.
    """
    order = ["conv", "part", "seq"]
    told = _map(blocks.repartition("conv").sortWithinPartitions(*order), _told, _REPORT)
    return told.select(id_of("conv").alias("conv_id"), *told.columns[1:])


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with faults put in by a hash of conversation and turn, and whether one is gone.

    Of twenty hashes one drops the turn, one empties its text, one takes its sentence ends away,
    one repeats it and one makes it the user's. Nulls count as one space.
    """
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    fate = F.crc32(F.concat(spaced["conv_id"], F.lit(":"), spaced["turn"]).cast("binary")) % 20
    struck = conversations.select(
        "conv_id", "turn", spaced["role"].alias("role"), spaced["text"].alias("text"), fate.alias("fate")
    )
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return struck.select(
        "conv_id", "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("fate") == 0).alias("gone"),
        F.explode(copies).alias("copy"),
    )


def op13_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repairs of all conversations, whose turns were damaged before."""
    turns = damaged(table(spark, sf_dir, "conversations"))
    return reports(repaired_blocks(turns, absent=F.col("gone")))
