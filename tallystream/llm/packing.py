"""Packing: concatenate all documents and cut into windows of equal length.

Pass one tokenizes every partition and notes where each document starts within it. The
prefix sums of the partitions' token totals give global offsets, from which pass two cuts
every document at the window borders. No row but one total per partition is ever together
in one place.
"""

from __future__ import annotations

import re
import string
import sys
import types
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.llm.batches import parts
from tallystream.llm.tables import store

WINDOW = 4096
END_ID = 2
#: Words kept with their ids per task (some 100 MB); beyond that a new memory is begun, and the
#: words that the one before has in common with it are taken over as they come up.
REMEMBERED = 500_000
#: Text bytes whose distinct words are encoded at a time.
TEXT_BYTES = 1 << 21
_MARKS = string.punctuation


@cache
def marked_letters() -> str:
    """Letters whose lower case or normal form ends in a mark, which joins the marks behind it."""
    found = []
    for letter in filter(str.isalpha, map(chr, range(sys.maxunicode + 1))):
        forms = letter.lower() + unicodedata.normalize("NFC", letter)
        if any(unicodedata.category(c).startswith("M") for c in forms):
            found.append(letter)
    return "".join(found)


class WordEncoder:
    """Ids of whole texts from the ids of their distinct words, with a bounded memory of words.

    Holds for tokenizers that ignore the case of A to Z, never join what white space parts and
    end each piece with ``</w>``; the test compares it with the tokenizer on whole texts. Texts
    with a special token, a combining mark or a letter that stands for one go to the tokenizer as
    they are.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.end_id = end_id
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for piece, i in vocabulary.items():
            self.last[i] = piece.endswith("</w>")
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Special tokens, and marks that may join the letter before them.
        marks = r"[\x{0300}-\x{036f}" + marked_letters() + "]"
        self.odd = "|".join([marks, *map(re.escape, special)])
        self.seen: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _plain(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, "<u4").tobytes()

    def _learn_pieces(self, pieces: list[str]) -> None:
        """Words that are a single piece each, all letters or all marks."""
        raw = self._plain(" ".join(pieces))
        ends = 4 * (np.flatnonzero(self.last[np.frombuffer(raw, "<u4")]) + 1)
        if len(ends) == len(pieces):
            ends = ends.tolist()
            self.seen.update(
                zip(pieces, [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], strict=True)
            )
        else:
            self.seen.update((p, self._plain(p)) for p in pieces)

    def _recall(self, words: Iterable[str]) -> list[str]:
        """Take words over from the older memory; returns those that it lacks."""
        unknown = []
        for w in words:
            ids = self.older.get(w)
            if ids is None:
                unknown.append(w)
            else:
                self.seen[w] = ids
        return unknown

    def _learn(self, new: list[str]) -> None:
        need = {w for w in new if w.isalpha()}
        composed = []
        for w in set(new) - need:
            core = w.rstrip(_MARKS)
            if not core or core.isalpha():
                tail = w[len(core) :]
                need.update((core, tail))
                composed.append((w, core, tail))
            else:
                self.seen[w] = self._plain(w)
        need.difference_update(self.seen)
        if need := self._recall(need):
            self._learn_pieces(need)
        seen = self.seen
        seen.update([(w, seen[core] + seen[tail]) for w, core, tail in composed])

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids behind each other, and how many each text has."""
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        encoded = split.flatten().dictionary_encode()
        distinct = encoded.dictionary.to_pylist()
        if len(self.seen) > REMEMBERED:
            self.older, self.seen = self.seen, {"": b""}
        new = [w for w in distinct if w not in self.seen]
        if new := self._recall(new):
            self._learn(new)
        known = list(map(self.seen.__getitem__, distinct))
        ids = np.frombuffer(b"".join(known), "<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        heads = np.cumsum(sizes) - sizes
        word = encoded.indices.to_numpy()
        n = sizes[word]
        ends = np.concatenate([[0], np.cumsum(n)])
        kind = np.int32 if max(len(ids), ends[-1]) < 1 << 31 else np.int64
        place = np.repeat((heads[word] - ends[:-1]).astype(kind), n)
        place += np.arange(len(place), dtype=kind)
        borders = split.offsets.to_numpy() - split.offsets[0].as_py()
        return ids[place], np.diff(ends[borders])

    def encode(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Little-endian unsigned 32-bit ids of each text and the end id, and how many."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(odd)) + 1).tolist(), len(texts)]
        ids, sizes = [], []
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b and odd[a]:
                own = [np.frombuffer(self._plain(t), "<u4") for t in texts[a:b].to_pylist()]
                ids.append(np.concatenate(own))
                sizes.append(np.array([len(x) for x in own], np.int64))
            elif a < b:
                out, n = self._by_words(texts[a:b])
                ids.append(out)
                sizes.append(n)
        ids, sizes = np.concatenate(ids), np.concatenate(sizes)
        full = np.full(len(ids) + len(sizes), self.end_id, "<u4")
        full[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)] = ids
        sizes = sizes + 1
        borders = (4 * np.concatenate([[0], np.cumsum(sizes)])).astype(np.int64)
        buffers = [None, pa.py_buffer(borders), pa.py_buffer(full)]
        return pa.Array.from_buffers(pa.large_binary(), len(sizes), buffers).cast(pa.binary()), sizes


def _encoder(path: str, end_id: int) -> WordEncoder:
    """One per Python worker, so that the tasks it runs one after another share the words."""
    kept = sys.modules.setdefault(f"{__name__}.kept", types.ModuleType("kept")).__dict__
    if (path, end_id) not in kept:
        kept[path, end_id] = WordEncoder(path, end_id)
    return kept[path, end_id]


def _encode_partition(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = _encoder(path, end_id), TaskContext.get().partitionId(), 0
        for rows in parts(batches, size=TEXT_BYTES):
            ids, n = encoder.encode(rows["text"])
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.record_batch(
                {
                    "doc_id": rows["doc_id"].cast(pa.int64()),
                    "part": pa.array(np.full(len(n), part, np.int32)),
                    "part_start": pa.array(starts),
                    "n_tokens": pa.array(n),
                    "ids": ids,
                }
            )

    return run


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Pass one: a stored table of ids with each document's place in its partition."""
    rows = docs.select("doc_id", "text").mapInArrow(
        _encode_partition(tokenizer_path, end_id),
        "doc_id long, part int, part_start long, n_tokens long, ids binary",
    )
    return store(rows, "ids")


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document in a window.

    Columns: doc_id, start (ids of the document before the piece), length, ids (binary,
    little-endian unsigned 32-bit), doc_tokens, sequence_id, offset (in the window),
    boundary (the document goes on in another window). Only the last window can be short.

    A null text is empty and yields the end id alone, as an empty one does. Rows with the
    same doc_id, null ids and equal rows are packed one by one. Other columns are ignored;
    no rows give no pieces.
    """
    encoded = encode_documents(docs, tokenizer_path, end_id)
    # One row per task of pass one.
    totals = encoded.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    offsets, at = [], 0
    for row in totals:
        offsets.append((row["part"], at))
        at += row["n"]
    placed = encoded.join(
        F.broadcast(docs.sparkSession.createDataFrame(offsets, "part int, part_offset long")), "part"
    )
    begin = F.col("part_offset") + F.col("part_start")
    window_start = F.col("sequence_id") * window
    return (
        placed.withColumn("begin", begin)
        .withColumn(
            "sequence_id",
            F.explode(
                F.sequence(
                    F.expr(f"begin div {window}"), F.expr(f"(begin + n_tokens - 1) div {window}")
                )
            ),
        )
        .withColumn("start", F.greatest(window_start - F.col("begin"), F.lit(0)))
        .withColumn(
            "length",
            F.least(window_start + window - F.col("begin"), F.col("n_tokens")) - F.col("start"),
        )
        .select(
            "doc_id",
            "start",
            "length",
            F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))").alias("ids"),
            F.col("n_tokens").alias("doc_tokens"),
            "sequence_id",
            (F.col("begin") + F.col("start") - window_start).alias("offset"),
            (F.col("length") < F.col("n_tokens")).alias("boundary"),
        )
    )


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """``pack`` with a checksum in place of the ids."""
    packed = pack(docs, tokenizer_path or public_tokenizer())
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset", "boundary",
    )


def op4_pack_concat_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 4096 ids."""
    return pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"))
