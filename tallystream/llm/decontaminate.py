"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive words; words at ignored places do not count, so a seed
still hits where a copied passage has other words there. Seeds of the test items are joined
with those of the documents by hash; around each hit the item is laid along the document and
the overlap is verified word by word.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.llm.batches import parts
from tallystream.llm.tables import id_of, key_of, store, table
from tallystream.llm.words import mix, words

_log = logging.getLogger(__name__)

#: Places of 12 consecutive words that each mask looks at. Wherever the other words of an overlap
#: stand, at least one mask fits between them somewhere (the tests go through all cases).
MASKS = (
    (0, 1, 2, 3, 4, 7, 8),
    (0, 1, 3, 4, 5, 6, 7),
    (0, 1, 3, 6, 8, 10, 11),
    (0, 1, 3, 7, 9, 10, 11),
    (0, 1, 4, 5, 6, 8, 9),
    (0, 1, 4, 6, 9, 10, 11),
)
SPAN = 12
#: Masks for items of so many words (from, to), which meet every whole item with 80 % equal.
SHORT_MASKS = (
    (6, 6, ((0, 1, 2, 4), (0, 3, 4, 5))),
    (7, 7, ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 2, 3, 4, 5))),
    (8, 9, ((0, 1, 2, 3, 4, 6), (0, 1, 3, 4, 5, 6), (0, 2, 3, 5, 6, 7))),
    (
        10,
        11,
        (
            (0, 1, 2, 3, 5, 7),
            (0, 1, 2, 3, 6, 7),
            (0, 1, 3, 4, 5, 6),
            (0, 1, 4, 5, 7, 8),
            (0, 2, 4, 5, 6, 7),
        ),
    ),
)
#: Items of fewer words are not looked for, see ``not_looked_for``.
SHORTEST = SHORT_MASKS[0][0]
#: An overlap counts from so many words, or the whole item if that is shorter ...
OVERLAP = 13
#: ... of which at least this share is equal.
EQUAL = 0.8
_EQUAL_FOR_OTHER = round(EQUAL / (1 - EQUAL))
#: Words of test items that are broadcast at a time (some 2 MB, 30 MB as seeds); more are more passes.
BLOCK_WORDS = 250_000
#: Hits made at a time; a single place can have as many as the block has items' places.
HITS = 1 << 20
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_FILTER_BITS = 22


def seeds(numbers: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """A number for each place from which the mask fits."""
    size = len(numbers) - mask[-1]
    if size <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(size, np.uint64)
    for at in mask:
        total = total * _FACTOR + numbers[at : at + size]
    return mix(total)


class SeedIndex:
    """Seeds of a block of items: sorted hashes by mask, and the items' words."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids = np.array(ids, np.int64)
        self.numbers, self.rows = words(pa.array(texts, pa.string()), lower=True)
        sizes = np.diff(self.rows)
        item_of = np.repeat(np.arange(len(ids)), sizes)
        self.masks = [(m, sizes >= SPAN) for m in MASKS]
        self.masks += [(m, (sizes >= a) & (sizes <= b)) for a, b, masks in SHORT_MASKS for m in masks]
        self.tables = []
        for mask, which in self.masks:
            hashes = seeds(self.numbers, mask)
            item = item_of[: len(hashes)]
            good = np.flatnonzero(which[item] & (item == item_of[mask[-1] :])) if len(hashes) else item
            order = good[np.argsort(hashes[good], kind="stable")]
            sieve = np.zeros(1 << _FILTER_BITS, bool)
            sieve[hashes[order] >> np.uint64(64 - _FILTER_BITS)] = True
            self.tables.append((hashes[order], item[order], order - self.rows[item[order]], sieve))

    def hits(self, numbers: np.ndarray, row_of: np.ndarray):
        """Distinct (row, item, place in ``numbers`` where the item would begin).

        Repeated words hit each other everywhere, so hits are made in pieces of bounded size, of
        which only distinct ones are kept, as one number each.
        """
        found = np.zeros(0, np.int64)
        before = int(np.diff(self.rows).max(initial=0))
        n_items, n_rows = len(self.ids), int(row_of.max(initial=0)) + 1
        for (mask, _), (hashes, item, place, sieve) in zip(self.masks, self.tables, strict=True):
            if not len(hashes):
                continue
            own = seeds(numbers, mask)
            at = np.flatnonzero(sieve[own >> np.uint64(64 - _FILTER_BITS)])
            at = at[row_of[at] == row_of[at + mask[-1]]]
            lo, hi = (np.searchsorted(hashes, own[at], side) for side in ("left", "right"))
            n = hi - lo
            at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
            piece = (np.cumsum(n) - n) // HITS
            cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(n)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a < b:
                    m = n[a:b]
                    entry = np.repeat(lo[a:b] - (np.cumsum(m) - m), m) + np.arange(m.sum())
                    where = np.repeat(at[a:b], m)
                    begin = where - place[entry] + before
                    named = (begin * n_items + item[entry]) * n_rows + row_of[where]
                    found = np.union1d(found, named)
        rest, row = np.divmod(found, n_rows)
        begin, item = np.divmod(rest, n_items)
        return np.stack([row, item, begin - before], axis=1)

    def verify(self, numbers: np.ndarray, first: int, end: int, item: int, begin: int):
        """Longest overlap of the item laid at ``begin``: (start in the row, start in the item, words, equal).

        Other words at its ends are left off as long as enough words remain.
        """
        own = self.numbers[self.rows[item] : self.rows[item + 1]]
        need = min(OVERLAP, len(own))
        a, b = max(begin, first), min(begin + len(own), end)
        if b - a < need:
            return None
        same = numbers[a:b] == own[a - begin : b - begin]
        # A run has enough equal words if its sum is not negative, so each place is paired with
        # the first one before it whose prefix sum is not larger.
        total = np.concatenate([[0], np.cumsum(np.where(same, 1, -_EQUAL_FOR_OTHER))])
        starts = np.searchsorted(-np.minimum.accumulate(total), -total)
        stop = int(np.argmax(np.arange(len(total)) - starts))
        start = int(starts[stop])
        if stop - start < need:
            return None
        equals = np.flatnonzero(same[start:stop]) + start
        start = min(int(equals[0]), stop - need)
        stop = max(int(equals[-1]) + 1, start + need)
        n, equal = stop - start, len(equals)
        return a + start - first, a + start - begin, n, equal


_OVERLAPS = "d long, item_id long, doc_start long, item_start long, n_words long, n_equal long"


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = SeedIndex(*shared.value)
        for batch in parts(batches):
            numbers, rows = words(batch["text"], lower=True)
            row_of = np.repeat(np.arange(batch.num_rows), np.diff(rows))
            ids, out = batch["d"], []
            for row, item, begin in index.hits(numbers, row_of).tolist():
                best = index.verify(numbers, rows[row], rows[row + 1], item, begin)
                if best is not None:
                    out.append((ids[row].as_py(), int(index.ids[item]), *map(int, best)))
            if out:
                names = [x.split()[0] for x in _OVERLAPS.split(", ")]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)

    return run


def counted(benchmark: DataFrame) -> DataFrame:
    n = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    return benchmark.withColumn("n", F.coalesce(n, F.lit(0)))


def not_looked_for(benchmark: DataFrame) -> DataFrame:
    """Test items that are too short to be looked for (or null), with their number of words ``n``."""
    return counted(benchmark).filter(f"n < {SHORTEST}")


def blocks(benchmark: DataFrame) -> Iterator[tuple[list[int], list[str]]]:
    """Items in blocks of at most ``BLOCK_WORDS`` words (a longer item is a block of its own)."""
    items = store(counted(benchmark.select(key_of("item_id").alias("item_id"), "text")), "items")
    short = items.filter(f"n < {SHORTEST}").count()
    if short:
        _log.warning("%d test items of fewer than %d words are not looked for", short, SHORTEST)
    items = items.filter(f"n >= {SHORTEST}")
    # A block has items whose hash falls to it, so its size is near the mean.
    total = items.agg(F.sum("n")).first()[0] or 0
    n = -(-2 * total // BLOCK_WORDS)
    for i in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).orderBy("item_id", "text")
        rows = part.select("item_id", "text").collect()
        if rows:
            yield [r["item_id"] for r in rows], [r["text"] for r in rows]


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The longest verified overlap of each document and test item that have one.

    Columns: d (doc_id, null as the largest number), item_id, doc_start and item_start (words
    before the overlap), n_words, n_equal. An overlap is at least 13 words, or the item if that
    is shorter, of which 80 % are equal; A to Z are lower-cased. Items of fewer than 6 words
    and null texts have none (``not_looked_for`` gives them). Equal items are all given. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.select(key_of().alias("d"), "text")
    found = spark.createDataFrame([], _OVERLAPS)
    for ids, item_texts in blocks(benchmark):
        shared = spark.sparkContext.broadcast((ids, item_texts))
        found = found.unionByName(texts.mapInArrow(_search(shared), _OVERLAPS))
    best = F.max_by(
        F.struct("doc_start", "item_start", "n_words", "n_equal"),
        F.struct("n_equal", -F.col("doc_start"), -F.col("item_start")),
    )
    return found.groupBy("d", "item_id").agg(best.alias("best")).select("d", "item_id", "best.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id has no overlap with a test item; columns unchanged."""
    bad = store(overlaps(docs, benchmark).select(F.col("d").alias("__d")).distinct(), "contaminated")
    return docs.withColumn("__d", key_of()).join(bad, "__d", "left_anti").select(*docs.columns)


def op10_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents with the test items they hold."""
    found = overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(id_of("d").alias("doc_id"), id_of("item_id").alias("item_id"), *found.columns[2:])
