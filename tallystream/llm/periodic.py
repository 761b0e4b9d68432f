"""Periodic run detection: words that repeat with a period, found from Lyndon roots.

Documents are independent, so this is one pass without a shuffle. A task takes the documents of
a batch together: stretches of words that might hold a run are put behind each other, Baier's
grouping gives their Lyndon arrays under both orders, and roots are extended to whole runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.llm.batches import parts
from tallystream.llm.lyndon import runs
from tallystream.llm.tables import table

EXPONENT = 4
SHORTEST = 6
_RUN = "struct<start: bigint, length: bigint, period: bigint>"
_RUN_ARROW = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def crowded(numbers: np.ndarray, often: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that may lie in a run, and the number of the stretch that each belongs to.

    A run of ``often`` periods holds each of its words as many times, so a rarer word parts
    the text; so does a word that is rare within what the others leave of its stretch.
    """
    at = np.arange(len(numbers))
    stretch = np.zeros(len(numbers), np.int64)
    while len(at):
        key = stretch * (numbers.max() + 1) + numbers[at]
        _, word, count = np.unique(key, return_inverse=True, return_counts=True)
        keep = count[word] >= often
        left = at[keep]
        stretch = np.cumsum(np.diff(left, prepend=-2) != 1) - 1
        whole = np.bincount(stretch)[stretch] >= shortest if len(left) else np.zeros(0, bool)
        if keep.all() and whole.all():
            break
        at, stretch = left[whole], stretch[whole]
    return at, stretch


def _find(
    batches: Iterator[pa.RecordBatch], exponent: int, shortest: int
) -> Iterator[pa.RecordBatch]:
    for part in parts(batches):
        texts = part["text"].cast(pa.large_binary()).to_pylist()
        n = len(texts)
        words = [(text or b"").split() for text in texts]  # at bytes 0x20 and 0x09 to 0x0D
        letters, places, owners = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        for d, text in enumerate(words):
            if len(text) < max(shortest, exponent):
                continue
            known: dict[bytes, int] = {}
            numbers = np.fromiter((known.setdefault(w, len(known) + 1) for w in text), np.int64, len(text))
            at, stretch = crowded(numbers, exponent, shortest)
            if len(at):
                row = np.zeros(len(at) + stretch[-1] + 1, np.int64)  # each stretch ends with a 0
                place = row.copy()
                row[np.arange(len(at)) + stretch] = numbers[at]
                place[np.arange(len(at)) + stretch] = at
                letters.append(row)
                places.append(place)
                owners.append(np.full(len(row), d))
        place, owner = np.concatenate(places), np.concatenate(owners)
        found: list[list[dict]] = [[] for _ in range(n)]
        for start, length, period in runs(np.concatenate(letters), exponent, shortest):
            run = {"start": int(place[start]), "length": length, "period": period}
            found[owner[start]].append(run)
        kept = []
        for text, here in zip(words, found, strict=True):
            if here:
                depth = np.zeros(len(text) + 1, np.int64)
                for run in here:
                    depth[run["start"] + run["period"]] += 1
                    depth[run["start"] + run["length"]] -= 1
                text = [text[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
            kept.append(b" ".join(text))
        yield pa.RecordBatch.from_arrays(
            [
                part["doc_id"],
                pa.array([len(text) for text in words], pa.int64()),
                pa.array(found, pa.list_(_RUN_ARROW)),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "n_words", "runs", "kept_text"],
        )


def periodic_runs(docs: DataFrame, exponent: int = EXPONENT, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), kept_text per document.

    A run is a longest stretch of consecutive words that repeats its smallest period at least
    ``exponent`` times and has ``shortest`` words or more; several runs may overlap. ``kept_text``
    has the words that no run holds behind its first period, joined by one space. Words are
    whole texts split at ASCII white space, compared exactly.

    Null and empty texts have no words, no runs and an empty ``kept_text``. Every row is judged
    by itself, so null and repeated ids and equal rows change nothing; other columns are not
    read. No rows give no rows.
    """
    schema = f"doc_id bigint, n_words bigint, runs array<{_RUN}>, kept_text string"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_find, exponent=exponent, shortest=shortest), schema)


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, a tenth of the texts ending in words that repeat, by a hash of the id.

    With h the CRC-32 of the decimal id and g = h div 10, a text of n words whose h is a multiple of
    ten repeats p = 1 + (n - a) div (3 + g mod 8) words from word a = g mod n on. Rows without
    an id keep their text.
    """
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    hashed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")).alias("h"),
    )
    struck = hashed.select("doc_id", "text", "h", F.when(F.expr("h % 10 = 0"), words).alias("words"))
    sized = struck.selectExpr("*", "size(words) AS n", "CAST(h DIV 10 AS BIGINT) AS g").selectExpr(
        "*", "CAST(CASE WHEN n > 0 THEN g % n ELSE 0 END AS INT) AS a"
    ).selectExpr("*", "CAST(1 + (n - a) DIV (3 + g % 8) AS INT) AS p")
    tail = "slice(flatten(array_repeat(slice(words, a + 1, p), CAST((n - a) DIV p + 1 AS INT))), 1, n - a)"
    repeated = f"array_join(concat(slice(words, 1, a), {tail}), ' ')"
    return sized.selectExpr("doc_id", f"CASE WHEN n > 0 THEN {repeated} ELSE text END AS text")


def op12_baier_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of four periods and more in all documents, some of which end in repeated words."""
    found = periodic_runs(with_repeated_tails(table(spark, sf_dir, "documents")))
    ranked = F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    text = F.concat_ws("", F.transform(lines, lambda line: F.concat(line, F.lit("\n"))))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.array_min(ranked).alias("first"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2(F.col("kept_text"), 256).alias("collapsed_sha256"),
        "n_words",
    ).select(
        "doc_id",
        "n_runs",
        F.col("first.start").alias("start"),
        (-F.col("first.less")).alias("length"),
        F.col("first.period").alias("period"),
        F.expr("(-1000 * first.less) DIV first.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
        "n_words",
    )
