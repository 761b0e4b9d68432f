"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.llm.batches import parts
from tallystream.llm.tables import table

BUCKETS = 1 << 16
LENGTHS = (1, 2, 3)
#: Labelled rows that the model is fitted on, as many of each language, chosen by hash.
TRAINING_ROWS = 20_000
#: The matrix of log-probabilities is broadcast: 0.5 MB a language.
LANGUAGES = 200
#: Entries of the probability table gathered at a time (32 MB), whatever the texts and languages.
GATHERED = 1 << 22
SMOOTHING = 0.5
UNKNOWN = "und"
_TASKS = 8


def remainder(name: str, n: int) -> Column:
    return F.crc32(F.col(name).cast("string").cast("binary")) % n


def buckets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: the bucket of every n-gram, and the row it belongs to."""
    texts = pc.fill_null(column, "")
    sizes = pc.utf8_length(lower := pc.utf8_lower(texts)).to_numpy(zero_copy_only=False)
    points = np.frombuffer("".join(lower.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    row_of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    for n in LENGTHS:
        size = len(points) - n + 1
        if size <= 0:
            continue
        total = np.full(size, n, np.uint32)
        for at in range(n):
            total = (total ^ points[at : at + size]) * np.uint32(0x9E3779B1)
            total ^= total >> np.uint32(15)
        if n == 1:
            yield total & np.uint32(BUCKETS - 1), row_of
        else:
            inside = row_of[:size] == row_of[n - 1 :]
            yield (total & np.uint32(BUCKETS - 1))[inside], row_of[:size][inside]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in parts(batches):
        languages = np.array(batch["lang"].to_pylist(), object)
        for bucket, row in buckets(batch["text"]):
            for name in set(languages):
                own = np.bincount(bucket[(languages == name)[row]], minlength=BUCKETS)
                counts[name] = counts.get(name, 0) + own
    if counts:
        yield pa.record_batch(
            {
                "lang": pa.array(list(counts)),
                "counts": pa.array([c.astype(np.int64).tobytes() for c in counts.values()], pa.binary()),
            }
        )


def quota(sizes: list[int], rows: int) -> int:
    """Rows to take of each language (all of smaller ones), so that at most ``rows`` are taken together."""
    for i, size in enumerate(sorted(sizes)):
        each = rows // (len(sizes) - i)
        if size > each:
            return max(1, each)
        rows -= size
    return max(sizes, default=0)


def fit(labelled: DataFrame, rows: int = TRAINING_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities (buckets x languages) from ``labelled`` (doc_id, text, lang).

    At most about ``rows`` rows are used, of each language those with the smallest hash of doc_id:
    all of languages that have fewer rows than their share, and of the others as many as that
    leaves for each. Every language counts alike (no prior).
    """
    spark = labelled.sparkSession
    labelled = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    known = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(LANGUAGES + 1).collect()
    if len(known) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    each = quota([r["n"] for r in known], rows)
    shares = spark.createDataFrame(
        [(r["lang"], int((1 << 32) * min(1.0, each / r["n"]))) for r in known], "lang string, below long"
    )
    counted = (
        labelled.join(F.broadcast(shares), "lang")
        .filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < F.col("below"))
        .select("text", "lang").repartition(_TASKS)
        .mapInArrow(_count, "lang string, counts binary").collect()
    )
    names = sorted({r["lang"] for r in counted})
    counts = np.zeros((BUCKETS, len(names)))
    for r in counted:
        counts[:, names.index(r["lang"])] += np.frombuffer(r["counts"], np.int64)
    counts += SMOOTHING
    return names, np.log(counts / counts.sum(axis=0))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = shared.value
        for batch in parts(batches):
            size = batch.num_rows
            sums = np.zeros((size, len(names)))
            step = max(1, GATHERED // max(len(names), 1))
            for buckets_of, rows_of in buckets(batch["text"]):
                for a in range(0, len(rows_of) if names else 0, step):
                    bucket, row = buckets_of[a : a + step], rows_of[a : a + step]
                    heads = np.flatnonzero(np.diff(row, prepend=-1))
                    sums[row[heads]] += np.add.reduceat(table[bucket], heads, axis=0)
            letters = pc.fill_null(pc.match_substring_regex(batch["text"], r"\pL"), False)
            known = letters.to_numpy(zero_copy_only=False) & bool(names)
            predicted, score = np.full(size, UNKNOWN, object), np.zeros(size)
            if known.any():
                best = sums[known]
                odds = np.exp(best - best.max(axis=1, keepdims=True))
                predicted[known] = np.array(names, object)[best.argmax(axis=1)]
                score[known] = 1 / odds.sum(axis=1)
            yield pa.record_batch(
                [batch["doc_id"], batch["held_out"], pa.array(predicted, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """doc_id, held_out, lang_pred and score (posterior) of every row of ``docs`` (with those and text).

    A text that is null or has no letter is ``und`` with score 0; so is every text if the model
    knows no language. Equal scores go to the language first in order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        _score(shared), "doc_id long, held_out boolean, lang_pred string, score double"
    )


def op9_language_naive_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a third of the ids is held out of training."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        "lang",
        # A row without an id is never learned from.
        F.coalesce(remainder("doc_id", 3) == 1, F.lit(True)).alias("held_out"),
    )
    return predict(docs, fit(docs.filter("NOT held_out")))
