"""Quality classifier: positive-unlabelled learning with non-negative risk.

Trusted positives and unlabelled web text train an additive model over shapes of the text
(shares of kinds of characters, repeated and distinct words, lengths), cut into quantile bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystream.llm.batches import parts
from tallystream.llm.language import remainder
from tallystream.llm.tables import one_text, refuse_names, table
from tallystream.llm.words import text_bytes, words

#: Rows of positives, of unlabelled text, and labelled rows for the class prior; chosen by hash.
TRAINING_ROWS = 20_000
BINS = 12
STEPS = 400
RATE = 0.2
PENALTY = 1e-4
THRESHOLD = 0.7
_KINDS = ("\n", " \t\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
          "0123456789", "|", "!?", "#$%&*@^~_=+<>/\\{}[]", ".,;:", "'\"()-`")
_KIND = np.full(256, len(_KINDS) + 1, np.int64)
_KIND[:128] = len(_KINDS)
for _i, _characters in enumerate(_KINDS):
    _KIND[[ord(c) for c in _characters]] = _i


def shapes(column: pa.Array) -> np.ndarray:
    """A row of numbers for each text; a null or empty text gives the same row."""
    data, bounds = text_bytes(column)
    size, kinds = len(bounds) - 1, len(_KINDS) + 2
    kind = np.repeat(np.arange(0, size * kinds, kinds), np.diff(bounds))
    kind += _KIND[data]
    counts = np.bincount(kind, minlength=size * kinds).reshape(size, kinds)
    del kind
    numbers, heads = words(column)
    n = np.diff(heads)
    word_row = np.repeat(np.arange(size), n)
    distinct, common = np.zeros(size), np.zeros(size)
    for i in np.flatnonzero(n):
        _, times = np.unique(numbers[heads[i] : heads[i + 1]], return_counts=True)
        distinct[i], common[i] = len(times), times.max()
    again = np.zeros((size, 2))
    for apart in (1, 2):
        same = (numbers[apart:] == numbers[:-apart]) & (word_row[apart:] == word_row[:-apart])
        again[:, apart - 1] = np.bincount(word_row[apart:][same], minlength=size)
    letters = np.maximum(counts[:, 2] + counts[:, 3], 1)
    in_words = np.maximum(counts[:, 2:].sum(axis=1), 1)
    per_word = np.maximum(n, 1)[:, None]
    return np.column_stack(
        [
            counts[:, 2:] / in_words[:, None],
            counts[:, [0, 5, 6, 7, 8, 9]] / per_word,
            counts[:, 3] / letters,
            np.log1p(n),
            in_words / per_word[:, 0],
            distinct / np.sqrt(np.maximum(n, 1)),
            distinct / per_word[:, 0],
            common / per_word[:, 0],
            again / per_word,
        ]
    )


class Model(NamedTuple):
    edges: np.ndarray  # features x (bins - 1)
    weights: np.ndarray  # features x bins
    bias: float
    prior: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for column, edges, weights in zip(x.T, self.edges, self.weights, strict=True):
            total += weights[np.searchsorted(edges, column, side="right")]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def learn(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative unbiased risk with the logistic loss, by gradient descent (Adam).

    risk = prior * E_p[loss(f, 1)] + max(0, E_u[loss(f, 0)] - prior * E_p[loss(f, 0)]).
    While the second term is negative, the step goes the other way along it, which keeps the
    model from calling unlabelled positives negative without end.
    """
    both = np.concatenate([positive, unlabelled])
    edges = np.quantile(both, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    place = np.stack([np.searchsorted(e, c, side="right") for c, e in zip(both.T, edges, strict=True)], axis=1)
    place += np.arange(edges.shape[0]) * BINS
    p, u = place[: len(positive)], place[len(positive) :]
    size = edges.shape[0] * BINS
    theta, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)

    def sigma(rows):
        return 1 / (1 + np.exp(-np.clip(theta[rows].sum(axis=1) + theta[size], -40, 40)))

    def gradient(rows, values):
        flat = np.bincount(rows.ravel(), np.repeat(values, rows.shape[1]), minlength=size)
        return np.append(flat, values.sum()) / len(rows)

    for step in range(1, STEPS + 1):
        sp, su = sigma(p), sigma(u)
        negative = -np.log(1 - su + 1e-12).mean() + prior * np.log(1 - sp + 1e-12).mean()
        down = gradient(u, su) - prior * gradient(p, sp)
        g = prior * gradient(p, sp - 1) + down if negative >= 0 else -down
        g[:size] += PENALTY * theta[:size]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(edges, theta[:size].reshape(-1, BINS), float(theta[size]), prior)


def _shapes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches):
        rows = [x.tobytes() for x in shapes(batch["text"])]
        yield pa.record_batch([batch["id"], batch["role"], pa.array(rows, pa.binary())], names=["id", "role", "shape"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model | None:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality); None without a positive.

    The class prior is the share of label 1 among the labelled rows. Positives and unlabelled
    texts (any text, labelled or not) are about ``rows`` ids each, those with the smallest hash of
    doc_id; of several texts of an id one is learned from.
    """
    labelled = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("quality").alias("quality")
    )
    tally = labelled.agg(F.count("*").alias("n"), F.sum("quality").alias("good")).first()
    if not tally["good"]:
        return None
    prior = (tally["good"] + 1) / (tally["n"] + 2)

    def some(df: DataFrame, n: int, seed: int) -> DataFrame:
        spread = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 32))
        return df.filter(spread < int((1 << 32) * min(1.0, rows / max(n, 1))))

    texts = docs.select("doc_id", "text").filter("doc_id IS NOT NULL")
    positives = one_text(texts, some(labelled.filter("quality = 1"), tally["good"], 1).select("doc_id"))
    unlabelled = one_text(some(texts, texts.count(), 2))
    chosen = positives.withColumn("role", F.lit(1)).unionByName(unlabelled.withColumn("role", F.lit(0)))
    got = (
        chosen.withColumnRenamed("doc_id", "id").mapInArrow(_shapes_of, "id long, role int, shape binary")
        .orderBy("role", "id", "shape").toArrow()
    )
    x = np.array([np.frombuffer(b) for b in got["shape"].to_pylist()])
    role = got["role"].to_numpy()
    if not (role == 1).any() or not (role == 0).any():
        return None
    return learn(x[role == 1], x[role == 0], prior)


def _score(shared, schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value) if shared.value else None
        for batch in parts(batches):
            score = model.score(shapes(batch["text"])) if model else np.full(batch.num_rows, 0.5)
            columns = [*batch.columns, pa.array(score)]
            yield pa.record_batch([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """All rows and columns of ``docs`` with ``quality_score`` (0 to 1) from the text alone.

    A null text scores as an empty one. Without a model every text scores 0.5. A column of that
    name is an error.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    refuse_names(docs, ["quality_score"])
    schema = T.StructType([*docs.schema.fields, T.StructField("quality_score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model and tuple(model))
    return docs.mapInArrow(_score(shared, to_arrow_schema(schema)), schema)


def fit_on_learned_fold(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Learn from rows whose fold (crc32 of the id as text, modulo 4) is not 2."""
    kept = remainder("doc_id", 4) != 2
    return fit(docs.filter(kept), labels.filter(kept))


def op7_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; a quarter of the ids is held out of training."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = fit_on_learned_fold(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return score(docs.withColumn("held_out", held_out), model).select(
        "doc_id",
        "held_out",
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
