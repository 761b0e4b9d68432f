"""Toxicity: cumulative-link ordinal regression over sparse text features.

Severity grades 0 to 3 have ordered thresholds and one weight per feature shared by all of
them: P(grade > k) = sigmoid(w x - threshold_k). The expected severity is the sum of these.
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
from tallystream.llm.tables import one_text, refuse_names, store, table
from tallystream.llm.words import words

#: Labelled rows the model is fitted on, chosen by hash.
TRAINING_ROWS = 20_000
#: Hashed features: whole words and word beginnings of four and five bytes.
BUCKETS = 1 << 22
FORMS = (None, 4, 5)
#: Features in the model: in at least 5 toxic rows, and ten times as common there as elsewhere.
FEATURES = 4_000
LEAST_ROWS = 5
LEAST_RATIO = 10.0
GRADES = 4
STEPS = 400
RATE = 0.05
PENALTY = 1e-3

_BETWEEN = np.ones(256, bool)
_BETWEEN[128:] = False
_BETWEEN[ord("a") : ord("z") + 1] = False
_BETWEEN[ord("A") : ord("Z") + 1] = False


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, bucket) with their counts, sorted."""
    found, size = [], len(column)
    for form, first in enumerate(FORMS):
        numbers, rows = words(column, lower=True, between=_BETWEEN, first=first)
        n = np.diff(rows)
        bucket = (numbers >> np.uint64(42)).astype(np.int64) ^ (form * 0x15A5A5)
        found.append(np.repeat(np.arange(size), n) * BUCKETS + bucket)
    pairs, counts = np.unique(np.concatenate(found), return_counts=True)
    return pairs // BUCKETS, pairs % BUCKETS, counts


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches):
        row, bucket, counts = features(batch["text"])
        heads = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(heads), pa.array(x.astype(np.int32))) for x in (bucket, counts)]
        yield pa.record_batch(
            [batch["id"], batch["toxic"], *lists], names=["id", "toxic", "bucket", "times"]
        )


class Model(NamedTuple):
    buckets: np.ndarray  # of the features
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def feature_of(self) -> np.ndarray:
        """Bucket to feature, or -1."""
        out = np.full(BUCKETS, -1, np.int16)
        out[self.buckets] = np.arange(len(self.buckets))
        return out

    def above(self, strength: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, a row per strength."""
        return 1 / (1 + np.exp(-np.clip(strength[:, None] - self.thresholds, -40, 40)))


def grades(toxic: np.ndarray, amount: np.ndarray) -> np.ndarray:
    """Training grades: 0 if not toxic, else the third of the toxic rows by amount of toxic features."""
    out = np.zeros(len(toxic), np.int64)
    bad = np.flatnonzero(toxic)
    if len(bad):
        cuts = np.quantile(amount[bad], np.arange(1, GRADES - 1) / (GRADES - 1))
        out[bad] = 1 + np.searchsorted(cuts, amount[bad], side="left")
    return out


def learn(row, feature, counts, toxic, buckets) -> Model:
    """Derive grades and fit weights and thresholds (Adam on the likelihood).

    ``row``, ``feature`` and ``counts`` are the non-zero entries; ``toxic`` has a value per row.
    """
    size, n_features, x = len(toxic), len(buckets), np.log1p(counts)
    grade = grades(toxic, np.bincount(row, x, minlength=size))
    # Thresholds are a first one and positive gaps, so that they stay in order.
    theta = np.zeros(n_features + GRADES - 1)
    theta[n_features] = 1.0
    m, v = np.zeros(len(theta)), np.zeros(len(theta))

    def unpack(theta):
        return theta[: n_features], theta[n_features] + np.concatenate([[0], np.cumsum(np.exp(theta[n_features + 1 :]))])

    for step in range(1, STEPS + 1):
        weights, thresholds = unpack(theta)
        strength = np.bincount(row, weights[feature] * x, minlength=size)
        cumulative = 1 / (1 + np.exp(-np.clip(strength[:, None] - thresholds, -40, 40)))
        bounded = np.column_stack([np.ones(size), cumulative, np.zeros(size)])
        at = np.arange(size)
        upper, lower = bounded[at, grade], bounded[at, grade + 1]
        # d log(upper - lower) / d(strength - threshold)
        likely = np.maximum(upper - lower, 1e-12)
        up, down = upper * (1 - upper) / likely, lower * (1 - lower) / likely
        slope = np.zeros((size, GRADES + 1))
        slope[at, grade] += up
        slope[at, grade + 1] -= down
        of_threshold = slope[:, 1:GRADES].sum(axis=0) / size
        of_strength = -(up - down) / size
        g = np.zeros(len(theta))
        g[: n_features] = np.bincount(feature, of_strength[row] * x, minlength=n_features) + PENALTY * weights / size
        g[n_features] = of_threshold.sum()
        tails = np.cumsum(of_threshold[::-1])[::-1]
        g[n_features + 1 :] = tails[1:] * np.exp(theta[n_features + 1 :])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    weights, thresholds = unpack(theta)
    return Model(buckets, weights, thresholds)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model | None:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic 0/1).

    About ``rows`` labelled ids are used, those with the smallest hash of doc_id; an id with
    several labels counts as toxic if one says so, and of several texts one is learned from. None if a class is missing.
    """
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = store(known, "labels")
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < int((1 << 32) * min(1.0, rows / max(known.count(), 1)))
    found = store(
        one_text(docs, known.filter(share).select("doc_id")).join(known, "doc_id")
        .select(F.col("doc_id").alias("id"), "toxic", "text")
        .mapInArrow(_features_of, "id long, toxic int, bucket array<int>, times array<int>"),
        "features",
    )
    ids = found.groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy("id").toArrow()
    id_of_row, toxic = ids["id"].to_numpy(), ids["toxic"].to_numpy()
    bad = int(toxic.sum())
    if bad in (0, len(toxic)):
        return None
    entries = found.select("id", "toxic", F.explode(F.arrays_zip("bucket", "times")).alias("x")).select(
        "id", "toxic", "x.*"
    )
    ratio = (F.col("bad") / bad) / ((F.col("good") + 0.5) / (len(toxic) - bad))
    chosen = (
        entries.groupBy("bucket").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
        .filter((F.col("bad") >= LEAST_ROWS) & (ratio >= LEAST_RATIO))
        .orderBy(F.desc("bad"), "bucket").limit(FEATURES).select("bucket").toArrow()
    )
    buckets = np.sort(chosen["bucket"].to_numpy())
    few = docs.sparkSession.createDataFrame([(int(b),) for b in buckets], "bucket int")
    used = entries.join(F.broadcast(few), "bucket").select("id", "bucket", "times").orderBy("id", "bucket", "times")
    used = used.toArrow()
    return learn(
        np.searchsorted(id_of_row, used["id"].to_numpy()),
        np.searchsorted(buckets, used["bucket"].to_numpy()),
        used["times"].to_numpy(),
        toxic,
        buckets,
    )


def _score(shared, schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value) if shared.value else None
        feature_of = model.feature_of() if model else None
        for batch in parts(batches):
            size = batch.num_rows
            if model:
                strength = np.zeros(size)
                for form, first in enumerate(FORMS):
                    numbers, rows = words(batch["text"], lower=True, between=_BETWEEN, first=first)
                    bucket = (numbers >> np.uint64(42)).astype(np.int64) ^ (form * 0x15A5A5)
                    feature = feature_of[bucket]
                    hit = np.flatnonzero(feature >= 0)
                    at = np.searchsorted(rows, hit, side="right") - 1
                    pairs, counts = np.unique(at * BUCKETS + bucket[hit], return_counts=True)
                    weights = model.weights[feature_of[pairs % BUCKETS]]
                    strength += np.bincount(pairs // BUCKETS, weights * np.log1p(counts), minlength=size)
                above = model.above(strength)
            else:
                above = np.zeros((size, GRADES - 1))
            grade = (above >= 0.5).sum(axis=1).astype(np.int32)
            columns = [*batch.columns, pa.array(above.sum(axis=1)), pa.array(grade)]
            yield pa.record_batch([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """All rows and columns of ``docs`` with ``expected_severity`` (0 to 3) and ``grade``.

    The grade is the number of thresholds that are more likely passed than not. A null, empty or
    unknown text scores as one without toxic features; without a model all are 0. A column named
    like one of the two is an error.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    refuse_names(docs, ["expected_severity", "grade"])
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("expected_severity", T.DoubleType()),
            T.StructField("grade", T.IntegerType()),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model and tuple(model))
    return docs.mapInArrow(_score(shared, to_arrow_schema(schema)), schema)


def op2_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document; ``toxic`` is a grade of 1 or more."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return score(docs, model).select(
        "doc_id", "expected_severity", "grade", (F.col("grade") >= 1).cast("int").alias("toxic")
    )
