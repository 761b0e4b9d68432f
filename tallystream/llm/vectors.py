"""Approximate nearest neighbours by randomly rotated one-bit codes.

Every vector, less the mean of all, is scaled to unit length, turned in a few random ways and
kept as the signs of its components, packed into words of 64 bits, with its length and how close
each code comes to it. Queries are turned alike and cut to four bits a component, of which each
bit makes one mask. Counting the bits that codes and masks have in common estimates inner products
without bias, with an error bound from the scalars; only vectors whose upper bound reaches
the best scores found so far are compared in full. Queries go to all tasks in blocks of bounded
size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystream.llm.tables import store, table

NEAREST = 20
#: Width of the error bound in standard deviations of the estimate.
SIGMAS = 4.0
#: Codes of a vector, each turned another way: so many times the bits, an error less by the root.
TURNS = 4
#: Bits of a query's component.
QUERY_BITS = 4
#: Query components broadcast at a time (32 MB as doubles).
BLOCK_VALUES = 1 << 22
ROWS_PER_TASK = 8_192
#: Candidates, and queries, compared at a time.
CHUNK, QUERIES = 4_096, 64
_SEED = 20_250


def rotation(size: int, turn: int = 0) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(_SEED + turn).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of zeros and ones as rows of 64-bit words."""
    octets = np.packbits(bits.astype(bool), axis=1)
    octets = np.pad(octets, ((0, 0), (0, -octets.shape[1] % 8)))
    return np.ascontiguousarray(octets).view(np.uint64)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (id, vector of doubles) that take part: no null, non-finite component; not zero, not empty."""
    doubles = F.transform("vector", lambda x: x.cast("double"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select("id", doubles.alias("vector")).filter(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    )


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _codes(mean: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(mean)
        turns = [rotation(size, t) for t in range(TURNS)]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch["vector"]) - mean
            norm = np.sqrt((x * x).sum(axis=1))
            unit = x / np.maximum(norm, 1e-300)[:, None]
            turned = [unit @ t for t in turns]
            codes = np.hstack([packed(u >= 0) for u in turned])
            # Inner product of the unit vector with each code, itself of unit length.
            close = np.stack([np.abs(u).sum(axis=1) for u in turned], axis=1) / np.sqrt(size)
            borders = np.arange(len(norm) + 1, dtype=np.int32) * TURNS
            yield pa.record_batch(
                {
                    "id": batch["id"],
                    "vector": batch["vector"],
                    "codes": pa.array([c.tobytes() for c in codes], pa.binary()),
                    "norm": pa.array(norm),
                    "close": pa.ListArray.from_arrays(borders, pa.array(np.maximum(close, 1e-12).ravel())),
                }
            )

    return run


def index(vectors: DataFrame, mean: np.ndarray) -> DataFrame:
    """The stored index: every usable vector with its code and scalars."""
    rows = vectors.count()
    coded = vectors.repartition(max(1, -(-rows // ROWS_PER_TASK))).mapInArrow(
        _codes(mean), "id long, vector array<double>, codes binary, norm double, close array<double>"
    )
    return store(coded, "index")


def exact(candidates: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, summed from the first component to the last in double precision."""
    total = np.zeros(len(candidates))
    for column, value in zip(candidates.T, query, strict=True):
        total += column * value
    return total


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


class Masks:
    """Queries as the masks that codes are counted against."""

    def __init__(self, queries: np.ndarray):
        self.size = size = queries.shape[1]
        self.length = np.sqrt((queries * queries).sum(axis=1))
        self.turns = []
        top = (1 << QUERY_BITS) - 1
        for t in range(TURNS):
            turned = queries @ rotation(size, t)
            low = turned.min(axis=1)
            step = np.maximum((turned.max(axis=1) - low) / top, 1e-300)
            levels = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
            masks = [packed(levels >> bit & 1) for bit in range(QUERY_BITS)]
            self.turns.append((masks, low, step, turned.sum(axis=1)))
        # Cutting a component to a step errs by at most half, evenly.
        self.blur = np.max([step for _, _, step, _ in self.turns], axis=0) / np.sqrt(12)

    def estimates(self, part: slice, codes: np.ndarray, close: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Inner products of some queries (rows) with coded vectors less their mean (columns)."""
        words = codes.shape[1] // TURNS
        total = np.zeros((part.stop - part.start, len(codes)), np.float32)
        for t, (masks, low, step, whole) in enumerate(self.turns):
            own = codes[:, t * words : (t + 1) * words]
            common = np.zeros(total.shape, np.uint32)
            for bit, mask in enumerate(masks):
                for w in range(words):
                    both = np.bitwise_count(own[:, w][None, :] & mask[part, w][:, None])
                    common += both.astype(np.uint32) << np.uint32(bit)
            ones = np.bitwise_count(own).sum(axis=1, dtype=np.int64)
            product = common * (2 * step[part]).astype(np.float32)[:, None]
            product += (2 * low[part]).astype(np.float32)[:, None] * ones.astype(np.float32)
            product -= whole[part].astype(np.float32)[:, None]
            total += product * (norm / (close[:, t] * np.sqrt(self.size) * TURNS)).astype(np.float32)
        return total


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries, mean = shared.value
        size = len(mean)
        masks = Masks(queries)
        centre = queries @ mean
        found = [(np.zeros(0), np.zeros(0, np.int64))] * len(queries)
        floor = np.full(len(queries), -np.inf)  # the k-th best score so far
        reach = 0.0  # no vector of a chunk is longer

        def compare(q: int, some: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
            some = some[ids[some] != query_ids[q]]
            if floor[q] > -np.inf:  # a first look in any order of summing, beyond whose error none counts
                near = vectors[some] @ queries[q]
                some = some[near >= floor[q] - 1e-9 * (masks.length[q] * reach + 1)]
            scores = np.concatenate([found[q][0], exact(vectors[some], queries[q])])
            both = np.concatenate([found[q][1], ids[some]])
            keep = _best(scores, both, k)
            found[q] = scores[keep], both[keep]
            if len(keep) == k:
                floor[q] = scores[keep[-1]]

        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                rows = batch.slice(lo, CHUNK)
                ids, vectors = rows["id"].to_numpy(), _matrix(rows["vector"])
                codes = np.frombuffer(b"".join(rows["codes"].to_pylist()), np.uint64).reshape(len(ids), -1)
                norm, close = rows["norm"].to_numpy(), _matrix(rows["close"])
                error = np.sqrt(((1 - np.minimum(close, 1) ** 2) / close**2).sum(axis=1) / max(size - 1, 1))
                error, blur = SIGMAS * norm * error / TURNS, SIGMAS * norm * np.sqrt((close**-2).sum(axis=1)) / TURNS
                reach = norm.max() + np.abs(mean).sum()
                for first in range(0, len(queries), QUERIES):
                    part = slice(first, min(first + QUERIES, len(queries)))
                    upper = masks.estimates(part, codes, close, norm)
                    unsure = masks.length[part, None] * error + masks.blur[part, None] * blur
                    upper += unsure.astype(np.float32)
                    # Single precision and the largest code's length bound what sums may lose.
                    slack = 1e-5 * (masks.length[part] * 2 * reach + 1)
                    for q in range(part.start, part.stop):
                        above = upper[q - first]
                        if len(found[q][0]) < k:  # no floor yet: that of the most promising ones
                            lead = np.argpartition(-above, min(2 * k, len(above) - 1))[: 2 * k]
                            compare(q, lead, ids, vectors)
                            above[lead] = -np.inf
                        some = np.flatnonzero(above >= floor[q] - centre[q] - slack[q - first])
                        if len(some):
                            compare(q, some[above[some] > -np.inf], ids, vectors)
        sizes = [len(s) for s, _ in found]
        if sum(sizes):
            yield pa.record_batch(
                {
                    "query_id": pa.array(np.repeat(query_ids, sizes)),
                    "vec_id": pa.array(np.concatenate([i for _, i in found])),
                    "score": pa.array(np.concatenate([s for s, _ in found])),
                }
            )

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEAREST) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` largest inner products of each query.

    ``vectors`` and ``queries`` are (id, vector). A query is not its own neighbour (ids are
    compared); ties go to the smaller id. Vectors that are null, empty, zero or hold a null or
    non-finite component, or have no id, take no part. The others must have one length. Rows
    that repeat an id are all candidates; the ranks of a repeated query run over all of them.
    """
    spark = vectors.sparkSession
    clean = usable(vectors)
    empty = "query_id long, rank int, vec_id long, score double"
    lengths = clean.select(F.size("vector").alias("size")).distinct().limit(2).collect()
    if not lengths:
        return spark.createDataFrame([], empty)
    if len(lengths) > 1:
        raise ValueError("vectors of different lengths")
    size = lengths[0]["size"]
    mean = clean.agg(*[F.avg(F.element_at("vector", i + 1)).alias(f"m{i}") for i in range(size)]).first()
    mean = np.array(mean, np.float64)
    coded = index(clean, mean)
    asked = store(usable(queries).distinct(), "queries")
    total = asked.count()
    blocks = -(-2 * total * size // BLOCK_VALUES)
    found = spark.createDataFrame([], "query_id long, vec_id long, score double")
    for i in range(blocks):
        # Blocks by hash are near half the limit each.
        part = asked.filter(F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)) == i).orderBy("id", "vector").toArrow()
        if part.num_rows:
            shared = spark.sparkContext.broadcast((part["id"].to_numpy(), _matrix(part["vector"]), mean))
            found = found.unionByName(
                coded.mapInArrow(_search(shared, k), "query_id long, vec_id long, score double")
            )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op8_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector")
    )
    return nearest(vectors, vectors.filter("id % 20 = 0"))


OP8_SQL = """
WITH vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 20
"""
