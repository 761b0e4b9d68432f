"""N-gram Jaccard join by a token-group matrix.

Documents are partitioned into groups of similar ones, the tokens (distinct 5-word shingles)
of each group are kept as one union, and a document is compared with the members of a group
only if its overlap with the group's union can reach the threshold.

1. Equal sets become one. Sets that share a smallest hash gather around the smallest id among
   them and are compared with it; links make first components, gatherings make the groups,
   which are divided into parts of some 64 members.
2. Which parts a set can link with follows from its prefix: two sets with a Jaccard
   similarity of 0.75 or more share one of the rarest quarter of their tokens, in one order of
   all tokens. The order puts tokens of more than ``COMMON`` documents last (counted over all
   documents), so the lists of the others are short: they give pairs of sets, whose sizes and
   number of shared tokens bound the overlap. For common tokens the matrix of tokens and parts
   gives pairs of parts. Nothing is asked within a component.
3. Candidate parts arrive at a task with the sets that query them. The bound against the
   part's union decides which are opened; then sets are compared exactly.

All links between different first components are found, so the final ones are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.llm.batches import parts, structs
from tallystream.llm.components import components
from tallystream.llm.tables import key_of, store, table
from tallystream.llm.words import grams, mix, signed, words

SHINGLE = 5
#: Similarity of 3 / 4, as whole numbers.
OVER, UNDER = 3, 4
#: Tokens of more documents than this are put last in the order.
COMMON = 64
#: At most so many of the most common tokens are put last. Bounds the broadcast at 8 MB.
COMMON_LIMIT = 1 << 20
#: Members in a part of a group, and queries for one copy of a part.
MEMBERS = 64
QUERIES_PER_COPY = 256
#: Tokens counted by one task.
COUNTED_AT_ONCE = 1 << 22
_SEEDS = tuple(np.uint64(0x9E3779B97F4A7C15 * (2 * i + 3) % (1 << 64)) for i in range(3))


def token_sets(column: pa.Array, n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingles of each row; fewer than ``n`` words are one shingle, none is empty."""
    numbers, rows = words(column, lower=True)
    whole = grams(numbers, n)
    out = []
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        if b - a >= n:
            x = np.sort(whole[a : b - n + 1])
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        elif b > a:
            out.append(grams(numbers[a:b], b - a))
        else:
            out.append(whole[:0])
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches):
        sets = token_sets(batch["text"])
        sizes = np.array([len(s) for s in sets], np.int64)
        some = np.flatnonzero(sizes)
        columns = {x: np.zeros(len(sets), np.int64) for x in ("k1", "k2", "m0", "m1", "m2")}
        if len(some):
            tokens = np.concatenate(sets)
            heads = (np.cumsum(sizes) - sizes)[some]
            columns["k1"][some] = signed(np.add.reduceat(mix(tokens), heads))
            columns["k2"][some] = signed(np.add.reduceat(mix(tokens ^ _SEEDS[0]), heads))
            for i, seed in enumerate(_SEEDS):
                columns[f"m{i}"][some] = signed(np.minimum.reduceat(mix(tokens + seed), heads))
        named = {"d": batch["d"], "o": batch["o"], "n": pa.array(sizes)}
        yield pa.record_batch(named | {k: pa.array(v) for k, v in columns.items()})


def _by_bucket(bits: int):
    """Tokens as ``bits`` high bits, which name a bucket, and the 32 bits behind them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            tokens = np.sort(np.concatenate([*token_sets(batch["text"]), np.zeros(0, np.uint64)]))
            bucket = _short(tokens, bits) >> np.uint64(32)
            rest = _short(tokens, bits).astype(np.uint32)
            cuts = np.searchsorted(bucket, np.arange((1 << bits) + 1, dtype=np.uint64))
            some = np.flatnonzero(np.diff(cuts))
            if len(some):
                yield pa.record_batch(
                    {
                        "bucket": pa.array(some.astype(np.int64)),
                        "tokens": pa.array([rest[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary()),
                    }
                )

    return run


def _short(tokens: np.ndarray, bits: int) -> np.ndarray:
    return tokens >> np.uint64(32 - bits)


def _count(least: int):
    def run(bucket: pa.Table) -> pa.Table:
        tokens = np.concatenate([np.frombuffer(x, np.uint32) for x in bucket["tokens"].to_pylist()])
        value, n = np.unique(tokens, return_counts=True)
        common = n > least
        short = (bucket["bucket"][0].as_py() << 32) + value[common].astype(np.int64)
        return pa.table({"short": pa.array(short), "docs": pa.array(n[common].astype(np.int64))})

    return run


def common_tokens(texts: DataFrame, total: int) -> tuple[np.ndarray, int]:
    """The (at most ``COMMON_LIMIT`` most) common tokens by their high bits, and how many bits."""
    bits = min(20, max(0, (total // COUNTED_AT_ONCE).bit_length()))
    counted = store(
        texts.mapInArrow(_by_bucket(bits), "bucket long, tokens binary")
        .groupBy("bucket")
        .applyInArrow(_count(COMMON), "short long, docs long"),
        "common",
    )
    most = counted.orderBy(F.desc("docs"), "short").limit(COMMON_LIMIT).select("short").toArrow()
    return np.sort(most["short"].to_numpy().astype(np.uint64)), bits


def _has(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)] == x


def _prefixes(common, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            rare, usual, size = [], [], []
            for tokens in token_sets(batch["text"]):
                length = len(tokens) - -(-OVER * len(tokens) // UNDER) + 1 if len(tokens) else 0
                last = _has(common.value, _short(tokens, bits))
                first = tokens[~last][:length]
                size.append(len(tokens))
                rare.append(signed(first))
                usual.append(signed(tokens[last][: length - len(first)]))
            lists = pa.list_(pa.int64())
            yield pa.record_batch(
                [
                    *batch.select(["d", "c", "g", "part"]).columns,
                    pa.array(np.array(size, np.int32)),
                    pa.array(rare, lists),
                    pa.array(usual, lists),
                ],
                names=["d", "c", "g", "part", "n", "rare", "usual"],
            )

    return run


_PAIR = "g long, part int, q long, d long, least int"
_ROW = ("token", "d", "c", "g", "part", "n", "usual")


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by token: pairs of sets of different components, once for each token they share."""
    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch[c].to_numpy() for c in _ROW]
        if kept is not None:
            rows = [np.concatenate(x) for x in zip(kept, rows, strict=True)]
        open_from = np.searchsorted(rows[0], rows[0][-1])  # the last token may go on in the next batch
        kept = [x[open_from:] for x in rows]
        yield from _pairs(*[x[:open_from] for x in rows])
    if kept is not None:
        yield from _pairs(*kept)


def _pairs(t, d, c, g, part, n, usual) -> Iterator[pa.RecordBatch]:
    """``least`` is how many of their rare prefix tokens the two must share.

    What two sets share is at most what their prefixes share and what the set whose prefix
    ends first has left; they link only if they share 3/7 of their sizes' sum.
    """
    left_over = -(-OVER * n // UNDER) - 1
    apart = 1
    left = np.flatnonzero(t[apart:] == t[:-apart]) if len(t) > 1 else np.zeros(0, np.int64)
    while len(left):
        right = left + apart
        fits = UNDER * np.minimum(n[left], n[right]) >= OVER * np.maximum(n[left], n[right])
        fits &= c[left] != c[right]
        a, b = left[fits], right[fits]
        if len(a):
            swap = c[a] > c[b]
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            needed = -(-OVER * (n[a] + n[b]) // (OVER + UNDER))
            least = needed - np.maximum(left_over[a], left_over[b]) - np.minimum(usual[a], usual[b])
            yield pa.record_batch(
                [pa.array(x) for x in (g[b], part[b], d[a], d[b], np.maximum(least, 1).astype(np.int32))],
                names=["g", "part", "q", "d", "least"],
            )
        apart += 1
        left = left[left + apart < len(t)]
        left = left[t[left] == t[left + apart]]


def candidates(prefixes: DataFrame) -> DataFrame:
    """Distinct (g, part, q): set ``q`` can link with a member of that part, of another component."""
    rare = (
        prefixes.select(
            F.explode("rare").alias("token"), "d", "c", "g", "part", "n", F.size("usual").alias("usual")
        )
        .repartition("token").sortWithinPartitions("token").mapInArrow(_meet, _PAIR)
        .groupBy("g", "part", "q", "d", "least").agg(F.count("*").alias("shared"))
        .filter("shared >= least").select("g", "part", "q")
    )
    # The matrix: each common token once for each part that has it in a prefix.
    matrix = store(
        prefixes.select(F.explode("usual").alias("token"), "c", "g", "part", "n")
        .groupBy("token", "g", "part")
        .agg(*[f("c").alias(f"{k}_c") for k, f in (("least", F.min), ("most", F.max))],
             *[f("n").alias(f"{k}_n") for k, f in (("least", F.min), ("most", F.max))]),
        "matrix",
    )
    several = store(
        matrix.groupBy("token").agg(F.min("least_c").alias("low"), F.max("most_c").alias("high"))
        .filter("low < high").select("token"),
        "tokens",
    )
    matrix = store(matrix.join(several, "token"), "spread")
    left, right = (matrix.select("token", *[F.col(c).alias(s + c) for c in matrix.columns[1:]]) for s in "ab")
    met = (
        left.join(right, "token")
        .filter("ag < bg OR (ag = bg AND apart <= bpart)")
        .filter("aleast_c < bmost_c OR bleast_c < amost_c")
        .filter(f"{UNDER} * amost_n >= {OVER} * bleast_n AND {UNDER} * bmost_n >= {OVER} * aleast_n")
        .select("ag", "apart", "bg", "bpart").distinct()
    )
    asking = prefixes.filter("size(usual) > 0").select(
        F.col("g").alias("ag"), F.col("part").alias("apart"), F.col("d").alias("q")
    )
    usual = store(met, "met").join(asking, ["ag", "apart"]).select(
        F.col("bg").alias("g"), F.col("bpart").alias("part"), "q"
    )
    return store(rare.unionByName(usual).distinct(), "candidates")


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of each document, once for every place where it is a member or a query."""
    for batch in parts(batches):
        offsets, places = structs(batch["places"])
        sets = token_sets(batch["text"])
        row = np.repeat(np.arange(len(sets)), np.diff(offsets))
        for lo in range(0, len(row), 10_000):
            some = row[lo : lo + 10_000]
            yield pa.record_batch(
                [pa.array(places[c][lo : lo + 10_000]) for c in ("g", "part", "copy", "kind", "c")]
                + [batch["d"].take(pa.array(some)), pa.array([sets[i].tobytes() for i in some], pa.binary())],
                names=["g", "part", "copy", "kind", "c", "d", "tokens"],
            )


class _Part:
    """Members of a part of a group, with the union of their tokens."""

    def __init__(self):
        self.ids: list[int] = []
        self.components: list[int] = []
        self.sets: list[np.ndarray] = []
        self.union = None

    def add(self, d: int, component: int, tokens: np.ndarray) -> None:
        self.ids.append(d)
        self.components.append(component)
        self.sets.append(tokens)

    def close(self) -> None:
        self.all = np.concatenate(self.sets)
        self.union = np.unique(self.all)
        self.sizes = np.array([len(s) for s in self.sets])
        self.heads = np.cumsum(self.sizes) - self.sizes
        self.component = np.array(self.components)

    def links(self, component: int, tokens: np.ndarray) -> list[int]:
        """A member of each other component that links with the set."""
        if not self.ids:
            return []
        if self.union is None:
            self.close()
        if UNDER * int(_has(self.union, tokens).sum()) < OVER * len(tokens):
            return []  # no member can reach the threshold: the part stays shut
        shared = np.add.reduceat(_has(tokens, self.all).astype(np.int64), self.heads)
        linked = UNDER * shared >= OVER * (self.sizes + len(tokens) - shared)
        linked = np.flatnonzero(linked & (self.component != component))
        _, first = np.unique(self.component[linked], return_index=True)
        return [self.ids[i] for i in linked[first].tolist()]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part of a group, its members first."""
    key, part = None, _Part()
    for batch in batches:
        a, b = [], []
        columns = (batch[c].to_pylist() for c in ("g", "part", "copy", "kind", "c", "d", "tokens"))
        for g, number, copy, kind, component, d, raw in zip(*columns, strict=True):
            if (g, number, copy) != key:
                key, part = (g, number, copy), _Part()
            tokens = np.frombuffer(raw, np.uint64)
            if not len(tokens):
                continue
            if kind == 0:
                part.add(d, component, tokens)
            else:
                found = part.links(component, tokens)
                a += [d] * len(found)
                b += found
        if a:
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def compare(texts: DataFrame, members: DataFrame, queries: DataFrame) -> DataFrame:
    """Links (a, b) of query sets with members of the part of a group they query.

    ``members`` (g, part, d, c) and ``queries`` (g, part, q, c) name documents of ``texts``
    (d, text) and their components; of a component that a set links with, one member is given.
    A part with many queries is sent to several tasks, each with its share of them.
    """
    copies = F.ceil(F.col("n") / QUERIES_PER_COPY).cast("int")
    asked = store(
        queries.groupBy("g", "part").agg(F.count("*").alias("n")).select("g", "part", copies.alias("copies")),
        "asked",
    )
    to_members = members.join(asked, ["g", "part"]).select(
        "g", "part", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("kind"), "c", "d"
    )
    to_queries = queries.join(asked, ["g", "part"]).select(
        "g", "part", F.pmod(F.hash("q"), F.col("copies")).alias("copy"), F.lit(1).alias("kind"), "c", F.col("q").alias("d")
    )
    places = (
        to_members.unionByName(to_queries).groupBy("d")
        .agg(F.collect_list(F.struct("g", "part", "copy", "kind", "c")).alias("places"))
    )
    sent = texts.join(places, "d").mapInArrow(
        _send, "g long, part int, copy int, kind int, c long, d long, tokens binary"
    )
    unit = ["g", "part", "copy"]
    compared = sent.repartition(*unit).sortWithinPartitions(*unit, "kind").mapInArrow(_compare, "a long, b long")
    return store(compared, "compared")


def linked_sets(texts: DataFrame) -> DataFrame:
    """One row per row of ``texts`` (d, a number of its own, o, its order, and text): d, n_shingles, component.

    A component is named by its smallest d. The numbers must be stored with the texts. The first
    in order of several similar sets leads them: near copies resemble their original more than
    each other, and originals come first more often than not.
    """
    spark = texts.sparkSession
    signs = store(
        texts.mapInArrow(_signatures, "d long, o long, n long, k1 long, k2 long, m0 long, m1 long, m2 long"), "signs"
    )
    texts = texts.select("d", "text")
    first = F.min(F.struct("o", "d")).alias("first")
    same = ["n", "k1", "k2"]
    sets = store(
        signs.filter("n > 0").groupBy(*same)
        .agg(first, *[F.first(m).alias(m) for m in ("m0", "m1", "m2")])
        .select("first.*", *same, "m0", "m1", "m2"),
        "sets",
    )
    total = sets.agg(F.sum("n")).first()[0] or 0
    # First groups: sets that share a smallest hash, around the first among them.
    near = []
    for m in ("m0", "m1", "m2"):
        lead = store(
            sets.groupBy(m).agg(first, F.count("*").alias("times")).filter("times > 1").select(m, F.col("first.d").alias("g")),
            "lead",
        )
        near.append(sets.join(lead, m).filter("d <> g").select("g", F.lit(0).alias("part"), F.col("d").alias("q")))
    queries = store(near[0].unionByName(near[1]).unionByName(near[2]).distinct(), "near")
    own = lambda c: F.col(c).alias("c")
    leaders = queries.select("g", "part", F.col("g").alias("d"), own("g")).distinct()
    links = compare(texts, leaders, queries.select("g", "part", "q", own("q")))
    component = components(links).select(F.col("node").alias("d"), F.col("component").alias("c"))
    component = store(
        sets.select("d").distinct().join(component, "d", "left").select("d", F.coalesce("c", "d").alias("c")),
        "component",
    )
    gathered = queries.groupBy(F.col("q").alias("d")).agg(F.min("g").alias("leader"))
    of_leader = component.select(F.col("d").alias("leader"), F.col("c").alias("leader_c"))
    grouped = store(
        component.join(gathered, "d", "left").join(of_leader, "leader", "left")
        .select("d", "c", F.coalesce("leader_c", "c").alias("g")),
        "grouped",
    )
    sizes = grouped.groupBy("g").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    parted = store(
        grouped.join(store(sizes, "sizes"), "g").select(
            "d", "c", "g", F.pmod(F.hash("d"), F.col("parts")).alias("part")
        ),
        "parted",
    )
    common, bits = common_tokens(texts, total)
    shared = spark.sparkContext.broadcast(common)
    prefixes = store(
        texts.join(parted, "d").mapInArrow(
            _prefixes(shared, bits),
            "d long, c long, g long, part int, n int, rare array<long>, usual array<long>",
        ),
        "prefixes",
    )
    asked = candidates(prefixes)
    wanted = asked.select("g", "part").distinct()
    asking = asked.join(component.withColumnRenamed("d", "q"), "q")
    more = compare(texts, parted.join(wanted, ["g", "part"]), store(asking, "asking"))
    whole = components(links.unionByName(more))
    named = sets.join(whole.withColumnRenamed("node", "d"), "d", "left").select(
        *same, F.coalesce("component", "d").alias("component")
    )
    named = store(named, "named")
    return signs.join(named, same, "left").select(
        "d", F.col("n").alias("n_shingles"), F.coalesce("component", "d").alias("component")
    )


def _linked_rows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with a number __d for each row, stored, and its ``linked_sets``.

    Links are between rows, not ids: rows without an id, or with an id in common, stay apart.
    """
    rows = store(docs.withColumn("__d", F.monotonically_increasing_id()), "rows")
    return rows, linked_sets(rows.select(F.col("__d").alias("d"), key_of().alias("o"), "text"))


def join_near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every document.

    Two documents link when their sets of distinct 5-word shingles (A to Z lower-cased) have a
    Jaccard similarity of 0.75 or more. Fewer than five words are one shingle; a null, empty or
    blank text has none, links with nothing and is its own component. Every row is linked by
    its own text, also where rows share a doc_id or have none. A component of rows without an
    id has a null component_id; others pass over null ids. Other columns are ignored; no rows
    give no rows.
    """
    rows, linked = _linked_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    named = store(
        rows.select("doc_id", F.col("__d").alias("d")).join(linked, "d").select("doc_id", "n_shingles", "component"),
        "linked",
    )
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(smallest, "component").select("doc_id", "n_shingles", "component_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component, columns unchanged: that with the smallest doc_id.

    Null ids come after all others; of rows with the same id one is kept. Rows that link with
    nothing stay, whatever their ids.
    """
    rows, linked = _linked_rows(docs)
    ids = rows.select(F.col("__d").alias("d"), F.col("doc_id").cast("long").alias("id"))
    order = F.struct(F.col("id").isNull().alias("absent"), "id", "d")
    kept = ids.join(linked, "d").groupBy("component").agg(F.min(order).alias("first"))
    kept = store(kept.select(F.col("first.d").alias("__d")), "kept")
    return rows.join(kept, "__d", "left_semi").select(*docs.columns)


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return join_near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP6_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 75 * (
    (SELECT n FROM sizes WHERE doc_id = a.doc_id) + (SELECT n FROM sizes WHERE doc_id = b.doc_id) - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM words
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT words.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(reach.b) AS component_id
FROM words LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.a = words.doc_id
GROUP BY words.doc_id, n
"""
