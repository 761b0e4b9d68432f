"""Substring dedup: suffix automata of reference shards, documents streamed past them.

A run of 50 words that starts in two documents is removed from the later one. Every such run
has the same anchor wherever it stands: its 12-word run with the smallest hash. Anchors found
in more than one document name the reference: the passages around them in the first document
that has them, cut into shards of at most ``SHARD`` anchor places. Each shard's automaton is
built in a task, past which the matching passages of later documents stream; shards that many
documents match are sent to several tasks, each with its share of the documents.

What has a known anchor but is not in the first document's passage (the same anchor, other
surroundings) goes to another round with wider anchors: of 31, 41, 46 and at last 50 words,
each the one before and what stands beside it in the run. Surroundings that a single document
has end there; the first document of all others is the reference of that round. An anchor of
50 words is the whole run, so nothing is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystream.llm.automaton import SuffixAutomaton
from tallystream.llm.batches import parts, structs
from tallystream.llm.tables import key_of, refuse_names, store, table
from tallystream.llm.words import grams, signed, words

WINDOW = 50
#: Places in the first document that one reference shard covers.
SHARD = 4096
#: Documents that stream past one copy of a shard before it is sent to twice as many tasks.
PER_COPY = 64

_REFERENCE, _OWN, _STREAMED = 0, 1, 2
_MATCHED, _MISSED = 0, 1


def anchor_widths(window: int) -> list[int]:
    """Words of an anchor in each round.

    The first is short enough for few anchors (two in ``window - width + 2`` places) and long
    enough to be rare. Each further one takes half of what is left of the run, on the side that
    has it; a few last words are taken at once.
    """
    widths = [max(1, window // 4)]
    while widths[-1] < window:
        left = window - widths[-1]
        widths.append(window if left <= 4 else widths[-1] + (left + 1) // 2)
    return widths


def _least(numbers: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs as long as a first anchor, and the place of each window's least one."""
    k = anchor_widths(window)[0]
    span = window - k + 1
    hashes = grams(numbers, k)
    # High half: hash; low half: place, so that the first of equal hashes wins.
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    return hashes, (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where any of the columns differs from the row before; the first row is a head."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def minimizers(numbers: np.ndarray, rows: np.ndarray, window: int):
    """Anchors of all windows that lie within a row.

    Returns arrays of row, anchor hash, anchor place, first window and number of windows in
    a row that share the hash; places are counted from the start of the row. Where a text
    repeats itself, the windows with equal anchors are one entry (for each ``SHARD`` places).
    """
    if len(numbers) < window:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none, none
    hashes, place = _least(numbers, window)
    row_of = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    first = np.flatnonzero(row_of[: len(place)] == row_of[window - 1 :])
    row, place = row_of[first], place[first]
    h, place, first = hashes[place], place - rows[row], first - rows[row]
    heads = _heads(h, row, place // SHARD)
    counts = np.diff(np.append(heads, len(h)))
    return row[heads], h[heads], place[heads], first[heads], counts


def wider_anchors(numbers: np.ndarray, windows: np.ndarray, window: int, step: int, start: int = 0):
    """Anchors of round ``step`` of the given windows of a passage that begins at ``start``.

    Returns arrays of hash, place, first window and number of neighbouring windows that share
    the hash; places are counted like ``start``.
    """
    widths = anchor_widths(window)
    place, width = _least(numbers, window)[1][windows], widths[0]
    for wider in widths[1 : step + 1]:
        if wider == window:
            place = windows
        else:  # to the left where there is room, else to the right, where there must be
            more = wider - width
            place = np.where(place - windows >= more, place - more, place)
        width = wider
    h = grams(numbers, width)[place]
    place, first = place + start, windows + start
    heads = _heads(h, place // SHARD, first - np.arange(len(first)))
    return h[heads], place[heads], first[heads], np.diff(np.append(heads, len(h)))


def _anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            numbers, rows = words(batch["text"])
            row, h, place, lo, n = minimizers(numbers, rows, window)
            if len(row):
                yield pa.record_batch(
                    {
                        "h": pa.array(signed(h)),
                        "d": batch["d"].take(pa.array(row)),
                        "t": batch["t"].take(pa.array(row)),
                        "place": pa.array(place.astype(np.int32)),
                        "lo": pa.array(lo.astype(np.int32)),
                        "n": pa.array(n.astype(np.int32)),
                    }
                )

    return run


#: A reference shard: places of one text.
_SHARD = ("first", "first_t", "block", "level")
_PASSAGE = (
    "first long, first_t long, block int, level int, kind int, d long, t long, lo int, n int, words binary"
)
_ARROW = pa.schema(
    [("first", pa.int64()), ("first_t", pa.int64()), ("block", pa.int32()), ("level", pa.int32()),
     ("kind", pa.int32()), ("d", pa.int64()), ("t", pa.int64()), ("lo", pa.int32()),
     ("n", pa.int32()), ("words", pa.binary())]
)


def _passages(window: int):
    """Reference and streamed passages of each document, by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            numbers, rows = words(batch["text"])
            offsets, all_fields = structs(batch["anchors"])
            ds, ts = batch["d"].to_pylist(), batch["t"].to_pylist()
            out = []
            for i, (d, t) in enumerate(zip(ds, ts, strict=True)):
                f = {k: v[offsets[i] : offsets[i + 1]] for k, v in all_fields.items()}
                order = np.argsort(f["lo"], kind="stable")
                f = {k: v[order] for k, v in f.items()}
                # Neighbouring windows bound for the same shard stay together.
                gaps = np.cumsum(np.append(True, f["lo"][1:] != f["lo"][:-1] + f["n"][:-1]))
                heads = _heads(gaps, f["kind"], *(f[x] for x in _SHARD))
                tails = np.append(heads[1:], len(order)) - 1
                for a, b in zip(heads.tolist(), tails.tolist(), strict=True):
                    lo = int(f["lo"][a])
                    n = int(f["lo"][b] + f["n"][b]) - lo
                    text = numbers[rows[i] + lo : rows[i] + lo + n + window - 1].tobytes()
                    out.append((*(int(f[x][a]) for x in (*_SHARD, "kind")), d, t, lo, n, text))
            if out:
                columns = zip(*out, strict=True)
                yield pa.record_batch([pa.array(c, type=f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)

    return run


_FOUND = "kind int, h long, place int, d long, t long, lo int, n int, words binary"
_FOUND_ARROW = pa.schema(
    [("kind", pa.int32()), ("h", pa.int64()), ("place", pa.int32()), ("d", pa.int64()),
     ("t", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()), ("words", pa.binary())]
)


def _runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Heads and lengths of runs of consecutive numbers."""
    heads = np.flatnonzero(np.diff(places, prepend=-2) != 1)
    return places[heads], np.diff(np.append(heads, len(places)))


def _stream(window: int, step: int):
    """Rows come sorted by shard, each shard's reference first; one automaton lives at a time.

    Gives the matched runs, and passages around the anchors of round ``step`` of what is missed.
    """

    def judge(row: dict, automaton: SuffixAutomaton) -> Iterator[tuple]:
        d, t, lo = row["d"], row["t"], row["lo"]
        numbers = np.frombuffer(row["words"], np.uint64)
        missed = np.array(automaton.matches(numbers.tolist()))[window - 1 :] < window
        if row["kind"] == _STREAMED:  # what a document has twice does not go
            for start, n in zip(*(x.tolist() for x in _runs(np.flatnonzero(~missed) + lo)), strict=True):
                yield _MATCHED, None, None, d, t, start, n, None
        if missed.any():
            found = wider_anchors(numbers, np.flatnonzero(missed), window, step, lo)
            for h, place, first, n in zip(signed(found[0]).tolist(), *(x.tolist() for x in found[1:]), strict=True):
                yield _MISSED, h, place, d, t, first, n, numbers[first - lo : first - lo + n + window - 1].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, automaton = None, SuffixAutomaton()
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                key = (*(row[x] for x in _SHARD), row["copy"])
                if key != shard:
                    shard, automaton = key, SuffixAutomaton()
                if row["kind"] == _REFERENCE:
                    automaton.add(np.frombuffer(row["words"], np.uint64).tolist())
                else:
                    out.extend(judge(row, automaton))
            if out:
                columns = zip(*out, strict=True)
                yield pa.record_batch([pa.array(c, type=f.type) for c, f in zip(columns, _FOUND_ARROW, strict=True)], schema=_FOUND_ARROW)

    return run


def _shared(anchors: DataFrame) -> DataFrame:
    """Anchors of several documents, the first text that has each, and how many tasks its shard goes to."""
    return (
        anchors.groupBy("h")
        .agg(
            F.min(F.struct("d", "t", "place")).alias("first"),
            F.max("d").alias("last"),
            F.count("*").alias("docs"),
        )
        .filter("first.d < last")
        .select(
            "h",
            F.col("first.d").alias("first"),
            F.col("first.t").alias("first_t"),
            F.floor(F.col("first.place") / SHARD).cast("int").alias("block"),
            F.greatest(F.lit(0), F.floor(F.log2(F.col("docs") / PER_COPY))).cast("int").alias("level"),
        )
    )


def _kind() -> Column:
    """What an anchor is to the shard of its hash."""
    own = F.col("d") == F.col("first")
    here = (F.col("t") == F.col("first_t")) & (F.floor(F.col("place") / SHARD) == F.col("block"))
    return F.when(own & here, _REFERENCE).when(own, _OWN).otherwise(_STREAMED)


def _past_automata(passages: DataFrame, window: int, step: int) -> DataFrame:
    """Send each passage to its shard: references to all of its tasks, others to one of them."""
    copies = F.expr("sequence(0, shiftleft(1, level) - 1)")
    one = F.expr("array(cast(xxhash64(d, t) & (shiftleft(1L, level) - 1) AS int))")
    unit = [*_SHARD, "copy"]
    return (
        passages.withColumn("copy", F.explode(F.when(F.col("kind") == _REFERENCE, copies).otherwise(one)))
        .repartition(*unit)
        .sortWithinPartitions(*unit, "kind")
        .mapInArrow(_stream(window, step), _FOUND)
    )


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Windows of each document that also start in a document with a smaller id.

    One row per id and text that has some: d (id, null as the largest number), t (hash of the
    text), spans (array of start and number of consecutive windows). Equal rows share one.
    """
    texts = docs.select(key_of().alias("d"), F.xxhash64("text").alias("t"), "text")
    anchors = store(
        texts.mapInArrow(_anchors(window), "h long, d long, t long, place int, lo int, n int"), "anchors"
    )
    shared = store(_shared(anchors), "shared")
    fields = ("lo", "n", "kind", *_SHARD)
    # Equal rows are looked at once, so that no list and no shard grows with their number.
    by_document = (
        anchors.join(shared, "h").withColumn("kind", _kind())
        .groupBy("d", "t").agg(F.collect_set(F.struct(*fields)).alias("anchors"))
    )
    once = texts.dropDuplicates(["d", "t"])
    passages = once.join(by_document, ["d", "t"]).mapInArrow(_passages(window), _PASSAGE)
    last = len(anchor_widths(window)) - 1
    found = []
    for step in count(1):
        found.append(store(_past_automata(passages, window, min(step, last)), "matched"))
        left = found[-1].filter(F.col("kind") == _MISSED).drop("kind")
        shared = store(_shared(left), "shared")
        if shared.isEmpty():  # in the round of whole runs: unless hashes of two are equal
            break
        passages = left.join(shared, "h").withColumn("kind", _kind()).select(*_ARROW.names)
    matched = reduce(DataFrame.unionByName, found).filter(F.col("kind") == _MATCHED)
    spans = F.collect_list(F.struct(F.col("lo").alias("start"), "n"))
    return matched.groupBy("d", "t").agg(spans.alias("spans"))


def _cut(window: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            offsets, spans = structs(batch["__spans"])
            kept, total, removed = [], [], []
            for i, text in enumerate(batch["text"].to_pylist()):
                own = (text or "").encode().split()  # splits at exactly the bytes that part words
                gone = np.zeros(len(own) + 1, np.int32)
                a, b = offsets[i], offsets[i + 1]
                if a < b:
                    np.add.at(gone, spans["start"][a:b], 1)
                    np.add.at(gone, spans["start"][a:b] + spans["n"][a:b] + window - 1, -1)
                cut = np.cumsum(gone[:-1]) > 0
                if cut.any():
                    left = [own[j] for j in np.flatnonzero(~cut).tolist()]
                else:
                    left = own
                kept.append(b" ".join(left).decode())
                total.append(len(own))
                removed.append(len(own) - len(left))
            data = [batch[n] for n in schema.names[:-3]] + [pa.array(x) for x in (kept, total, removed)]
            yield pa.record_batch([x.cast(f.type) for x, f in zip(data, schema, strict=True)], schema=schema)

    return run


def cut_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """All rows of ``docs`` with ``kept_text``, ``n_words`` and ``n_removed``.

    A word goes if a run of ``window`` words that covers it also starts in a document with a
    smaller doc_id. Runs lie within one row; they are judged on the input, not on what is
    left. ``kept_text`` has the kept words joined by one space. A null text has no words and
    an empty ``kept_text``. Of rows with the same doc_id none counts as earlier than another;
    a null doc_id comes after all others. Columns of other names are passed on unchanged; a
    column named like one of the three is an error.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    refuse_names(docs, ["kept_text", "n_words", "n_removed"])

    spans = repeated_windows(docs, window).select(
        F.col("d").alias("__d"), F.col("t").alias("__t"), F.col("spans").alias("__spans")
    )
    keyed = docs.withColumns({"__d": key_of(), "__t": F.xxhash64("text")})
    joined = keyed.join(spans, ["__d", "__t"], "left").select(*docs.columns, "__spans")
    schema = T.StructType(
        docs.schema.fields
        + [
            T.StructField("kept_text", T.StringType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
        ]
    )
    return joined.mapInArrow(_cut(window, to_arrow_schema(schema)), schema)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words of repeated 50-word runs removed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return cut_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


OP1_SQL = """
WITH parts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM parts WHERE len(w) >= 50
), runs AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS run FROM starts
), firsts AS (
  SELECT run, min(doc_id) AS first FROM runs GROUP BY run HAVING count(DISTINCT doc_id) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS j
  FROM runs JOIN firsts USING (run) WHERE first < doc_id
), placed AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM parts
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n
  FROM placed ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM parts LEFT JOIN kept USING (doc_id)
"""
