"""Balanced mixing against plain water filling and the invariants of the cube method."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from oracle import SF_DIR

from tallystream.llm import mixing
from tallystream.llm.mixing import flight, landing, mix, targets
from tallystream.llm.workload import QUERIES

WORDS = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, source string"


def plain_targets(sizes):
    """Share out by weight, cut at twice the size, share the excess again, in exact numbers."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target = dict.fromkeys(order, Fraction(0))
    rest = Fraction(3, 2) * sum(sizes.values())
    while rest:
        free = [s for s in order if target[s] < 2 * sizes[s]]
        part = rest / sum(weight[s] for s in free)
        rest = 0
        for s in free:
            target[s] += part * weight[s]
            rest += max(0, target[s] - 2 * sizes[s])
            target[s] = min(target[s], 2 * sizes[s])
    return target


def size_of(text):
    return len(WORDS.findall(text or ""))


def check(rows, got, near=None):
    """``rows`` are (doc_id, text, source); ``near`` bounds the distance to a target."""
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size_of(text)
    want = plain_targets(sizes)
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter(
        (d, size_of(t), s) for d, t, s in rows
    )
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(float(want[r["source"]]))
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        largest = max(size_of(t) for _, t, s in rows if s == source)
        assert abs(taken[source] - target) <= (largest / 2 if near is None else near)


def test_query_against_plain_targets(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "source").collect()
    check([tuple(r) for r in rows], QUERIES["op11_cube_mixing"](spark, SF_DIR).collect())


def test_flight_keeps_sums_and_means():
    size = np.random.default_rng(0).integers(0, 4_000, 60).astype(float)
    start = np.random.default_rng(1).uniform(0.05, 0.95, 60)
    ends = []
    for seed in range(400):
        p = flight(start, size, np.random.default_rng(seed), 2)
        between = (p > 0) & (p < 1)
        assert between.sum() <= 2
        assert p.sum() == pytest.approx(start.sum())
        assert p @ size == pytest.approx(start @ size)
        ends.append(p)
    assert np.abs(np.mean(ends, axis=0) - start).max() < 0.1  # four standard deviations


@pytest.mark.parametrize("sizes", [[5.0] * 30, [0.0] * 30, [1e9] + [1.0] * 29])
def test_flight_of_equal_and_extreme_sizes(sizes):
    size = np.array(sizes)
    p = flight(np.full(30, 0.3), size, np.random.default_rng(0), 10)
    assert ((p > 0) & (p < 1)).sum() <= 10
    assert p.sum() == pytest.approx(9)


def test_landing_is_the_nearest_rounding():
    rng = np.random.default_rng(2)
    for _ in range(50):
        p, size = rng.uniform(0, 1, 6), rng.integers(0, 30, 6).astype(float)
        done = landing(p, size)
        assert set(done) <= {0.0, 1.0}
        ways = (np.arange(64)[:, None] >> np.arange(6)) & 1
        assert abs(done @ size - p @ size) == pytest.approx(np.abs(ways @ size - p @ size).min())
    assert landing(np.array([0.0, 1.0]), np.ones(2)).tolist() == [0, 1]


def test_blocks_meet_again(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 40)
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(0, 200), rng.choice(["a", "b", "b", "b", "c"])) for i in range(2_000)]
    frame = spark.createDataFrame(rows, DOCS)
    got = mix(frame).collect()
    check(rows, got, near=5)
    for source in "abc":  # documents are balanced too
        own = [r for r in got if r["source"] == source]
        ratio = own[0]["target"] / own[0]["source_size"]
        assert abs(sum(r["times"] for r in own) - ratio * len(own)) < 8
    again = mix(frame.repartition(7, "text")).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_CHUNK", 16)
    rng = random.Random(5)
    rows = [(None, "a b", "x")] * 500 + [(3, "a", "y")] * 41 + [(4, None, None), (4, " \n", None), (5, "é é b", "")]
    rows += [(None, "w " * rng.randrange(9), None) for _ in range(40)] + [(6, "long " * 30_000, "z"), (7, None, "empty")]
    rows += [(100 + i, "w " * rng.randrange(1, 90), "x") for i in range(300)]
    named = [(*r, 1, 2.0, "k") for r in rows]
    frame = spark.createDataFrame(named, DOCS + ", size int, p double, rows string")
    check(rows, mix(frame).collect())
    assert mix(frame.limit(0)).collect() == []
    blank = mix(spark.createDataFrame([(1, None, "a"), (2, "", None)], DOCS)).collect()
    assert [(r["target"], r["taken"]) for r in blank] == [(0, 0), (0, 0)]


def test_targets_of_many_sources(spark):
    rng = random.Random(6)
    sizes = {f"s{i:04}": rng.choice([0, 1, 10, 10_000]) * rng.randrange(9) for i in range(700)} | {None: 5, "": 7, "é": 1}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(9)
    got = {r["source"]: r["target"] for r in targets(frame).collect()}
    want = plain_targets(sizes)
    assert got == {s: pytest.approx(float(t)) for s, t in want.items()}
