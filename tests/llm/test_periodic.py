"""Periodic runs against plain definitions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from oracle import SF_DIR

from tallystream.llm.lyndon import lyndon_array, runs
from tallystream.llm.periodic import crowded, op12_baier_runs, periodic_runs
from tallystream.llm.workload import QUERIES

WORDS = re.compile("[^\x20\x09-\x0d]+")


def split(text):
    return WORDS.findall(text or "")


def plain_lyndon(letters):
    ends = []
    for i in range(len(letters)):
        j = i + 1
        while j < len(letters) and letters[j:] > letters[i:]:
            j += 1
        ends.append(j - i)
    return ends


def plain_runs(letters, exponent, shortest):
    """Every period in turn, smallest first; a multiple of a run's period is not its own."""
    found = []
    for p in range(1, len(letters) // exponent + 1):
        i = 0
        while i + p < len(letters):
            j = i
            while j + p < len(letters) and letters[j] == letters[j + p]:
                j += 1
            length = j + p - i
            known = any(s <= i and i + length <= s + n and p % q == 0 for s, n, q in found)
            if j > i and length >= max(shortest, exponent * p) and not known:
                found.append((i, length, p))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def some_letters(rng):
    letters = [rng.randrange(1, 4) for _ in range(rng.randrange(0, 40))]
    if len(letters) > 4 and rng.random() < 0.6:
        p, a = rng.randrange(1, len(letters) // 2), rng.randrange(len(letters))
        letters[a:] = [letters[a + i % p] if a + i % p < len(letters) else 1 for i in range(len(letters) - a)]
    return letters


def test_lyndon_arrays_and_runs():
    rng = random.Random(1)
    for _ in range(1500):
        letters = some_letters(rng)
        array = np.array(letters, np.int64)
        assert lyndon_array(array).tolist() == plain_lyndon(letters)
        for exponent, shortest in ((2, 2), (3, 3), (4, 6)):
            assert runs(array, exponent, shortest) == plain_runs(letters, exponent, shortest)


def test_separators_and_rare_words_change_nothing():
    rng = random.Random(2)
    for _ in range(400):
        letters = some_letters(rng) + [9] + some_letters(rng)
        array = np.array(letters, np.int64)
        want = plain_runs(letters, 4, 6)
        parted = [r for r in runs(np.where(array == 9, 0, array), 4, 6)]
        assert parted == want
        at, _ = crowded(array, 4, 6)
        covered = {i for s, n, _ in want for i in range(s, s + n)}
        assert covered <= set(at.tolist())


@pytest.mark.parametrize("n", [2_000, 20_000])
def test_long_periodic_texts(n):
    unit = np.random.default_rng(3).integers(1, 9, 137)
    letters = np.tile(unit, n // 137)
    assert (0, len(letters), 137) in runs(letters, 4, 6)
    assert runs(np.ones(n, np.int64), 4, 6) == [(0, n, 1)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_row(doc_id, text):
    words = split(text)
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words, 4, 6)
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    s, m, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    return (
        doc_id, len(found), s, m, q, m * 1000 // q if found else None,
        digest("".join(f"{a},{b},{c}\n" for a, b, c in found)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def by_id(rows):
    return sorted(map(tuple, rows), key=str)


def test_query_against_plain_definition(spark):
    assert QUERIES["op12_baier_runs"] is op12_baier_runs
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = [plain_row(*r) for r in docs]
    assert sum(r[1] > 0 for r in want) > 10
    got = op12_baier_runs(spark, SF_DIR)
    assert got.columns[:8] == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    assert by_id(got.drop("n_words").collect()) == by_id(want)


def test_odd_rows(spark, tmp_path):
    rng = random.Random(4)
    tail = " ".join(["x", "y", "z"] * 9_000)
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "a a a a a"), (5, "a a a a a a"), (None, "b  b\tb b\nb b b"),
        (6, tail), (6, tail), (7, " ".join(str(rng.randrange(3)) for _ in range(400))), (8, "é é " * 8), (None, None),
    ]
    rows += [(i, " ".join(rng.choice("ab") for _ in range(30))) for i in range(9, 60)]
    named = [(*r, "r", 3, "k") for r in rows]
    frame = spark.createDataFrame(named, "doc_id long, text string, runs string, n_words long, kept_text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = op12_baier_runs(spark, str(tmp_path)).drop("n_words")
    quick = [plain_row(*r) for r in rows if r[0] != 6]
    assert by_id(r for r in got.collect() if r["doc_id"] != 6) == by_id(quick)
    found = periodic_runs(frame).filter("doc_id = 6").collect()
    assert [[tuple(r) for r in row["runs"]] for row in found] == [[(0, 27_000, 3)]] * 2
    assert {row["kept_text"] for row in found} == {"x y z"}
    assert periodic_runs(frame.limit(0)).collect() == []
