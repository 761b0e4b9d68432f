"""The pipeline operators against SQL, brute force, round trips and held-out labels."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from oracle import SF_DIR, difference

import __spark_entry__ as contract
import corpus_pipeline
from tallystream.llm import decontaminate, jaccard, language, packing, quality, sharding, substrings, toxicity, urls
from tallystream.llm import vectors as nn
from tallystream.llm.automaton import SuffixAutomaton
from tallystream.llm.components import components
from tallystream.llm.words import grams, words
from tallystream.llm.workload import ORACLES, QUERIES

WORDS = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string"


def split(text):
    return WORDS.findall(text or "")


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def some_words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), ORACLES[name]) == {}


def test_registered():
    assert QUERIES.items() <= contract.queries().items()
    assert contract.queries()["pipeline"] is corpus_pipeline.run


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls, blanks, a long text, copies, repeated rows, and columns named like internal ones."""
    rng = random.Random(5)
    long = " ".join(some_words(rng, 30_000))
    passage = some_words(rng, 70)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (None, "one two"), (6, long), (7, long)]
    rows += [(8, "one two"), (8, "one two"), (None, None)]
    rows += [(i, " ".join(some_words(rng, rng.randrange(5, 90)) + passage[: rng.randrange(40, 71)])) for i in range(9, 60)]
    base = some_words(rng, 80)
    for i in range(60, 90):
        copy = list(base)
        for j in rng.sample(range(80), rng.randrange(0, 6)):
            copy[j] = "X"
        rows.append((i, " ".join(copy)))
    return frame(spark, [(*r, "d", i) for i, r in enumerate(rows)], DOCS + ", d string, g int"), rows


def test_words_agree_with_regex():
    texts = ["a b  c", "", None, " x\ty\x0bz ", "Hello wörld a\u00a0b", "\n", "a" * 5000 + " b"]
    numbers, rows = words(pa.array(texts))
    assert np.diff(rows).tolist() == [len(split(t)) for t in texts]
    seen = {}
    for word, number in zip([w for t in texts for w in split(t)], numbers, strict=True):
        assert seen.setdefault(word, number) == number
    assert len(set(seen.values())) == len(seen)
    values = np.random.default_rng(0).integers(0, 4, 300).astype(np.uint64)
    for n in (1, 3, 5, 26, 50):
        runs = {}
        for i, g in enumerate(grams(values, n)):
            assert runs.setdefault(tuple(values[i : i + n]), g) == g
        assert len(set(runs.values())) == len(runs)


def test_automaton_gives_matching_statistics():
    rng = random.Random(1)
    sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 40))] for _ in range(8)]
    automaton = SuffixAutomaton()
    for s in sequences:
        automaton.add(s)
    known = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for _ in range(20):
        query = [rng.randrange(4) for _ in range(60)]
        want = [max((n for n in range(1, i + 2) if tuple(query[i + 1 - n : i + 1]) in known), default=0) for i in range(60)]
        assert automaton.matches(query) == want


def removed_by_hand(rows, window):
    key = lambda d: math.inf if d is None else d
    first = {}
    for d, text in rows:
        w = split(text)
        for i in range(len(w) - window + 1):
            run = tuple(w[i : i + window])
            first[run] = min(first.get(run, math.inf), key(d))
    out = []
    for d, text in rows:
        w = split(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < key(d):
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [50, 7])
def test_substrings_against_brute_force(spark, odd_docs, window, monkeypatch):
    df, rows = odd_docs
    monkeypatch.setattr(substrings, "SHARD", 64)
    monkeypatch.setattr(substrings, "PER_COPY", 4)
    cut = substrings.cut_repeats(df, window)
    assert cut.columns == [*df.columns, "kept_text", "n_words", "n_removed"]
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in cut.collect()]
    assert sorted(got, key=str) == removed_by_hand(rows, window)
    assert sum(r[2] for r in got) > 1000


def components_by_hand(rows):
    fold = str.maketrans({c: c.lower() for c in map(chr, range(65, 91))})
    sets = []
    for _, text in rows:
        w = split((text or "").translate(fold))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = [math.inf if d is None else d for d, _ in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    links += [(i, j) for i in range(len(rows)) for j in range(i) if rows[i][0] == rows[j][0] and sets[i] and sets[j]]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    return sorted(
        ((d, len(s), None if x == math.inf else x) for (d, _), s, x in zip(rows, sets, label, strict=True)), key=str
    )


@pytest.mark.parametrize("common, limit", [(64, 1 << 20), (3, 1 << 20), (3, 5)])
def test_jaccard_against_brute_force(spark, odd_docs, common, limit, monkeypatch):
    df, rows = odd_docs
    monkeypatch.setattr(jaccard, "COMMON", common)
    monkeypatch.setattr(jaccard, "COMMON_LIMIT", limit)
    monkeypatch.setattr(jaccard, "MEMBERS", 4)
    monkeypatch.setattr(jaccard, "QUERIES_PER_COPY", 3)
    got = jaccard.join_near_duplicates(df).collect()
    assert sorted((tuple(r) for r in got), key=str) == components_by_hand(rows)
    kept = jaccard.keep_one_of_each(df)
    assert kept.columns == df.columns


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(rng.randrange(200, 260),) * 2]
    got = {r["node"]: r["component"] for r in components(frame(spark, links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}
    assert components(frame(spark, [], "a long, b long")).count() == 0


def test_packing_round_trip(spark, odd_docs):
    from tokenizers import Tokenizer

    df, rows = odd_docs
    path = packing.public_tokenizer()
    odd = [(1000, "it's A1b!! x's «quoted» naïve e\u0301t ΣΑΣ İx <|endoftext|> a<|startoftext|>b ǰ J\u030c ½ 日本語。")]
    got = packing.pack(df.select("doc_id", "text").union(frame(spark, odd)), path, window=64).collect()
    tokenizer = Tokenizer.from_file(path)
    want = sorted(
        (str(d), np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes())
        for d, t in rows + odd
    )
    got.sort(key=lambda r: (r["sequence_id"], r["offset"]))
    texts, last = [], {}
    at = 0
    for r in got:
        assert r["sequence_id"] * 64 + r["offset"] == at and len(r["ids"]) == 4 * r["length"] and r["offset"] + r["length"] <= 64
        at += r["length"]
        if r["start"] == 0:
            last = [str(r["doc_id"]), b"", r["doc_tokens"]]
            texts.append(last)
        assert len(last[1]) == 4 * r["start"] and r["boundary"] == (r["length"] < r["doc_tokens"])
        last[1] += r["ids"]
    assert all(len(t[1]) == 4 * t[2] for t in texts)
    assert sorted((t[0], t[1]) for t in texts) == want


def test_sharding(spark, odd_docs):
    df, rows = odd_docs
    got = sharding.shard(df, shards=4, bundles=64).collect()
    size = lambda t: len((t or "").encode()) + 1
    want = sorted((str(d), size(t), zlib.crc32((t or "").encode())) for d, t in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
    for s in range(4):
        own = [r["slot"] for r in got if r["shard"] == s]
        assert sorted(own) == list(range(len(own)))
    placed = sharding.place(np.random.default_rng(0).random((500, 3)), 7)
    sizes = np.random.default_rng(0).random((500, 3))
    sums = np.array([sizes[placed == s].sum(axis=0) for s in range(7)])
    assert (sums.max(axis=0) / sums.min(axis=0) < 1.1).all()


def test_sharding_cuts_a_hot_text(spark):
    rows = [(i, "same text") for i in range(600)] + [(i, f"text {i}") for i in range(600, 1200)]
    got = sharding.shard(frame(spark, rows), shards=4, bundles=64).groupBy("shard").count().collect()
    counts = [r["count"] for r in got]
    assert len(counts) == 4 and max(counts) - min(counts) < 40


def test_decontamination(spark):
    rng = random.Random(2)
    items = [(i, " ".join(some_words(rng, n, 5000))) for i, n in enumerate([9, 12, 20, 40, 40, 5, 60])]
    items += [(7, None), (8, "")]
    docs, want = [], set()
    for i in range(300):
        body = some_words(rng, rng.randrange(0, 200), 5000)
        if i % 3 == 0:
            k = rng.randrange(7)
            passage = items[k][1].split()
            if len(passage) >= 20:
                for j in range(rng.randrange(15), len(passage), 15):
                    passage[j] = "other"
            at = rng.randrange(len(body) + 1)
            body[at:at] = [w.upper() for w in passage]
            if k != 5:
                want.add((i, k))
        docs.append((i, " ".join(body)))
    docs += [(None, None), (301, "")]
    benchmark = frame(spark, items, "item_id long, text string")
    df = frame(spark, docs)
    got = {(r["d"], r["item_id"]) for r in decontaminate.overlaps(df, benchmark).collect()}
    assert got == want
    left = decontaminate.drop_contaminated(df, benchmark)
    assert left.count() == len(docs) - len({d for d, _ in want})
    assert decontaminate.overlaps(df, benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("size", [200, 1_000, 20_000])
def test_sharding_keeps_copies_together(spark, size):
    rng = random.Random(size)
    rows, i = [], 0
    while i < size:
        copies = rng.choice([1, 1, 2, 3]) if i > size / 50 else size // 100
        text = " ".join(f"{w:4}" for w in rng.sample(range(1000, 10_000), 12))
        rows += [(j, text) for j in range(i, i + copies)]
        i += copies
    got = sharding.shard(frame(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in got) == [d for d, _ in rows]
    shards = {}
    for r in got:
        shards.setdefault(r["group_key"], set()).add(r["shard"])
    assert len(shards) > size / 4 and all(len(s) == 1 for s in shards.values())
    if size >= 1_000:  # 12 rows are too few for a shard to be even
        sums = [sum(r["size"] for r in got if r["shard"] == s) for s in range(sharding.SHARDS)]
        assert max(sums) < 1.05 * min(sums)


@pytest.mark.parametrize("doc_id", [None, 7])
def test_sharding_cuts_equal_rows(spark, doc_id, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_SLOT_RANGE", 20)
    rows = [(doc_id, "same old text")] * 1_000 + [(i, f"text number {i}") for i in range(1_000, 3_000)]
    got = sharding.shard(frame(spark, rows)).collect()
    assert sorted(map(str, (r["doc_id"] for r in got))) == sorted(str(d) for d, _ in rows)
    shards = [[r for r in got if r["shard"] == s] for s in range(sharding.SHARDS)]
    assert all(sorted(r["slot"] for r in own) == list(range(len(own))) for own in shards)
    sums = [sum(r["size"] for r in own) for own in shards]
    assert max(sums) < 1.1 * min(sums)


def fits(masks, n, others):
    """Whether a mask fits somewhere into ``n`` words without looking at one of ``others``."""
    return any(not {s + at for at in m} & others for m in masks for s in range(n - m[-1]))


def test_masks_meet_every_promised_overlap():
    # A longer overlap has a half of 13 words or more with as large a share of equal words.
    for n in range(12, 26):
        for others in itertools.combinations(range(n), n // 5):
            assert fits(decontaminate.MASKS, n, set(others)), (n, others)


    for low, high, masks in decontaminate.SHORT_MASKS:
        for n in range(low, high + 1):
            for others in itertools.combinations(range(n), n // 5):
                assert fits(masks, n, set(others)), (n, others)


def test_short_items(spark, caplog):
    items = [(n, " ".join(f"i{n}w{i}" for i in range(n))) for n in range(1, 12)] + [(12, None)]
    docs, want = [], set()
    for n, text in items[:11]:
        for others in [(), *itertools.combinations(range(n), 1), *itertools.combinations(range(n), 2)]:
            body = ["other" if i in others else w for i, w in enumerate(text.split())]
            docs.append((len(docs), " ".join(["a", "b", *body, "c"])))
            if n >= 6 and 5 * len(others) <= n:
                want.add((len(docs) - 1, n))
    benchmark = frame(spark, items, "item_id long, text string")
    got = decontaminate.overlaps(frame(spark, docs), benchmark).collect()
    assert {(r["d"], r["item_id"]) for r in got} == want
    assert all(r["n_words"] == r["item_id"] and (r["doc_start"], r["item_start"]) == (2, 0) for r in got)
    assert sorted(r["item_id"] for r in decontaminate.not_looked_for(benchmark).collect()) == [1, 2, 3, 4, 5, 12]
    assert "6 test items of fewer than 6 words are not looked for" in caplog.text


@pytest.mark.parametrize("n", range(12, 21))
def test_overlaps_with_other_words_at_every_place(n):
    """All overlaps that the rule names are found, and no others, however the other words lie."""
    rng = random.Random(n)
    item = [f"w{i}" for i in range(n)]
    index = decontaminate.SeedIndex([0], [" ".join(item)])
    places = [set(c) for k in range(3) for c in itertools.combinations(range(n), k)]
    places += [set(rng.sample(range(n), rng.randrange(3, 8))) for _ in range(300)]
    least = min(13, n)
    for others in places:
        text = " ".join(["before"] * 3 + ["other" if i in others else w for i, w in enumerate(item)] + ["behind"] * 3)
        numbers, rows = words(pa.array([text]), lower=True)
        hits = index.hits(numbers, np.zeros(len(numbers), int)).tolist()
        got = [index.verify(numbers, rows[0], rows[1], i, begin) for _, i, begin in hits]
        good = [
            (b - a, a)
            for a in range(n) for b in range(a + least, n + 1)
            if 5 * len(others & set(range(a, b))) <= b - a
        ]
        if not good:
            assert got in ([], [None]), others
            continue
        ((start, item_start, size, equal),) = got
        assert start == item_start + 3 and size >= least and 5 * equal >= 4 * size
        assert equal == sum(i not in others for i in range(item_start, item_start + size))
        # The longest one, but for other words at its ends.
        ends = max(good)[0] - size
        assert any(set(range(a, item_start)) | set(range(item_start + size, a + size + ends)) <= others
                   for length, a in good if length == size + ends and a <= item_start <= a + ends)


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 24)).astype(np.float32)
    x[50:150] = x[50]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    rows += [(400, None), (401, []), (402, [0.0] * 24), (403, [math.nan] * 24), (404, [None] + [1.0] * 23), (None, [1.0] * 24)]
    df = frame(spark, rows, "id long, vector array<float>")
    got = {}
    for r in nn.nearest(df, df.filter("id % 20 = 0"), k=7).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    y = x.astype(np.float64)
    assert sorted(got) == list(range(0, 400, 20))
    for q, found in got.items():
        scores = nn.exact(y, y[q])
        order = [i for i in np.lexsort((np.arange(400), -scores)) if i != q][:7]
        assert found == [(i, scores[i]) for i in order]
    assert nn.nearest(df.limit(0), df.limit(0)).count() == 0


def test_url_rules(spark):
    rows = [
        (1, "http://A.Example.NET/en/x?y#z"), (2, "https://example.net/de/"), (3, "x://example.com/de/1"),
        (4, "http://notexample.com/de/1"), (5, "http://a.org/fr/"), (6, "http://a.org/fr"), (7, None), (8, "no scheme/net/"),
        (9, "http://x.net"), (10, "http://b.example.com/de/?q://c.net/"), (11, ""), (11, ""), (12, "http://x.com#a.net/"),
    ]
    rows += [(100 + i, f"http://h{i}.{'net' if i % 2 else 'org'}/{'fr' if i % 2 == 0 else 'a'}/{i}") for i in range(60)]
    got = {r["id"]: r for r in urls.judge(frame(spark, rows, "id long, url string")).collect()}
    assert len(got) == len(rows) - 1
    rule = {1: "example.net/en/", 2: "net/", 3: "example.com/de/", 5: "org/fr/", 10: "example.com/de/"}
    assert {i: r["rule"] for i, r in got.items() if i < 100 and r["rule"]} == rule
    verdict = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    assert all(r["verdict"] == verdict.get(r["rule"], r["verdict"]) and r["verdict"] in ("allow", "block") for r in got.values())
    assert (got[1]["host"], got[1]["path"]) == ("a.example.net", "/en/x")
    assert (got[8]["host"], got[8]["path"], got[7]["host"], got[9]["path"], got[12]["path"]) == ("", "", "", "", "")
    plan = urls.judge(frame(spark, rows, "id long, url string"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert urls.judge(frame(spark, [(1, None)], "id long, url string")).first()["verdict"] == "allow"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    got = language.op9_language_naive_bayes(spark, SF_DIR).join(docs, "doc_id").filter("held_out").collect()
    assert got and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)
    model = language.fit(frame(spark, [(1, "abc abd", "x"), (2, "öüä ß", "y")], DOCS + ", lang string"))
    odd = frame(spark, [(1, None, True), (2, "12 !", True), (3, "", True), (4, "abab", True)], DOCS + ", held_out boolean")
    out = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(odd, model).collect()}
    assert [out[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3 and out[4][0] == "x" and 0.5 < out[4][1] <= 1
    none = language.predict(odd, language.fit(frame(spark, [], DOCS + ", lang string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}


def test_rare_language_is_learned(spark):
    rows = [(i, "abc abd" if i % 2 else "cde dce", "xy"[i % 2]) for i in range(10_000)]
    rows += [(i, "öüä ßöü", "z") for i in range(10_000, 10_003)]
    names, table = language.fit(frame(spark, rows, DOCS + ", lang string"), rows=500)
    assert names == ["x", "y", "z"]
    odd = frame(spark, [(1, "öü", True), (2, "abd", True), (3, "dce", True)], DOCS + ", held_out boolean")
    out = {r["doc_id"]: r["lang_pred"] for r in language.predict(odd, (names, table)).collect()}
    assert out == {1: "z", 2: "y", 3: "x"}


def test_quota_of_languages():
    assert language.quota([], 10) == 0 and language.quota([3, 4], 10) == 4
    assert language.quota([5000, 10, 1000], 900) == 445
    for sizes in ([1, 2, 3, 4, 5], [7, 7, 7], [1, 100, 100], [30]):
        for rows in range(len(sizes), 220):
            each = language.quota(sizes, rows)
            taken = sum(min(n, each) for n in sizes)
            assert taken <= rows and (taken == sum(sizes) or taken > rows - len(sizes))


def test_quality_held_out(spark):
    sf = SF_DIR.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.op7_pu_quality(spark, sf).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in got)
    assert right >= 0.9 * len(got) and all(0 <= r["score"] <= 1 for r in got)
    odd = frame(spark, [(1, None, "a"), (2, "", "b"), (None, "x " * 5000, None)], DOCS + ", quality_score_of string")
    assert quality.score(odd, None).count() == 3
    model = quality.fit_on_learned_fold(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    out = {r["quality_score_of"]: r["quality_score"] for r in quality.score(odd, model).collect()}
    assert out["a"] == out["b"]


def test_toxicity_held_out(spark):
    sf = SF_DIR.replace("sf0.001", "sf0.1")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels.filter("doc_id % 4 <> 0"))
    assert (np.diff(model.thresholds) > 0).all()
    got = toxicity.score(docs, model).join(labels.filter("doc_id % 4 = 0"), "doc_id").collect()
    bad, good = ([r["grade"] >= 1 for r in got if r["toxic"] == t] for t in (1, 0))
    # A tenth of the rows labelled toxic hold none of the words that the others have.
    assert sum(bad) >= 0.85 * len(bad) and sum(good) <= 0.01 * len(good)
    odd = frame(spark, [(1, None), (2, ""), (None, "12")])
    assert {r["grade"] for r in toxicity.score(odd, model).collect()} == {0}
    assert toxicity.fit(docs, labels.limit(0)) is None
    assert toxicity.score(odd, None).filter("grade = 0 AND expected_severity = 0").count() == 3


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.columns == docs.columns
        if name == "near_duplicates":
            rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
            want = {c for _, _, c in components_by_hand(rows)}
            assert {r["doc_id"] for r in after.collect()} == want
        if name == "substrings":
            rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
            cut = {d: (n, kept) for d, _, n, kept in removed_by_hand(rows, 50)}
            for r in after.collect():
                n, kept = cut[r["doc_id"]]
                assert r["text"] == (kept if n else dict(rows)[r["doc_id"]])
        docs = corpus_pipeline.store(after, f"test-{name}")
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.collect()}


@pytest.mark.parametrize("operator", [substrings.cut_repeats, jaccard.join_near_duplicates, jaccard.keep_one_of_each,
                                      sharding.shard, lambda d: packing.pack(d, packing.public_tokenizer())])
def test_empty_tables(spark, operator):
    assert operator(frame(spark, [])).count() == 0


def test_digest_of_kept_text(spark):
    row = substrings.op1_substring_dedup(spark, SF_DIR).orderBy("doc_id").first()
    text = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").first()["text"]
    assert row["kept_sha256"] == hashlib.sha256(" ".join(split(text)).encode()).hexdigest()


def test_words_outlive_the_memory(monkeypatch):
    """Texts in many parts, with a memory that is renewed all the time, as the tokenizer has them."""
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    encoder = packing.WordEncoder(packing.public_tokenizer(), packing.END_ID)
    texts = ["the quick, brown fox", "the fox! x1y2", None, "", "quick (fox) café the", "fox, the brown"] * 3
    for text in texts:
        ids, sizes = encoder.encode(pa.array([text], pa.string()))
        expected = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids
        got = np.frombuffer(ids[0].as_py(), "<u4").tolist()
        assert got == [*expected, packing.END_ID] and sizes.tolist() == [len(got)]
    assert "the" in encoder.seen and len(encoder.seen) + len(encoder.older) < 20
