"""Placement, url features and the three classifiers against plain definitions of the same."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from tallystream.llm import language, quality, sharding, toxicity, urls

DOCS = "doc_id long, text string"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# Sharding


def placed_by_hand(sizes, shards):
    totals = [max(1, sum(column)) for column in zip(*sizes, strict=True)]
    share = [[x / t for x, t in zip(row, totals, strict=True)] for row in sizes]
    room = [[1 / shards] * len(totals) for _ in range(shards)]
    out = [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-max(share[i]), i)):
        fit = [sum(r * s for r, s in zip(one, share[i], strict=True)) for one in room]
        out[i] = fit.index(max(fit))
        room[out[i]] = [r - s for r, s in zip(room[out[i]], share[i], strict=True)]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_placement_rule(seed):
    rng = random.Random(seed)
    # Powers of two: sums and products are exact, so that ties are ties in either order.
    sizes = [[2.0 ** rng.randrange(6) for _ in range(3)] for _ in range(60)]
    for column in range(3):  # totals that are powers of two too
        sizes[0][column] += 4096 - sum(row[column] for row in sizes)
    got = sharding.place(np.array(sizes), 8)
    assert got.tolist() == placed_by_hand(sizes, 8)


def test_placement_of_ties_and_of_what_is_too_large():
    assert sharding.place(np.ones((4, 3)), 4).tolist() == [0, 1, 2, 3]
    huge = np.array([[90.0, 90.0, 1.0], [1.0, 1.0, 1.0], [1.0, 1.0, 1.0]])
    assert sharding.place(huge, 2).tolist() == placed_by_hand(huge.tolist(), 2)
    assert sharding.place(np.zeros((0, 3)), 4).tolist() == []


def test_a_text_larger_than_a_shard(spark):
    rows = [(0, "x " * 50_000)] + [(i, f"text {i}") for i in range(1, 80)] + [(None, None)] * 3
    got = sharding.shard(frame(spark, rows, DOCS), 4).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    large = next(r["shard"] for r in got if r["doc_id"] == 0)
    assert sum(r["size"] for r in got if r["shard"] == large and r["doc_id"] != 0) <= 1_000
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


# Url filters


def url_parts(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not found:
        return "", ""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in found[1]), found[2]


def entropy(text):
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def lexical_by_hand(url):
    url = url or ""
    host, path = url_parts(url)
    query = re.search(r"\?([^#]*)", url)
    size = max(1, len(url))
    return {
        "length": len(url), "host_length": len(host), "path_length": len(path),
        "depth": sum(part != "" for part in path.split("/")[1:]),
        "host_labels": sum(part != "" for part in host.split(".")),
        "digit_ratio": sum(c in "0123456789" for c in url) / size,
        "hyphens": sum(c in "-_" for c in url), "entropy": entropy(url), "host_entropy": entropy(host),
        "parameters": sum(part != "" for part in query[1].split("&")) if query else 0,
        "fragment": url.count("#"), "secure": url.startswith("https:"),
        "dated": len(re.findall("/(?:19|20)[0-9]{2}/", path)),
        "extension": bool(re.search(r"\.[A-Za-z0-9]{1,5}$", path)),
    }


def rule_by_hand(host, path):
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return (best.host + best.path, best.verdict) if best else (None, None)


def some_urls():
    hosts = ["example.net", "a.b.example.net", "Example.COM", "x.org", "org", "net", "xnet", "h-1.example.com", ""]
    paths = ["", "/", "/en/", "/de/2021/x.html", "/fr/a/b//c", "/EN/?q=1&r=&&s", "/fr/#top", "?a://b.net/de/", "/é/\n.pdf"]
    return [f"{s}://{h}{p}" for s, h, p in product(("http", "https"), hosts, paths)] + [None, "", "no/scheme", "https:", "a" * 50_000 + "://x.net/1"]


def test_features_and_rules_of_urls(spark):
    given = list(enumerate(some_urls()))
    rows = urls.described(frame(spark, given, "id long, url string")).collect()
    assert len(rows) == len(given)
    for r in rows:
        url = given[r["id"]][1]
        host, path = url_parts(url)
        assert (r["host"], r["path"], r["rule"], r["rule_verdict"]) == (host, path, *rule_by_hand(host, path)), url
        labels = host.split(".")
        head = re.match("/([^/]*)/", path)
        assert (r["suffix_1"], r["suffix_2"], r["head"]) == (labels[-1], ".".join(labels[-2:]), head[1] if head else "")
        for name, want in lexical_by_hand(url).items():
            assert r[name] == pytest.approx(float(want), abs=1e-9), (name, url)


def test_statistics_of_suffixes(spark):
    rows = urls.described(frame(spark, list(enumerate(some_urls())), "id long, url string"))
    labelled = rows.filter("rule IS NOT NULL").selectExpr("*", "double(rule_verdict = 'block') AS label")
    known = labelled.collect()
    overall = sum(r["label"] for r in known) / len(known)
    for name in ("suffix_1", "suffix_2", "head"):
        seen = defaultdict(list)
        for r in known:
            seen[r[name]].append(r["label"])
        for r in urls.with_suffix_statistics(rows, labelled).select(name, f"{name}_share").distinct().collect():
            got = seen[r[name]]
            want = (sum(got) + urls.SMOOTHING * overall) / (len(got) + urls.SMOOTHING)
            assert r[f"{name}_share"] == pytest.approx(want), (name, r[name])


def test_no_urls(spark):
    assert urls.judge(frame(spark, [], "id long, url string")).collect() == []


# Classifiers: the same number of Adam steps, with the gradient taken by differences


def adam(theta, slope, steps, rate, least):
    m, v = np.zeros(len(theta)), np.zeros(len(theta))
    for step in range(1, steps + 1):
        g = slope(theta)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + least)
    return theta


def by_differences(f, theta, h=1e-5):
    one = np.eye(len(theta)) * h
    return np.array([(f(theta + e) - f(theta - e)) / (2 * h) for e in one])


@pytest.mark.parametrize("prior", [0.02, 0.3, 0.95])
def test_risk_of_positives_and_unlabelled(monkeypatch, prior):
    """Where the second term falls below 0 on the way, steps go the other way."""
    steps, bins = 40, 3
    monkeypatch.setattr(quality, "STEPS", steps)
    monkeypatch.setattr(quality, "BINS", bins)
    rng = np.random.default_rng(5)
    positive, unlabelled = rng.normal(1, 1, (40, 2)), rng.normal(0, 1, (60, 2))
    model = quality.learn(positive, unlabelled, prior)

    def raw(theta, x):
        bin_of = [(x[:, i, None] >= model.edges[i]).sum(axis=1) for i in range(2)]
        return theta[-1] + theta[bin_of[0]] + theta[bins + bin_of[1]]

    loss = lambda f, y: np.log1p(np.exp(-f if y else f)).mean()
    below = []

    def slope(theta):
        second = lambda t: loss(raw(t, unlabelled), 0) - prior * loss(raw(t, positive), 0)
        whole = lambda t: prior * loss(raw(t, positive), 1) + second(t)
        below.append(second(theta) < 0)
        g = by_differences(whole, theta) if not below[-1] else -by_differences(second, theta)
        return g + quality.PENALTY * np.append(theta[:-1], 0)

    theta = adam(np.zeros(2 * bins + 1), slope, steps, quality.RATE, 1e-8)
    assert np.append(model.weights.ravel(), model.bias) == pytest.approx(theta, abs=1e-3)
    assert any(below) == (prior > 0.1)


def test_likelihood_of_ordered_thresholds(monkeypatch):
    steps = 30
    monkeypatch.setattr(toxicity, "STEPS", steps)
    rng = np.random.default_rng(6)
    toxic = (rng.random(80) < 0.4).astype(np.int64)
    x = rng.integers(0, 4, (80, 3)) * (0.3 + toxic[:, None])
    row, feature = np.nonzero(x)
    model = toxicity.learn(row, feature, x[row, feature], toxic, np.array([5, 9, 11]))
    amount = np.log1p(x)
    grade = toxicity.grades(toxic, amount.sum(axis=1))
    assert (grade[toxic == 0] == 0).all() and set(grade[toxic == 1]) == {1, 2, 3}

    def unpack(theta):
        first, gaps = theta[3], np.exp(theta[4:])
        return theta[:3], np.array([first, first + gaps[0], first + gaps[0] + gaps[1]])

    def risk(theta):
        weights, thresholds = unpack(theta)
        total = 0.0
        for features, k in zip(amount, grade, strict=True):
            above = [1.0, *(1 / (1 + math.exp(t - float(features @ weights))) for t in thresholds), 0.0]
            total -= math.log(above[k] - above[k + 1])
        return (total + toxicity.PENALTY / 2 * float(weights @ weights)) / len(grade)

    start = np.array([0.0, 0, 0, 1.0, 0, 0])
    theta = adam(start, lambda t: by_differences(risk, t), steps, toxicity.RATE, 1e-9)
    weights, thresholds = unpack(theta)
    assert model.weights == pytest.approx(weights, abs=1e-4) and model.thresholds == pytest.approx(thresholds, abs=1e-4)
    assert (np.diff(model.thresholds) > 0).all()


def grams_of(text):
    low = text.lower()
    return Counter(low[i : i + n] for n in language.LENGTHS for i in range(len(low) - n + 1))


def test_naive_bayes_by_hand(spark):
    rng = random.Random(7)
    letters = {"x": "abcd ", "y": "cdefé ", "z": "жзи ab"}
    rows = [(i, "".join(rng.choice(letters[name]) for _ in range(30)), name) for i, name in enumerate("xyz" * 8)]
    rows += [rows[0], (None, "abc", None), (99, None, "x"), (98, "", "y")]
    names, table = language.fit(frame(spark, rows, DOCS + ", lang string"))
    counts = {name: Counter() for name in "xyz"}
    for _, text, name in rows:
        if name:
            counts[name].update(grams_of(text or ""))
    # Two n-grams of a bucket count as one; the bucket of an n-gram is asked from the operator.
    bucket = {g: int(list(language.buckets(pa.array([g])))[len(g) - 1][0][0]) for c in counts.values() for g in c}
    test = ["".join(rng.choice("abcdeéжзи ") for _ in range(20)) for _ in range(12)] + ["ABCD", "ab" * 20_000]
    bucket |= {g: int(list(language.buckets(pa.array([g])))[len(g) - 1][0][0]) for t in test for g in grams_of(t)}
    log = {}
    for name, c in counts.items():
        sums = Counter()
        for g, n in c.items():
            sums[bucket[g]] += n
        whole = sum(c.values()) + language.SMOOTHING * language.BUCKETS
        log[name] = lambda b, sums=sums, whole=whole: math.log((sums[b] + language.SMOOTHING) / whole)
    assert names == ["x", "y", "z"]
    given = [(i, t, True) for i, t in enumerate(test)]
    for r in language.predict(frame(spark, given, DOCS + ", held_out boolean"), (names, table)).collect():
        total = {n: sum(k * log[n](bucket[g]) for g, k in grams_of(test[r["doc_id"]]).items()) for n in names}
        best = max(names, key=total.get)
        assert r["lang_pred"] == best
        assert r["score"] == pytest.approx(1 / sum(math.exp(v - total[best]) for v in total.values()), rel=1e-6)
