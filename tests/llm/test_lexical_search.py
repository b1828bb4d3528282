"""Ranked search against scores of every document, and the limit on accumulators."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pitchcast.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, n int, terms string, no string, score string"   # names the operator uses inside


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def plain(docs, items, k):
    held = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    n = [sum(c.values()) for _, c in held]
    many, total = sum(x > 0 for x in n), sum(n)
    out = []
    for item, text in items:
        terms = set(TERM.findall(lower(text)))
        df = {t: sum(t in c for _, c in held) for t in terms}
        scores = []
        for (i, c), size in zip(held, n):
            m = 50 + (50 * size * many) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def corpus():
    r = random.Random(11)
    def text(words):
        return " ".join(f"w{int(r.paretovariate(.7))}" for _ in range(words))
    docs = [(k, text(r.randrange(1, 60))) for k in range(400)] + [(500 + k, "w1 w2, W3! É2é the same") for k in range(150)]
    docs += [(900, None), (901, ""), (902, " .,- "), (903, "w1 " * 30000 + "rare"), (904, "W1_w2[w3]"), (905, "tie É"), (905, "tie É"), (None, "tie É"), (None, "É é")]
    items = [(k, text(12)) for k in range(12)] + [(20, "w1 w1 w2 W3"), (21, "rare w1 w1 w2"), (22, None), (23, ""), (24, "nowhere"), (25, "É Tie"), (25, "É Tie"), (None, "w3")]
    return docs, items


def run(spark, docs, items, k=50):
    d = spark.createDataFrame([(i, t, 1, "x", "y", "z") for i, t in docs], SCHEMA).repartition(3)
    q = spark.createDataFrame([(i, t, 1.0) for i, t in items], "item_id long, text string, score double")
    return sorted((tuple(r) for r in L.search(d, q, k=k).collect()), key=repr)


def test_search(spark):
    docs, items = corpus()
    assert run(spark, docs, items) == plain(docs, items, 50)
    assert run(spark, docs, items, k=3) == plain(docs, items, 3)
    assert run(spark, [], items) == [] and run(spark, docs, []) == []


def test_search_in_small_slices_and_groups_of_queries(spark, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(L, "SLICE_DOCS", 64)
    monkeypatch.setattr(L, "QUERY_BYTES", 300)
    monkeypatch.setattr(L, "PIECE", 50)
    assert run(spark, docs, items, k=5) == plain(docs, items, 5)


@pytest.mark.parametrize("seed", range(20))
def test_fewer_accumulators_same_scores(seed):
    r = np.random.default_rng(seed)
    size, k = 2000, 10
    lists = {t: (np.sort(r.choice(size, n, replace=False)), r.integers(1, w, n)) for t, (n, w) in enumerate([(5, 9000), (40, 4000), (40, 4000), (1500, 300), (2000, 40)])}
    whole = np.zeros(size, np.int64)
    for places, more in lists.values():
        whole[places] += more
    top, score, made = L.best_of_slice(size, lists, [0, 1, 2, 3, 4], k, 0)
    want = np.lexsort((np.arange(size), -whole))[:k]
    assert top.tolist() == want.tolist() and score.tolist() == whole[want].tolist()
    assert made < 100          # the two long lists only update documents that a rarer term has met
    again, _, fewer = L.best_of_slice(size, lists, [0, 1, 2, 3, 4], k, int(score[-1]))
    assert again.tolist() == want.tolist() and fewer <= made


def test_terms():
    t = "Ab-c_d É x 中文 1a"
    assert [w.decode() for words in L.terms_of(t.encode()) for w in words] == TERM.findall(lower(t))
