"""Repeated byte strings: periodic texts, small pieces, and mark tables that are not made, against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from pitchcast.llm import suffix_dedup
from pitchcast.llm.rolling import portions


def brute(raw, width=200):
    seen = {}
    for t in raw:
        for p in range(len(t) - width + 1):
            seen[t[p:p + width]] = seen.get(t[p:p + width], 0) + 1
    out = []
    for t in raw:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - width + 1):
            if seen[t[p:p + width]] > 1:
                gone[p:p + width] = True
        out.append(bytes(np.frombuffer(t, np.uint8)[~gone]))
    return out


def cases():
    r = random.Random(2)
    noise = lambda n: "".join(r.choice("abcdefgh é") for _ in range(n))
    word = noise(37)
    rows = [noise(50) + "ab" * 900 + noise(50), noise(30) + "ba" * 100 + "x",           # a run; in another text, a string of it stands once
            noise(20) + "ab" * 100, "q" * 199, "z" * 200, "y" * 201, noise(300),
            (word * 30)[5:] + noise(40), noise(10) + (word * 9)[11:215], (word * 6)[:220],     # a longer period, and pieces of it
            "abc" * 70 + noise(8) + "abc" * 70, "cab" * 67, noise(90) + "m" * 230 + noise(90), "é" * 150, "é" * 100 + "k",
            "ab" * 120 + "ac" * 120 + "ab" * 120, "", None, (noise(99) * 4)[:350], "uv" * 101, "vu" * 100]
    return rows


@pytest.mark.parametrize("piece, marks", [(1 << 18, 1 << 28), (300, 1 << 28), (1 << 18, 0)])
def test_periodic_texts(spark, monkeypatch, piece, marks):
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    monkeypatch.setattr(suffix_dedup._mark_table, "__defaults__", (marks,))
    rows = cases()
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.remove_repeats(df).select("row.doc_id", "kept").collect()}
    want = brute([(t or "").encode() for t in rows])
    assert [k for k in got if got[k] != want[k]] == []


def test_a_periodic_text_has_few_samples():
    text = b"ab" * 500_000
    found = list(suffix_dedup.samples([text], 200))
    assert sum(len(f[3]) for f in found) < 300          # some fifty at the end of each piece, not half a million
    start, end = (np.concatenate([f[8][k] for f in found]) for k in (1, 2))
    covered = np.zeros(len(text) + 1, int)
    np.add.at(covered, start, 1)
    np.add.at(covered, end, -1)
    assert (np.cumsum(covered)[:-1] > 0).mean() > 0.999          # the samples kept stand for the ends of the pieces


def test_portions_hold_about_a_limit():
    texts = ["x" * n for n in (10, 0, 30, 500, 1, 1, 99, 100)] + [None]
    cut = list(portions(pa.array(texts), 100))
    assert [t for s, n in cut for t in texts[s:s + n]] == texts and cut[0] == (0, 4) and all(n for _, n in cut)
    assert list(portions(pa.array([], pa.string()))) == []
