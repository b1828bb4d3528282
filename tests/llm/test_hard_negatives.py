"""Hard negatives against scores of all pairs, and the certified end of a walk."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchcast.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, part int"   # names the operator uses inside


def plain(rows, positives=5, negatives=10):
    held = sorted({(i, label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) for i, v, label in rows
                   if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)},
                  key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))   # noqa: E731  (the shorter one filled with zeros)
    out = []
    for a, own, v in held:
        if a is None or a % 100:
            continue
        ranked = sorted(((-dot(v, w), b is None, b or 0, b, label) for b, label, w in held), key=lambda r: r[:3])
        for s, _, _, p, _ in [r for r in ranked if r[4] == own and r[3] != a][:positives]:
            fit = [r for r in ranked if r[4] != own and 30 * -s <= 100 * -r[0] <= 90 * -s][:negatives]
            out += [(a, p, k, n[3], -s, -n[0]) for k, n in enumerate(fit, 1)]
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(i, v, label, "x", "y", 0) for i, v, label in rows], SCHEMA).repartition(4)
    return sorted((tuple(r) for r in H.mine(H.quantised(df), F.col("id") % 100 == 0).collect()), key=repr)


def vectors(seed, n, width=8):
    r = np.random.default_rng(seed)
    return r, [(int(k), [float(x) for x in r.normal(size=width)], int(r.integers(0, 3))) for k in range(n)]


def test_mine(spark):
    r, rows = vectors(5, 350)
    same = rows[50][1]
    rows += [(400 + k, same, k % 2) for k in range(150)]                                  # a vector that a third of all rows hold
    rows += [(600, [0.0] * 8, 1), (601, [0.0] * 8, 0), (602, None, 1), (603, rows[3][1], None), (604, [float("nan")] + [0.5] * 7, 1),
             (605, [float("inf")] * 8, 1), (606, [None] + [0.5] * 7, 2), (607, [], 1), (608, [1.0, -2.0], 2), (None, same, 0), (None, rows[7][1], 1),
             (700, rows[9][1], 0), (700, rows[9][1], 0), (800, rows[11][1], 9)]           # repeated; a label of its own
    assert run(spark, rows) == plain(rows)


def test_blocks_parts_and_odd_tables(spark, monkeypatch):
    for name, value in {"PARTS": 2, "PART_ROWS": 40, "BLOCK_ROWS": 2, "STEP": 4, "MEMBERS": 2, "CLUSTERS": 3}.items():
        monkeypatch.setattr(H, name, value)
    _, rows = vectors(6, 320)
    rows = [(k * 25, v, label) for k, v, label in rows]        # every fourth row is an anchor
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == [] and run(spark, rows[:1]) == []


@pytest.mark.parametrize("wide", [False, True])
def test_a_walk_ends_once_it_is_certain(wide):
    r = np.random.default_rng(8)
    heads = r.normal(size=(20, 16)) * 100
    groups = np.repeat(np.arange(20), 200)
    rows = np.rint(heads[groups] + r.normal(size=(4000, 16)) * 8).astype(np.int64) * (2**20 if wide else 1)
    anchors = rows[groups == 4][:40]
    low, high = np.full((40, 1), -2**62), np.full((40, 1), 2**62)
    centre = H.centres(anchors.astype(float), 1)[0]
    *found, (_, made, _, _) = H.walks(anchors, rows, lambda a, c: np.ones((len(a), len(c)), bool), low, high, np.arange(4000), 10, centre)
    whole = anchors @ rows.T
    for i, _, got, score in found:
        want = np.lexsort((np.arange(4000), -whole[i]))[:10]
        assert got.tolist() == want.tolist() and score.tolist() == whole[i][want].tolist()
    assert len(found) == 40 and made < 40 * 4000 / 3
