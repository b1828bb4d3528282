"""Exact dedup against a dictionary of the normalised texts, at any size of the filter."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pitchcast.llm import exact_dedup
from pitchcast.llm.common import join_groups

SCHEMA = "doc_id long, text string, row int, hash string, maybe string, digest string"   # names the operator uses inside


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y", "z") for i, t in rows], SCHEMA)


def plain(rows):
    """(id, keep id, size, digest) of each row, and how often a row with that id and size is kept."""
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        out.append((i, min(groups[key])[3], len(groups[key]), hashlib.sha256(key.encode()).hexdigest()))
    return out, groups


def cases():
    r = random.Random(3)
    rows = [(k, " ".join(f"w{r.randrange(9)}é" for _ in range(r.randrange(1, 5)))) for k in range(300)]
    rows += [(1000 + k, "the same  text" if k % 2 else "thesame\ttext") for k in range(200)]          # a group of a third of all rows
    return rows + [(2000, None), (2001, ""), (2002, " \t\n\x0b\f\r "), (2003, "A b"), (2004, "a b"), (2005, "x y"), (2006, "xy"),
                   (2007, "long " * 20000), (2008, "long" * 20000), (2009, "tie"), (2009, "tie"), (None, "none"), (None, "none"), (7, "none")]


@pytest.mark.parametrize("max_bits", [exact_dedup.MAX_BITS, exact_dedup.BITS_A_ROW * 200])
def test_find_duplicates(spark, max_bits):
    rows = cases()
    got = exact_dedup.find_duplicates(frame(spark, rows).repartition(5), max_bits=max_bits).collect()
    want, groups = plain(rows)
    assert sorted(((r["id"], r["keep_id"], r["group_size"], r["digest"].hex()) for r in got), key=repr) == sorted(want, key=repr)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) == len({bytes(r["digest"]) for r in kept}) and all(r["id"] == r["keep_id"] for r in kept)


def test_drop_duplicates(spark):
    rows = cases()
    docs = frame(spark, rows)
    out = exact_dedup.drop_duplicates(docs)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    _, groups = plain(rows)
    best = {min(g)[3] for g in groups.values()}
    assert len(got) == len(groups) and {i for i, _ in got} == best
    assert exact_dedup.drop_duplicates(frame(spark, [])).count() == 0 and exact_dedup.find_duplicates(frame(spark, [])).count() == 0


def test_filter_marks_every_repeated_hash_and_few_others(spark):
    hashes = spark.range(20000).select(F.xxhash64("id").alias("hash")).union(spark.range(300).select(F.xxhash64(F.col("id") % 150).alias("hash")))
    bits = 1 << 19
    plane = exact_dedup.repeated_filter(hashes.repartition(7), bits)
    import numpy as np
    slots = exact_dedup._slots(np.array([r["hash"] for r in hashes.collect()], np.int64), bits)
    maybe = ((plane[slots >> 3] >> (slots & 7)) & 1).all(axis=0)
    assert maybe[:150].all() and maybe[20000:].all() and maybe[150:20000].mean() < 0.03


def test_only_rows_that_may_be_repeated_shuffle(spark, tmp_path):
    docs = frame(spark, [(k, f"text number {k}") for k in range(500)] + [(900, "text number 1")])
    docs.write.parquet(str(tmp_path / "d"))
    out = exact_dedup.drop_duplicates(spark.read.parquet(str(tmp_path / "d")))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 1 and out.count() == 500
    straight = plan[plan.rindex("Project"):]
    assert "Aggregate" not in straight and "Join" not in straight


def test_join_groups_splits_off_the_hot_keys(spark):
    rows = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then -1 else id end as k")
    groups = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    got = join_groups(rows, groups, "k", "n", 3000)
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in rows.join(groups, "k").select("id", "k", "n", "top").collect())
