"""Fingerprints cut and hash a text once, and sum their lanes block by block."""

import struct

import xxhash
from pyspark.sql import functions as F

from pitchcast.llm import fingerprints as P


def test_a_text_is_cut_and_hashed_once(spark):
    plan = P.with_fingerprint(spark.createDataFrame([("a b",)], "t string"), "t", "fp")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1
    assert plan.count("sha2(") == 1
    assert plan.count("xxhash64(") == 2 + P.WORDS      # two for the lanes, one a word


def lanes(paragraphs):
    """Bit s + t of a hash for each s in 0..14 and t in 0, 15, 30, 45, for both hashes of a paragraph."""
    second = xxhash.xxh64_intdigest(struct.pack("<i", 1), seed=42)
    out = []
    for seed in (42, second):
        hashes = [xxhash.xxh64_intdigest(p.encode(), seed=seed) for p in paragraphs]
        out += [sum(h >> (s + t) & 1 for h in hashes) for s in range(15) for t in (0, 15, 30, 45)]
    return out


def test_lanes_count_bits_across_blocks(spark):
    texts = ["\n".join(f"line {k}" for k in range(n)) for n in (0, 1, 126, 127, 128, 254, 255, 300)] + ["same\n" * 127, "same\n" * 128, "same\n" * 1000]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").withColumn("p", P.pieces(F.col("t")))
    for r in P.with_fingerprint(df, "t", "fp").collect():
        assert list(r["fp"]["v"]) == lanes(r["p"]), (r["k"], len(r["p"]))
        assert r["fp"]["n"] == len(r["p"])
