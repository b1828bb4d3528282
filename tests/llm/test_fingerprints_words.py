"""Fingerprints against a multiset of paragraphs: equality, insertion, deletion and likeness."""

import hashlib
import random
import struct
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from pitchcast.llm import fingerprints as P

MOD = 1 << 64


def words(paragraphs):
    """The four sums, by whole numbers: Spark's hash of (number, digest in hexadecimal form) is xxHash64 of the digest seeded by that of the number."""
    digests = [hashlib.sha256(p.encode()).hexdigest() for p in paragraphs]
    seeds = [xxhash.xxh64_intdigest(struct.pack("<i", k), seed=42) for k in range(4)]
    return [sum(xxhash.xxh64_intdigest(d, seed=s) for d in digests) % MOD for s in seeds]


def joined(halves):
    return [(halves[2 * k] << 32) | halves[2 * k + 1] for k in range(4)]


def texts():
    r = random.Random(9)
    lines = [" ".join(r.choices([f"w{k}é" for k in range(40)], k=r.randrange(1, 8))) for _ in range(60)]
    out = ["\n".join(r.choices(lines, k=r.randrange(1, 50))) for _ in range(25)]
    return lines, out + ["\n".join(reversed(out[0].split("\n"))), "", "\n\n", "x\n" * 5000, "ÿ" * 100]


def frame(spark, rows):
    return P.with_fingerprint(spark.createDataFrame(list(enumerate(rows)), "k int, t string").withColumn("p", P.pieces(F.col("t"))), "t", "fp")


def test_words_are_sums_of_digests_modulo_two_to_the_64(spark):
    _, rows = texts()
    got = frame(spark, rows).collect()
    assert [joined(r["fp"]["w"]) for r in got] == [words(r["p"]) for r in got]
    assert all(0 <= h < 1 << 32 for r in got for h in r["fp"]["w"])
    for a in got:
        for b in got:
            assert (a["fp"]["w"] == b["fp"]["w"]) == (Counter(a["p"]) == Counter(b["p"]))


def test_insertion_and_deletion(spark):
    lines, rows = texts()
    pairs = [(f"{a}\n{b}", b, a) for a, b in zip(rows[:12], rows[1:13])]
    df = spark.createDataFrame(pairs, "whole string, part string, rest string")
    for c in df.columns:
        df = P.with_fingerprint(df, c, f"{c}_fp")
    out = df.select((P.subtract(F.col("whole_fp"), F.col("part_fp"))["w"] == F.col("rest_fp.w")).alias("less"),
                    (P.add(F.col("rest_fp"), F.col("part_fp"))["w"] == F.col("whole_fp.w")).alias("more"),
                    (P.subtract(F.col("part_fp"), F.col("whole_fp"))["w"] == F.col("rest_fp.w")).alias("wrong")).collect()
    assert all(r["less"] and r["more"] and not r["wrong"] for r in out)


def test_likeness_estimates_the_shared_part(spark):
    r = random.Random(3)
    base = [f"line {k} {r.random()}" for k in range(200)]
    rows = []
    for share in (0, 40, 100, 160, 190, 200):
        rows.append(("\n".join(base), "\n".join(base[:share] + [f"other {k} {r.random()}" for k in range(200 - share)])))
    df = P.with_fingerprint(P.with_fingerprint(spark.createDataFrame(rows, "a string, b string").withColumn("pa", P.pieces(F.col("a"))).withColumn("pb", P.pieces(F.col("b"))), "a", "fa"), "b", "fb")
    for got in df.select("pa", "pb", P.likeness(F.col("fa"), F.col("fb")).alias("like")).collect():
        a, b = Counter(got["pa"]), Counter(got["pb"])
        apart = sum((a[x] - b[x]) ** 2 for x in a.keys() | b.keys())
        want = 1 - apart / (sum(v * v for v in a.values()) + sum(v * v for v in b.values()))
        assert abs(got["like"] - want) < 0.2
