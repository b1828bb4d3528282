"""Multiplicities and lines without blanks in fingerprints."""

from pyspark.sql import functions as F

from pitchcast.llm import fingerprints


def prints(spark, *texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    return fingerprints.with_fingerprint(df, "t", "fp")


def like(spark, a, b):
    df = prints(spark, a, b)
    two = df.where("k = 0").select(F.col("fp").alias("a")).crossJoin(df.where("k = 1").select(F.col("fp").alias("b")))
    return two.select(fingerprints.likeness(F.col("a"), F.col("b")).alias("like"), (fingerprints.as_text(F.col("a")) == fingerprints.as_text(F.col("b"))).alias("equal"),
                      fingerprints.subtract(F.col("a"), F.col("b"))["n"].alias("n")).first()


def test_lines_repeated_many_times(spark):
    for n in (16384, 32767, 32768, 70000):
        r = like(spark, "x\n" * n, "y\n" * n)
        assert not r["equal"] and r["like"] < 0.5
        assert max(prints(spark, "x\n" * n).first()["fp"]["v"]) == n
    assert like(spark, "x\n" * 12000, "x\n" * 4384)["like"] < 0.7
    assert like(spark, "x\n" * 50000 + "a\nb", "b\na\n" + "x\n" * 50000)["like"] == 1.0


def test_runs_without_blanks(spark):
    line = "".join(chr(0x4E00 + (k * k * 7 + 13 * k) % 5000) for k in range(3000))
    assert 0.9 < like(spark, line, line[:-40] + "\u3042" * 40)["like"] < 1.0
    words = "some words of usual length " * 3
    pieces = spark.createDataFrame([(words + "\n" + line[:70],)], "t string").select(fingerprints.pieces(F.col("t"))).first()[0]
    assert "".join(pieces) == (words + line[:70]) and [len(p) for p in pieces[-3:]] == [32, 32, 6]
