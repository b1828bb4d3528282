"""Fuzzy team equality as an equi-join (no nested loop over name pairs).

Two canonical names match when they are equal or one contains the other
(``'' in x`` is true, so an empty name matches every name).  Instead of testing
every (prediction name, fixture name) pair, each name is exploded into its
substrings of length 1..K; a contained name of length <= K is then found by an
exact equi-join on the substring, and a longer one by joining its first K
characters to the K-grams of the container and verifying with ``instr``.  Work
is linear in the number of distinct names (times K), never quadratic, and the
result is exact.  Names are compared within one competition, which is the
scope of a candidate fixture list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 16


def _substrings(names: DataFrame, name: str, k: int) -> DataFrame:
    """(competition, name, sub) for every distinct non-empty substring of length <= k."""
    n = F.char_length(F.col(name))
    subs = F.array_distinct(F.flatten(F.transform(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: F.transform(F.sequence(F.lit(1), F.greatest(F.least(F.lit(k), n - i + 1), F.lit(1))),
                              lambda m: F.substring(F.col(name), i, m)))))
    return names.where(n > 0).select("competition", name, F.explode(subs).alias("sub"))


def contained_pairs(inner: DataFrame, outer: DataFrame, k: int = K) -> DataFrame:
    """(competition, inner_name, outer_name) where inner_name is in outer_name.

    ``inner``/``outer``: (competition, name) with distinct names.  The empty
    name is contained in every name; it is paired through a join on the
    competition rather than through an empty substring, which would put every
    name of the competition behind one join key.
    """
    subs = _substrings(outer.withColumnRenamed("name", "outer_name"), "outer_name", k)
    probe = inner.where(F.char_length("name") > 0).select(
        "competition", F.col("name").alias("inner_name"),
        F.when(F.char_length("name") <= k, F.col("name"))
         .otherwise(F.substring("name", 1, k)).alias("sub"))
    found = (probe.join(subs, ["competition", "sub"])
             .where((F.char_length("inner_name") <= k) | (F.instr("outer_name", F.col("inner_name")) > 0))
             .select("competition", "inner_name", "outer_name"))
    empty = inner.where(F.col("name") == "").select("competition").distinct()
    everywhere = (outer.where(F.col("name").isNotNull()).join(empty, "competition")
                  .select("competition", F.lit("").alias("inner_name"), F.col("name").alias("outer_name")))
    return found.unionByName(everywhere)


def name_map(pred_names: DataFrame, fixture_names: DataFrame, k: int = K) -> DataFrame:
    """(competition, pred_name, fix_name) for every matching pair of canonical names."""
    p = pred_names.select("competition", "name").distinct()
    x = fixture_names.select("competition", "name").distinct()
    p_in_x = contained_pairs(p, x, k).select(
        "competition", F.col("inner_name").alias("pred_name"), F.col("outer_name").alias("fix_name"))
    x_in_p = contained_pairs(x, p, k).select(
        "competition", F.col("outer_name").alias("pred_name"), F.col("inner_name").alias("fix_name"))
    return p_in_x.unionByName(x_in_p).distinct()
