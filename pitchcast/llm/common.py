"""Small helpers shared by the operators."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchcast.session import _SCRATCH, ensure_checkpoint_dir


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; pure ASCII values take the faster ``lower``."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase)))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (all columns of docs), ``id``, ``text`` (null: empty) and ``tag``.

    Everything the caller's table holds sits inside ``row``, so its column names
    cannot clash with those an operator adds. (id, tag) names a row by its id and
    text: rows that share an id but not the text stay apart, identical rows share
    their results.
    """
    text = F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))
    return (docs.select(F.struct("*").alias("row"))
            .select("row", F.col(f"row.`{id_col}`").alias("id"), text.alias("text"))
            .withColumn("tag", F.xxhash64("text")))


def same(left: DataFrame, right: DataFrame, *pairs: tuple[str, str]) -> Column:
    """Null-safe equality on pairs of column names."""
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


def unpack(df: DataFrame, columns: list[str], text_col: str | None = None, text: str | None = None) -> DataFrame:
    """The table's own columns again, in order; ``text_col`` taken from column ``text`` if given."""
    return df.select(*[(F.col(text) if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in columns])


def stored(df: DataFrame, name: str, block: int | None = None) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back: computed once, and a lost
    executor costs nothing that was done before. ``block``: bytes of a row group, all of which a task holds while it writes."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    (df.write.option("parquet.block.size", block) if block else df.write).parquet(path)
    _SCRATCH.append(path)   # release_materialized deletes it
    return spark.read.schema(df.schema).parquet(path)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, many: int = 1000) -> DataFrame:
    """``rows`` joined with the one row of ``groups`` that has their ``key``; ``size``: how many rows hold it, of ``total``.

    Groups of more than one in ``many`` of all rows are fewer than ``many``, so they are broadcast and their rows stay
    where they are; the rest meets by a shuffle in which no key has a larger share.
    """
    least = max(total // many, 1)
    held = [c for c in groups.columns if c != key]
    hot = groups.where(F.col(size) > least).select(F.col(key).alias("hot_key"), F.struct(*held).alias("hot"))
    near = rows.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left").drop("hot_key")
    met = near.where("hot is not null").select(*rows.columns, *[F.col(f"hot.{c}").alias(c) for c in held])
    rest = near.where("hot is null").drop("hot").join(groups.where(F.col(size) <= least), key)
    return met.unionByName(rest)
