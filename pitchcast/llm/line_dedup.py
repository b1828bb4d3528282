"""Line dedup: hash the normalised lines, count documents per hash, drop frequent lines, reassemble by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, join_groups, keyed, same, stored, unpack

BLANKS = " \t\n\x0b\f\r"   # [\x20\x09-\x0D]


def line_key(line: Column, min_chars: int) -> Column:
    """128-bit key of a line stripped at both ends and lower-cased (A-Z); null if it is too short to count."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.char_length(bare) >= min_chars, F.unhex(F.md5(ascii_lower(bare).cast("binary"))))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    r"""One row per row of ``docs``: ``row`` (its columns), ``kept`` text, ``n_lines``, ``n_dropped``.

    A line (split at \n; null or empty text is one empty line) whose key has at
    least ``min_chars`` code points and is found in at least ``min_docs`` rows is
    dropped everywhere but in the largest id that holds it, where all its lines
    stay. A null id is below every other id; rows that repeat an id each count
    as a document and keep or lose a line together. An empty table gives no rows.

    Only 16-byte keys and positions are shuffled to find the lines: keys are made
    distinct within their row, counts combine map-side (a line that a third of all
    documents hold is a few rows per task), and only keys over the threshold are
    joined back to their positions: those that hold more than a thousandth of all frequent lines, fewer than a thousand keys, by
    a broadcast, so a hot key's lines stay where they are. Texts move once, to meet their own positions.
    """
    base = keyed(docs, id_col, text_col)
    keys = F.transform(F.split("text", "\n", -1), lambda x: line_key(x, min_chars))
    frequent = stored(base.select("id", F.explode(F.array_distinct(keys)).alias("key")).where("key is not null")
                      .groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
                      .where(F.col("n") >= min_docs), "frequent")
    held = frequent.agg(F.sum("n")).first()[0] or 0
    lines = base.select("id", "tag", F.posexplode(keys).alias("pos", "key")).where("key is not null")
    drops = (join_groups(lines, frequent, "key", "n", held).where(~F.col("id").eqNullSafe(F.col("keeper")))
             .groupBy(F.col("id").alias("drop_id"), F.col("tag").alias("drop_tag"))
             .agg(F.collect_set("pos").alias("drops")))
    joined = (base.join(drops, same(base, drops, ("id", "drop_id"), ("tag", "drop_tag")), "left")
              .withColumn("lines", F.split("text", "\n", -1)))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    return joined.select("row",
                         F.when(F.col("drops").isNull(), F.col("text")).otherwise(kept).alias("kept"),
                         F.size("lines").cast("long").alias("n_lines"),
                         F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the kept text in place of the text."""
    return unpack(dedup_lines(docs, id_col, text_col, **options), docs.columns, text_col, "kept")


def query(spark, sf):
    from .common import table

    out = dedup_lines(table(spark, sf, "documents"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
with d as (select doc_id, coalesce(text, '') as t from documents),
l as (select doc_id, unnest(string_split(t, chr(10))) as line,
             generate_subscripts(string_split(t, chr(10)), 1) as pos from d),
k as (select doc_id, pos, line,
             translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
f as (select key, max(doc_id) as keeper from k where length(key) >= 40
      group by key having count(distinct doc_id) >= 5),
m as (select k.*, f.key is not null and k.doc_id <> f.keeper as gone from k left join f on k.key = f.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from m group by doc_id
"""
