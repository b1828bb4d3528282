"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, scanned for in every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, keyed, same, stored, table, unpack

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WIDTH = 10
#: Window hashes are broadcast up to this number (16 bytes each, so below 64 MB once hashed);
#: a larger benchmark is joined by a shuffle on the same hashes.
MAX_BROADCAST_WINDOWS = 2_000_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _word_hashes(text: Column) -> Column:
    """A hash per word of the text lower-cased by ``lower``, which costs far less than A-Z alone. It parts words alike and
    makes equal what A-Z alone makes equal, so windows that match are never lost; what it adds is verified away. Only of
    a capital sigma does ``lower`` look at the surroundings (a final one becomes another letter): it is put in lower case before."""
    return F.transform(F.regexp_extract_all(F.lower(F.replace(text, F.lit("\u03a3"), F.lit("\u03c3"))), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def _hashed(words: str, width: int) -> Column:
    """(width, pos, hash) of each window of ``width`` words; none if there are fewer words."""
    at = F.when(F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - (width - 1))).otherwise(
        F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(F.lit(width).alias("width"), i.alias("pos"),
                                              F.xxhash64(F.slice(words, i, width)).alias("hash")))


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                      width: int = WIDTH) -> DataFrame:
    """(width, hash, window, items): each distinct window with the ids of the items that hold it.

    An item of fewer words than ``width``, but not none, is one window. Items without
    words have no window; those with a null id are searched for but not listed.
    """
    items = (keyed(benchmark, item_col, text_col)
             .select(F.col("id").cast("string").alias("item"), words_of(F.col("text")).alias("words"), _word_hashes(F.col("text")).alias("hashes"))
             .where(F.size("words") > 0).withColumn("width", F.least(F.lit(width), F.size("words"))))
    at = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)).alias("pos")
    cut = items.select("item", "width", "words", "hashes", at)
    return (cut.select("item", "width", F.expr("xxhash64(slice(hashes, pos, width))").alias("hash"),
                       F.expr("array_join(slice(words, pos, width), ' ')").alias("window"))
            .groupBy("width", "hash", "window").agg(F.collect_set("item").alias("items")))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: ``row``, ``n_words``, ``hits`` (pos, width), ``hit_words`` (1-based positions,
    distinct), ``items`` (sorted ids of the items found).

    The benchmark becomes a set of window hashes. Documents are scanned once: each
    window's hash meets the broadcast set without a shuffle, so a passage in a third
    of all documents is no hot key, and only what meets leaves the scan. Documents with a meeting are
    verified word for word. A null text has no words; an empty benchmark finds
    nothing; rows that repeat an id are told apart by their text.
    """
    base = keyed(docs, id_col, text_col)
    windows = benchmark_windows(benchmark, item_col, item_text_col, width)
    counts = {r["width"]: r["n"] for r in windows.groupBy("width").agg(F.count("*").alias("n")).collect()}  # <= width rows
    wanted = windows.select(F.col("hash").alias("wanted"), F.col("width").alias("wanted_width")).distinct()
    if sum(counts.values()) <= MAX_BROADCAST_WINDOWS:
        wanted = F.broadcast(wanted)
    # a row of width 0 carries the number of words of every document past the join
    number = F.array(F.struct(F.lit(0).alias("width"), F.size("hashes").alias("pos"), F.lit(0).cast("long").alias("hash")))
    scan = (base.select("id", "tag", _word_hashes(F.col("text")).alias("hashes"))
            .select("id", "tag", F.inline(F.concat(number, *(_hashed("hashes", w) for w in sorted(counts))))))
    met = (scan.join(wanted, (F.col("hash") == F.col("wanted")) & (F.col("width") == F.col("wanted_width")), "left")
           .where("width = 0 or wanted is not null")
           .groupBy("id", "tag").agg(F.max(F.when(F.col("width") == 0, F.col("pos"))).alias("n_words"),
                                     F.collect_set(F.when(F.col("width") > 0, F.struct("width", "pos", "hash"))).alias("met")))
    met = stored(met.withColumnsRenamed({"id": "m_id", "tag": "m_tag"}), "met")   # read twice, a row per document
    some = met.where(F.size("met") > 0)
    words = (base.join(some, same(base, some, ("id", "m_id"), ("tag", "m_tag")))
             .select("id", "tag", words_of(F.col("text")).alias("words"), "met").dropDuplicates(["id", "tag"]))
    real = (words.select("id", "tag", "words", F.inline("met"))
            .select("id", "tag", "width", "pos", "hash", F.array_join(F.slice("words", F.col("pos"), F.col("width")), " ").alias("window"))
            .join(windows, ["width", "hash", "window"])
            .groupBy(F.col("id").alias("r_id"), F.col("tag").alias("r_tag"))
            .agg(F.collect_set(F.struct("pos", "width")).alias("hits"), F.collect_set("items").alias("items")))
    rows = base.join(met, same(base, met, ("id", "m_id"), ("tag", "m_tag"))).select("row", "id", "tag", "n_words")
    out = rows.join(real, same(rows, real, ("id", "r_id"), ("tag", "r_tag")), "left")
    hits = F.coalesce("hits", F.array().cast("array<struct<pos:int,width:int>>"))
    spans = F.transform(hits, lambda h: F.sequence(h["pos"], h["pos"] + h["width"] - 1))
    return out.select("row", "n_words", hits.alias("hits"), F.array_distinct(F.flatten(spans)).alias("hit_words"),
                      F.array_sort(F.array_distinct(F.flatten(F.coalesce("items", F.array().cast("array<array<string>>"))))).alias("items"))


def drop_leaked(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window."""
    return unpack(find_leaks(docs, benchmark, **options).where(F.size("hits") == 0), docs.columns)


def query(spark, sf):
    out = find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return out.select("row.doc_id", F.col("n_words").cast("long").alias("n_words"),
                      F.size("hit_words").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.size("hit_words") > 0).alias("contaminated"))


SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bl as (select item_id, w, least(10, len(w)) as k from b where len(w) > 0),
bw as (select distinct item_id, k, array_to_string(w[i:i+k-1], ' ') as win
       from (select item_id, w, k, unnest(range(1, len(w) - k + 2)) as i from bl)),
ks as (select distinct k from bw),
dw as (select doc_id, k, i, array_to_string(w[i:i+k-1], ' ') as win
       from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from d, ks where len(w) >= k)),
h as (select doc_id, i, dw.k as k, item_id from dw join bw on dw.win = bw.win and dw.k = bw.k),
hit as (select doc_id, count(distinct p) as n_hit
        from (select doc_id, unnest(range(i, i + k)) as p from (select distinct doc_id, i, k from h)) group by doc_id),
it as (select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as items
       from (select distinct doc_id, cast(item_id as varchar) as s from h) group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit on d.doc_id = hit.doc_id left join it on d.doc_id = it.doc_id
"""
