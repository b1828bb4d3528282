"""Document fingerprints: a homomorphic multiset hash, the sum of wide vectors hashed from paragraphs.

Equality rests on four words of 64 bits: a paragraph adds four words made from its SHA-256 digest, each sum modulo 2^64.
Likeness rests on 120 lanes beside them: a paragraph adds 0 or 1 to each, as the bits of two 64-bit
hashes of it say; each lane is a long of its own, so that no number of paragraphs
that a text can have is lost. Sums do not depend on the order, ``add`` and
``subtract`` insert and delete paragraphs without the rest of the text, and lane by
lane 2*ones - paragraphs is a random projection with signs +1 and -1, so that
differences of two sums tell how much of two documents is not shared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keyed, same, stored, table

LANES = 120
BITS = [s + t for s in range(15) for t in (0, 15, 30, 45)]   # of a hash, in the order of its lanes
WIDTH = 7                                     # bits of a lane while a block is summed, nine lanes in a long
ONES = sum(1 << s for s in range(0, 63, WIDTH))
BLOCK = (1 << WIDTH) - 1                      # paragraphs, so that lanes of WIDTH bits hold their sums
PIECE_WORDS = 8
LONG_RUN = 32                                 # code points
WORDS = 4                                     # of 64 bits; kept as their high and low halves, as sums must not overflow
HALF = (1 << 32) - 1


def pieces(text: Column, words: int = PIECE_WORDS) -> Column:
    """Paragraphs are lines; a long one counts as pieces of ``words`` words, so that an edit within it leaves the
    rest, and a run without blanks (scripts that write none, encoded bytes) as pieces of LONG_RUN code points. Blank lines
    are no paragraphs."""
    cut = F.regexp_extract_all(text, F.lit(r"[^\S\n]*(?:\S{%d}[^\S\n]*|(?:\S{1,%d}(?!\S)[^\S\n]*){1,%d})" % (LONG_RUN, LONG_RUN - 1, words)), F.lit(0))
    return F.filter(cut, lambda p: p != "")


def _once(value: Column, use) -> Column:
    """``use(value)``, in which ``value`` is computed once, however often ``use`` names it: what stands inside a lambda
    function or beside one is otherwise computed again at each mention."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hashes(text: Column) -> Column:
    return _once(pieces(text), lambda p: F.struct(
        F.transform(p, lambda x: F.xxhash64(x)).alias("a"),
        F.transform(p, lambda x: F.xxhash64(F.lit(1), x)).alias("b"),
        F.transform(p, lambda x: F.sha2(x.cast("binary"), 256)).alias("d"),
        F.char_length(text).cast("long").alias("chars")))


def _packed(hashes: Column) -> Column:
    """WIDTH longs of 9 lanes: the sums over at most BLOCK hashes."""
    return F.transform(F.sequence(F.lit(0), F.lit(WIDTH - 1)), lambda s: F.aggregate(
        hashes, F.lit(0).cast("long"), lambda acc, h: acc + F.call_function("shiftrightunsigned", h, s).bitwiseAND(F.lit(ONES))))


def _lanes(packed: Column) -> Column:
    return _once(packed, lambda x: F.array(*(F.shiftright(F.get(x, F.lit(b % WIDTH)), b - b % WIDTH).bitwiseAND(F.lit(BLOCK)) for b in BITS)))


def _sum(hashes: str) -> Column:
    """60 longs: each lane's sum over all hashes, block by block."""
    h = F.col(hashes)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(h) - 1) / BLOCK).cast("int")), lambda k: _lanes(_packed(F.slice(h, k * BLOCK + 1, F.lit(BLOCK)))))
    several = F.aggregate(blocks, F.array_repeat(F.lit(0).cast("long"), len(BITS)), lambda acc, v: F.zip_with(acc, v, lambda x, y: x + y))
    return F.when(F.size(h) <= BLOCK, _lanes(_packed(h))).otherwise(several)


def _carried(halves: Column) -> Column:
    """High and low halves of words modulo 2^64, from sums (or differences) of halves."""
    def words(sums):
        def word(k):
            high, low = F.get(sums, 2 * k), F.get(sums, 2 * k + 1)
            return F.array((high + F.shiftright(low, 32)).bitwiseAND(F.lit(HALF)), low.bitwiseAND(F.lit(HALF)))

        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), word))

    return _once(halves, words)


def _words(digests: Column) -> Column:
    """The sums of the digests' words modulo 2^64. A word is a 64-bit hash of the whole digest, seeded by its number: reading
    the digest's own words out of its hexadecimal form takes ten times the time of all else."""
    def total(hashes, cut):
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda acc, h: acc + cut(h))

    def halves(k):
        return _once(F.transform(digests, lambda x: F.xxhash64(F.lit(k), x)), lambda hashes: F.array(
            total(hashes, lambda h: F.call_function("shiftrightunsigned", h, F.lit(32))), total(hashes, lambda h: h.bitwiseAND(F.lit(HALF)))))

    return _carried(F.flatten(F.array(*(halves(k) for k in range(WORDS)))))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with column ``name``: struct(w: 4 words in halves, v: 120 lanes, n: paragraphs, chars)."""
    h = f"{name}_h"
    hashed = df.select("*", F.explode(F.array(_hashes(F.col(text)))).alias(h))   # hashed once, summed by lane
    value = F.struct(_words(F.col(f"{h}.d")).alias("w"), F.concat(_sum(f"{h}.a"), _sum(f"{h}.b")).alias("v"),
                     F.size(f"{h}.a").cast("long").alias("n"), F.col(f"{h}.chars").alias("chars"))
    return hashed.withColumn(name, value).drop(h)


def add(a: Column, b: Column) -> Column:
    """The fingerprint of both texts' paragraphs together."""
    return F.struct(_carried(F.zip_with(a["w"], b["w"], lambda x, y: x + y)).alias("w"),
                    F.zip_with(a["v"], b["v"], lambda x, y: x + y).alias("v"),
                    (a["n"] + b["n"]).alias("n"), (a["chars"] + b["chars"]).alias("chars"))


def subtract(a: Column, b: Column) -> Column:
    """The fingerprint of a's paragraphs without b's."""
    return F.struct(_carried(F.zip_with(a["w"], b["w"], lambda x, y: x - y)).alias("w"),
                    F.zip_with(a["v"], b["v"], lambda x, y: x - y).alias("v"),
                    (a["n"] - b["n"]).alias("n"), (a["chars"] - b["chars"]).alias("chars"))


def as_text(fp: Column) -> Column:
    return F.concat_ws(":", F.array_join(F.transform(fp["w"], lambda x: F.lpad(F.hex(x), 8, "0")), ""), F.array_join(F.transform(fp["v"], lambda x: F.hex(x)), "."),
                       F.hex(fp["n"]), F.hex(fp["chars"]))


def _energy(v: Column, n: Column) -> Column:
    """Sum over the lanes of the squared projection 2*ones - n."""
    def square(x):
        lane = (F.lit(2) * x - n).cast("double")
        return lane * lane

    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + square(x))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: one less the estimated part of both multisets that is not shared; 1 for equal fingerprints."""
    d = subtract(a, b)
    whole = _energy(a["v"], a["n"]) + _energy(b["v"], b["n"])
    apart = _energy(d["v"], d["n"])
    return F.when(whole == 0, (apart == 0).cast("double")).otherwise(
        F.greatest(F.lit(0.0), F.lit(1.0) - apart / whole))


def successors(base: DataFrame) -> DataFrame:
    """(id, tag, chars) with next_id, next_tag, and prev_id, prev_tag, prev_chars, in descending order of id (null
    last; ties by tag), the first after the last.

    Ids are dealt by range, so windows are within a partition; only the first and last of each partition, as many
    rows as there are partitions, are put in line across them.
    """
    ids = base.select("id", "tag", F.char_length("text").cast("long").alias("chars")).distinct()
    order = [F.desc_nulls_last("id"), F.desc("tag")]
    # the partition's number is stored with the rows: every later use sees the same one
    dealt = stored(ids.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "successors")
    me = F.struct("id", "tag", "chars")
    within = Window.partitionBy("part").orderBy(*order)
    rows = dealt.select("*", F.lead(me).over(within).alias("nx"), F.lag(me).over(within).alias("pv"))
    rank = F.struct(F.col("id").isNotNull().alias("some"), F.col("id"), F.col("tag"))
    ends = dealt.groupBy("part").agg(F.max_by(me, rank).alias("first"), F.min_by(me, rank).alias("last"))
    line = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    step = Window.partitionBy(F.lit(0)).orderBy("part")   # as many rows as partitions
    ends = ends.select(F.col("part").alias("end_part"),
                       F.coalesce(F.lead("first").over(step), F.first("first").over(line)).alias("after"),
                       F.coalesce(F.lag("last").over(step), F.last("last").over(line)).alias("before"))
    joined = rows.join(ends, F.col("part") == F.col("end_part"))
    nx, pv = F.coalesce("nx", "after"), F.coalesce("pv", "before")
    return joined.select("id", "tag", "chars", nx["id"].alias("next_id"), nx["tag"].alias("next_tag"),
                         pv["id"].alias("prev_id"), pv["tag"].alias("prev_tag"), pv["chars"].alias("prev_chars"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_chars, edited (text), fp, edited_fp, near_edited, near_next.

    The edited text has its last floor(n/2) code points replaced by the first as many (or all) of the next document.
    Rows that agree in id and text are one document in the line of documents. A null text is empty. Texts are
    shuffled once to meet their neighbours' names; from there the heads that the neighbours need travel once.
    """
    base = keyed(docs, id_col, text_col).select("id", "tag", "text")
    links = stored(successors(base).withColumnsRenamed({"id": "l_id", "tag": "l_tag"}), "links")
    d = base.join(links, same(base, links, ("id", "l_id"), ("tag", "l_tag")))
    heads = with_fingerprint(d.select("prev_id", "prev_tag", "prev_chars", "text"), "text", "next_fp")
    heads = (heads.select("prev_id", "prev_tag", F.struct(F.expr("left(text, cast(prev_chars div 2 as int))").alias("head"),
                                                          "next_fp").alias("give"))
             .groupBy("prev_id", "prev_tag").agg(F.first("give").alias("give")))
    mine = d.select("id", "tag", "text", "chars")
    both = mine.join(heads, same(mine, heads, ("id", "prev_id"), ("tag", "prev_tag")))
    both = both.withColumn("edited", F.concat(F.expr("left(text, cast(chars - chars div 2 as int))"), F.col("give.head")))
    both = with_fingerprint(with_fingerprint(both, "text", "fp"), "edited", "edited_fp")
    return both.select("id", F.col("chars").alias("n_chars"), "edited", "fp", "edited_fp",
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("give.next_fp")).alias("near_next"))


def query(spark, sf):
    out = fingerprint_edits(table(spark, sf, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                      as_text(F.col("fp")).alias("fingerprint"), as_text(F.col("edited_fp")).alias("edited_fingerprint"),
                      "near_edited", "near_next")


SQL = None
