"""The corpus pipeline: toxicity, line dedup, near duplicates, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as the next
one's docs. All but the last return the columns of documents. Each stage works on all rows and whole texts of its
input: rows with nulls in any column stay unless a text decides otherwise, rows that repeat an id are judged each by its
text, an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitchcast.llm.common import stored, table
from pitchcast.llm.decontaminate import drop_leaked
from pitchcast.llm.jaccard_join import one_of_each
from pitchcast.llm.line_dedup import drop_repeated_lines
from pitchcast.llm.packing import pack
from pitchcast.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds toxic go.

    Null and empty texts score like a text without words and stay, as does everything where ``labels`` confirms no toxic
    document. A score equal to the threshold goes. Very long texts are scored whole.
    """
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in many documents stay in one of them.

    That is the one with the largest id; rows that repeat it all keep the line, and a null id is below every other. A null text
    becomes one empty line.
    """
    return drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share four fifths of their five-word shingles, one stays: the smallest id of those that links join.

    Texts without words, null or empty, all stay. Rows that repeat the id that stays stay with it; a row with a null id
    stays unless a row with an id has the same shingles. Ids are whole numbers.
    """
    return one_of_each(docs, words=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go.

    A null or empty text holds none; an empty benchmark, or items without words, drop nothing.
    """
    return drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences to train on, with their ids: a row per piece.

    A null or empty text is the end token alone; rows that repeat an id are packed each on its own; an empty table gives no rows.
    """
    return pack(docs, added_tokens=True)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None
