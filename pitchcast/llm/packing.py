"""Packing: each document's tokens are cut by the binary digits of their number, so that pieces of equal length share
a bucket and no sequence crosses documents or needs padding."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

MAX_LENGTH = 2048
END_ID = 1


def tokenizer(ranks_path: str, json_path: str, added_tokens: bool = False):
    """text -> ids. The ranks file holds the same vocabulary as the JSON file and encodes several times faster;
    a text that it refuses (a run too long for its pattern) goes to the JSON file's tokenizer, and so does, with
    ``added_tokens``, one that holds a token that the JSON file adds to the vocabulary; without, such a token is
    text like any other. Kept per worker."""
    import base64
    import json
    import sys

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    kept = sys.__dict__.setdefault("_packing_tokenizers", {})   # outlives the task in a reused worker
    if (ranks_path, json_path, added_tokens) not in kept:
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        slow, added = [], []
        if added_tokens:
            with open(json_path, encoding="utf-8") as f:
                added = [t["content"] for t in json.load(f)["added_tokens"]]

        def encode_whole(text: str) -> np.ndarray:
            if not slow:
                slow.append(Tokenizer.from_file(json_path))
                slow[0].encode_special_tokens = not added_tokens
            return np.array(slow[0].encode(text, add_special_tokens=False).ids, dtype=np.uint32)

        def encode(text: str) -> np.ndarray:
            if any(t in text for t in added):
                return encode_whole(text)
            try:
                return fast.encode_to_numpy(text, disallowed_special=())
            except BaseException as e:   # the library's panics are no Exception
                if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
                return encode_whole(text)

        kept[ranks_path, json_path, added_tokens] = encode
    return kept[ranks_path, json_path, added_tokens]


def pieces_of(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: as many of ``longest`` (a power of two) as fit, then the binary
    digits of the rest, largest first."""
    out = [(s, longest) for s in range(0, n - n % longest, longest)]
    start, bit = n - n % longest, longest >> 1
    while bit:
        if n & bit:
            out.append((start, bit))
            start += bit
        bit >>= 1
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = MAX_LENGTH,
         end_id: int = END_ID, ranks_path: str | None = None, json_path: str | None = None,
         with_ids: bool = True, added_tokens: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, bucket (log2 of the length), sequence_id,
    offset and, unless told otherwise, ``ids``.

    A document is its text's ids and then ``end_id``; a null or empty text is that id
    alone. With ``added_tokens``, tokens that the JSON file adds (<|endoftext|>) have their own id, as its tokenizer
    gives it by default; without, they are text. Every piece is a sequence of its own with a power of two of ids, at most
    ``longest``, so nothing is padded. Rows that repeat an id are packed each on its own; an empty table
    gives no rows. The work is one pass over the documents without a shuffle;
    ``sequence_id`` follows from the partition and the place in it.
    """
    import public_tokenizers

    ranks = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    full = json_path or public_tokenizers.path("byte_bpe_50k.json")
    kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<int>" * with_ids

    def cut(batches):
        encode = tokenizer(ranks, full, added_tokens)
        for batch in batches:
            took, start, length, crc, total, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                text = text.as_py()
                tokens = np.append(encode(text).astype("<u4") if text else np.empty(0, "<u4"), np.uint32(end_id)).astype("<u4")
                for s, n in pieces_of(len(tokens), longest):
                    took.append(row)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(tokens[s:s + n].tobytes()))
                    total.append(len(tokens))
                    if with_ids:
                        ids.append(tokens[s:s + n].astype(np.int32))
            columns = [batch.column(0).take(pa.array(took, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    out = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(cut, schema)
    return (out.withColumn("bucket", F.log2("length").cast("int"))
            .withColumn("sequence_id", F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder per length, from which a trainer draws batches of equal length."""
    pieces.write.partitionBy("bucket").parquet(path)


def query(spark, sf):
    return pack(table(spark, sf, "documents"), with_ids=False, added_tokens=True)


SQL = None
