"""The query's and the pipeline's ids are those of the JSON file's tokenizer as it comes."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from pitchcast.llm import packing

TEXTS = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "no token <|endoftext |>", "x" * 3000 + "<|endoftext|>", None, ""]


def test_added_tokens(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {i: full.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(TEXTS)}
    assert expected[0] == [64, 220, 50256, 275, 1]
    for r in packing.query(spark, str(tmp_path)).collect():
        part = expected[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert (r["doc_tokens"], r["ids_crc32"]) == (len(expected[r["doc_id"]]), zlib.crc32(np.array(part, "<u4").tobytes()))
    got = {}
    for r in sorted(corpus_pipeline.packing(spark, docs, "").collect(), key=lambda r: (r["doc_id"], r["start"])):
        got.setdefault(r["doc_id"], []).extend(r["ids"])
    assert got == expected
