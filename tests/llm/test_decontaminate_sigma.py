"""Words that are equal but for A-Z are found whatever stands around them."""

import pytest
from pyspark.sql import functions as F

from pitchcast.llm import decontaminate

PASSAGE = "Ο ΛΟΓΟΣ ΕΙΝΑΙ ΑΡΧΗ ΚΑΙ ΤΕΛΟΣ ΤΗΣ ΓΝΩΣΗΣ ΟΠΩΣ ΛΕΝΕ"


@pytest.mark.parametrize("mark", ["'", ".", ":", "-", ", "])
def test_capital_final_sigma(spark, mark):
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {PASSAGE.replace(' ', mark)} y"), (2, PASSAGE.lower())], "doc_id long, text string")
    out = {r["row"]["doc_id"]: r for r in decontaminate.find_leaks(docs, bench).collect()}
    assert (len(out[1]["hit_words"]), out[1]["items"]) == (10, ["1"]) and not out[2]["hits"]
    assert [r["doc_id"] for r in decontaminate.drop_leaked(docs, bench).collect()] == [2]


def test_lower_looks_at_nothing_else(spark):
    """Every other letter is hashed alike as a word of its own, at the end of a word and beside marks."""
    points = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and chr(c).lower() != chr(c)]
    df = spark.createDataFrame([(c,) for c in points], "c string")
    for shape in ("{} x", "{}'x", "{}.{}", "A:{}"):
        text, n = shape.replace("{}", "%s"), shape.count("{}")
        alone = decontaminate._word_hashes(F.col("c"))[0]
        assert df.where(~F.array_contains(decontaminate._word_hashes(F.format_string(text, *["c"] * n)), alone)).count() == 0
