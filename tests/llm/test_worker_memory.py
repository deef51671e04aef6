"""What a Python worker holds: slices of Spark's batches, and no words of tasks that are over."""

import pytest
from pyspark.sql import functions as F

from footfall.llm import common, dart_minhash, encoding, packing, words
from footfall.llm.queries import tokenizer_file

TEXT = "one two three four five six seven"


def steps_of(monkeypatch, module, call) -> tuple:
    """The step and the number of rows that a call gives to map_columns."""
    given = []
    monkeypatch.setattr(module, "map_columns", lambda df, step, schema, rows=None: given.append((step, rows)) or df)
    call()
    return given[0]


def test_steps_get_slices_of_a_batch(spark):
    def sizes(batches):
        for batch in batches:
            yield {"n": [len(batch["id"])], "total": [sum(batch["id"])]}

    found = common.map_columns(spark.range(0, 2500, 1, 1), sizes, "n long, total long", 1000).collect()
    assert [r.n for r in found] == [1000, 1000, 500] and sum(r.total for r in found) == sum(range(2500))


def test_text_columns_keep_nulls_and_places(spark):
    docs = spark.range(0, 2500, 1, 1).withColumn("text", F.when(F.col("id") % 7 > 0, F.concat(F.lit("t"), "id")))
    turned = common.text_column(spark, lambda x: None if x is None else x[::-1], "string")
    for r in docs.withColumn("turned", turned("text")).collect():
        assert r.turned == (f"t{r.id}"[::-1] if r.id % 7 else None)
    assert docs.limit(0).withColumn("turned", turned("text")).count() == 0


@pytest.mark.parametrize("texts", [[TEXT], [TEXT, "", TEXT + " eight"]])
def test_no_words_stay_after_a_sketch(spark, monkeypatch, texts):
    docs = spark.createDataFrame([(1, TEXT)], "doc_id long, text string")
    step, rows = steps_of(monkeypatch, dart_minhash, lambda: dart_minhash._sketch(docs))
    out = list(step(iter([{"_id": [*range(len(texts))], "_hash": [*range(len(texts))], "_text": texts}])))
    assert out[0]["n"] == [max(0, len(x.split()) - 4) for x in texts]
    assert not words._known and rows <= 1000


def test_no_chunks_stay_after_encoding(spark, monkeypatch):
    docs, path = spark.createDataFrame([(1, TEXT)], "doc_id long, text string"), tokenizer_file("byte_bpe_50k.json")
    step, rows = steps_of(monkeypatch, packing, lambda: packing.token_pieces(docs, path))
    out = list(step(iter([{"doc_id": [1], "text": [TEXT]}])))
    assert out[0]["length"] == [len(encoding.encoder(path).encode(TEXT)) // 4 + 1]
    encoding.encoder(path).forget()
    list(step(iter([{"doc_id": [1], "text": [TEXT]}])))
    assert not encoding.encoder(path).known and rows <= 1000
