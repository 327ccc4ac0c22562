import zlib

import numpy as np
import pytest

from sluice.llm import language
from sluice.llm.common import documents

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return language.fit(documents(spark, SMALL))


def test_held_out_accuracy(spark, model):
    labels = {r.doc_id: r.lang for r in documents(spark, SMALL, "doc_id", "lang").collect()}
    got = language.identify(documents(spark, SMALL), model).collect()
    assert len(got) == len(labels)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    unseen = [r for r in got if r.held_out]
    assert len(unseen) > 150
    assert np.mean([r.lang_pred == labels[r.doc_id] for r in unseen]) > 0.97


def test_held_out_labels_are_not_read(spark, model):
    from pyspark.sql import functions as F

    docs = documents(spark, SMALL)
    side = language.held_out(F.col("doc_id"))
    other = docs.withColumn("lang", F.when(side, F.lit("xx")).otherwise(F.col("lang"))).withColumn("text", F.when(side, F.lit("zq zq")).otherwise(F.col("text")))
    again = language.fit(other)
    assert again.languages == model.languages
    assert np.allclose(again.weights, model.weights)


def test_texts_without_letters_and_nulls(docs, model):
    rows = [(1, None), (2, ""), (3, "123 .. 45"), (4, "The thing is that the other one"), (None, "las cosas y los otros"), (4, "The thing is that the other one")]
    got = {(r.doc_id, r.lang_pred) for r in language.identify(docs(rows), model).collect()}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (None, "es")}
    assert language.identify(docs([]), model).collect() == []


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language.identify_languages(empty).collect()] == [("und", 0.0)]


def test_long_text_goes_in_slices(model, monkeypatch):
    text = "the thing is that the other one " * 40
    whole = model.margins([text, "x"])
    monkeypatch.setattr(language, "SLICE", 200)
    assert np.allclose(np.sign(model.margins([text, "x"])), np.sign(whole))


@pytest.mark.parametrize("languages", [0, 1, 2, 4, 6, 9, 40])
def test_codewords_differ_and_every_bit_splits(languages):
    code = language.codewords(languages)
    assert len(code) == languages
    if languages > 1:
        assert (np.abs(code.astype(int).sum(axis=0)) < languages).all()
        distance = (code.shape[1] - code.astype(int) @ code.T.astype(int)) // 2
        least = distance[~np.eye(languages, dtype=bool)].min()
        assert least >= (1 if languages < 4 else 4)


def test_one_wrong_bit_is_corrected():
    code = language.codewords(5)
    model = language.Model(list("abcde"), code, np.zeros((language.BUCKETS, code.shape[1])), np.full(code.shape, 1 / code.shape[1]))
    for i, word in enumerate(code):
        for bit in range(code.shape[1]):
            margins = 4.0 * word
            margins[bit] *= -1
            assert model.shares(margins[None]).argmax() == i
