import zlib

import pytest

from kerbside.llm import language_id as li
from kerbside.llm.queries import QUERIES


@pytest.fixture(scope="module")
def judged(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.toPandas(), QUERIES["op1_language_id"](spark, sf_dir).toPandas()


def test_held_out_accuracy_and_contract(judged):
    docs, found = judged
    assert sorted(docs.doc_id) == sorted(found.doc_id)
    assert {"doc_id", "held_out", "lang_pred", "score"} <= set(found.columns)
    for doc_id, held in zip(found.doc_id, found.held_out):
        assert held == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
    both = docs.merge(found, on="doc_id")
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() >= 0.95
    assert found.score.between(0, 1).all()


def test_odd_rows(spark, odd, none):
    texts = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    words = {"en": "the house and the water", "de": "das haus und das wasser", "fr": "la maison et leau", "es": "la casa y el agua"}
    rows = [(i, f"{t} {i}", lang) for i in range(40) for lang, t in words.items()]
    rows += [(90, None, "en"), (91, "text", None), (None, "the water", "en"), (92, "...", "de")]
    model = li.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.families == ("germanic", "romance")
    assert set(model.pair_weights) == {("de", "en"), ("es", "fr")}
    found = li.predict(odd, model).collect()
    assert len(found) == odd.count()
    assert found[0].lang_pred == "en"
    for row, (_, text) in zip(found, texts, strict=True):
        letters = any(c.isalpha() for c in text or "")
        assert (row.lang_pred == "und") == (not letters)
        assert 0 <= row.score <= 1
    kept = li.with_language(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(r.lang_pred != "und" for r in found)
    assert li.predict(none, model).count() == 0


def test_no_labels_and_one_language(spark, odd, none):
    assert li.fit(none) is None
    assert {r.lang_pred for r in li.predict(odd, None).collect()} == {"und"}
    one = li.fit(spark.createDataFrame([(1, "the house", "en"), (2, "a tree", "en")], "doc_id long, text string, lang string"))
    assert li.judge(["anything"], one)[0] == ["en"]
