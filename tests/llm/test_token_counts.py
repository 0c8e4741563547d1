import public_tokenizers
import sentencepiece

from kerbside.llm import token_counts as tc
from kerbside.llm.queries import QUERIES

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
HARD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "  a   b  ", "a \n b", "\n", "x\ty", "</s> <s>[INST]", "ça va — 日本語 テスト", "🙂 🙂🙂", " a　b", "▁ ▁a",
    "word " * 5000, "w" * 20_000, "a​b ﻿", "\x00 \x01", "The end. " + " " * 70 + "x",
]


def test_split_counts_equal_whole_counts():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert tc.encoder(MODEL)[1]
    assert tc.count_tokens(HARD, MODEL) == [len(sp.encode(t)) for t in HARD]
    assert tc.count_tokens(HARD, MODEL) == [len(sp.encode(t)) for t in HARD]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(tc, "REMEMBERED", 3)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for texts in (HARD, ["p q r s t u v w x y z"], HARD[::-1]):
        assert tc.count_tokens(texts, MODEL) == [len(sp.encode(t)) for t in texts]


def test_query_and_odd_rows(spark, sf_dir, odd, none):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for docs, found in (
        (spark.read.parquet(f"{sf_dir}/documents.parquet"), QUERIES["op10_token_counts"](spark, sf_dir)), (odd, tc.token_counts(odd, MODEL)),
    ):
        want = sorted(str((r.doc_id, len((r.text or "").encode()), len(sp.encode(r.text or "")), len(sp.encode(r.text or "")) > 4096)) for r in docs.select("doc_id", "text").collect())
        assert sorted(str(tuple(r)) for r in found.collect()) == want
    assert tc.token_counts(none, MODEL).count() == 0
