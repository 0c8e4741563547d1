import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from kerbside.llm import byte_bpe as bb
from kerbside.llm.queries import QUERIES

RANKS = str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return bb.coder(RANKS, public_tokenizers.PATTERN)


def packed(library, text):
    return np.array(library.encode_ordinary(text or ""), "<u4").tobytes()


CLASSES = (r"\p{L}", r"\p{N}", r"\s")


def hard_texts():
    rng = random.Random(4)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    pieces = ["a", "b", "e", "r", "t", "  ", " ", "\n", "é", "日", "ö", "1", "'", "s", "!", "\t", "\x1c", "\x85", " ", "　"]
    return [
        "", " ", "  ", "a ", " a", "a  b", "\n\n  \n a  b ", "'s don't 'S I'LL we'll", "<|endoftext|>", "\x00\x01", "🙂" * 200, "日本語のテキスト" * 300,
        "a" * 5000, "ab" * 3000, "aba" * 3000, "=-" * 9000, "!?" * 500, " " * 700, draw("ACGT", 9000), draw("etaoinshr", 1500), draw("äöüßéè", 900),
        "word " * 5000 + "x", *[draw(pieces, rng.randint(0, 40)) for _ in range(1500)],
    ]


def test_as_the_library(coder, library):
    texts = hard_texts()
    ids = coder.encode(texts)
    assert [t for t, i in zip(texts, ids, strict=True) if i != packed(library, t)] == []
    assert coder.decode(ids) == [t.encode() for t in texts]
    assert coder.encode(texts[::-1]) == ids[::-1]


def test_characters(coder, library):
    """Every character of which another Unicode version differs, and each 61st of the others."""
    others = regex.compile(r"[\p{L}\p{N}\s]")
    known = regex.compile(f"[{''.join(map(bb._members, CLASSES))}]")
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i <= 0xDFFF]
    points = [c for i, c in enumerate(points) if i % 61 == 0 or bool(others.match(c)) != bool(known.match(c))]
    # Between letters, numbers and signs a character shows its class.
    texts = ["".join(f"a{c}a 1{c}1 !{c}! " for c in points[i : i + 64]) for i in range(0, len(points), 64)]
    assert coder.encode(texts) == [packed(library, t) for t in texts]


def test_blocks_and_memory(library, monkeypatch):
    texts = hard_texts()[:40]
    small = bb.Coder(RANKS, public_tokenizers.PATTERN)
    for name, value in (("REMEMBERED", 3), ("ENCODE_BYTES", 50), ("DECODE_IDS", 7)):
        monkeypatch.setattr(bb, name, value)
    texts = [t[:200] for t in texts]
    for _ in range(2):
        ids = small.encode(texts)
        assert ids == [packed(library, t) for t in texts] and small.decode(ids) == [t.encode() for t in texts]
        assert sum(map(len, small.known)) < 1000


def want(library, rows):
    sha = lambda data: hashlib.sha256(data).hexdigest()
    coded = [(r.doc_id, packed(library, r.text), (r.text or "").encode()) for r in rows]
    return sorted(((i, len(ids) // 4, sha(ids), sha(text)) for i, ids, text in coded), key=repr)


def test_query_by_the_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = [tuple(r) for r in QUERIES["op13_byte_bpe"](spark, sf_dir).collect()]
    assert sorted(found, key=repr) == want(library, docs)


def test_odd_rows(odd, none, library):
    rows = odd.collect()
    coded = bb.encode(odd, RANKS)
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.ids)) for r in coded.collect()), key=repr) == sorted(
        ((r.doc_id, len(packed(library, r.text)) // 4, packed(library, r.text)) for r in rows), key=repr
    )
    back = bb.decode(coded, RANKS).collect()
    assert sorted(((r.doc_id, bytes(r.decoded)) for r in back), key=repr) == sorted(((r.doc_id, (r.text or "").encode()) for r in rows), key=repr)
    assert bb.round_trip(none, RANKS).count() == bb.decode(bb.encode(none, RANKS), RANKS).count() == 0
