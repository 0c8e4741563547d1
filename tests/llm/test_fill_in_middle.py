import hashlib
import random

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from kerbside.llm import fill_in_middle as fim
from kerbside.llm.queries import QUERIES


def brute(doc_id, text, units=None, seed=1):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if units is None:
        starts = list(range(len(text)))
    else:
        starts = [m.start() for m in regex.finditer(units, text)]
        starts[:1] = [0] * bool(starts)
    n = len(starts)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    at = lambda k: len(text) if k >= n else starts[k] if k else 0
    p, m, s = text[: at(a)], text[at(a) : at(b)], text[at(b) :]
    return n, *(("spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else ("psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_fenwick_finds_every_count():
    random.seed(1)
    for size in (0, 1, 2, 7, 8, 33):
        counts = np.array([random.choice([0, 1, 3, 10]) for _ in range(size)], np.int64)
        tree = fim.Fenwick(counts)
        assert [tree.before(i) for i in range(size + 1)] == [int(counts[:i].sum()) for i in range(size + 1)]
        for k in range(int(counts.sum())):
            block, left = tree.find(k)
            assert counts[:block].sum() <= k < counts[: block + 1].sum() and left == k - counts[:block].sum()


@pytest.mark.parametrize("units", [None, fim.WORDS])
def test_every_cut_of_small_blocks(monkeypatch, units):
    monkeypatch.setattr(fim, "BLOCK", 3)
    for text in ("", "a", "  a bc  d ", "é日本🙂 x\n\ny — z" * 3, "🙂" * 9, "    "):
        blocks = fim.Blocks(text.encode(), units)
        starts = list(range(len(text))) if units is None else [m.start() for m in regex.finditer(units, text)]
        assert blocks.n == len(starts)
        for k in range(len(starts) + 2):
            at = len(text) if k >= len(starts) else starts[k] if k else 0
            assert blocks.cut(k) == (len(text[:at].encode()), at)


def test_query_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for r in docs:
        *head, output = brute(r.doc_id, r.text)
        want.append((r.doc_id, *head, sha(output), sha(r.text or "")))
    found = [tuple(r) for r in QUERIES["op12_fill_in_middle"](spark, sf_dir).collect()]
    assert sorted(found) == sorted(want)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


HARD = ["<", "<P", "<<S>", "a<M>b", "S><P", "P><", "<S", "M>", "🙂<S", "x" * 100_000 + "é" * 50_000]


@pytest.mark.parametrize("units", [None, fim.WORDS])
def test_odd_rows(spark, odd, none, units):
    hard = spark.createDataFrame([(i, t) for i, t in enumerate(HARD * 3)], "doc_id long, text string")
    for docs in (odd, hard):
        made = fim.transform(docs, units)
        rows = made.withColumn("restored", fim.restored(F.col("output"), F.col("form"))).collect()
        want = [(r.doc_id, *brute(r.doc_id, r.text, units), r.text or "") for r in docs.collect()]
        assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert fim.transform(none).count() == 0


def test_markers_that_could_arise_are_refused(odd):
    for markers in (("<P>", "<S>", "<S>"), ("aa", "b", "c"), ("ab", "ba", "c"), ("", "a", "b"), ("x", "xy", "z")):
        with pytest.raises(ValueError):
            fim.transform(odd, markers=markers)
    assert fim.transform(odd, markers=("[pre]", "{suf}", "(mid)")).where("form = 'psm' and output like '[pre]%'").count() > 0
