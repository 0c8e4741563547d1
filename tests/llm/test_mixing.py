import math
from collections import Counter

import pytest

from kerbside.llm import mixing as mx
from kerbside.llm.queries import QUERIES


def entropy(tokens, a):
    size = sum(t**a for t in tokens)
    return -sum(t**a / size * math.log(t**a / size) for t in tokens)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "w " * (1 + i % 50), f"s{min(4, int(math.log2(1 + i % 37)))}") for i in range(3000)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")



@pytest.mark.parametrize(("target", "limit"), [(0.99, 50.0), (0.99, 1.5), (0.5, 50.0), (1.0, 1e9)])
def test_exponent_by_brute_force(docs, target, limit):
    totals = docs.select("source", mx.n_tokens(docs.text).alias("n")).groupBy("source").sum("n").toDF("source", "tokens")
    tokens = [r.tokens for r in totals.collect()]
    found = mx.choose_exponent(totals, target, limit)
    meets = lambda a: entropy(tokens, a) >= target * math.log(len(tokens)) - 1e-12
    repeats = lambda a: (max(tokens) / min(tokens)) ** (1 - a)
    grid = [i / 20_000 for i in range(20_001)]
    by_entropy = max((a for a in grid if meets(a)), default=0.0)
    by_limit = min(a for a in grid if repeats(a) <= limit)
    assert abs(found - max(by_entropy, by_limit)) < 2e-4


def test_every_document_comes_as_often_as_its_source_should(docs):
    found = mx.mix(docs, 0.99, 8.0).collect()
    counts, sizes, total = Counter(r.doc_id for r in found), Counter(), Counter()
    for r in docs.collect():
        sizes[r.source] += len(r.text.split())
    for r in found:
        total[r.source] += r.n_tokens
    assert set(counts) == set(range(3000))
    a = mx.choose_exponent(docs.select("source", mx.n_tokens(docs.text).alias("n")).groupBy("source").sum("n").toDF("source", "tokens"), 0.99, 8.0)
    most = max(sizes.values())
    for source, size in sizes.items():
        repeats = (size / most) ** (a - 1)
        got = [counts[r.doc_id] for r in docs.filter(docs.source == source).select("doc_id").collect()]
        assert set(got) <= {math.floor(repeats + 1e-9), math.ceil(repeats - 1e-9)}
        assert repeats * size - 50 <= total[source] <= repeats * size + 1
    for r in found:
        assert 0 <= r.mix_position < 1
    assert len({(r.doc_id, r.mix_epoch) for r in found}) == len(found)


def test_budget_cuts_sources_and_keeps_to_it(docs):
    size = docs.select(mx.n_tokens(docs.text).alias("n")).groupBy().sum("n").first()[0]
    found = mx.mix(docs, 0.95, 4.0, budget=size // 3).collect()
    assert size // 3 - 5 * 60 <= sum(r.n_tokens for r in found) <= size // 3 + 5
    again = mx.mix(docs.repartition(7), 0.95, 4.0, budget=size // 3).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_blocks_of_a_source_change_their_order(docs, monkeypatch):
    monkeypatch.setattr(mx, "BLOCK_TOKENS", 200)
    found = mx.mix(docs, 1.0, 8.0).collect()
    orders = {}
    for r in found:
        orders.setdefault((r.source, r.mix_epoch), {})[r.mix_block] = r.mix_position
    small = [o for (s, e), o in sorted(orders.items()) if s == "s0" and e < 2]
    first, second = (sorted(o, key=o.get) for o in small)
    assert set(first) == set(second) and first != second
    # read in the order of positions, sources keep their shares all along
    half = Counter(r.source for r in found if r.mix_position < 0.5)
    full = Counter(r.source for r in found)
    assert all(abs(half[s] / full[s] - 0.5) < 0.15 for s in full)


def test_odd_rows(odd, none):
    found = mx.mix(odd)
    assert found.count() >= odd.count()
    rows = found.collect()
    assert {(r.doc_id, r.text) for r in rows} == {(r.doc_id, r.text) for r in odd.collect()}
    assert set(odd.columns) <= set(found.columns) and len(found.columns) == len(set(found.columns))
    assert mx.mix(none).count() == 0
    empty = odd.filter("coalesce(trim(text), '') = ''")
    assert mx.mix(empty).count() == empty.count()


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = QUERIES["op7_mixing"](spark, sf_dir)
    assert {r.doc_id for r in found.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert found.columns == ["doc_id", "source", "n_tokens", "mix_epoch", "mix_block", "mix_position"]


def test_query_and_stage_count_the_tokens_of_op10(spark, sf_dir, tmp_path):
    import corpus_pipeline

    # one word of many tokens against many words of few
    rows = [(i, "".join(chr(0x4E00 + (i * 37 + j) % 900) for j in range(300)), "zh") for i in range(20)]
    rows += [(100 + i, "the of and " * 20, "en") for i in range(20)] + [(200, None, "en")]
    made = spark.createDataFrame(rows, "doc_id long, text string, source string")
    made.write.parquet(f"{tmp_path}/documents.parquet")
    counts = {r.doc_id: r.n_tokens for r in QUERIES["op10_token_counts"](spark, str(tmp_path)).collect()}
    found = QUERIES["op7_mixing"](spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} == set(counts) and all(r.n_tokens == counts[r.doc_id] for r in found)
    assert min(counts[i] for i in range(20)) > 100
    # the source of many tokens is the largest: it comes once, the other more often
    assert max(Counter(r.doc_id for r in found if r.source == "zh").values()) == 1
    assert max(Counter(r.doc_id for r in found if r.source == "en").values()) > 1
    staged = corpus_pipeline.source_mixing(spark, made, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.mix_epoch) for r in staged) == sorted((r.doc_id, r.n_tokens, r.mix_epoch) for r in found)
