from collections import Counter

import pytest

import corpus_pipeline
from kerbside.llm import decontamination, mixing
from kerbside.llm.queries import QUERIES
from llm.test_simhash_dedup import slow_components, slow_print


def test_stages_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "source_mixing"]
    one = docs
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        one = corpus_pipeline.written(stage(spark, one, sf_dir), name)
        assert one.columns == docs.columns
        seen.append({r.doc_id: r.text for r in one.collect()})
    texts = {r.doc_id: r.text for r in docs.collect()}
    judged = QUERIES["op1_language_id"](spark, sf_dir).collect()
    assert set(seen[0]) == {r.doc_id for r in judged if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_SCORE}
    assert set(seen[0]) >= {i for i, t in texts.items() if sum(c.isalpha() for c in t or "") > 40}
    assert all(texts[i] == t for i, t in seen[0].items())
    groups = slow_components([(i, slow_print(t)) for i, t in seen[0].items()])
    assert set(seen[1]) == {d for d, _, c in groups if d == c}
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = {r.doc_id for r in decontamination.contamination(docs, bench).collect() if r.contaminated}
    assert set(seen[2]) == set(seen[1]) - bad
    assert set(seen[3]) == set(seen[2])
    assert not any("token = \"" in t and "[SECRET]" not in t for t in seen[3].values())
    mixed = corpus_pipeline.run(spark, sf_dir)
    assert set(docs.columns) | set(mixing.RESULT) == set(mixed.columns)
    assert set(Counter(r.doc_id for r in mixed.select("doc_id").collect())) == set(seen[3])


def test_stages_on_odd_and_empty_rows(spark, sf_dir, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            made = corpus_pipeline.written(stage(spark, docs, sf_dir), name)
            assert set(docs.columns) <= set(made.columns)
            assert docs is not none or made.count() == 0


def test_shared_folder_is_the_one_the_cluster_names():
    from types import SimpleNamespace

    from kerbside.llm.common import shared_folder

    def session(named, master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named), sparkContext=SimpleNamespace(master=master))

    assert shared_folder(session("hdfs://a/b/", "yarn")) == "hdfs://a/b"
    assert shared_folder(session(None, "local[2]")).startswith("file:")
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_folder(session(None, master))


def test_queries_are_registered_with_their_sql():
    import __spark_entry__ as contract
    from kerbside.llm.queries import SQL

    assert [n.partition("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 11)]
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", ["op2_url_filter", "op6_decontamination"])
def test_query_equals_sql(spark, sf_dir, name):
    from compare import connect, difference

    assert difference(spark, connect(sf_dir), name, sf_dir) is None
