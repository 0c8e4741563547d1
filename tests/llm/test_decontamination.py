import pytest

from kerbside.llm import decontamination as dc
from kerbside.llm.queries import QUERIES, SQL


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" or ord(c) > 127 else " " for c in low).split(" ")


def brute(text, items, size=13):
    doc = [w for w in words(text) if w]
    hit, found = set(), set()
    for item_id, item in items:
        w = [x for x in words(item) if x]
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            for j in range(len(doc) - n + 1):
                if doc[j : j + n] == w[i : i + n]:
                    hit.update(range(j, j + n))
                    found.update([] if item_id is None else [str(item_id)])
    return len(doc), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(doc)


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today"), (2, "one two"), (3, "a"), (4, None), (5, ""), (6, "!!!"),
    (7, " ".join(f"t{i}" for i in range(40))), (8, " ".join(f"t{i}" for i in range(40))), (9, "of of of of of of of of of of of of of of of"), (None, "the"),
    (None, "jumps over the lazy"), (None, None),
    (10, "écrit à la main"), (12, "w0x0"), (2, "one two"),
]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 60])
def test_against_brute_force(spark, odd, none, shard_bytes):
    more = [
        (20, "THE quick, brown fox jumps over the lazy dog near the river bank (today) one-two a"), (21, "x " * 400 + " ".join(f"t{i}" for i in range(5, 30))),
        (22, "of " * 30), (23, "t0 t1 t2 t3"), (24, "w0x0"), (25, " ".join(f"t{i}" for i in range(40)) * 3),
    ]
    docs = odd.filter("length(text) < 1000 OR text IS NULL").select("doc_id", "text", "n_words").unionByName(
        spark.createDataFrame([(*r, "x") for r in more], "doc_id long, text string, n_words string")
    )
    items = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, doc_id string")
    want = [(r.doc_id, *brute(r.text, ITEMS)) for r in docs.collect()]
    got = [(r.doc_id, r.n_words, r.n_hit, list(r.item_ids), r.contaminated) for r in dc.contamination(docs, items, shard_bytes=shard_bytes).collect()]
    assert got == want
    kept = dc.uncontaminated(docs, items, shard_bytes=shard_bytes)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [w[0] for w in want if not w[-1]]
    for size in (1, 2, 13):
        again = dc.contamination(docs, items, shingle=size)
        assert [(r.n_hit, list(r.item_ids)) for r in again.collect()] == [(w[2], w[3]) for w in want]
    assert dc.contamination(none, items).count() == 0
    assert {r.n_hit for r in dc.contamination(docs, items.limit(0)).collect()} == {0}


def test_long_text_and_shingle_bound(spark, odd):
    items = spark.createDataFrame([(1, "w976x985 the w0x1009")], "item_id long, text string")
    assert dc.contamination(odd.filter("doc_id = 7"), items).first().n_words == 60_000
    with pytest.raises(ValueError):
        dc.contamination(odd, items, window=2, shingle=3)


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).collect()
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = {r.doc_id: r for r in QUERIES["op6_decontamination"](spark, sf_dir).collect()}
    for r in docs:
        n, hit, ids, flag = brute(r.text, items)
        got = found[r.doc_id]
        assert (got.n_words, got.n_hit, got.n_items, got.contaminated) == (n, hit, len(ids), flag)


def test_sql_agrees_on_odd_rows(spark, odd, tmp_path):
    """Items without an id, null and empty texts, repeated rows: the query against its SQL."""
    duckdb = pytest.importorskip("duckdb")
    odd.select("doc_id", "text").filter("length(text) < 1000 OR text IS NULL").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(SQL["op6_decontamination"])
    columns = [d[0] for d in want.description]
    got = QUERIES["op6_decontamination"](spark, str(tmp_path)).select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)
