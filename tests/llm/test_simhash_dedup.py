import numpy as np
import xxhash

from kerbside.llm import simhash_dedup as sd
from kerbside.llm.queries import QUERIES


def slow_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in text.encode().replace(b"\x0b", b" ").split() if w]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """The smallest id reachable of each (id, fingerprint); all pairs."""
    values = sorted({p for _, p in prints})
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                root[top(a)] = top(b)
    least = {}
    for doc_id, p in prints:
        if doc_id is not None:
            least[top(p)] = min(doc_id, least.get(top(p), doc_id))
    return [(d, p, least.get(top(p))) for d, p in prints]


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = slow_components([(r.doc_id, slow_print(r.text)) for r in docs])
    got = QUERIES["op5_simhash_dedup"](spark, sf_dir).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted((d, f"{p:016x}", c) for d, p, c in want)


def test_links_connect_what_all_pairs_connect(spark):
    rng = np.random.default_rng(3)
    values = set()
    for _ in range(60):
        base = int(rng.integers(0, 1 << 63)) * 2 + 1
        for _ in range(int(rng.integers(1, 12))):
            values.add(base)
            base ^= 1 << int(rng.integers(0, 64))
            if rng.random() < 0.6:
                base ^= 1 << int(rng.integers(0, 64))
    values |= {0, 3, 1 << 63, (1 << 64) - 1}
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "bits long")
    roots = {r.node & (1 << 64) - 1: r.root for r in sd.components(sd.links(frame)).collect()}
    want = {p: c for _, p, c in slow_components([(v % (1 << 62), v) for v in values])}
    groups = {}
    for v in values:
        groups.setdefault(want[v], set()).add(roots.get(v, ("alone", v)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "a long, b long")
    roots = {r.node: r.root for r in sd.components(edges).collect()}
    assert len({roots[i] for i in range(301)}) == 1 and roots[1000] == roots[1001] != roots[0]


def test_tree_follows_only_edges_within_the_radius():
    rng = np.random.default_rng(5)
    values = [int(v) for v in rng.integers(0, 1 << 12, 400)]
    tree = sd.Tree(values[0])
    for v in dict.fromkeys(values[1:]):
        if v != values[0]:
            tree.add(v)
    for probe in range(0, 1 << 12, 37):
        for radius in (0, 1, 2, 4):
            assert sorted(tree.within(probe, radius)) == sorted(v for v in set(values) if (v ^ probe).bit_count() <= radius)


def test_odd_rows(spark, odd, none):
    rows = odd.collect()
    want = slow_components([(r.doc_id, slow_print(r.text)) for r in rows])
    got = sd.near_duplicates(odd).collect()
    key = lambda t: tuple(map(str, t))
    assert sorted(((r.doc_id, r.bits & (1 << 64) - 1, r.component_id) for r in got), key=key) == sorted(want, key=key)
    kept = sd.representatives(odd)
    assert kept.columns == odd.columns
    # id 8 has two texts that are not near: two components of the same smallest id
    assert kept.count() == len({(c, p if c in (None, 8) else 0) for _, p, c in want}) == 8
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids.count(2) == 0 and ids.count(1) == 1
    assert sd.near_duplicates(none).count() == 0 and sd.representatives(none).count() == 0
