import hashlib

import numpy as np

from kerbside.llm import fingerprints as fp
from kerbside.llm.queries import QUERIES


def shingle_set(text, n=5):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def brute(rows):
    """By id: code points, the edited text, the next text; rows with distinct ids."""
    rows = in_order(rows)
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        part = len(text) // 4
        yield doc_id, len(text), text[: len(text) - part] + following[:part], following


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r.doc_id: r for r in QUERIES["op4_document_fingerprint"](spark, sf_dir).collect()}
    texts = {r.doc_id: r.text or "" for r in docs}
    assert len(found) == len(docs)
    by_text = {}
    errors = []
    for doc_id, n, changed, following in brute([(r.doc_id, r.text) for r in docs]):
        r = found[doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(changed.encode()).hexdigest())
        assert by_text.setdefault(texts[doc_id], r.fingerprint) == r.fingerprint
        assert np.array_equal(fp.decode(r.edited_fingerprint), fp.sketches([changed.encode()])[0])
        assert np.array_equal(fp.decode(r.fingerprint), fp.sketches([texts[doc_id].encode()])[0])
        a, b, c = shingle_set(texts[doc_id]), shingle_set(changed), shingle_set(following)
        if len(a) > 300:
            errors += [abs(r.near_edited - len(a & b) / len(a | b)), abs(r.near_next - len(a & c) / len(a | c))]
    assert np.mean(errors) < 0.05


def test_ranges_give_the_next_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    want = {d: f for d, _, _, f in brute([tuple(r) for r in docs.collect()])}
    for rows in (7, 50, 1000):
        got = fp.with_next(docs.repartition(5), rows).collect()
        assert len(got) == len(want)
        assert all(r.next_text == want[r.doc_id] for r in got)


def test_odd_rows(odd, none):
    found = fp.compare_edits(odd).collect()
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(map(str, (r.doc_id for r in odd.collect())))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert {r.fingerprint for r in found if r.n_chars == 0} == {""}
    assert fp.compare_edits(none).count() == 0
    assert fp.fingerprints(odd).count() == odd.count() and fp.fingerprints(none).count() == 0
    one = odd.filter("doc_id = 9")
    assert fp.compare_edits(one).first().near_next == 1.0


def test_sketches_merge_and_estimate_containment():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(5000)]
    long = " ".join(rng.choice(words, 20_000)).encode()
    short = b" ".join(long.split()[500:900])
    a, b = fp.sketches([short, long])
    assert fp.containment(a, b) == 1.0 and fp.likeness(a, b) < 0.1
    other = " ".join(rng.choice(words, 300)).encode()
    c = fp.sketches([other])[0]
    # merging is the sketch of all shingles of both
    union = np.union1d(a, c)
    assert np.array_equal(fp.merge(a, c), union)
    tiny = fp.sketches([b"one"], scale=1 << 40)[0]
    assert len(tiny) == 1 and np.array_equal(fp.merge(tiny, tiny, 1 << 40), tiny)
