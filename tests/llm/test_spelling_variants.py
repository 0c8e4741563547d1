import re
import zlib
from collections import Counter, defaultdict

from kerbside.llm import spelling_variants as sv
from kerbside.llm.queries import QUERIES

COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def brute(rows):
    """By the contract's words, with a dictionary of words with one letter left out or replaced by a hole."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    near = defaultdict(set)
    holes = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1 :]
            if shorter in counts:
                near[w].add(shorter)
                near[shorter].add(w)
            holes[w[:i], w[i + 1 :]].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, n, len(near[w]), form[w], counts[form[w]] if form[w] else None, root(w)) for w, n in counts.items())


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_query_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = brute(docs)
    assert found(QUERIES["op11_spelling_variants"](spark, sf_dir)) == want
    assert sum(w[2] > 0 for w in want) > 50 and any(w[3] for w in want)


def test_edits_runs_and_long_words(spark, monkeypatch):
    """Runs of one letter, first and last letters, chains of forms, words beyond the levels of the trie."""
    monkeypatch.setattr(sv, "LEVELS", 8)
    long = "".join(chr(97 + i * i % 23) for i in range(300))
    other = "z" * 150
    words = {
        "aaaaa": 3, "aaaaaa": 9, "aaaaaaa": 27, "baaaa": 4, "aaaab": 4, "house": 40, "hause": 3, "houses": 10, "ouse": 50, "xhouse": 5, "hous": 9,
        "mouse": 41, "abcde": 3, "abced": 3, "étude": 6, "etude": 3, "Étude": 3, "e÷ude": 3, "abcdefgh": 7, "abcdefghi": 3, "abcdefghij": 15, "abcdxfghi": 4, long: 20, long[:-1]: 3, long[1:]: 4, long[:99] + "A" + long[100:]: 5,
        long[:99] + "B" + long[100:]: 5, long[:200] + "x" + long[200:]: 6, other: 8, other + "z": 3, other[1:]: 4, "q" * 64: 3, "q" * 65: 7, "q" * 63: 15, "q" * 63 + "r": 4,
    }
    rows = [(i, " ".join(w for w, n in words.items() if n > i)) for i in range(50)] + [(None, "aaaaa 1house2 HOUSE"), (1, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert len(want) > 25 and any(w[0] != w[3] and w[3] and w[5] != w[3] for w in want)
    assert found(sv.variants(docs)) == want


def test_no_pair_twice(spark):
    words = ["aaaaa", "aaaaaa", "aabaa", "aaaba", "abaaa", "aabaaa", "banana", "bananaa", "bannana", "baanana"]
    vocabulary = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    pairs = [tuple(sorted(r)) for r in sv._trie_pairs(vocabulary).collect()]
    assert len(pairs) == len(set(pairs)) > 5


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(sv.variants(odd)) == brute(rows)
    assert sv.variants(none).count() == 0
