import re

from pyspark.sql import functions as F

from kerbside.llm import pii
from kerbside.llm.queries import QUERIES

KEY = "k"
TEXTS = [
    "Call +1 (017) 555-7713 or 555-123-4567, mail Thingst.34@mail8.example.com; IP 161.17.88.162, 4111111111111111.",
    "Mr. John Smith met Frau Müller and Mrs John Smith. Господин Иванов. MR SMITH",
    "THINGST.34@MAIL8.EXAMPLE.COM!! and 4111 1111 1111 1111, 123-45-6789, DE44 5001 0517 5407 3249 31 x 1.2.3.4.5 v1.2.3",
    "+1 017 555 7713\n+1 (017) 555-7713",
    None, "", "no entity at all, 12 apples", "ñskbgdb.01@mail6.example.com", "161.17.88.162 | 161.17.88.163",
]


def run(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_entities string")
    return {r.doc_id: r for r in pii.replace_entities(docs, KEY).collect()}


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10


def test_surrogates_keep_type_format_script_and_gender(spark):
    got = run(spark, TEXTS)
    assert [got[i].n_entities for i in range(9)] == [5, 5, 4, 2, 0, 0, 0, 1, 2]
    assert got[4].text is None and got[5].text == "" and got[6].text == TEXTS[6]
    first = re.fullmatch(r"Call (\+1 \(\d{3}\) \d{3}-\d{4}) or (\d{3}-\d{3}-\d{4}), mail (\w+\.\d\d@\w{4}\d\.\w{7}\.com); IP ([\d.]+), (\d{16})\.", got[0].text)
    assert first and not set(first.groups()) & set(re.findall(r"[+\w(][^,;]*", TEXTS[0]))
    assert luhn(first[5]) == 0 and all(0 <= int(x) <= 255 for x in first[4].split("."))
    names = re.fullmatch(r"Mr\. (\w+n) (\w+n) met Frau (\w+na) and Mrs (\w+na) (\w+na)\. Господин ([Ѐ-ӿ]+в)\. MR ([A-Z]+N)", got[1].text)
    assert names and not {"John", "Smith", "Müller", "Иванов"} & set(names.groups())
    # coreference over documents and spellings
    assert got[2].text.split("!!")[0] == first[3].upper()
    assert got[2].text.split(" and ")[1].split(",")[0].replace(" ", "") == first[5]
    assert "1.2.3.4.5 v1.2.3" in got[2].text
    spaced, dashed = got[3].text.split("\n")
    assert dashed == first[1] and re.sub(r"\D", "", spaced) == re.sub(r"\D", "", dashed)
    a, b = got[8].text.split(" | ")
    assert a == first[4] and a != b


def test_originals_are_gone(spark):
    found = run(spark, TEXTS)
    for i, text in enumerate(TEXTS):
        for value in re.findall(pii_pattern(), text or ""):
            assert value not in found[i].text


def pii_pattern():
    return r"[\w.]+@[\w.]+|(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![.\d])|\+1 \(\d{3}\) \d{3}-\d{4}|\d{16}"


def test_collisions_are_drawn_again(spark):
    # one entity is what another's first draw would be: the other must be drawn again
    value = F.col("v")
    one = spark.range(1).select(F.lit("161.17.88.162").alias("v"))
    made = one.select(pii.surrogate(value, F.lit(0), KEY)).first()[0]
    got = run(spark, [f"a 161.17.88.162 b {made}", "c 161.17.88.162"])
    _, first, _, second = got[0].text.split(" ")
    assert len({first, second, made, "161.17.88.162"}) == 4
    assert got[1].text == f"c {first}"


def test_full_format_ends_in_labels(spark):
    # a format of two values, both in use, has no free surrogate
    known = spark.createDataFrame([(f"ip:{i}", f"1.1.1.{i}") for i in range(3)], "canonical string, value string")
    label = known.select(pii.surrogate(F.col("value"), F.lit(pii.DRAWS), KEY).alias("s")).collect()
    assert len({r.s for r in label}) == 3 and all(re.fullmatch(r"\[IP-[0-9a-f]{24}\]", r.s) for r in label)


def test_odd_rows(odd, none):
    found = pii.replace_entities(odd, KEY)
    assert found.columns == [c for c in odd.columns if c != "n_entities"] + ["n_entities"]
    assert sorted(map(str, ((r.doc_id, r.text) for r in found.collect()))) == sorted(map(str, ((r.doc_id, r.text) for r in odd.collect())))
    assert pii.replace_entities(none, KEY).count() == 0


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op8_pii_surrogates"](spark, sf_dir).collect()
    assert len(found) == len(docs)
    for r in found:
        values = re.findall(pii_pattern(), docs[r.doc_id] or "")
        assert all(v not in r.text for v in values)
        assert (r.n_entities == 0) == (r.text == docs[r.doc_id])
        assert len(re.findall(r"\s", r.text)) == len(re.findall(r"\s", docs[r.doc_id]))


def test_full_mailboxes_and_names_grow_instead_of_ending_in_labels(spark):
    texts = [f"mail {c}@mail8.example.com now" for c in "abcdefghijklmnopqrstuvwxyz"]
    got = [r.text for r in run(spark, texts).values()]
    assert all(re.fullmatch(r"mail [a-z]+@\w{4}\d\.\w{7}\.com now", t) for t in got) and len(set(got)) == 26
    drawn = spark.range(pii.DRAWS).select(pii.surrogate(F.lit("Frau Weber"), F.col("id").cast("int"), KEY).alias("s"))
    names = [r.s for r in drawn.collect()]
    assert all(re.fullmatch(r"Frau [A-Z][a-z]+na", n) for n in names) and len(max(names, key=len)) >= len(names[0]) + 14


def test_long_runs_of_each_group(spark):
    """No group of the pattern may recurse as deep as a text is long."""
    n = 100_000
    runs = ["a", "a.", "-", "1.2.3.", "12 ", "123-", "+1 (1)", "A1B2 ", "Mr Ab-", "é’"]
    texts = spark.createDataFrame([(r * n,) for r in runs], "text string")
    assert texts.where(F.regexp_count("text", F.lit(pii.PATTERN)) >= 0).count() == len(runs)
    # A domain of more than its 127 labels is an address as far as these go.
    (found,) = run(spark, ["x@" + "ab." * n + "com"]).values()
    assert found.n_entities == 1 and not found.text.startswith("x@")
