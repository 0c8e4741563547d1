import pytest

from kerbside.llm import url_filter as uf
from kerbside.llm.queries import QUERIES, URL_RULES

URLS = [
    "http://a.example.net/en/1?x=/de/", "HTTPS://WWW.Example.COM/de/x#y", "http://example.com/DE/", "http://net/", "http://net", "http://xnet/",
    "http://a.org/fr/", "http://a.org/fr", "http://forg/fr/", "ftp://u@b.net:80/p", "no scheme", "", None, "://a.net/x", "x://", "http://a.net?q=/",
    "http://a\n.net/b\nc", "http://É.net/ü", "a://b.net/c://d.org/fr/",
]


def brute(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best.text if best else None, best.verdict if best else default


def test_against_brute_force(spark):
    rows = [(None if i == 3 else i, u, "x") for i, u in enumerate(URLS + URLS[:3])]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    found = uf.judge(pages, URL_RULES).collect()
    assert [tuple(r) for r in found] == [(i, *brute(u, URL_RULES)) for i, u, _ in rows]


def test_collisions_are_confirmed_by_text(tmp_path):
    same = lambda host, path: 7
    uf.write_rules(URL_RULES, tmp_path / "r", same)
    array = uf.DigestArray(tmp_path / "r", same)
    hosts, paths = ["a.net", "b.example.net", "example.com", "c.gov"], ["/x", "/en/", "/de/", "/"]
    assert array.match(hosts, paths) == (["net/", "example.net/en/", "example.com/de/", None], ["block", "allow", "block", None])


def test_long_hosts_cost_their_length(tmp_path):
    uf.write_rules(URL_RULES, tmp_path / "r")
    array = uf.DigestArray(tmp_path / "r")
    asked = []
    probe = array.probe
    array.probe = lambda candidates: (asked.extend(candidates), probe(candidates))[1]
    long = "a." * 500_000 + "example.net"
    assert array.match([long, "." * 500_000 + "net"], ["/en/x", "/"]) == (["example.net/en/", "net/"], ["allow", "block"])
    assert sum(len(host) + len(path) for host, path in asked) < 1000


def test_no_rules_no_pages_too_many_rules(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id int, url string")
    assert [tuple(r) for r in uf.judge(pages, []).collect()] == [(1, "a.net", "/", None, "allow")]
    assert uf.judge(pages.limit(0), URL_RULES).count() == 0
    monkeypatch.setattr(uf, "MAX_BYTES", 10)
    with pytest.raises(ValueError):
        uf.write_rules(URL_RULES, tmp_path / "r")


def test_query(spark, sf_dir):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = QUERIES["op2_url_filter"](spark, sf_dir).collect()
    assert len(found) == len(urls)
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == brute(urls[r.page_id], URL_RULES)
