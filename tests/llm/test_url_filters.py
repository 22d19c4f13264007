import pytest

from brute import rows
from compare import database, differences
from tidelog.llm import queries, url_filters

RULES = [("com", "/", "allow"), ("b.com", "/x", "block"), ("b.com", "/x", "allow"), ("B.com", "/x/y/", "allow"), ("", "/", "block"), (None, "/", "block"), ("org", None, "block"), ("c.org", "", "allow")]


def expected(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    raw, after = rest[:end], rest[end:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in raw)
    path = after[: min([after.index(c) for c in "?#" if c in after], default=len(after))]
    known = {}
    for h, p, action in RULES:
        if h:
            known[h.lower(), p or ""] = max(action, known.get((h.lower(), p or ""), ""))
    fits = [(len(h + p), len(h), h + p, a) for (h, p), a in known.items() if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[2], max(fits)[3]) if fits else (host, path, None, "allow")


URLS = [
    None, "", "no scheme", "http://", "http://COM", "http://com/", "http://a.B.com/x?q", "http://b.com/x/y/z#f", "http://b.com/xy", "http://b.com/x/y", "http://b.com?x://y/z", "x://y.c.org", "http://org/a//b/",
    "http://a:80@b.com:8080/x", "http://ÄB.com/x", "http://b.com/x\n/y", "http://ab.com/x", "http://.com/", "http://" + "a." * 500 + "com/" + "d/" * 500,
]


def test_against_a_scan_of_all_rules(spark):
    pages = spark.createDataFrame([(i % 7 if i % 5 else None, u, "clash") for i, u in enumerate(URLS + URLS)], "page_id long, url string, host string")
    judged = url_filters.judge(pages, url_filters.rules_of(spark, RULES))
    want = sorted(((i % 7 if i % 5 else None, *expected(u)) for i, u in enumerate(URLS + URLS)), key=repr)
    assert rows(judged, "page_id", "host", "path", "rule", "verdict") == want


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert rows(url_filters.judge(pages, url_filters.rules_of(spark, [])), "rule", "verdict") == [(None, "allow")]
    assert url_filters.judge(pages.limit(0), url_filters.rules_of(spark, RULES)).count() == 0


def test_query(spark, sf_dir):
    assert differences(queries.op1_url_filters(spark, sf_dir), database(sf_dir), queries.OP1_SQL) == []


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries.op1_url_filters(spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian"))
