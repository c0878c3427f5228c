import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dwellmart.llm import url_filter
from dwellmart.llm.queries import ORACLES, QUERIES
from tests.comparison import duckdb_bag, duckdb_on, spark_bag

GLOBS = ("*.net?/*", "a*b*", "", "*", "abc", "*c", "é*", "a**b", ".x?/y*", "a" * 70 + "*z")
GLOB_MACHINE = url_filter.compile_globs(GLOBS)


def by_regex(glob, text):
    return re.fullmatch(".*".join(map(re.escape, glob.split("*"))), text, re.S) is not None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text("abcxyz.net?/é*", max_size=14), st.just("a" * 70 + "qz"), st.just("a" * 69 + "z")), max_size=6))
def test_automaton_against_regular_expressions(texts):
    found = url_filter.matches(GLOB_MACHINE, [t.encode() for t in texts])
    assert found.tolist() == [[by_regex(g, t) for g in GLOBS] for t in texts]


URLS = [
    ("http://A.B.Net/x?q=1", "a.b.net", "/x", "net/", "block"),
    ("https://example.net/en/1#top", "example.net", "/en/1", "example.net/en/", "allow"),
    ("https://www.example.net/EN/1", "www.example.net", "/EN/1", "net/", "block"),
    ("http://xnet/", "xnet", "/", None, "allow"),
    ("http://net", "net", "", None, "allow"),
    ("ftp://m.example.com/de/x", "m.example.com", "/de/x", "example.com/de/", "block"),
    ("http://a.org/fr/casino-win", "a.org", "/fr/casino-win", "org/fr/", "allow"),
    ("http://casino-win.example.com/en/", "casino-win.example.com", "/en/", None, "block"),
    ("http://a.com/.net/x", "a.com", "/.net/x", None, "allow"),
    ("http://a.com/set-up.exe", "a.com", "/set-up.exe", None, "block"),
    ("example.net/en/", "", "", None, "allow"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ("http://a.com\n.net/x", "a.com\n.net", "/x", "net/", "block"),
    ("http://ÄÖ.net/" + "y" * 5000, "ÄÖ.net", "/" + "y" * 5000, "net/", "block"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_urls(on_workers):
    rows = [(i, u[0], "x", "x") for i, u in enumerate(URLS)] + [(None, "http://a.net/", "x", "x")]
    pages = on_workers.createDataFrame(rows, "page_id long, url string, host string, canonical string")
    found = url_filter.judged(pages)
    got = {r.page_id: tuple(r)[1:] for r in found.collect()}
    assert {i: got[i] for i in range(len(URLS))} == {i: u[1:] for i, u in enumerate(URLS)}
    assert got[None] == ("a.net", "/", "net/", "block")
    assert url_filter.judged(pages.limit(0)).count() == 0
    assert url_filter.judged(pages.union(pages)).count() == 2 * len(rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_registered_queries_match_their_sql(spark, sf_dir, name):
    assert spark_bag(QUERIES[name](spark, sf_dir)) == duckdb_bag(duckdb_on(sf_dir), ORACLES[name])
