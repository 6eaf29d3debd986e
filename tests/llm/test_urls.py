"""URL filters against regular expressions and plain string rules."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from conftest import bag, plan
from fixtures import FOLDER, given, imports, lower  # noqa: F401

from clinflow.llm import queries, urls

PAGES = "page_id long, url string, host string, path string, rule string, html string"
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest).group()
    return lower(host), re.match(r"[^?#]*", rest[len(host) :]).group()


def regex(glob):
    """The glob rule by rule, written as a regular expression letter by letter."""
    out, i = "", 0
    while i < len(glob):
        if glob[i] == "\\" and i + 1 < len(glob):
            i += 1
            out += re.escape(glob[i])
        elif glob[i] == "*":
            run = re.match(r"\*+", glob[i:]).group()
            out += ".*" if len(run) > 1 else "[^/]*"
            i += len(run) - 1
        else:
            out += "[^/]" if glob[i] == "?" else re.escape(glob[i])
        i += 1
    return re.compile(out, re.DOTALL)


def judged(url):
    host, path = split(url)
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    matched = [glob for glob in urls.GLOBS if regex(glob).fullmatch(host + path)]
    if fits:
        best = max(fits, key=lambda r: len(r[1] + r[2]))
        return host, path, best[1] + best[2], best[0], " ".join(matched)
    return host, path, None, "block" if matched else "allow", " ".join(matched)


URLS = [
    None,
    "",
    "no scheme at all.net/",
    "http://",
    "://x.net/",
    "http://net/",
    "http://NET/a",
    "http://net",
    "http://net?x/",
    "http://net#/",
    "http://a.b.example.net/en/1",
    "http://example.net/en",
    "http://example.net/EN/1",
    "http://badexample.net/en/1",
    "http://example.com/de/1?x=/",
    "http://example.com.org/fr/",
    "http://example.org/x.net/abc",
    "http://org/fr/" + "a/" * 20_000,
    "http://casino.example.org",
    "http://www.casino-win.org/fr/x",
    "http://www.casino-win.org/en/x",
    "http://example.org/casino/",
    "http://example.org/a/b/cgi-bin/run",
    "http://example.org/files/Setup.exe",
    "http://example.org/calendar/2024-01-02x",
    "http://example.org/calendar/20/4-01-02",
    "http://user:pw@example.net:8080/en/",
    "http://ÉCOLE.net/é\n/x",
    "http://a.net://b.org/fr/",
    "http://x.org/" + "y" * 200_000 + ".exe",
]


def test_awkward_urls(spark):
    rows = [(i, url, "clash", "clash", "clash", None) for i, url in enumerate(URLS)]
    rows += [(None, "http://net/", None, None, None, None), (6, "http://NET/a", None, None, None, None)]
    got = urls.judge_urls(spark.createDataFrame(rows, PAGES).repartition(2)).collect()
    assert Counter(map(tuple, got)) == Counter((row[0], *judged(row[1])) for row in rows)


def test_no_pages(spark):
    assert urls.judge_urls(spark.createDataFrame([], PAGES)).collect() == []


def test_query(spark):
    found = queries.op11_urls(spark, FOLDER)
    assert Counter(map(tuple, found.collect())) == Counter((r["page_id"], *judged(r["url"])) for r in given(table="pages"))
    assert "Exchange" not in plan(found)


@pytest.mark.parametrize("seed", range(6))
def test_automaton_finds_what_regular_expressions_find(seed):
    """Random globs, hundreds of bits wide, over texts of the same few letters."""
    draw = random.Random(seed)
    globs = ["".join(draw.choice("ab/.?***\\") for _ in range(draw.randrange(1, 9))) for _ in range(120)]
    globs = [g for g in globs if not (len(g) - len(g.rstrip("\\"))) % 2] + ["", "*", "**", "?"]
    texts = ["".join(draw.choice("ab/.x*é") for _ in range(draw.randrange(0, 12))) for _ in range(300)] + ["", "a" * 3000, "ab/" * 900]
    found = urls.Automaton(globs, 1 << 16).matches(texts)
    for j, glob in enumerate(globs):
        want = regex(glob)
        assert [bool(want.fullmatch(text)) for text in texts] == found[:, j].tolist(), glob


def test_longest_rule_wins_and_ties_block(spark):
    hosts = [urls.HostRule("allow", "b.c", "/x"), urls.HostRule("block", "c", "/x/y"), urls.HostRule("allow", "c", "/")]
    settings = urls.UrlSettings(hosts, ["*.c/none"])
    rows = [(1, "http://b.c/x/y"), (2, "http://b.c/x"), (3, "http://c/z"), (4, "http://a*c/")]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), settings).collect()}
    assert got == {1: ("c/x/y", "block"), 2: ("b.c/x", "allow"), 3: ("c/", "allow"), 4: (None, "allow")}


def test_too_many_rules_are_refused(spark):
    with pytest.raises(ValueError):
        urls.judge_urls(spark.createDataFrame([], PAGES), urls.UrlSettings(globs=["a" * 100], most_bits=64))


def test_rows_do_not_depend_on_partitions(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    assert bag(urls.judge_urls(pages)) == bag(urls.judge_urls(pages.repartition(5)))
