from __future__ import annotations

import re

import pytest
from compare import assert_same, duck

from marlgrid.llm import queries, url_rules

URLS = [
    None,
    "",
    "no scheme",
    "://",
    "http://",
    "http://Example.ORG",
    "http://example.org/",
    "http://EXAMPLE.org/es/1",
    "https://a.b.example.org/en/17?x=1",
    "https://notexample.org/es/",
    "https://x.org?q=/es/",
    "http://shop.com/fr/a#b",
    "http://shop.com/de/",
    "http://shop.com/FR/a",
    "http://com/de/x",
    "http://ads.site.net/x",
    "http://m.casino-win.net/a",
    "http://loads.net/cart",
    "http://loads.net/cartoon",
    "http://a.net/en/1?page=2&ref=x",
    "http://a.net/es/1?page=2&ref=x",
    "http://a.net/es/1?page=2&ref=x",
    "http://docs.a.net/search?q=1",
    "http://a.net/search?q=1",
    "http://a.net/x\nhttp://ads.b.net/",
    "http://a.net/" + "very/long/" * 5_000,
    "http://xn--é.com/fr/ü",
    "a://b://c.org/x",
]


def matches(pattern: str, text: str) -> bool:
    """Whether a pattern without anchors at the front matches the start of ``text``, step by step."""
    states = {0}
    for at in range(len(text) + 1):
        grown = set()
        while states:
            i = states.pop()
            if i in grown:
                continue
            grown.add(i)
            if i < len(pattern) and (pattern[i] == "*" or pattern[i] == "^" and at == len(text)):
                states.add(i + 1)
            if i == len(pattern) - 1 and pattern[i] == "|" and at == len(text):
                states.add(i + 1)
        if len(pattern) in grown:
            return True
        if at == len(text):
            return False
        for i in grown:
            c = pattern[i]
            separates = not (text[at].isascii() and text[at].isalnum()) and text[at] not in "_.%-"
            if c == "*":
                states.add(i)
            elif c == text[at] or c == "^" and separates:
                states.add(i + 1)
    return False


def fits(rule, host: str, tail: str) -> bool:
    pattern, text = rule.pattern, host + tail
    if pattern.startswith("||"):
        name = re.match("[^/?#]*", text)[0]
        starts = [0, *(i + 1 for i, c in enumerate(name) if c == ".")]
        pattern = pattern[2:]
    else:
        starts = range(len(text) + 1)
    return any(matches(pattern, text[i:]) for i in starts)


def brute(url: str | None) -> tuple:
    at = (url or "").find("://")
    rest = url[at + 3 :] if url and at >= 0 else ""
    host = re.match(r"[^/?#]*", rest)[0]
    tail = rest[len(host) :]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    path = re.match(r"[^?#]*", tail)[0]
    fitting = []
    for rule in queries.PREFIX_RULES:
        name, _, start = rule.text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fitting.append(rule)
    if fitting:
        rule = max(fitting, key=lambda r: len(r.text))
        return host, path, rule.text, rule.action
    # Long repeats of one path have nothing that the start of them lacks.
    found = [r for r in queries.PATTERN_RULES if fits(r, host, tail[:500])]
    block = found and all(r.action == "block" for r in found)
    return host, path, None, "block" if block else "allow"


def test_against_all_rules_on_every_url(spark):
    rows = [(i, url, "x", "y", "z") for i, url in enumerate(URLS)]
    schema = "page_id int, url string, host string, verdict string, _tail string"
    pages = spark.createDataFrame(rows, schema)
    judged = url_rules.judge_urls(pages, queries.PREFIX_RULES, queries.PATTERN_RULES)
    assert {r._tail for r in judged.collect()} == {"z"}
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged.collect()}
    assert got == {i: brute(url) for i, url in enumerate(URLS)}


def test_no_rows(spark):
    pages = spark.createDataFrame([], "page_id int, url string")
    assert url_rules.judge_urls(pages, queries.PREFIX_RULES, queries.PATTERN_RULES).count() == 0


def test_a_rule_without_a_whole_literal_runs_on_every_url(spark):
    rules = [url_rules.pattern_rule("abc*")]
    assert url_rules.tokens_of(rules[0]) == []
    pages = spark.createDataFrame([("http://x.net/zabcz",), ("http://x.net/z",)], "url string")
    judged = url_rules.judge_urls(pages, [], rules).collect()
    assert [r.verdict for r in judged] == ["block", "allow"]


def test_literals_are_whole_tokens():
    rule = url_rules.prefix_rule("block", "example.org", "/en/1")
    assert url_rules.tokens_of(rule) == ["example", "org", "en"]
    assert url_rules.tokens_of(url_rules.pattern_rule("/a1*b2/c3^")) == ["c3"]


def test_a_rule_stands_under_its_rarest_literal(spark):
    rule = url_rules.prefix_rule("block", "example.org", "/es/")
    table, _, _ = url_rules.rule_index([rule], [], {"example": 9, "org": 5, "es": 2})
    entries = spark.range(1).select(url_rules.F.flatten(table).alias("t")).first().t
    assert [(entry.token, entry.prefix) for entry in entries] == [("es", True)]


def test_prefix_rules_of_any_kind_against_string_functions(spark):
    hosts = ["org", "example.org", "a.example.org", "b.a.example.org", "xexample.org", "example.org.uk"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab", "/A", "/a.b/c", "/a*b", "/a^b"]
    urls = [f"https://{h}{p}{q}" for h in hosts for p in paths for q in ("", "?x=/a/", "#/a")]
    rules = [
        url_rules.prefix_rule(action, h, p)
        for h, action in zip(hosts, ["allow", "block"] * 3)
        for p in ("/", "/a", "/a/", "/a.b/")
    ]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    for row in url_rules.judge_urls(pages, rules, []).collect():
        good = [
            r
            for r in rules
            if (row.host == r.text.partition("/")[0] or row.host.endswith("." + r.text.partition("/")[0]))
            and row.path.startswith("/" + r.text.partition("/")[2])
        ]
        want = max(good, key=lambda r: len(r.text), default=None)
        assert (row.rule, row.verdict) == ((want.text, want.action) if want else (None, "allow")), row


def test_fifty_thousand_rules(spark):
    patterns = [url_rules.pattern_rule(f"||ads{i}.net^" if i % 2 else f"/track{i}/") for i in range(50_000)]
    prefixes = [url_rules.prefix_rule("block", f"host{i}.org", "/x/") for i in range(2_000)]
    urls = ["http://a.ads77.net/", "http://a.ads78.net/", "http://b.net/track40/1", "http://b.net/track41/"]
    urls += ["http://a.host7.org/x/y", "http://a.host7.org/y", "http://b.net/" + "a/" * 100]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "n int, url string")
    judged = url_rules.judge_urls(pages, prefixes, patterns)
    got = {r.n: (r.verdict, r.rule or r.pattern) for r in judged.collect()}
    allowed = ("allow", None)
    assert got == {
        0: ("block", "||ads77.net^"), 1: allowed, 2: ("block", "/track40/"), 3: allowed,
        4: ("block", "host7.org/x/"), 5: allowed, 6: allowed,
    }
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_the_plan_has_no_shuffle_and_no_python(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    judged = url_rules.judge_urls(pages, queries.PREFIX_RULES, queries.PATTERN_RULES)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    sql = queries.SQL["op9_url_rules"]
    assert assert_same(queries.op9_url_rules(spark, folder), duck(folder), sql) > 0
