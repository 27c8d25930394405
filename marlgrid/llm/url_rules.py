"""URL rules that are looked up by their rarest literal token.

A rule is a pattern over ``host`` followed by the rest of the URL:

- ``||`` at the start anchors the pattern at the host or at one of its subdomains;
- ``|`` at the end anchors it at the end of the URL;
- ``*`` stands for any text, ``^`` for a separator or the end of the URL;
- ``@@`` before everything else makes it an exception, which allows what it matches.

Everything is built-in column functions: the URL is cut into tokens, each token
looks its rules up in a constant hash index, and only those rules run their
regular expression. No row is shuffled. A rule without any whole literal token
cannot be indexed and runs on every URL.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlgrid.llm.texts import free_prefix

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATOR = "[^A-Za-z0-9_.%-]"


class Rule(NamedTuple):
    """``text`` names the rule; ``action`` is ``allow`` or ``block``."""

    text: str
    action: str
    pattern: str


def prefix_rule(action: str, host: str, path: str) -> Rule:
    """Fits ``host`` and its subdomains where the URL's path starts with ``path``."""
    return Rule(host + path, action, f"||{host}{path}")


def pattern_rule(text: str) -> Rule:
    """A rule in the pattern language of this module."""
    if text.startswith("@@"):
        return Rule(text, "allow", text[2:])
    return Rule(text, "block", text)


def regex_of(rule: Rule) -> str:
    """The rule as a regular expression that Java and RE2 read alike."""
    body = rule.pattern.removeprefix("||").removesuffix("|")
    start = r"^([^/?#]*\.)?" if rule.pattern.startswith("||") else ""
    end = "$" if rule.pattern.endswith("|") else ""
    parts = {"*": ".*", "^": f"({SEPARATOR}|$)"}
    return "(?s)" + start + "".join(parts.get(c) or re.escape(c) for c in body) + end


def tokens_of(rule: Rule) -> list[str]:
    """Literals that are whole tokens of every URL that the rule matches, lower-cased."""
    anchored = rule.pattern.startswith("||")
    body = rule.pattern.removeprefix("||")
    found = []
    for m in re.finditer(r"[A-Za-z0-9]+", body):
        before = body[m.start() - 1] if m.start() else ("/" if anchored else "*")
        after = body[m.end()] if m.end() < len(body) else "*"
        if "*" not in (before, after):
            found.append(m.group().lower())
    return list(dict.fromkeys(found))


def url_parts(url: Column) -> dict[str, Column]:
    """``host`` (ASCII lower case), ``path`` and ``tail`` (all that follows the host).

    All are empty if the URL is null or has no ``://``.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3)))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substr(rest, F.length(raw) + F.lit(1))
    return {
        "host": F.translate(raw, UPPER, LOWER),
        "path": F.regexp_extract(tail, r"^[^?#]*", 0),
        "tail": tail,
    }


def url_tokens(host: Column, tail: Column) -> Column:
    """The distinct runs of ASCII letters and digits of a URL, lower-cased."""
    text = F.translate(F.concat(host, tail), UPPER, LOWER)
    return F.array_distinct(F.split(text, "[^a-z0-9]+"))


def token_counts(tokens: DataFrame, wanted: Sequence[str]) -> dict[str, int]:
    """Rows of ``tokens`` (column ``tokens``) that hold each of ``wanted``; one number per token."""
    asked = tokens.sparkSession.range(1).select(
        F.explode(F.from_json(F.lit(json.dumps(list(wanted))), "array<string>")).alias("wanted")
    )
    held = tokens.select(F.explode("tokens").alias("token")).groupBy("token").count()
    rows = held.join(asked, F.col("token") == F.col("wanted")).collect()
    return {row["token"]: row["count"] for row in rows}


ENTRY = "struct<token:string,regex:string,text:string,action:string,prefix:boolean>"


def rule_index(
    prefixes: Sequence[Rule], patterns: Sequence[Rule], counts: Mapping[str, int]
) -> tuple[Column, int, Column]:
    """A hash table from token to rules, its size, and the rules without a token.

    A rule stands under the literal of its own that the fewest URLs hold. Table and
    rules are one constant value each, however many rules there are.
    """
    size = 1
    while size < 2 * (len(prefixes) + len(patterns)):
        size *= 2
    slots: list[list[dict]] = [[] for _ in range(size)]
    always: list[dict] = []
    for rules, prefix in ((prefixes, True), (patterns, False)):
        for rule in rules:
            literals = tokens_of(rule)
            token = min(literals, key=lambda t: (counts.get(t, 0), t), default="")
            entry = {
                "token": token,
                "regex": regex_of(rule),
                "text": rule.text,
                "action": rule.action,
                "prefix": prefix,
            }
            (slots[_slot(token, size)] if literals else always).append(entry)
    constant = lambda value, kind: F.from_json(F.lit(json.dumps(value)), kind)
    return constant(slots, f"array<array<{ENTRY}>>"), size, constant(always, f"array<{ENTRY}>")


def _slot(token: str, size: int) -> int:
    number = 0
    for byte in token.encode():
        number = (number * 31 + byte) % 1_000_003
    return number % size


def _slot_column(token: Column, size: int) -> Column:
    # The same polynomial as _slot, over the token's characters, which are ASCII.
    step = lambda acc, c: (acc * 31 + F.ascii(c)) % 1_000_003
    number = F.aggregate(F.split(token, ""), F.lit(0).cast("int"), step)
    return number % F.lit(size) + F.lit(1)


def matching_rules(
    host: Column, tail: Column, tokens: Column, index: tuple[Column, int, Column]
) -> Column:
    """The rules of ``rule_index`` that match, as an array of its entries."""
    table, size, always = index
    of = lambda t: F.filter(F.element_at(table, _slot_column(t, size)), lambda r: r["token"] == t)
    fetched = F.flatten(F.transform(F.filter(tokens, lambda t: t != ""), of))
    subject = F.concat(host, tail)
    return F.filter(F.concat(fetched, always), lambda r: F.rlike(subject, r["regex"]))


def judge_urls(
    pages: DataFrame, prefixes: Sequence[Rule], patterns: Sequence[Rule], url: str = "url"
) -> DataFrame:
    """Adds ``host``, ``path``, ``rule``, ``pattern`` and ``verdict`` to every row of ``pages``.

    The longest fitting prefix rule gives ``rule`` and ``verdict``. Where none fits,
    ``rule`` is null and a URL is blocked if a blocking pattern matches it and no
    exception does; ``pattern`` is the first such rule in sort order, or null. A null
    URL, or one without ``://``, has an empty host and path, fits no rule and is allowed.
    Repeated rows are judged each; columns of those names are replaced. An empty table stays
    empty.
    """
    parts = url_parts(F.col(url))
    every_token = sorted({t for rule in [*prefixes, *patterns] for t in tokens_of(rule)})
    tokens = pages.select(url_tokens(parts["host"], parts["tail"]).alias("tokens"))
    counts = token_counts(tokens, every_token)
    index = rule_index(prefixes, patterns, counts)
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "pattern", "verdict")]
    inner = free_prefix(pages.columns)
    tail, found, best = (F.col(inner + name) for name in ("tail", "found", "best"))
    cut = pages.select(
        *names,
        parts["host"].alias("host"),
        parts["path"].alias("path"),
        parts["tail"].alias(f"{inner}tail"),
    )
    cut = cut.withColumn(f"{inner}tokens", url_tokens(F.col("host"), tail))
    matched = cut.withColumn(
        f"{inner}found", matching_rules(F.col("host"), tail, F.col(f"{inner}tokens"), index)
    )
    fits = F.filter(found, lambda r: r["prefix"])
    longest = F.array_max(
        F.transform(
            fits, lambda r: F.struct(F.length(r["text"]).alias("n"), r["text"], r["action"])
        )
    )
    others = F.filter(found, lambda r: ~r["prefix"])
    decided = F.coalesce(
        F.array_min(F.transform(F.filter(others, lambda r: r["action"] == "allow"), lambda r: r["text"])),
        F.array_min(F.transform(others, lambda r: r["text"])),
    )
    blocked = F.exists(others, lambda r: r["action"] == "block") & ~F.exists(
        others, lambda r: r["action"] == "allow"
    )
    return matched.withColumn(f"{inner}best", longest).select(
        *names,
        "host",
        "path",
        best["text"].alias("rule"),
        F.when(best.isNull(), decided).alias("pattern"),
        F.coalesce(
            best["action"], F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))
        ).alias("verdict"),
    )
