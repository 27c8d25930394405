"""Quality rules over the repeated substrings of a text, found with a suffix array of its words."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlgrid.llm.texts import SPACES, map_texts, word_hashes

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 3

# A repeat counts towards the covered share from this many words on.
MIN_WORDS = 20
# A text is kept if repeats cover at most this share of its words, in percent ...
MAX_COVERED_PERCENT = 30
# ... and its longest repeat is at most this share of its words, in percent.
MAX_LONGEST_PERCENT = 30


def repeat_lengths(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array of ``symbols``, its longest common prefixes, and each suffix's repeat.

    The suffix array is made by prefix doubling; only suffixes that are not yet told
    apart are sorted again. ``lcp[p]`` is the common prefix of the suffixes at
    ``p - 1`` and ``p`` of the array. The repeat of a suffix is the length of the
    longest substring that starts with it and occurs elsewhere, which is the value of the
    innermost longest-common-prefix interval that holds the suffix.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])[:n]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels = [rank.copy()]
    width = 1
    # Places in the suffix array that belong to a group of several suffixes.
    single = new & np.concatenate([new[1:], [True]])[:n]
    open_places = np.flatnonzero(~single)
    while len(open_places):
        suffixes = order[open_places]
        behind = suffixes + width
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)], -1)
        first = rank[suffixes]
        by = np.lexsort((second, first))
        suffixes, first, second = suffixes[by], first[by], second[by]
        order[open_places] = suffixes
        new = np.ones(len(by), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        start = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
        rank[suffixes] = open_places[start]
        levels.append(rank.copy())
        single = new & np.concatenate([new[1:], [True]])
        open_places = open_places[~single]
        width *= 2
    # The common prefix of neighbours, from the widest doubling step to the narrowest.
    lcp = np.zeros(n + 1, np.int64)
    near = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    left, right = order[near - 1], order[near]
    length = np.zeros(len(near), np.int64)
    for step in range(len(levels) - 1, -1, -1):
        a, b = left + length, right + length
        inside = (a < n) & (b < n)
        ranks = levels[step]
        same = inside & (ranks[np.minimum(a, n - 1)] == ranks[np.minimum(b, n - 1)]) & (a != b)
        length += np.where(same, 1 << step, 0)
    lcp[near] = length
    repeat = np.zeros(n, np.int64)
    repeat[order] = np.maximum(lcp[:-1], lcp[1:])
    return order, lcp[:n], repeat


def covered(repeat: np.ndarray, least: int) -> np.ndarray:
    """Which symbols lie in a repeated substring of at least ``least`` symbols."""
    at = np.arange(len(repeat))
    reach = np.maximum.accumulate(np.where(repeat >= least, at + repeat, 0)) if len(at) else at
    return at < reach


def _facts(texts: list[str]) -> list:
    hashes, counts = word_hashes(texts)
    text_of = np.repeat(np.arange(len(texts)), counts)
    # Symbols differ between texts, so no repeat reaches from one text into another.
    symbols = hashes ^ (text_of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, _, repeat = repeat_lengths(symbols)
    per_text = lambda flags: np.bincount(text_of[flags], minlength=len(texts))
    inside = covered(repeat, MIN_WORDS)
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, text_of, repeat)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    begins, stops = edges[0::2], edges[1::2]
    # Two texts that are covered up to their common border make one run; cut it there.
    first = np.cumsum(counts) - counts
    borders = first[(first > 0) & (first < len(inside))]
    if len(inside):
        borders = borders[inside[borders] & inside[borders - 1]]
        begins = np.unique(np.concatenate([begins, borders]))
        stops = np.unique(np.concatenate([stops, borders]))
    owner = text_of[begins] if len(begins) else np.zeros(0, np.int64)
    cuts = np.searchsorted(owner, np.arange(1, len(texts)))
    offset = first[owner]
    spaces = SPACES.decode()
    dup_lines = []
    for text in texts:
        lines = [line for line in text.split("\n") if line.strip(spaces)]
        dup_lines.append(len(lines) - len(set(lines)))
    return [
        counts,
        [len(t) - sum(map(t.count, spaces)) for t in texts],
        [sum(map(t.count, SYMBOLS)) for t in texts],
        dup_lines,
        per_text(covered(repeat, WINDOW)),
        per_text(inside),
        longest,
        [x.tolist() for x in np.split(begins - offset, cuts)],
        [x.tolist() for x in np.split(stops - offset, cuts)],
    ]


def repeat_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Judges every row of ``docs`` by the repeats in its whole ``text``.

    Keeps the columns of ``docs`` other than ``text`` and adds ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` (words in
    repeated windows of three), ``covered_words`` and ``longest_repeat`` (of repeated
    substrings of ``MIN_WORDS`` words and more; of any length), ``span_starts`` and
    ``span_ends`` (the union of those substrings' spans, in words), ``base_failed``
    and ``kept``. A null or empty text has no words and fails. Repeated rows are
    judged each; columns of ``docs`` with these names are replaced. No row moves
    between tasks. An empty table stays empty.
    """
    names = [
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "covered_words",
        "longest_repeat",
    ]
    added = {name: "bigint" for name in names}
    added |= {"span_starts": "array<bigint>", "span_ends": "array<bigint>"}
    judged = {"base_failed", "kept"}
    keep = [name for name in docs.columns if name != text and name not in judged]
    facts = map_texts(docs, keep, text, _facts, added)
    n = F.col("n_words")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    repetitive = (100 * F.col("covered_words") > MAX_COVERED_PERCENT * n) | (
        100 * F.col("longest_repeat") > MAX_LONGEST_PERCENT * n
    )
    return facts.withColumn("base_failed", failed).withColumn("kept", ~failed & ~repetitive)
