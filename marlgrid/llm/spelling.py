"""Spelling variants: words one edit apart, by sorted permuterm rotations.

A word with a terminator behind it is a ring, and its rotations are the places that
one can cut the ring at. Words that differ by one replaced character have rotations
that begin alike and differ in the last character; if a character is missing from a
word, one of its rotations is a whole rotation of the other word without the last
character. Hence each rotation is filed under what comes before its last character,
the edited one, and under the whole of itself, where nothing is edited. All of them are
sorted; the prefix ranges of the rotations are the groups of one file name, and range
partitions never cut a group. A group has a member per letter of the alphabet at most.

Each group is scanned once, and each of its words gets one row back: how many near words
the group has for it, and the best of them. Pairs are never listed.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlgrid.llm.order import numbered
from marlgrid.llm.texts import pieces
from marlgrid.sources.scratch import materialize

LEAST_CHARS, LEAST_COUNT = 5, 3
# A word's form occurs at least so many times as often.
FORM_FACTOR = 2

# The characters of a run once A-Z are lower-case, and the share of its
# occurrences (one of so many, by a checksum) that lose a character.
RUN = re.compile(rf"[a-zÀ-ÿ]{{{LEAST_CHARS},}}")
DAMAGED = 97

# Words that a task counts before it passes them on, and rows of a batch.
COUNTED_WORDS = 200_000
BATCH_ROWS = 50_000

# A file name of more characters is replaced by a checksum of 127 bits.
NAME_CHARS = 64
_PRIME, _BASE = 2**127 - 1, 0x5DEECE66D1B54A32D192ED03A4F0C6B9

# What a rotation is in a group: the whole of a word, or a word without the character
# behind the name, which may or may not be the first of its equal neighbours.
WHOLE, REPEATED, EDITED = 0, 1, 2


def damaged(run: str, checksum: int) -> str:
    """``run`` without one character, if its checksum says so."""
    if checksum % DAMAGED:
        return run
    at = checksum % len(run)
    return run[:at] + run[at + 1 :]


def words_of(key: str, text: str) -> Counter[str]:
    """The words of a text and how often it has them; ``key`` and run tell which are damaged."""
    lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    start = zlib.crc32(f"{key}:".encode())
    found: Counter[str] = Counter()
    for run, n in Counter(RUN.findall(lower)).items():
        checksum = zlib.crc32(run.encode(), start)
        found[run if checksum % DAMAGED else damaged(run, checksum)] += n
    return found


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n`` of every word of ``docs`` with enough characters and occurrences."""
    chosen = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"),
        F.col(text).cast("string").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter[str] = Counter()
        size = 0
        for piece in pieces(batches, "text"):
            for one, whole in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                if whole:
                    found = words_of(one, whole)
                    counted.update(found)
                    size += len(whole)
            if len(counted) > COUNTED_WORDS or size > 100 * COUNTED_WORDS:
                yield _counts(counted)
                counted, size = Counter(), 0
        yield _counts(counted)

    counts = chosen.mapInArrow(run, "word string, n bigint")
    total = counts.groupBy("word").agg(F.sum("n").alias("n"))
    return total.filter((F.length("word") >= LEAST_CHARS) & (F.col("n") >= LEAST_COUNT))


def _counts(counted: Counter[str]) -> pa.RecordBatch:
    columns = [pa.array(counted.keys(), pa.string()), pa.array(counted.values(), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n"])


def rotations(word: str) -> Iterator[tuple[str, int]]:
    """The file names of a word's rotations, and what the word is under each of them."""
    n = len(word)
    edited = _names(word, 1)
    whole = _names(word, 0)
    for i in range(n):
        first = i == 0 or word[i] != word[i - 1]
        yield edited(i), EDITED if first else REPEATED
    for i in range(n + 1):
        yield whole(i), WHOLE


def _names(word: str, skipped: int):
    """The function from ``i`` to the name that begins ``skipped`` characters behind ``i``."""
    length = len(word) + 1 - skipped
    if length <= NAME_CHARS:
        return lambda i: f"{word[i + skipped :]}${word[:i]}"
    before, power = [0], [1]
    for character in word:
        before.append((before[-1] * _BASE + ord(character)) % _PRIME)
        power.append(power[-1] * _BASE % _PRIME)

    def name(i: int) -> str:
        after = before[-1] - before[i + skipped] * power[len(word) - i - skipped]
        mixed = ((after * _BASE + ord("$")) * power[i] + before[i]) % _PRIME
        return f"$${length}:{mixed:x}"

    return name


def _filed(words: DataFrame) -> DataFrame:
    """``name``, ``place`` and ``role`` of every rotation of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        places: list[int] = []
        roles: list[int] = []

        def batch() -> pa.RecordBatch:
            columns = [
                pa.array(names, pa.string()),
                pa.array(places, pa.int64()),
                pa.array(roles, pa.int32()),
            ]
            for values in (names, places, roles):
                values.clear()
            return pa.RecordBatch.from_arrays(columns, names=["name", "place", "role"])

        for given in batches:
            for word, place in zip(*(c.to_pylist() for c in given.columns), strict=True):
                for name, role in rotations(word):
                    names.append(name)
                    places.append(place)
                    roles.append(role)
                    if len(names) >= BATCH_ROWS:
                        yield batch()
        yield batch()

    return words.select("word", "place").mapInArrow(run, "name string, place bigint, role int")


def scan(new: np.ndarray, place: np.ndarray, role: np.ndarray) -> tuple:
    """Place, number of near words and place of the best of them, for the words of groups.

    ``new`` is true where a group begins. Places rise within a group; lower is better.
    A pair of which one word has a character more meets under each of the equal
    neighbours of that character, and counts under the first.
    """
    starts = np.flatnonzero(new)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3
    group = np.cumsum(new) - 1
    at = np.arange(len(place))
    none = len(place)
    whole, edited = role == WHOLE, role == EDITED
    longer = ~whole
    least = lambda mask: np.minimum.reduceat(np.where(mask, at, none), starts)
    total = lambda mask: np.add.reduceat(mask.astype(np.int64), starts)
    first, shorter, first_edited = least(longer), least(whole), least(edited)
    second = least(longer & (at != first[group]))
    best = np.where(at == first[group], second[group], first[group])
    best = np.where(edited, np.minimum(best, shorter[group]), best)
    best = np.where(whole, first_edited[group], best)
    near = total(longer)[group] - 1 + edited * total(whole)[group]
    near = np.where(whole, total(edited)[group], near)
    found = near > 0
    return place[found], near[found], place[best[found]]


def _scanned(filed: DataFrame) -> DataFrame:
    """``place``, ``near`` and ``best`` for each group of rotations and word in it."""
    ordered = filed.repartitionByRange("name").sortWithinPartitions("name", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            names = table.column("name").combine_chunks()
            new = np.ones(len(names), bool)
            new[1:] = pc.not_equal(names[1:], names[:-1]).to_numpy(zero_copy_only=False)
            # The last group may go on in the next batch.
            last = int(np.flatnonzero(new)[-1])
            yield result(table.slice(0, last), new[:last])
            rest = table.slice(last)
        if rest is not None:
            new = np.zeros(rest.num_rows, bool)
            new[0] = True
            yield result(rest, new)

    def result(table: pa.Table, new: np.ndarray) -> pa.RecordBatch:
        found = scan(new, table.column("place").to_numpy(), table.column("role").to_numpy())
        columns = [pa.array(values, pa.int64()) for values in found]
        return pa.RecordBatch.from_arrays(columns, names=["place", "near", "best"])

    return ordered.mapInArrow(run, "place bigint, near bigint, best bigint")


def _roots(forms: DataFrame) -> DataFrame:
    """``place`` and ``root``, the last word that forms lead to, of each word with a form.

    The steps that a word looks ahead double in each round. Occurrences at least double
    with each form, so that chains, and rounds all the more, are few.
    """
    ahead = materialize(forms.select("place", F.col("form_place").alias("root")), "roots")
    while True:
        other = ahead.select(F.col("place").alias("at"), F.col("root").alias("further"))
        moved = ahead.join(other, ahead["root"] == other["at"], "left")
        moved = materialize(moved.select("place", "root", "further"), "roots")
        ahead = moved.select("place", F.coalesce("further", "root").alias("root"))
        if moved.filter(F.col("further").isNotNull()).isEmpty():
            return ahead


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word of ``docs``: ``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root``.

    Words are runs of letters of whole texts with A-Z in lower case, some of which have
    lost a character (see ``damaged``), that have at least ``LEAST_CHARS`` characters
    and ``LEAST_COUNT`` occurrences ``n``. ``n_near`` counts the words one edit away, ``form``
    is that with the most occurrences (ties: the smallest) if it has ``FORM_FACTOR`` times
    those of the word, and ``root`` is where forms end, or the word itself.

    A text that is null or empty, or has no run long enough, has no words. A null ``key`` stands
    as nothing before the colon of a checksum. Repeated rows count each. Other columns
    play no part. Without words there are no rows. Words may be of any length.
    """
    words = numbered(word_counts(docs, key, text), [F.desc("n"), "word"], "place", "words")
    near = _scanned(_filed(words)).groupBy("place").agg(
        F.sum("near").alias("n_near"), F.min("best").alias("best")
    )
    near = materialize(near, "near-words")
    best = words.select(F.col("place").alias("best"), F.col("n").alias("best_n"))
    often = F.col("best_n") >= FORM_FACTOR * F.col("n")
    forms = (
        near.join(words.select("place", "n"), "place")
        .join(best, "best")
        .select("place", "n_near", F.when(often, F.col("best")).alias("form_place"))
    )
    forms = materialize(forms, "forms")
    roots = _roots(forms.filter(F.col("form_place").isNotNull()))
    named = lambda name: words.select(
        F.col("place").alias(f"{name}_place"), F.col("word").alias(name), F.col("n").alias(f"{name}_n")
    )
    return (
        words.join(forms, "place", "left")
        .join(roots.withColumnRenamed("root", "root_place"), "place", "left")
        .join(named("form"), "form_place", "left")
        .join(named("root"), "root_place", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            "form",
            "form_n",
            F.coalesce("root", "word").alias("root"),
        )
    )
