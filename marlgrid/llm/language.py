"""Language of a text by string kernels.

The kernel of two texts is the number of character n-grams, of every length up to
``LONGEST``, that occur in both (a blended spectrum of presence bits), divided by the
geometric mean of the two texts' own numbers. N-grams are hashed to ``BUCKETS`` buckets,
so many that a long text in a large script fills a small part of them. A text is the
list of its buckets, and is compared with landmarks through the buckets these have. A
Nyström map over landmark texts makes features of the kernel, and one-versus-rest ridge
regression over the features gives a margin per language.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlgrid.llm.texts import map_texts
from marlgrid.sources.scratch import materialize

LONGEST = 3
BUCKET_BITS = 22
BUCKETS = 1 << BUCKET_BITS

# Texts per language that the model is fitted on, in the mean, and the landmarks among
# them; and the most of all languages, which share them if there are many.
TRAIN_TEXTS, ALL_TEXTS = 400, 25_600
LANDMARKS, ALL_LANDMARKS = 40, 1_280
# Buckets of a landmark. Texts that have more are landmarks only where a language has too
# few others, and are then represented by their smallest buckets, a sample by hash.
LANDMARK_BUCKETS = 1 << 14

RIDGE = 1e-3

# Texts that are scored together, and characters of one that are looked at together.
BLOCK = 256
SEGMENT = 1 << 19

# Buckets shared by texts and landmarks that are counted together.
SHARED = 1 << 20

HASH_RANGE = 1 << 30

_TABLES: dict[str, np.ndarray] = {}


def _letters(codes: np.ndarray) -> np.ndarray:
    """Which code points are letters, or marks, such as vowel signs, that belong to letters."""
    if "letters" not in _TABLES:
        points = map(chr, range(0x110000))
        _TABLES["letters"] = np.array([c.isalpha() or unicodedata.category(c)[0] == "M" for c in points])
    return _TABLES["letters"][codes]


def has_letters(text: str) -> bool:
    """Whether there is anything to tell a language by."""
    return any(map(str.isalpha, text))


def _codes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letters(codes), codes, 0)


def _grams(codes: np.ndarray, part: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The buckets of the n-grams of code points, in order, with their row above; 0 is a space.

    No n-gram reaches from one part into another.
    """
    found = []
    hashes = codes * np.uint32(0x9E3779B1)
    for n in range(1, LONGEST + 1):
        if n > 1:
            hashes = (hashes[:-1] * np.uint32(0x85EBCA6B)) ^ (codes[n - 1 :] * np.uint32(0xC2B2AE35))
        spread = (hashes ^ (hashes >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
        spread ^= spread >> np.uint32(13)
        bucket = (spread * np.uint32(0x297A2D39)) >> np.uint32(32 - BUCKET_BITS)
        same = part[: len(part) - n + 1] == part[n - 1 :]
        inside = same & ((codes[: len(same)] > 0) | (n > 1))
        found.append((row[n - 1 :][inside] << BUCKET_BITS) + bucket[inside])
    return np.unique(np.concatenate(found))


def _keys(texts: Sequence[str], rows: Sequence[int]) -> np.ndarray:
    """The n-grams of whole texts, see ``_grams``, with the row given for each."""
    # Runs of anything but letters count as one space, as does each end of a text.
    codes = _codes("".join([f" {text} " for text in texts]))
    part = np.repeat(np.arange(len(texts)), [len(text) + 2 for text in texts])
    starts = np.cumsum([0, *(len(text) + 2 for text in texts[:-1])])
    kept = (codes > 0) | np.concatenate([[True], codes[:-1] > 0])
    kept[starts] = True
    return _grams(codes[kept], part[kept], np.asarray(rows)[part[kept]])


def _long_keys(text: str, row: int) -> np.ndarray:
    """The same of one long text, piece by piece; a piece goes on from the end of the last one."""
    found = []
    before = np.zeros(1, np.uint32)
    for start in range(0, len(text), SEGMENT):
        codes = _codes(text[start : start + SEGMENT] + " " * (start + SEGMENT >= len(text)))
        codes = codes[(codes > 0) | (np.concatenate([before[-1:], codes[:-1]]) > 0)]
        codes = np.concatenate([before, codes])
        if len(codes) >= LONGEST or start + SEGMENT >= len(text):
            # Spaces behind the last word make no n-gram beyond the first of them.
            found.append(_grams(codes, np.zeros(len(codes), int), np.full(len(codes), row)))
            before = codes[-(LONGEST - 1) :]
        else:
            before = codes
    return np.unique(np.concatenate(found))


def buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of all texts, text by text and in order, and the text of each."""
    found = []
    few: list[str] = []
    rows: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        text = text.lower()
        if len(text) > SEGMENT:
            found.append(_long_keys(text, i))
            continue
        few.append(text)
        rows.append(i)
        size += len(text)
        if size > SEGMENT:
            found.append(_keys(few, rows))
            few, rows, size = [], [], 0
    if few:
        found.append(_keys(few, rows))
    keys = np.zeros(0, np.int64)
    if found:
        keys = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
    return keys & (BUCKETS - 1), keys >> BUCKET_BITS


def _normalized(shared: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return shared / np.maximum(np.sqrt(np.outer(left, right)), 1.0)


class Landmarks:
    """Lists of buckets, and for each bucket the landmarks that have it."""

    def __init__(self, lists: Sequence[np.ndarray]):
        self.sizes = np.array([len(x) for x in lists])
        every = np.concatenate(lists)
        owner = np.repeat(np.arange(len(lists)), self.sizes)
        order = np.argsort(every, kind="stable")
        self.owner = owner[order]
        self.has, counts = np.unique(every, return_counts=True)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.place = np.full(BUCKETS, -1, np.int32)
        self.place[self.has] = np.arange(len(self.has))

    def kernel(self, bucket: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """The normalized kernel between ``n`` rows of distinct buckets and the landmarks."""
        own = np.bincount(row, minlength=n)
        place = self.place[bucket]
        place, row = place[place >= 0], row[place >= 0]
        low, width = self.first[place], self.first[place + 1] - self.first[place]
        shared = np.zeros(n * len(self.sizes), np.int64)
        part = np.cumsum(width) // SHARED
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1), len(place)]
        for start, stop in zip(edges, edges[1:], strict=False):
            many = width[start:stop]
            at = np.arange(many.sum()) + np.repeat(low[start:stop] - np.cumsum(many) + many, many)
            cell = np.repeat(row[start:stop] * len(self.sizes), many) + self.owner[at]
            # The rows of a part follow each other.
            least = row[start] * len(self.sizes) if stop > start else 0
            counted = np.bincount(cell - least)
            shared[least : least + len(counted)] += counted
        return _normalized(shared.reshape(n, -1), own, self.sizes)


class LanguageModel(NamedTuple):
    """``landmarks`` are lists of buckets; ``weights`` lead from their kernel values to margins."""

    languages: list[str]
    landmarks: list[np.ndarray]
    weights: np.ndarray
    bias: np.ndarray

    def margins(self, values: np.ndarray) -> np.ndarray:
        """One margin per text and language, about 1 for the language and -1 for others."""
        return values @ self.weights + self.bias


def fit(
    values: np.ndarray, labels: Sequence[str], landmarks: list[np.ndarray]
) -> LanguageModel:
    """Kernel ridge regression, one language against the rest.

    ``values`` are the kernel between the texts of ``labels`` and ``landmarks``.
    """
    languages, of = np.unique(np.array(labels, object), return_inverse=True)
    marks = Landmarks(landmarks)
    among = marks.kernel(
        np.concatenate(landmarks), np.repeat(np.arange(len(landmarks)), marks.sizes), len(landmarks)
    )
    scales, vectors = np.linalg.eigh(among.astype(np.float64))
    large = scales > 1e-6 * scales[-1]
    nystrom = vectors[:, large] / np.sqrt(scales[large])
    features = values @ nystrom
    # Languages count alike, however many texts each has.
    share = 1.0 / np.bincount(of)[of]
    share /= share.sum()
    center, level = share @ features, 2.0 / len(languages) - 1.0
    moved = features - center
    gram = moved.T @ (moved * share[:, None]) + RIDGE * np.eye(features.shape[1])
    # Targets are 1 for the language and -1 for others, less their mean.
    order = np.argsort(of, kind="stable")
    starts = np.searchsorted(of[order], np.arange(len(languages)))
    targets = 2.0 * np.add.reduceat((moved * share[:, None])[order], starts)
    solved = np.linalg.solve(gram, targets.T)
    return LanguageModel(
        languages.tolist(),
        landmarks,
        (nystrom @ solved).astype(np.float32),
        (level - center @ solved).astype(np.float32),
    )


def learn(
    docs: DataFrame, key: str, learn_from: Column, text: str = "text", lang: str = "lang"
) -> LanguageModel | None:
    """Fits a model on rows of ``docs`` for which ``learn_from`` holds and ``lang`` is not null.

    Rows are drawn by a hash of ``key``, about ``TRAIN_TEXTS`` of each language. All
    languages found share ``ALL_TEXTS`` and ``ALL_LANDMARKS`` alike, with one text of each at
    least; of several texts of one key and language one is taken. Only the landmarks' buckets
    and kernel values come to the driver. None if there is nothing to learn from.
    """
    usable = docs.filter(learn_from & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = materialize(usable.groupBy(F.col(lang).alias("_lang")).count(), "languages")
    n = counts.count()
    if not n:
        return None
    texts = min(TRAIN_TEXTS, max(1, ALL_TEXTS // n))
    marks = min(LANDMARKS, max(1, ALL_LANDMARKS // n))
    # Of a small share more are drawn, lest a language has none.
    tried = texts if texts == TRAIN_TEXTS else texts + 5 * texts**0.5 + 20
    below = F.least(F.lit(float(HASH_RANGE)), F.lit(HASH_RANGE * tried) / F.col("count"))
    limits = counts.select("_lang", below.alias("_below"))
    number = F.pmod(F.xxhash64(F.col(key), F.lit(1)), F.lit(HASH_RANGE))
    drawn = (
        usable.select(F.col(key).alias("_key"), number.alias("_number"), F.col(lang).alias("_of"), F.col(text).alias("_text"))
        .join(F.broadcast(limits), F.col("_of") == F.col("_lang"))
        .filter("_number < _below")
        .groupBy("_key", "_number", "_lang")
        .agg(F.min_by("_text", F.md5("_text")).alias("_text"))
    )
    drawn = materialize(drawn, "language-texts")

    def buckets_of(texts: list[str]) -> list[list]:
        found = [buckets([text])[0] if has_letters(text) else [] for text in texts]
        cut = [np.array(x[:LANDMARK_BUCKETS], np.int32).tobytes() for x in found]
        return [cut, [len(x) > LANDMARK_BUCKETS for x in found]]

    added = {"buckets": "binary", "long": "boolean"}
    told = map_texts(drawn, ["_number", "_lang"], "_text", buckets_of, added)
    told = materialize(told.filter(F.length("buckets") > 0), "language-buckets")
    by_number = Window.partitionBy("_lang").orderBy("long", "_number", "buckets")
    ranked = told.withColumn("_rank", F.row_number().over(by_number)).filter(F.col("_rank") <= marks)
    rows = ranked.orderBy("_rank", "_lang").limit(ALL_LANDMARKS).collect()
    if not rows:
        return None
    landmarks = [np.frombuffer(row["buckets"], np.int32) for row in rows]
    held, against = landmarks, []

    def values_of(texts: list[str]) -> list[list[bytes]]:
        if not against:
            against.append(Landmarks(held))
        found = []
        for i in range(0, len(texts), BLOCK):
            block = texts[i : i + BLOCK]
            bucket, row = buckets(block)
            values = against[0].kernel(bucket, row, len(block)).astype(np.float32)
            found += [
                v.tobytes() if has_letters(x) else None for v, x in zip(values, block, strict=True)
            ]
        return [found]

    rated = map_texts(drawn, ["_number", "_lang"], "_text", values_of, {"values": "binary"})
    rated = materialize(rated.filter(F.col("values").isNotNull()), "language-values")
    by_number = Window.partitionBy("_lang").orderBy("_number", "values")
    rated = rated.withColumn("_rank", F.row_number().over(by_number))
    if texts < TRAIN_TEXTS:
        rated = rated.filter(F.col("_rank") <= texts)
    rows = sorted(rated.collect(), key=lambda row: (row["_number"], row["_lang"], bytes(row["values"])))
    values = np.array([np.frombuffer(row["values"], np.float32) for row in rows])
    return fit(values, [row["_lang"] for row in rows], landmarks)


def identify(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to every row of ``docs``, from the whole ``text`` alone.

    ``score`` is the margin of the language, brought to 0 to 1. A text that is null,
    empty or without a letter gets ``und`` and 0; so does every text if there is no
    model. Ties go to the language that sorts first. Repeated rows are judged each;
    columns with those two names are replaced. No row moves between tasks. An empty table
    stays empty.
    """
    against: list[Landmarks] = []

    def judge(texts: list[str]) -> list[list]:
        names: list[str] = []
        scores: list[float] = []
        if model is None:
            return [["und"] * len(texts), [0.0] * len(texts)]
        if not against:
            against.append(Landmarks(model.landmarks))
        for i in range(0, len(texts), BLOCK):
            block = texts[i : i + BLOCK]
            bucket, row = buckets(block)
            told = np.array([has_letters(x) for x in block], bool)
            margins = model.margins(against[0].kernel(bucket, row, len(block)).astype(np.float32))
            best = margins.argmax(axis=1)
            score = np.clip((margins[np.arange(len(best)), best] + 1) / 2, 0.0, 1.0)
            names += [model.languages[b] if t else "und" for b, t in zip(best, told, strict=True)]
            scores += np.where(told, score, 0.0).tolist()
        return [names, scores]

    keep = [name for name in docs.columns if name != text]
    return map_texts(docs, keep, text, judge, {"lang_pred": "string", "score": "double"})
