"""Encoding and decoding with a byte-pair vocabulary, whole texts of any length.

Where a token never holds white space, a text is encoded word by word, and words that
a task meets again are not encoded again. What remains is long text that the
pre-tokenizer does not split: one run of letters or of signs may fill a document. It
is cut in halves down to leaves, the leaves are encoded in parallel, and neighbours are
joined from the bottom up. At each join the text around it is encoded anew, over a
window that grows until its tokens agree with those of both sides. Two tokens that
are neighbours in an encoding stay so whatever stands further away, hence the joined
list is the encoding of the whole run.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from marlgrid.llm.texts import map_texts

# Characters of a leaf, and tokens on either side of a join that are tried first.
LEAF_CHARS = 4_096
FIRST_WINDOW = 8

# A longer word is not kept for the next time it is met.
WORD_CHARS = 256
# Words kept by a task; the store is emptied when it is full.
KEPT_WORDS = 400_000

# Words that are encoded together, and ids that are decoded together.
PIECE_WORDS = 5_000
PIECE_IDS = 100_000

# The id of a token that a cut has made and that no vocabulary holds.
CUT = -1

Token = tuple[int, str]

# The expression that the pre-tokenizer of a word vocabulary cuts text with,
# and the same for lower-case ASCII text that has no apostrophe.
WORD_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_PARTS = re.compile(r"[a-z]+|[0-9]|[^a-z0-9\t-\r ]+")


class TreeEncoder:
    """Encodes texts exactly as ``tokenizer`` does without adding special tokens.

    ``tokenizer`` must mark the end of a word by a suffix, or not at all. Texts are cut
    into words before only if it is known to treat these apart (``splits_words``).
    """

    def __init__(self, tokenizer: Tokenizer, leaf: int = LEAF_CHARS, window: int = FIRST_WINDOW):
        tokenizer.no_padding()
        tokenizer.no_truncation()
        self.tokenizer = tokenizer
        self.model = Tokenizer(tokenizer.model)
        self.suffix = tokenizer.model.end_of_word_suffix or ""
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.words = _words if splits_words(tokenizer) else _whole
        self.leaf = leaf
        self.window = window
        self.clear()

    def clear(self) -> None:
        # Word to number; where a number's ids start in ``flat``.
        self.store: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and the number of ids of each text."""
        words = [self.words(text) for text in texts]
        if len(self.store) > KEPT_WORDS or len(self.flat) > 8 * KEPT_WORDS:
            self.clear()
        store = self.store
        new = [word for word in set().union(*words) if word not in store]
        short = [word for word in new if len(word) <= WORD_CHARS]
        long = [word for word in new if len(word) > WORD_CHARS]
        ids: list = []
        for i in range(0, len(short), PIECE_WORDS):
            piece = short[i : i + PIECE_WORDS]
            encoded = self.tokenizer.encode_batch_fast(piece, add_special_tokens=False)
            ids += [np.array(e.ids, np.int32) for e in encoded]
        ids += [self.encode_run(word) for word in long]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        first = len(self.starts) - 1
        self.flat = np.concatenate([self.flat, *ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        store.update(zip([*short, *long], range(first, first + len(ids)), strict=True))

        counts = np.fromiter(map(len, words), np.int64, len(words))
        number = np.fromiter(map(store.__getitem__, chain(*words)), np.int64, counts.sum())
        begin = self.starts[number]
        width = self.starts[number + 1] - begin
        ends = np.concatenate([[0], np.cumsum(width)])
        place = np.arange(ends[-1]) + np.repeat(begin - ends[:-1], width)
        of_text = ends[np.concatenate([[0], np.cumsum(counts)])]
        for word in long:
            del store[word]
        return self.flat[place], np.diff(of_text)

    def encode_run(self, word: str) -> np.ndarray:
        """The ids of text, however long."""
        if len(word) <= self.leaf or any(content in word for content in self.added):
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, np.int32)
        normal = self.tokenizer.normalizer.normalize_str(word) if self.tokenizer.normalizer else word
        ids = [np.zeros(0, np.int32)]
        for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
            ids.append(np.array([token[0] for token in self.encode_tree(part)], np.int32))
        return np.concatenate(ids)

    def encode_tree(self, part: str) -> list[Token]:
        """The tokens (id and characters) of text that the pre-tokenizer does not split."""
        pieces = 1
        while len(part) > pieces * self.leaf:
            pieces *= 2
        cuts = [len(part) * i // pieces for i in range(pieces + 1)]
        leaves = [part[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        lists = self._tokens(leaves, ends=True)
        while len(lists) > 1:
            last = len(lists) - 2
            lists = [
                self._join(lists[i], lists[i + 1], i == last) for i in range(0, len(lists), 2)
            ]
        return lists[0]

    def _tokens(self, texts: list[str], ends: bool) -> list[list[Token]]:
        # The model takes the end of what it gets for the end of a word. Only the last
        # text ends one, if ``ends``; elsewhere the last token is an artefact of the cut.
        lists = []
        for i, e in enumerate(self.model.encode_batch(texts, add_special_tokens=False)):
            characters = [token.removesuffix(self.suffix) for token in e.tokens]
            ids = e.ids
            if self.suffix and not (ends and i == len(texts) - 1):
                ids[-1] = CUT
            lists.append(list(zip(ids, characters, strict=True)))
        return lists

    def _join(self, left: list[Token], right: list[Token], ends: bool) -> list[Token]:
        """The tokens of the text of both; ``ends`` if it ends the word."""
        width = self.window
        while True:
            before, after = left[-width:], right[:width]
            start, stop = len(before) == len(left), len(after) == len(right)
            text = "".join(token[1] for token in before + after)
            middle = self._tokens([text], ends and stop)[0]
            if start or (middle[0] == before[0] and middle[0][0] != CUT):
                if stop:
                    return left[: len(left) - len(before)] + middle
                if meeting := _meeting(before, after, middle):
                    taken, passed = meeting
                    return left[: len(left) - len(before)] + middle[:taken] + right[passed:]
            width *= 2


def _meeting(before: list[Token], after: list[Token], middle: list[Token]) -> tuple | None:
    """How many tokens of ``middle`` and of ``after`` end with the first token they share."""
    at, ends = 0, {}
    for i, token in enumerate(middle):
        at += len(token[1])
        ends[at, token] = i + 1
    at = sum(len(token[1]) for token in before)
    for i, token in enumerate(after):
        at += len(token[1])
        if token[0] != CUT and (at, token) in ends:
            return ends[at, token], i + 1
    return None


def splits_words(tokenizer: Tokenizer) -> bool:
    """Whether white space separates words that ``tokenizer`` treats apart, as ``_words`` cuts them."""
    told = json.loads(tokenizer.to_str())
    normalizers = (told["normalizer"] or {}).get("normalizers", [])
    kinds = [x["type"] for x in normalizers]
    cutters = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        kinds == ["NFC", "Replace", "Lowercase"]
        and normalizers[1]["pattern"] == {"Regex": "\\s+"}
        and normalizers[1]["content"] == " "
        and [x["type"] for x in cutters] == ["Split", "ByteLevel"]
        and cutters[0]["pattern"] == {"Regex": WORD_PARTS}
        and (cutters[0]["behavior"], cutters[0]["invert"]) == ("Removed", True)
        and not cutters[1]["add_prefix_space"]
        and not cutters[1]["use_regex"]
        and all(
            token.content.startswith("<|") and not (token.normalized or token.lstrip or token.rstrip)
            for token in tokenizer.get_added_tokens_decoder().values()
        )
    )


def _whole(text: str) -> list[str]:
    return [text] if text else []


def _words(text: str) -> list[str]:
    """Parts of a text that the tokenizer treats apart from each other, without white space."""
    for space in "\n\t\r":
        text = text.replace(space, " ")
    if text.isascii() and "'" not in text and "<|" not in text:
        # The pre-tokenizer's own parts, for want of a contraction or a special token.
        return ASCII_PARTS.findall(text.lower())
    return [word for word in text.split(" ") if word]


def _threads() -> None:
    # As many threads as Spark gives a task, not as many as the machine has.
    os.environ.setdefault("RAYON_NUM_THREADS", os.environ.get("OMP_NUM_THREADS", "1"))


def encode(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """Adds ``ids`` (array of int) to every row of ``docs``, for the whole of ``text``.

    With ``decoded`` it also adds, under that name, what ``decode`` makes of them, in the
    same pass. ``path`` names a tokenizer file that every executor has. A null or
    empty text has no ids. Repeated rows are encoded each; columns that are called as the
    added ones are replaced. No row moves between tasks. An empty table stays empty.
    """
    made: list = []

    def run(texts: list[str]) -> list[pa.Array]:
        if not made:
            _threads()
            tokenizer = Tokenizer.from_file(path)
            made.extend([TreeEncoder(tokenizer), Decoder(tokenizer)])
        encoder, decoder = made
        values, counts = encoder.encode(texts)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
        return [lists, decoder.decode(lists)] if decoded else [lists]

    added = {ids: "array<int>"} | ({decoded: "string"} if decoded else {})
    return map_texts(docs, docs.columns, text, run, added)


class Decoder:
    """Makes text of lists of ids, exactly as ``tokenizer`` does with special tokens kept.

    A vocabulary without a decoder has its tokens joined by spaces, which Arrow does on
    whole columns. Other vocabularies, and ids that the vocabulary lacks, go to the library.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self.tokens = None
        if tokenizer.decoder is None:
            names = tokenizer.get_vocab(with_added_tokens=True)
            tokens = [None] * (max(names.values(), default=-1) + 1)
            for token, number in names.items():
                tokens[number] = token
            self.tokens = pa.array(tokens, pa.string())

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """The text of each list of ids; no text for a null list."""
        ids = lists.flatten()
        if self.tokens is not None and not ids.null_count:
            known = pc.and_(pc.greater_equal(ids, 0), pc.less(ids, len(self.tokens)))
            if pc.all(known).as_py() is not False:
                tokens = self.tokens.take(ids)
                if not tokens.null_count:
                    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    parts = pa.ListArray.from_arrays(pa.array(offsets), tokens)
                    return pc.binary_join(parts, " ")
        return self.by_library(lists)

    def by_library(self, lists: pa.ListArray) -> pa.Array:
        """The same by the library; rows with about ``PIECE_IDS`` ids go together."""
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(counts) // PIECE_IDS
        edges = [0, *(np.flatnonzero(np.diff(piece)) + 1), len(lists)]
        found = []
        for a, b in zip(edges, edges[1:], strict=False):
            part = [x or [] for x in lists.slice(a, b - a).to_pylist()]
            texts = self.tokenizer.decode_batch(part, skip_special_tokens=False)
            found.append(pa.array(texts, pa.string()))
        return pa.concat_arrays(found)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds ``text`` to every row: what the tokenizer makes of ``ids``, special tokens included.

    Null or empty ids give an empty text. A column that is called as ``text`` is replaced.
    """
    keep = [name for name in rows.columns if name != text]
    schema = rows.select(*keep).schema.add(text, "string")
    made: list[Decoder] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            _threads()
            made.append(Decoder(Tokenizer.from_file(path)))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            lists = batch.column(batch.schema.get_field_index(ids))
            yield pa.RecordBatch.from_arrays(
                [*batch.select(keep).columns, made[0].decode(lists)], names=[*keep, text]
            )

    return rows.mapInArrow(run, schema)
