"""Whole texts in tasks: Arrow batches cut into pieces of bounded size, and words as arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Bytes of text that a task looks at together; a longer text stands alone.
PIECE_BYTES = 500_000

# Bytes of rows that Spark hands to a Python task at once.
BATCH_BYTES = 2_000_000
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

# The ASCII white space that separates words.
SPACES = b" \t\n\x0b\x0c\r"


def free_prefix(columns: list[str]) -> str:
    """Underscores that no column's name starts with, for columns that come and go."""
    prefix = "_"
    while any(name.startswith(prefix) for name in columns):
        prefix += "_"
    return prefix


def small_batches(spark: SparkSession) -> None:
    """Lowers the size of the Arrow batches of ``spark`` to ``BATCH_BYTES``, where it is larger.

    Spark's own limit is mostly the number of rows, so that a batch of whole texts is as large as
    the task's input, and stands several times in the executor: being built, sent and read.
    Results do not depend on it. The setting stays, since a lazy result is computed later.
    """
    told = spark.conf.get(BATCH_SETTING)
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if in_bytes(told) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def give_back() -> None:
    """Returns memory that this process has freed to the system.

    Spark uses a Python worker for one task after another, of any query. What its allocators
    keep of the largest task counts for the executor as long as the worker lives.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def pieces(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of at most ``PIECE_BYTES`` of text, or of one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string())
        sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1])
        start, size = 0, 0
        for row, n in enumerate(sizes):
            if size and size + n > PIECE_BYTES:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += int(n)
        yield batch.slice(start)


def map_texts(
    df: DataFrame, keep: list[str], text: str, function: Callable, added: dict[str, str]
) -> DataFrame:
    """``keep`` and the columns of ``added`` (name to type), one row for each row of ``df``.

    ``function`` gets a list of texts (null: empty) and returns one list or array of
    values per added column. Columns of ``df`` that have the name of an added one
    are not kept.
    """
    keep = [name for name in keep if name not in added]
    chosen = df.select(*keep, *([] if text in keep else [text]))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name in keep]
    schema = ", ".join([*fields, *(f"`{name}` {kind}" for name, kind in added.items())])
    kinds = [_arrow(kind) for kind in added.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What the task before has left is free only by now.
        give_back()
        for piece in pieces(batches, text):
            texts = [x or "" for x in piece.column(piece.schema.get_field_index(text)).to_pylist()]
            values = [
                v if isinstance(v, pa.Array) else pa.array(v, type=k)
                for v, k in zip(function(texts), kinds, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*piece.select(keep).columns, *values], names=[*keep, *added]
            )
        give_back()

    return chosen.mapInArrow(run, schema)


def _arrow(kind: str) -> pa.DataType:
    if kind.startswith("array<"):
        return pa.list_(_arrow(kind[6:-1]))
    return {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "float": pa.float32(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
    }[kind]


def _weights() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 2**63, 1 << 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_STATE: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word of all texts in order, and the number of words of each text.

    Words are the runs of anything but ASCII white space. The hash depends on the
    word alone.
    """
    if "weights" not in _STATE:
        _STATE["weights"] = _weights()
        table = np.zeros(256, bool)
        table[list(SPACES)] = True
        _STATE["space"] = table
    weights, space = _STATE["weights"], _STATE["space"]
    encoded = [text.encode("utf-8", "surrogatepass") for text in texts]
    # A space after each text ends its last word.
    data = np.frombuffer(b" ".join([*encoded, b""]), np.uint8)
    sizes = np.array([len(x) + 1 for x in encoded], np.int64)
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    blank = space[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank]).view(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    if len(starts) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    lengths = ends - starts
    letters = data[~blank].astype(np.uint64) + np.uint64(1)
    first = np.cumsum(lengths) - lengths
    position = np.arange(len(letters)) - np.repeat(first, lengths)
    letters *= weights[position & 0xFFFF]
    hashes = np.add.reduceat(letters, first) + lengths.astype(np.uint64)
    text_ends = np.cumsum(sizes)
    counts = np.diff(np.searchsorted(starts, text_ends), prepend=0)
    return mix(hashes), counts
