"""Near-duplicate texts by DartMinHash signatures in bands.

A text is a weighted set: its shingles of five words, in lower case, each weighted by
how often it occurs. Similarity is the weighted Jaccard of two such sets. Every shingle
owns a random rain of darts over the plane of weight and rank, the same in every text;
a text holds the darts that fall below its weight of the shingle and below a rank that
lets through enough darts whatever its size. Each dart belongs to one of ``DARTS``
coordinates; the dart of least rank in each is the signature. Two texts agree in a
coordinate with the probability of their similarity.

Texts that agree in a band of coordinates are compared, whole and exactly. To do so
without all pairs of a large bucket, the texts of a bucket are first compared with one
of them. Only where that leaves several components are texts of different components
compared with each other, in tiles of bounded size. A tile looks only at pairs that share
one of their rarest shingles, without which they could not be similar, and gives
back no more links than it takes to connect what is similar.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlgrid.llm.components import connected_components
from marlgrid.llm.sieve import sieve
from marlgrid.llm.texts import map_texts, mix, word_hashes
from marlgrid.sources.scratch import materialize

SHINGLE = 5
DARTS = 64
ROWS_PER_BAND = 4

# Darts per text that leave a coordinate empty in one text of eight; those are thrown again.
THROWN = DARTS * (math.log(DARTS) + 2)
# Texts whose darts are thrown together.
BLOCK = 1_024

# Texts of a tile on either side, their shingles with all repeats, in the mean, and pairs
# that are compared together.
TILE_LEFT, TILE_RIGHT = 256, 1_024
WEIGHT_LEFT, WEIGHT_RIGHT = 250_000, 1_000_000
PAIRS = 2_000

# Bytes of text whose pairs are compared together.
PAIR_BYTES = 2_000_000

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes | None]]:
    """Hash, weight and text number of every distinct shingle, and a digest of each text's words.

    A text of fewer than ``SHINGLE`` words has them all as its one shingle. A text
    without words has no shingle and no digest.
    """
    hashes, counts = word_hashes([text.lower() for text in texts])
    ends = np.cumsum(counts)
    digests = [
        hashlib.blake2b(hashes[e - n : e].tobytes(), digest_size=16).digest() if n else None
        for e, n in zip(ends, counts, strict=True)
    ]
    width = np.minimum(counts, SHINGLE)
    per_text = np.where(counts > 0, counts - width + 1, 0)
    owner = np.repeat(np.arange(len(texts)), per_text)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    at += (ends - counts)[owner]
    whole = np.zeros(len(owner), np.uint64)
    short = width[owner]
    for i in range(SHINGLE):
        inside = short > i
        word = hashes[np.minimum(at + i, max(len(hashes) - 1, 0))] if len(hashes) else whole
        whole = np.where(inside, mix(whole * np.uint64(31) + word + np.uint64(i)), whole)
    # Equal shingles of one text come together by a hash that differs between texts.
    marked = whole ^ (owner.astype(np.uint64) * _GOLD)
    _, first, weight = np.unique(marked, return_index=True, return_counts=True)
    order = np.argsort(owner[first], kind="stable")
    first, weight = first[order], weight[order]
    return whole[first], weight, owner[first], digests


def _multiple(times: int, number: int) -> np.uint64:
    return np.uint64(times * number % 2**64)


def _uniform(hashes: np.ndarray) -> np.ndarray:
    return ((hashes >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def signatures(
    shingle: np.ndarray, weight: np.ndarray, owner: np.ndarray, n: int
) -> np.ndarray:
    """The ``DARTS`` darts of each of ``n`` texts; zeros for a text without shingles."""
    found = np.zeros((n, DARTS), np.uint32)
    total = np.bincount(owner, weight, minlength=n)
    thrown = THROWN
    left = total > 0
    while left.any():
        mine = left[owner]
        text, coordinate, rank, dart = _throw(
            shingle[mine], weight[mine], owner[mine], thrown / np.maximum(total, 1)
        )
        place = text * DARTS + coordinate
        order = np.lexsort((rank, place))
        place, dart = place[order], dart[order]
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])[: len(place)])
        full = np.bincount(place[first] // DARTS, minlength=n) == DARTS
        done = full[place[first] // DARTS]
        found.reshape(-1)[place[first][done]] = dart[first][done]
        # A text with an empty coordinate looks at more of the same rain.
        left &= ~full
        thrown *= 2
    return found


def _throw(shingle, weight, owner, below) -> tuple:
    """The darts of each text: its number, and each dart's coordinate, rank and name.

    The weight axis of a shingle is cut at 1, 2, 4, 8 and so on. In each part the ranks
    of darts are the arrivals of a Poisson process whose rate is the part's width.
    """
    darts: list[tuple] = []
    low, width, part = 0, 1, 0
    while True:
        own = np.flatnonzero(weight > low)
        if not len(own):
            break
        seed = mix(shingle[own] + _multiple(part + 1, 0x9E3779B97F4A7C15))
        limit = below[owner[own]]
        arrival = np.zeros(len(own))
        step = 0
        while len(own):
            name = mix(seed + _multiple(step + 1, 0xC2B2AE3D27D4EB4F))
            arrival = arrival - np.log(_uniform(name)) / width
            near = arrival < limit
            own, seed, limit, arrival, name = (x[near] for x in (own, seed, limit, arrival, name))
            other = mix(name)
            inside = low + _uniform(other) * width < weight[own]
            if inside.any():
                last = mix(other[inside])
                darts.append(
                    (
                        owner[own[inside]],
                        (last % np.uint64(DARTS)).astype(np.int64),
                        arrival[inside],
                        (last >> np.uint64(32)).astype(np.uint32),
                    )
                )
            step += 1
        low, width, part = low + width, low + width, part + 1
    if not darts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0), np.zeros(0, np.uint32)
    return tuple(np.concatenate(x) for x in zip(*darts, strict=True))


def _signed(texts: list[str]) -> list:
    """Digest, weight and band keys of each text."""
    digests: list = []
    totals: list = []
    keys: list = []
    for i in range(0, len(texts), BLOCK):
        block = texts[i : i + BLOCK]
        shingle, weight, owner, digest = shingles(block)
        sign = signatures(shingle, weight, owner, len(block))
        bands = sign.reshape(len(block), -1, ROWS_PER_BAND).astype(np.uint64)
        key = np.zeros(bands.shape[:2], np.uint64) + np.arange(1, bands.shape[1] + 1, dtype=np.uint64)
        for row in range(ROWS_PER_BAND):
            key = mix(key * np.uint64(0x100000001B3) + bands[:, :, row])
        digests += digest
        totals += np.bincount(owner, weight, minlength=len(block)).astype(np.int64).tolist()
        keys += list(key.view(np.int64))
    return [digests, totals, keys]


def similarities(
    left: list[str], right: list[str], digests: tuple[list[bytes], list[bytes]]
) -> np.ndarray:
    """The exact similarity of each pair of texts; -1 where a text is not the one meant."""
    n = len(left)
    one, two = shingles(left), shingles(right)
    meant = np.array(
        [a == c and b == d for a, b, c, d in zip(one[3], two[3], *digests, strict=True)], bool
    )
    totals = [np.bincount(x[2], x[1], minlength=n) for x in (one, two)]
    key = np.concatenate([x[0] ^ (x[2].astype(np.uint64) * _GOLD) for x in (one, two)])
    weight = np.concatenate([one[1], two[1]])
    owner = np.concatenate([one[2], two[2]])
    order = np.argsort(key, kind="stable")
    key, weight, owner = key[order], weight[order], owner[order]
    both = np.flatnonzero(key[1:] == key[:-1]) if len(key) else np.zeros(0, np.int64)
    shared = np.bincount(owner[both], np.minimum(weight[both], weight[both + 1]), minlength=n)
    union = totals[0] + totals[1] - shared
    return np.where(meant, shared / np.maximum(union, 1), -1.0)


def _checked(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``) whose texts have a similarity of ``least``.

    Pairs whose weights are too far apart to be similar are left out, and no others. Only
    the texts of the remaining ones move. A text that is part of very many pairs meets
    them in joins that adaptive execution can split.
    """
    facts = nodes.select("node", "weight")
    named = lambda df, side: df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])
    near = (
        pairs.join(named(facts, "a"), F.col("a") == F.col("a_node"))
        .join(named(facts, "b"), F.col("b") == F.col("b_node"))
        .filter(
            F.least("a_weight", "b_weight") >= (least - 1e-9) * F.greatest("a_weight", "b_weight")
        )
        .select("a", "b")
    )
    near = materialize(near, "candidate-pairs")
    met = (
        near.join(named(texts, "a"), F.col("a") == F.col("a_node"))
        .join(named(texts, "b"), F.col("b") == F.col("b_node"))
        .select("a", "b", "a_digest", "b_digest", "a_text", "b_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            size = np.array([0])
            for side in ("a_text", "b_text"):
                lengths = pc.binary_length(columns[side]).to_numpy(zero_copy_only=False)
                size = size + lengths
            part = np.cumsum(size) // PAIR_BYTES
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
            for start, stop in zip(edges, edges[1:], strict=False):
                if start == stop:
                    continue
                cut = {k: v.slice(start, stop - start) for k, v in columns.items()}
                lists = {k: cut[k].to_pylist() for k in ("a_text", "b_text", "a_digest", "b_digest")}
                found = similarities(
                    lists["a_text"], lists["b_text"], (lists["a_digest"], lists["b_digest"])
                )
                kept = pa.array(found >= least - 1e-12)
                yield pa.RecordBatch.from_arrays(
                    [cut["a"].filter(kept), cut["b"].filter(kept)], names=["a", "b"]
                )

    return materialize(met.mapInArrow(run, "a bigint, b bigint"), "similar-pairs")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.8
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``class_id`` and ``kept``.

    ``class_id`` is the smallest key that links lead to; two texts are linked if their
    similarity is at least ``least``. ``kept`` tells whether it is the row's own. Texts
    of the same words in the same order, whatever their case and white space, are one.
    A text that is null or has no word is linked with nothing, and kept. Rows that share a key
    and a text are one document, and all kept if it is. Rows without a key are compared like
    all others; they are not kept beside a row with a key. A class in which no row has a
    key has a null ``class_id``, and one of its rows is kept. Columns other than ``key`` are
    dropped. An empty table gives no rows.
    """
    docs = docs.select(
        F.col(key).alias("_id"), F.col(text).alias("_text"), F.xxhash64(text).alias("_hash")
    )
    signed = map_texts(
        docs,
        ["_id", "_hash"],
        "_text",
        _signed,
        {
            "digest": "binary",
            "weight": "bigint",
            "bands": "array<bigint>",
        },
    )
    # Rows have no names but their places, which writing them down fixes.
    signed = signed.withColumn("_row", F.monotonically_increasing_id())
    signed = materialize(signed, "signatures")
    classes = (
        signed.filter(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(
            F.min("_id").alias("least"),
            F.min("_row").alias("first_row"),
            # A row that the text can be read from again.
            F.min(F.struct("_hash", "_id")).alias("rep"),
            F.first("weight").alias("weight"),
            F.first("bands").alias("bands"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = materialize(classes, "text-classes")
    banded = classes.select("node", F.explode("bands").alias("band"))
    buckets = (
        banded.groupBy("band")
        .agg(F.min("node").alias("hub"), F.count("*").alias("size"))
        .filter("size > 1")
    )
    buckets = materialize(buckets, "buckets")
    # A band is a hash already. Most have one text, and need not move to learn that.
    shared, _ = sieve(banded, F.col("band"), buckets, F.col("band"))
    members = materialize(shared.join(buckets, "band"), "bucket-members")
    # From here on only texts that share a bucket with another one matter.
    nodes = classes.drop("bands").join(members.select("node").distinct(), "node")
    nodes = materialize(nodes, "member-classes")
    # Texts without a bucket are most of the corpus, and stay where they are.
    place = lambda of: F.xxhash64(f"{of}_hash", f"{of}_id")
    docs, _ = sieve(docs, place(""), nodes, place("rep."))
    meant = (F.col("rep._hash") == F.col("_hash")) & F.col("rep._id").eqNullSafe(F.col("_id"))
    texts = nodes.join(docs, meant).groupBy("node", "digest").agg(F.first("_text").alias("text"))
    texts = materialize(texts, "member-texts")
    spokes = members.filter("hub < node").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    links = _checked(spokes.distinct(), nodes, texts, least)
    links = _rest(members, links, nodes, texts, least)
    found = connected_components(links, "text-components")
    grouped = classes.select("node", "digest", "least", "first_row").join(found, "node", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "node"))
    smallest = grouped.groupBy("component").agg(
        F.min("least").alias("class_id"), F.min("first_row").alias("first_row")
    )
    by_digest = materialize(
        grouped.select("digest", "component").join(smallest, "component").drop("component"),
        "text-class-ids",
    )
    joined = signed.select("_id", "_row", "digest").join(by_digest, "digest", "left")
    wordless = F.col("digest").isNull()
    without_key = F.col("class_id").isNull()
    return joined.select(
        F.col("_id").alias(key),
        F.when(wordless, F.col("_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(wordless, True)
        .when(without_key, F.col("_row") == F.col("first_row"))
        .otherwise(F.col("class_id").eqNullSafe(F.col("_id")))
        .alias("kept"),
    )


def _rest(
    members: DataFrame, links: DataFrame, nodes: DataFrame, texts: DataFrame, least: float
) -> DataFrame:
    """``links`` and those between texts of a bucket that its hub does not connect."""
    components = connected_components(links, "hub-components")
    own = (
        members.filter("size > 2")
        .join(components, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    own = materialize(own, "bucket-components")
    # Buckets of a single component are done with. The others are few as a rule, and small
    # enough to be sent to the members, however many of those one band has.
    ends = own.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b"))
    hubs = own.filter("node = hub").select("band", F.col("component").alias("_hub"))
    hubs = materialize(hubs.join(ends.filter("a != b").select("band"), "band"), "open-hubs")
    # What is in the hub's component needs no comparison among itself.
    own = own.join(hubs, "band").withColumn("outside", F.col("component") != F.col("_hub"))
    own = own.join(nodes.select("node", "weight"), "node")
    own = materialize(own, "open-members")
    some = own.groupBy("band").agg(
        F.count_if("outside").alias("n_outside"),
        F.sum(F.when(F.col("outside"), F.col("weight"))).alias("weight_outside"),
        F.sum("weight").alias("weight_all"),
    )
    opened = materialize(
        own.select("band", "node", "size", "component", "outside")
        .join(some.filter("n_outside > 0"), "band"),
        "open-buckets",
    )
    rows, weight = opened.agg(F.count("*"), F.sum(F.col("weight_all") / F.col("size"))).first()
    if not rows:
        return links
    wanted = opened.select("node").distinct()
    full = map_texts(
        wanted.join(texts, "node"),
        ["node", "digest"],
        "text",
        _elements,
        {"_own": "binary", "elements": "array<bigint>"},
    )
    full = full.filter(F.col("_own") == F.col("digest")).select("node", "elements")
    full = materialize(full.dropDuplicates(["node"]), "open-elements")
    lots = 1 + max(rows // TILE_RIGHT, int(weight) // WEIGHT_RIGHT)
    found = _tiles(opened.join(full, "node"), lots, least)
    return links.unionByName(materialize(found, "tile-links"))


def _elements(texts: list[str]) -> list:
    """The digest of each text, and its shingles with every repeat as an element of its own.

    Two texts share as many elements as the smaller weights of their shingles add up to.
    """
    shingle, weight, owner, digests = shingles(texts)
    first = np.cumsum(weight) - weight
    repeat = np.arange(weight.sum()) - np.repeat(first, weight)
    elements = mix(np.repeat(shingle, weight) + repeat.astype(np.uint64) * _GOLD)
    ends = np.cumsum(np.bincount(owner, weight, minlength=len(texts))).astype(np.int64)
    parts = np.split(elements.view(np.int64), ends[:-1]) if len(texts) else []
    return [digests, parts]


def _tiles(opened: DataFrame, lots: int, least: float) -> DataFrame:
    """Links, as ``a`` and ``b``, that connect what is similar in each open bucket.

    The texts outside the hub's component are the left side of a bucket's tiles, all its
    texts the right side. Small buckets share ``lots`` tiles, and each of their texts is sent
    once for both sides.
    """
    parts = lambda n, most, weight, heaviest: F.greatest(
        F.ceil(F.col(n) / most), F.ceil(F.col(weight) / heaviest)
    )
    lefts = parts("n_outside", TILE_LEFT, "weight_outside", WEIGHT_LEFT)
    rights = parts("size", TILE_RIGHT, "weight_all", WEIGHT_RIGHT)
    small = (F.col("size") <= TILE_LEFT) & (F.col("weight_all") <= WEIGHT_LEFT)
    mine = F.xxhash64("node")
    tile = F.when(small, F.pmod(F.xxhash64("band"), F.lit(lots))).otherwise(F.col("band"))
    sides = []
    for left in (True, False):
        rows = opened.filter(F.col("outside") & ~small) if left else opened
        own = F.pmod(mine, lefts if left else rights)
        others = F.sequence(F.lit(0).cast("bigint"), (rights if left else lefts) - 1)
        rows = rows.select(
            tile.alias("tile"),
            small.alias("small"),
            own.alias("row" if left else "column"),
            F.explode(others).alias("column" if left else "row"),
            (F.lit(left) | (small & F.col("outside"))).alias("left"),
            F.lit(not left).alias("right"),
            "band",
            "node",
            "component",
            "elements",
        )
        sides.append(rows)

    def run(table: pa.Table) -> pa.Table:
        band, node, component = (
            table.column(k).to_numpy() for k in ("band", "node", "component")
        )
        left, right = (np.array(table.column(k).to_pylist(), bool) for k in ("left", "right"))
        lists = table.column("elements").combine_chunks()
        ends = np.cumsum(lists.value_lengths().to_numpy())
        elements = np.split(lists.flatten().to_numpy(), ends[:-1])
        links = []
        for bucket in np.split(np.argsort(band, kind="stable"), _edges(np.sort(band))):
            of = [bucket[left[bucket]], bucket[right[bucket]]]
            links += _bucket_links(of, node, component, elements, least)
        pairs = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    whole = sides[0].unionByName(sides[1])
    return whole.groupBy("tile", "small", "row", "column").applyInArrow(run, "a bigint, b bigint")


def _edges(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(ordered[1:] != ordered[:-1]) + 1


def _bucket_links(of, node, component, elements, least) -> list[tuple[int, int]]:
    """Links between left and right texts of a bucket that connect their components."""
    left, right = of
    if not len(left) or not len(right):
        return []
    sizes = [np.array([len(elements[i]) for i in side]) for side in of]
    light, heavy = np.minimum(sizes[0][:, None], sizes[1]), np.maximum(sizes[0][:, None], sizes[1])
    maybe = (component[left][:, None] != component[right]) & (light >= (least - 1e-9) * heavy)
    if not maybe.any():
        return []
    rows, columns = np.flatnonzero(maybe.any(axis=1)), np.flatnonzero(maybe.any(axis=0))
    sets = [[elements[i] for i in left[rows]], [elements[i] for i in right[columns]]]
    names, counts = np.unique(np.concatenate(sets[0] + sets[1]), return_counts=True)
    sorted_sets = [[np.sort(np.searchsorted(names, x)) for x in side] for side in sets]
    sharing = _rare_elements_shared(sorted_sets, counts, least)
    one, two = np.nonzero((sharing > 0) & maybe[np.ix_(rows, columns)])
    # Pairs that share more are likelier to be linked, which spares others.
    best = np.argsort(-sharing[one, two], kind="stable")
    one, two = one[best], two[best]

    # Texts that a link has connected already need no other.
    group = {int(c): int(c) for c in np.unique(component[np.concatenate(of)])}

    def root(c: int) -> int:
        while group[c] != c:
            c = group[c]
        return c

    code = np.concatenate([k * len(names) + x for k, x in enumerate(sorted_sets[1])])
    links = []
    for start in range(0, len(one), PAIRS):
        ends = [component[left[rows[i]]] for i in one[start : start + PAIRS]]
        others = [component[right[columns[j]]] for j in two[start : start + PAIRS]]
        apart = [root(int(a)) != root(int(b)) for a, b in zip(ends, others, strict=True)]
        i, j = (x[start : start + PAIRS][apart] for x in (one, two))
        for x, y in zip(*_similar(sorted_sets, i, j, code, len(names), least), strict=True):
            a, b = int(component[left[rows[x]]]), int(component[right[columns[y]]])
            if root(a) != root(b):
                group[max(root(a), root(b))] = min(root(a), root(b))
                links.append((int(node[left[rows[x]]]), int(node[right[columns[y]]])))
    return links


def _rare_elements_shared(sets: list[list[np.ndarray]], counts: np.ndarray, least) -> np.ndarray:
    """How many of their rarest elements left and right sets share.

    Of sets that share at least ``least`` of their union, each holds a shared element
    among as many of its rarest as can be missing from the other, and one more.
    """
    rarest = []
    for side in sets:
        firsts = []
        for x in side:
            n = len(x) - math.ceil(least * len(x) - 1e-9) + 1
            firsts.append(x[np.lexsort((x, counts[x]))][:n])
        owner = np.repeat(np.arange(len(side)), [len(x) for x in firsts])
        rarest.append((np.concatenate(firsts), owner))
    (left, left_of), (right, right_of) = rarest
    order = np.argsort(right, kind="stable")
    right, right_of = right[order], right_of[order]
    low, high = np.searchsorted(right, left, "left"), np.searchsorted(right, left, "right")
    sharing = np.zeros((len(sets[0]), len(sets[1])), np.int32)
    # The right texts of each element, one piece of left elements after another.
    for start in range(0, len(left), PAIRS):
        a, b = low[start : start + PAIRS], high[start : start + PAIRS]
        found = np.arange((b - a).sum()) + np.repeat(a - np.cumsum(b - a) + (b - a), b - a)
        pair = np.repeat(left_of[start : start + PAIRS], b - a) * len(sets[1]) + right_of[found]
        sharing += np.bincount(pair, minlength=sharing.size).reshape(sharing.shape)
    return sharing


def _similar(sets, i: np.ndarray, j: np.ndarray, code: np.ndarray, width: int, least) -> tuple:
    """Those of the pairs ``i``, ``j`` of left and right sets that are similar.

    ``code`` is, in order, the elements of the right sets, ``width`` apart per set.
    """
    if not len(i):
        return i, j
    own = [sets[0][x] for x in i]
    sizes = np.array([len(x) for x in own])
    sought = np.concatenate(own) + np.repeat(j * width, sizes)
    place = np.minimum(np.searchsorted(code, sought), len(code) - 1)
    pair = np.repeat(np.arange(len(i)), sizes)
    shared = np.bincount(pair[code[place] == sought], minlength=len(i))
    other = np.array([len(sets[1][y]) for y in j])
    near = shared >= (least - 1e-12) * (sizes + other - shared)
    return i[near], j[near]
