"""Quality by hierarchical empirical Bayes over hosts and paths.

A classifier over a document's own signs gives evidence: a log likelihood ratio of
being good. Grouped sums of the classifier's probabilities give the share of good
documents of each path, host and of all. A path's share is shrunk to its host's and a
host's to the global one, the more so the fewer documents it has; how much is learned
from how far shares differ between groups (method of moments). A document's posterior
is its path's shrunk share, its own part left out, combined with its evidence.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlgrid.llm.linear import fit_logistic, labelled_sample, logit
from marlgrid.llm.texts import free_prefix, map_texts, word_hashes
from marlgrid.sources.scratch import materialize

RIDGE = 1e-4
# Evidence of one document, in nats, is at most this.
MOST_EVIDENCE = 12.0
# Strength of shrinking: documents that the share of the group above stands for.
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 1e4
# From this posterior on a document is good.
THRESHOLD = 0.5

# Paths that are broadcast at most, about a hundred bytes each.
BROADCAST_PATHS = 50_000

# The classes of bytes that are counted.
CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t\n\x0b\x0c\r",
    "stop": b".,;:'\"()-",
    "shout": b"!?",
    "sign": b"#*$%&|<>~^_=+/\\@{}[]`",
}
SIGNALS = [
    "log_words",
    "word_length",
    *[f"share_{name}" for name in CLASSES if name != "lower"],
    "share_other",
    "distinct_words",
    "distinct_triples",
]


def signals(texts: list[str]) -> np.ndarray:
    """One row of ``SIGNALS`` per text, from the whole of it."""
    table = np.full(256, len(CLASSES), np.int64)
    for i, members in enumerate(CLASSES.values()):
        table[list(members)] = i
    encoded = [text.encode("utf-8", "surrogatepass") for text in texts]
    sizes = np.array([len(x) for x in encoded])
    row = np.repeat(np.arange(len(texts)), sizes)
    kinds = len(CLASSES) + 1
    data = np.frombuffer(b"".join(encoded), np.uint8)
    counts = np.bincount(row * kinds + table[data], minlength=len(texts) * kinds)
    counts = counts.reshape(len(texts), kinds)
    share = counts / np.maximum(sizes, 1)[:, None]
    hashes, words = word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), words)
    marked = hashes ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    triples = marked[:-2] * np.uint64(3) + marked[1:-1] * np.uint64(5) + marked[2:] * np.uint64(7)
    inside = owner[:-2] == owner[2:]
    spaces = list(CLASSES).index("space")
    return np.column_stack(
        [
            np.log1p(words),
            np.log1p((sizes - counts[:, spaces]) / np.maximum(words, 1)),
            share[:, 1:],
            _distinct(marked, owner, len(texts)),
            _distinct(triples[inside], owner[:-2][inside], len(texts)),
        ]
    )


def _distinct(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The share of distinct values of each owner; 1 for an owner without any."""
    _, first = np.unique(values, return_index=True)
    different = np.bincount(owner[first], minlength=n)
    total = np.bincount(owner, minlength=n)
    return np.where(total > 0, different / np.maximum(total, 1), 1.0)


class Evidence(NamedTuple):
    """A linear classifier over standardized signals, and the share that it was fitted at."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float


def learn(
    docs: DataFrame, labels: DataFrame, good: Column, key: str, text: str = "text"
) -> Evidence | None:
    """Fits the classifier on a sample of labelled rows, see ``labelled_sample``.

    None if there is no labelled text, or all labels are alike.
    """
    usable = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    usable = usable.filter(F.col("_text").isNotNull())
    told = labels.withColumnRenamed(key, "_id")
    sample = labelled_sample(usable, told, "_id", {"_good": good}, text="_text")
    number = F.xxhash64(F.col("_id"), F.lit(3)).alias("_number")

    def run(texts: list[str]) -> list[list]:
        return [signals(texts).tolist()]

    rows = map_texts(
        sample.select(number, "_good", "_text"), ["_number", "_good"], "_text", run, {"x": "array<double>"}
    )
    rows = sorted(tuple(row) for row in rows.collect())
    y = np.array([row[1] for row in rows], float)
    if not len(y) or y.min() == y.max():
        return None
    x = np.array([row[2] for row in rows])
    center, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    weights, bias = fit_logistic((x - center) / scale, y, RIDGE)
    return Evidence(center, scale, weights, bias, float(y.mean()))


def _strength(groups: DataFrame, total: str, n: str, mean: Column) -> float:
    """Documents that the mean above is worth, from how much shares vary beyond chance.

    ``groups`` has sums ``total`` over ``n`` documents and the ``mean`` of the group above.
    """
    share = F.col(total) / F.col(n)
    chance = mean * (1 - mean)
    row = groups.agg(
        F.sum(F.col(n) * F.pow(share - mean, 2)),
        F.sum(chance),
        F.sum(F.col(n) * chance),
    ).first()
    spread, expected, weight = (float(x or 0.0) for x in row)
    excess = spread - expected
    if excess <= 0 or weight <= 0:
        return MOST_STRENGTH
    return min(MOST_STRENGTH, max(LEAST_STRENGTH, weight / excess))


def group_shares(rated: DataFrame, host: str, path: str) -> tuple[DataFrame, dict[str, float]]:
    """Sums per path and its host, and the global share and strengths of shrinking.

    ``rated`` has one probability ``_p`` per document. A null host or path is a group of its own.
    """
    paths = rated.groupBy(F.col(host).alias("_host"), F.col(path).alias("_path")).agg(
        F.sum("_p").alias("_path_good"), F.count("*").alias("_path_n")
    )
    paths = materialize(paths, "paths")
    hosts = paths.groupBy("_host").agg(
        F.sum("_path_good").alias("_host_good"), F.sum("_path_n").alias("_host_n")
    )
    hosts = materialize(hosts, "hosts")
    good, n = hosts.agg(F.sum("_host_good"), F.sum("_host_n")).first()
    if not n:
        return paths.withColumns({"_host_good": F.lit(0.0), "_host_n": F.lit(0)}), {}
    share = good / n
    by_host = _strength(hosts, "_host_good", "_host_n", F.lit(share))
    both = paths.withColumnRenamed("_host", "_of").join(
        hosts, F.col("_of").eqNullSafe(F.col("_host"))
    )
    shrunk = (F.col("_host_good") + by_host * share) / (F.col("_host_n") + by_host)
    by_path = _strength(both, "_path_good", "_path_n", shrunk)
    both = materialize(both.drop("_of"), "path-shares")
    return both, {"share": share, "by_host": by_host, "by_path": by_path}


def _evidence_of(model: Evidence):
    """The function from texts to their evidence."""
    base = logit(np.array(model.prior))

    def run(texts: list[str]) -> list[np.ndarray]:
        x = (signals(texts) - model.center) / model.scale
        evidence = x @ model.weights + model.bias - base
        empty = np.array([not text.strip() for text in texts], bool)
        evidence = np.where(empty, -MOST_EVIDENCE, evidence)
        return [np.clip(evidence, -MOST_EVIDENCE, MOST_EVIDENCE)]

    return run


def rate(
    docs: DataFrame,
    model: Evidence | None,
    host: str,
    path: str,
    text: str = "text",
    prefix: str = "",
    keep: list[str] | None = None,
) -> DataFrame:
    """Adds ``evidence``, ``host_share``, ``path_share``, ``posterior`` and ``rejected`` to every row.

    The names start with ``prefix``. ``path`` names parts of a ``host``; both may be null,
    which is a group of its own. A text that is null, empty or white space has the
    least evidence. Without a model nothing is rejected and the numbers are null. Repeated
    rows are rated each; columns with the added names are replaced, all others kept, or those
    of ``keep``. A posterior that equals the threshold is good. An empty table stays empty.

    Evidence is computed once and written down with the kept columns. The shares are two
    grouped aggregates with map-side sums, so a host with most of the documents does
    no harm. Documents meet them by broadcast up to ``BROADCAST_PATHS`` paths. Beyond that
    rows of numbers do, in a join that adaptive execution can split, and what it gives
    is attached by row number, so that no text moves by a host.
    """
    names = ["evidence", "host_share", "path_share", "posterior"]
    added = [prefix + name for name in [*names, "rejected"]]
    kept = [name for name in (docs.columns if keep is None else keep) if name not in added]
    unknown = [F.lit(None).cast("double").alias(prefix + name) for name in names]
    unknown.append(F.lit(False).alias(prefix + "rejected"))
    if model is None:
        return docs.select(*kept, *unknown)
    inner = free_prefix([*docs.columns, *added])
    own = {name: inner + name for name in ("host", "path", "evidence", "p", "row")}
    base = float(logit(np.array(model.prior)))
    docs = docs.withColumns({own["host"]: F.col(host), own["path"]: F.col(path)})
    rated = map_texts(
        docs, [*kept, own["host"], own["path"]], text, _evidence_of(model), {own["evidence"]: "double"}
    )
    p = 1 / (1 + F.exp(-(F.col(own["evidence"]) + base)))
    rated = rated.withColumns({own["p"]: p, own["row"]: F.monotonically_increasing_id()})
    rated = materialize(rated, "evidence")
    grouped = rated.select(F.col(own["p"]).alias("_p"), own["host"], own["path"])
    shares, world = group_shares(grouped, own["host"], own["path"])
    if not world:
        return docs.select(*kept, *unknown)
    facts = shares.withColumnsRenamed({c: f"{inner}of{c}" for c in shares.columns})
    met = rated[own["host"]].eqNullSafe(facts[f"{inner}of_host"]) & rated[own["path"]].eqNullSafe(
        facts[f"{inner}of_path"]
    )

    def judged(rows: DataFrame) -> list[Column]:
        # What a document says itself is its evidence; its group speaks without it.
        fact = lambda name: rows[f"{inner}of_{name}"]
        within = lambda share: F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), share))
        by_host, by_path = world["by_host"], world["by_path"]
        p, evidence = rows[own["p"]], rows[own["evidence"]]
        host_share = within(
            (fact("host_good") - p + by_host * world["share"]) / (fact("host_n") - 1 + by_host)
        )
        path_share = within(
            (fact("path_good") - p + by_path * host_share) / (fact("path_n") - 1 + by_path)
        )
        posterior = 1 / (1 + F.exp(-(F.log(path_share / (1 - path_share)) + evidence)))
        found = [evidence, host_share, path_share, posterior, posterior < THRESHOLD]
        return [c.alias(name) for c, name in zip(found, added, strict=True)]

    if shares.count() <= BROADCAST_PATHS:
        rows = rated.join(F.broadcast(facts), met, "left")
        return rows.select(*kept, *judged(rows))
    narrow = rated.select(*own.values()).join(facts, met, "left")
    verdicts = materialize(narrow.select(own["row"], *judged(narrow)), "verdicts")
    return rated.select(*kept, own["row"]).join(verdicts, own["row"]).select(*kept, *added)
