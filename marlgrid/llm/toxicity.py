"""Toxicity by a chain of classifiers over the categories that documents are labelled with.

The categories are predicted one after the other. Each has a linear model over the
words, beginnings of words and runs of signs that tell it apart, and over the
probabilities of the categories before it. For fitting, those come from models that
have not seen the document (out-of-fold predictions), as they will for new documents.
Such a model chooses its terms, too, without the documents that it predicts, and copies
of one text are in one fold.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlgrid.llm.linear import fit_logistic, labelled_sample, logit, sigmoid
from marlgrid.llm.texts import map_texts
from marlgrid.sources.scratch import materialize

# Features per category, and labelled documents that must hold one.
FEATURES = 512
LEAST_DOCUMENTS = 5

FOLDS = 4
# The number of the model that is fitted on all folds.
WHOLE = FOLDS
RIDGE = 1e-3
# A document is in a category from the probability on that at most this share of those
# outside of it reach unseen, but not below the one and not above the other bound. The
# lower bound is below a half, since one abusive word in a long text counts.
FALSE_SHARE = 0.005
LEAST_THRESHOLD, MOST_THRESHOLD = 0.2, 0.5

BEGINNINGS = (4, 5, 6, 7)
TERM = re.compile(r"\w+|[^\w\s]+")


def words_of(text: str) -> set[str]:
    """The distinct words and runs of signs of a text, in lower case."""
    return set(TERM.findall(text.lower()))


def terms(text: str) -> set[str]:
    """What a text may be told by: its words, and their beginnings with a star."""
    words = words_of(text)
    found = set(words)
    for n in BEGINNINGS:
        found.update([word[:n] + "*" for word in words if len(word) > n])
    return found


class Category(NamedTuple):
    """A linear model: a weight per term, and per logit of each earlier category.

    ``decides`` tells whether reaching the threshold rejects a document.
    """

    name: str
    weights: dict[str, float]
    chained: list[float]
    bias: float
    threshold: float
    decides: bool


class Scorer:
    """The probability of each category of a chain for one text after another."""

    def __init__(self, chain: Sequence[Category]):
        self.chain = chain
        self.every = set().union(*(category.weights for category in chain))
        # A run of signs may itself end with a star.
        self.starts = {
            n: {t[:-1] for t in self.every if len(t) == n + 1 and t[-1] == "*"} for n in BEGINNINGS
        }

    def score(self, text: str) -> list[float]:
        """One probability per category; 0 for a text without any word or sign."""
        words = words_of(text)
        if not words:
            return [0.0] * len(self.chain)
        found = words & self.every
        for n in BEGINNINGS:
            starts = {word[:n] for word in words if len(word) > n} & self.starts[n]
            found |= {start + "*" for start in starts}
        logits: list[float] = []
        for category in self.chain:
            total = category.bias + sum(sorted(category.weights.get(term, 0.0) for term in found))
            total += sum(w * x for w, x in zip(category.chained, logits, strict=True))
            logits.append(min(30.0, max(-30.0, total)))
        return [1 / (1 + math.exp(-x)) for x in logits]


def _selected(rows: DataFrame, names: list[str]) -> dict[tuple[str, int], dict[str, float]]:
    """The terms that tell each label best, with the log ratio of their shares.

    One choice for each label and fold, from the documents outside of the fold, and one
    for each label from all.
    """
    folds = range(FOLDS)
    spread = [
        column
        for i, name in enumerate(names)
        for k in folds
        for column in (
            F.count(F.when(F.col("_fold") == k, F.col(name))).alias(f"n {i} {k}"),
            F.coalesce(F.sum(F.when(F.col("_fold") == k, F.col(name))), F.lit(0)).alias(f"p {i} {k}"),
        )
    ]
    of = rows.agg(*spread).first()
    counted = rows.select(F.explode("terms").alias("term"), "_fold", *names).groupBy("term").agg(*spread)
    choices = []
    for i, name in enumerate(names):
        for model in range(FOLDS + 1):
            seen = [k for k in folds if k != model]
            total = lambda kind, i=i, seen=seen: sum(F.col(f"{kind} {i} {k}") for k in seen)
            positive = sum(of[f"p {i} {k}"] for k in seen)
            negative = sum(of[f"n {i} {k}"] for k in seen) - positive
            with_it = (total("p") + 0.5) / (positive + 1)
            without = (total("n") - total("p") + 0.5) / (negative + 1)
            ratio = F.log(with_it / without)
            choices.append(
                F.struct(
                    F.lit(name).alias("name"),
                    F.lit(model).alias("model"),
                    total("n").alias("n"),
                    ratio.alias("ratio"),
                    (F.abs(with_it - without) * F.abs(ratio)).alias("worth"),
                )
            )
    each = counted.select("term", F.explode(F.array(*choices)).alias("at")).select("term", "at.*")
    best = Window.partitionBy("name", "model").orderBy(F.desc("worth"), "term")
    chosen = (
        each.filter(F.col("n") >= LEAST_DOCUMENTS)
        .withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= FEATURES)
        .orderBy("name", "model", "place")
    )
    found: dict[tuple[str, int], dict[str, float]] = {
        (name, model): {} for name in names for model in range(FOLDS + 1)
    }
    for row in chosen.collect():
        found[row["name"], row["model"]][row["term"]] = row["ratio"]
    return found


def learn(
    docs: DataFrame, labels: DataFrame, categories: dict[str, Column], key: str, text: str = "text"
) -> list[Category]:
    """Fits the chain on a sample of the labelled rows of ``docs``, see ``labelled_sample``.

    ``categories`` gives each label as a boolean over ``labels``, in the order of the
    chain; the last of them decides what is rejected. Each is fitted on the documents
    that have its own label, whether or not they have the others. A category whose labels
    are missing or all alike is left out of the chain, and without the last one nothing
    is rejected. Empty tables give an empty chain. What reaches the driver is bounded by the
    sample and the number of features.
    """
    usable = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    usable = usable.filter(F.col("_text").isNotNull())
    told = labels.withColumnRenamed(key, "_id")
    labelled = {f"label {i}": column for i, column in enumerate(categories.values())}
    sample = labelled_sample(usable, told, "_id", labelled, text="_text")

    def terms_of(texts: list[str]) -> list[list]:
        return [[sorted(terms(x)) for x in texts]]

    sample = sample.withColumns(
        {
            "_number": F.xxhash64(F.col("_id"), F.lit(3)),
            "_fold": F.pmod(F.xxhash64(F.col("_text"), F.lit(4)), F.lit(FOLDS)).cast("int"),
        }
    )
    kept = ["_number", "_fold", *labelled]
    rows = map_texts(sample, kept, "_text", terms_of, {"terms": "array<string>"})
    rows = materialize(rows, "labelled-terms")
    both = [f(name) for name in labelled for f in (F.count, F.sum)]
    totals = list(rows.agg(*both).first())
    counts = dict(zip(labelled, zip(totals[::2], totals[1::2], strict=True), strict=True))
    names = [name for name, (n, positive) in counts.items() if positive not in (None, 0, n)]
    if not names:
        return []
    chosen = _selected(rows, names)
    every = sorted(set().union(*chosen.values()))
    place = {term: i for i, term in enumerate(every)}
    held = materialize(_held(rows, place, names), "labelled-features")
    table = held.orderBy("_number").toArrow()
    fitted = _fit_chain(table, names, chosen, every)
    titles = dict(zip(labelled, categories, strict=True))
    last = list(categories)[-1]
    return [c._replace(name=titles[c.name], decides=titles[c.name] == last) for c in fitted]


def _held(rows: DataFrame, place: dict[str, int], names: list[str]) -> DataFrame:
    """The sample with the numbers of the chosen terms instead of all terms."""
    kept = rows.select("_number", "_fold", *names, "terms")

    def run(batches):
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("terms")).to_pylist()
            found = [[place[t] for t in terms if t in place] for terms in lists]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.list_(pa.int32()))],
                names=["_number", "_fold", *names, "found"],
            )

    labels = [f"`{name}` int" for name in names]
    return kept.mapInArrow(run, ", ".join(["_number bigint, _fold int", *labels, "found array<int>"]))


def _fit_chain(
    table: pa.Table,
    names: list[str],
    chosen: dict[tuple[str, int], dict[str, float]],
    every: list[str],
) -> list[Category]:
    found = table.column("found").to_pylist()
    present = np.zeros((len(found), len(every)), bool)
    for i, numbers in enumerate(found):
        present[i, numbers] = True
    fold = table.column("_fold").to_numpy()
    place = {term: i for i, term in enumerate(every)}
    chain: list[Category] = []
    earlier = np.zeros((len(found), 0))

    def features(ratios: dict[str, float]) -> np.ndarray:
        # Terms are scaled by how well each tells the category on its own.
        columns = [place[term] for term in ratios]
        scaled = present[:, columns] * np.array(list(ratios.values()), np.float32)
        return np.column_stack([scaled, earlier.astype(np.float32)])

    for name in names:
        y = np.array(table.column(name).to_pylist(), np.float64)
        ratios = chosen[name, WHOLE]
        x = features(ratios)
        # Documents without the label are unseen by the model of all that have it.
        has = ~np.isnan(y)
        weights, bias = fit_logistic(x[has], y[has], RIDGE)
        unseen = np.where(has, logit(np.array(y[has].mean())), x @ weights + bias)
        for k in range(FOLDS):
            own, others = has & (fold == k), has & (fold != k)
            if own.any() and 0 < y[others].sum() < others.sum():
                part = features(chosen[name, k])
                of_part, level = fit_logistic(part[others], y[others], RIDGE)
                unseen[own] = part[own] @ of_part + level
        unseen = np.clip(unseen, -30, 30)
        earlier = np.column_stack([earlier, unseen])
        reached = np.quantile(sigmoid(unseen[y == 0]), 1 - FALSE_SHARE)
        by_term = weights[: len(ratios)] * np.array(list(ratios.values()))
        chain.append(
            Category(
                name,
                {term: float(w) for term, w in zip(ratios, by_term, strict=True)},
                weights[len(ratios) :].tolist(),
                bias,
                float(np.clip(reached, LEAST_THRESHOLD, MOST_THRESHOLD)),
                False,
            )
        )
    return chain


def rate(
    docs: DataFrame, chain: Sequence[Category], text: str = "text", prefix: str = ""
) -> DataFrame:
    """Adds ``p_`` and the name of each category of ``chain``, and ``rejected``, to every row.

    The names start with ``prefix``.

    ``rejected`` tells whether the deciding category's probability reaches its threshold. A
    text that is null, empty or white space has probability 0; a chain without a
    deciding category rejects nothing. Repeated rows are rated each; columns with the added names are
    replaced. All other columns are kept, no row moves between tasks, and an empty table stays
    empty. A probability that equals the threshold rejects.
    """
    chain = list(chain)

    def run(texts: list[str]) -> list[list]:
        scorer = Scorer(chain)
        rated = [scorer.score(x) for x in texts]
        columns = [[row[i] for row in rated] for i in range(len(chain))]
        limits = [c.threshold if c.decides else math.inf for c in chain]
        return [*columns, [any(p >= t for p, t in zip(row, limits, strict=True)) for row in rated]]

    names = [*(f"p_{category.name}" for category in chain), "rejected"]
    kinds = ["double"] * len(chain) + ["boolean"]
    added = {prefix + name: kind for name, kind in zip(names, kinds, strict=True)}
    return map_texts(docs, docs.columns, text, run, added)
