"""Operators against brute force on small inputs."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import timedelta
from decimal import Decimal

import pytest
from fixtures import EVENTS, awkward_events
from pyspark.sql import functions as F

from marlgrid.functions.money import amount, exact_sum, mean, units
from marlgrid.functions.properties import json_field
from marlgrid.operators.aggregates import rollup_of_sums, window_sums
from marlgrid.operators.asof import asof_join
from marlgrid.operators.joins import parents_with_children, parents_without_children
from marlgrid.operators.keysets import (
    key_except,
    key_except_all,
    key_intersect,
    key_intersect_all,
    key_set_summary,
    key_union,
    side_counts,
    union_of,
)
from marlgrid.operators.ranking import top_k_per_group
from marlgrid.operators.sessions import sessionize
from marlgrid.operators.skew import split_by_key_size


def events_frame(spark, rows):
    return spark.createDataFrame(rows, EVENTS).repartition(3)


# Long keys: every key, only the largest, none.
@pytest.mark.parametrize("rows_per_task", [7, 60, 10_000])
@pytest.mark.parametrize("inclusive", [True, False])
def test_asof_join(spark, rows_per_task, inclusive):
    rows = awkward_events(seed=rows_per_task)
    rows += [(1000, 1, None, "view", 0.0), (1001, 1, None, "purchase", 0.0)]
    events = events_frame(spark, rows)
    joined = asof_join(
        events.filter("kind = 'purchase'"),
        events.filter("kind = 'view'").select("user", "ts", "id"),
        by="user",
        time="ts",
        tie="id",
        out="view",
        inclusive=inclusive,
        rows_per_task=rows_per_task,
    )
    got = {r["id"]: r["view"] and r["view"]["id"] for r in joined.collect()}

    want = {}
    for i, user, ts, kind, _ in rows:
        if kind != "purchase":
            continue
        views = [
            (t, j)
            for j, u, t, k, _ in rows
            if k == "view" and None not in (user, ts, t) and u == user
            and (t <= ts if inclusive else t < ts)
        ]
        want[i] = max(views)[1] if views else None
    assert got == want
    assert any(v is None for v in want.values()) and any(v is not None for v in want.values())


def brute_sessions(rows, gap):
    by_user = defaultdict(list)
    for _, user, ts, kind, value in rows:
        by_user[user].append((ts, kind, value))
    result = set()
    for user, events in by_user.items():
        events.sort()
        session = [events[0]]
        for event in events[1:] + [None]:
            if event is None or event[0] - session[-1][0] > gap:
                cents = sum(round(value * 100) for _, _, value in session)
                buys = sum(kind == "purchase" for _, kind, _ in session)
                result.add((user, session[0][0], session[-1][0], len(session), buys, cents))
                session = []
            session.append(event)
    return result


# Slices of one bucket, of a few, and one slice.
@pytest.mark.parametrize("buckets_per_slice", [1, 5, 100_000])
@pytest.mark.parametrize("gap", [timedelta(minutes=30), timedelta(hours=2), timedelta(seconds=1)])
def test_sessionize(spark, buckets_per_slice, gap):
    rows = awkward_events(seed=11)
    sums = {
        "buys": F.count_if(F.col("kind") == "purchase"),
        "cents": exact_sum(units(F.col("value"))),
    }
    timeless = [(1000 + i, user, None, "view", 1.0) for i, user in enumerate([1, 1, 99, None])]
    events = events_frame(spark, rows + timeless)
    sessions = sessionize(events, "user", "ts", gap, sums, buckets_per_slice)
    got = [tuple(r) for r in sessions.collect()]
    assert len(got) == len(set(got))
    assert {(*r[:5], int(r[5])) for r in got} == brute_sessions(rows, gap)


def test_a_hot_key_with_a_short_gap_is_ordered_in_slices(spark):
    """Every event is a session of its own, and no task gets them all."""
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + 3 * F.col("id")).cast("timestamp_ntz")
    events = spark.range(0, 20_000, 1, 4).select(F.lit(1).alias("user"), ts.alias("ts"))
    sessions = sessionize(events, "user", "ts", timedelta(seconds=1), {}, buckets_per_slice=600)
    assert sessions.count() == 20_000 and sessions.agg(F.max("n_events")).first()[0] == 1
    together = sessionize(events, "user", "ts", timedelta(seconds=3), {}, buckets_per_slice=50)
    assert [r.n_events for r in together.collect()] == [20_000]


@pytest.mark.parametrize("panes", [1, 4])
def test_window_sums(spark, panes):
    rows = awkward_events(seed=5)
    slide = timedelta(minutes=30)
    got = {
        (r.window_start, r.kind): (r.window_end, r.n)
        for r in window_sums(
            events_frame(spark, rows), "ts", slide, ["kind"], {"n": F.count("*")}, panes
        ).collect()
    }
    want = Counter()
    for _, _, ts, kind, _ in rows:
        first = ts.replace(minute=ts.minute // 30 * 30)
        want.update((first - i * slide, kind) for i in range(panes))
    assert got == {(s, k): (s + panes * slide, n) for (s, k), n in want.items()}


def test_rollup_tells_null_groups_from_subtotals(spark):
    rows = [("a", "x", 1), ("a", None, 2), (None, None, 4), (None, "x", 8)]
    df = spark.createDataFrame(rows, "p string, q string, v bigint")
    got = {tuple(r) for r in rollup_of_sums(df, ["p", "q"], {"v": F.sum("v")}).collect()}
    native = df.rollup("p", "q").agg(F.grouping_id().cast("int"), F.sum("v"))
    assert got == {tuple(r) for r in native.collect()}
    assert ("a", None, 0, 2) in got and ("a", None, 1, 3) in got and (None, None, 3, 15) in got


LEFT_KEYS = [1, 1, 1, 2, 3, 3, None, None]
RIGHT_KEYS = [1, 3, 3, 3, 4, None]


def key_frames(spark):
    def frame(keys):
        return spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(3)

    return frame(LEFT_KEYS), frame(RIGHT_KEYS)


def test_key_sets(spark):
    left, right = key_frames(spark)
    a, b = Counter(LEFT_KEYS), Counter(RIGHT_KEYS)

    def keys(df):
        return sorted((r.k for r in df.collect()), key=str)

    assert keys(key_union(left, right, "k")) == sorted(a.keys() | b.keys(), key=str)
    assert keys(key_intersect(left, right, "k")) == sorted(a.keys() & b.keys(), key=str)
    assert keys(key_except(left, right, "k")) == sorted(a.keys() - b.keys(), key=str)


def test_key_multisets(spark):
    left, right = key_frames(spark)
    a, b = Counter(LEFT_KEYS), Counter(RIGHT_KEYS)
    assert dict(map(tuple, key_intersect_all(left, right, "k").collect())) == dict(a & b)
    assert dict(map(tuple, key_except_all(left, right, "k").collect())) == dict(a - b)
    native = Counter(r.k for r in left.exceptAll(right).collect())
    assert native == a - b


def test_key_set_summary(spark):
    left, right = key_frames(spark)
    got = {r.found_in: tuple(r)[1:] for r in key_set_summary(left, right, "k").collect()}
    assert got == {"both": (3, 7, 5), "left only": (1, 1, 0), "right only": (1, 0, 1)}


def test_parents(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id bigint, name string")
    children = spark.createDataFrame([(1,)] * 50 + [(3,), (None,)], "parent bigint")
    with_children = parents_with_children(parents, children, "id", "parent")
    without = parents_without_children(parents, children, "id", "parent")
    assert [r.name for r in with_children.collect()] == ["a"]
    assert sorted(r.name for r in without.collect()) == ["b", "c"]


# Spark limits each map task's rows up to a threshold; both sides of it, and off.
@pytest.mark.parametrize("threshold", ["1000", "2", "-1"])
def test_top_k_per_group(spark, conf, threshold):
    conf("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    rows = awkward_events(seed=3)
    order = [F.col("value").desc(), F.col("id")]
    top = top_k_per_group(events_frame(spark, rows), ["user"], order, 5, salts=3)
    got = {(r.user, r["rank"]): r.id for r in top.collect()}
    assert top.columns == ["id", "user", "ts", "kind", "value", "rank"]
    want = {}
    for user in {r[1] for r in rows}:
        ranked = sorted((-r[4], r[0]) for r in rows if r[1] == user)[:5]
        want.update({(user, i + 1): row_id for i, (_, row_id) in enumerate(ranked)})
    assert got == want


def test_money_is_exact(spark):
    values = [0.1, 0.2, 104_999.91, -999.85, 0.07, None] * 100
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    cents = exact_sum(units(F.col("v")))
    row = df.agg(cents.alias("s"), amount(cents, 2).alias("a"), mean(cents, 2, F.count("v"))).first()
    want = sum(Decimal(str(v)) for v in values if v is not None)
    assert row.s == want * 100
    assert row.a == float(want)
    assert row[2] == float(want) / 500


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "value", [0.125, 0.004, -7.001, float("nan"), float("inf"), -float("inf"), 1e20, -1e17]
)
def test_an_amount_that_is_no_number_of_units_fails(spark, conf, ansi, value):
    conf("spark.sql.ansi.enabled", ansi)
    df = spark.createDataFrame([(1.0,), (value,)], "v double")
    with pytest.raises(Exception, match="not a whole number of 1e-2 units"):
        df.agg(exact_sum(units(F.col("v")))).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_rounding_of_doubles_is_no_loss(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    cents = [7, 29, 57, 115, 1_000_000_000_001, 90_071_992_547_409, -57, 0]
    df = spark.createDataFrame([(c / 100,) for c in cents] + [(None,)], "v double")
    assert [r[0] for r in df.select(units(F.col("v"))).collect()] == [*cents, None]
    assert df.select(units(F.col("v"), 4)).first()[0] == 700


def test_sides_of_one_table(spark):
    rows = [(1, "a"), (1, "b"), (2, "a"), (None, "b"), (3, "c"), (1, "a"), (4, None)]
    df = spark.createDataFrame(rows, "k bigint, side string")
    counts = side_counts(df, "k", F.col("side") == "a", F.col("side") == "b")
    assert {tuple(r) for r in counts.collect()} == {(1, 2, 1), (2, 1, 0), (None, 0, 1)}
    assert {r.k for r in union_of(counts, "k").collect()} == {1, 2, None}


def test_exact_sum_beyond_bigint(spark):
    big = 9 * 10**17 + 123_456_789
    df = spark.range(40).select(F.lit(big).alias("u"))
    assert int(df.agg(exact_sum(F.col("u"))).first()[0]) == 40 * big
    assert int(df.agg(exact_sum(-F.col("u"))).first()[0]) == -40 * big


def test_amount_rounds_half_up(spark):
    df = spark.createDataFrame([(1234565,), (-1234565,), (1234564,)], "u bigint")
    got = [r[0] for r in df.select(amount(F.col("u").cast("decimal(38,0)"), 3)).collect()]
    assert got == [1234.57, -1234.57, 1234.56]


def test_json_field(spark):
    texts = ['{"k": 3}', '{"k": null}', '{"j": 1}', "{broken", None, '{"k": "x"}']
    df = spark.createDataFrame([(t,) for t in texts], "props string")
    got = [r.k for r in df.select(json_field(F.col("props"), "k", "int").alias("k")).collect()]
    assert got == [3, None, None, None, None, None]


def test_key_sizes_are_estimated_from_a_sample(spark):
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    rows = spark.range(0, 600_000, 1, 4).select(hot.cast("bigint").alias("k"), "id")
    rows = rows.unionAll(spark.range(90_000).select(F.lit(None).cast("bigint"), "id"))
    parts = split_by_key_size(rows, "k", 50_000)
    assert {r.k for r in parts.long.select("k").distinct().collect()} == {7, None}
    assert parts.long_rows == pytest.approx(290_000, rel=0.05)
    assert parts.short.count() + parts.long.count() == 690_000
    assert split_by_key_size(rows, "k", 300_000).long is None
