"""Streams fed file by file: late rows, restarts, failures and state expiry."""

from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from marlgrid.functions.money import exact_sum, units
from marlgrid.sources.tables import SCHEMAS
from marlgrid.streaming.dedup import drop_repeats
from marlgrid.streaming.runner import append_available, stream_session
from marlgrid.streaming.spells import KEY, stream_spell_totals
from marlgrid.streaming.windows import stream_window_sums

DAY = datetime(2024, 5, 1)


def event(event_id, hours, user=1, kind="view", value=1.25):
    return (event_id, DAY + timedelta(hours=hours), user, kind, value, None)


class Feed:
    """A stream over files that are added one at a time, with its output."""

    def __init__(self, spark, folder, build):
        self.session = stream_session(spark)
        self.folder = folder
        self.build = build
        self.files = 0

    def add(self, *rows):
        frame = self.session.createDataFrame(list(rows), SCHEMAS["events"]).coalesce(1)
        frame.write.parquet(f"{self.folder}/in/part={self.files}")
        self.files += 1
        return self

    def run(self):
        source = self.session.readStream.schema(SCHEMAS["events"]).parquet(f"{self.folder}/in/*")
        events = source.withColumn("ts", F.col("ts").cast("timestamp"))
        result = self.build(events.withWatermark("ts", "1 hour"))
        append_available(result, f"{self.folder}/out", f"{self.folder}/checkpoint")
        return sorted(tuple(r) for r in self.session.read.parquet(f"{self.folder}/out").collect())


def hourly(events):
    sums = {"n": F.count("*"), "units": exact_sum(units(F.col("value")))}
    counts = stream_window_sums(events, "ts", timedelta(hours=1), ["event_type"], sums)
    return counts.select("window_start", "event_type", "n", F.col("units").cast("bigint"))


def hour(h):
    return DAY + timedelta(hours=h)


def test_windows_are_emitted_once_when_closed(spark, tmp_path):
    feed = Feed(spark, tmp_path, hourly)
    assert feed.add(event(1, 0.1), event(2, 0.9), event(3, 1.5)).run() == []
    # The watermark is 1.5 now: hour 0 is closed, hour 1 is open.
    first = [(hour(0), "view", 2, 250)]
    assert feed.add(event(4, 2.5, kind="click")).run() == first
    assert feed.run() == first
    second = [*first, (hour(1), "view", 1, 125)]
    assert feed.add(event(5, 3.2)).run() == second


def test_rows_within_the_delay_count_and_later_ones_do_not(spark, tmp_path):
    feed = Feed(spark, tmp_path, hourly)
    feed.add(event(1, 2.4)).run()  # watermark 1.4
    feed.add(event(2, 1.6), event(3, 0.5)).run()  # in time; its hour has closed
    got = feed.add(event(4, 5)).run()
    assert got == [(hour(1), "view", 1, 125), (hour(2), "view", 1, 125)]


def test_a_failed_run_is_taken_up_again(spark, tmp_path):
    feed = Feed(spark, tmp_path, hourly)
    feed.add(event(1, 0.5), event(2, 2.5)).run()

    def failing(events):
        fail = F.when(F.col("event_id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("value"))
        return hourly(events.withColumn("value", fail.cast("double")))

    feed.build = failing
    feed.add(event(3, 2.7), event(4, 4.5))
    with pytest.raises(StreamingQueryException, match="lost"):
        feed.run()
    feed.build = hourly
    assert feed.run() == [(hour(0), "view", 1, 125), (hour(2), "view", 2, 250)]


def test_sliding_windows_equal_the_batch_form(spark, tmp_path):
    def sliding(events):
        sums = {"n": F.count("*")}
        return stream_window_sums(events, "ts", timedelta(hours=1), ["event_type"], sums, panes=3)

    rows = [event(i, 0.37 * i, kind="view" if i % 3 else "click") for i in range(40)]
    feed = Feed(spark, tmp_path, sliding)
    for start in range(0, 40, 10):
        got = feed.add(*rows[start : start + 10]).run()

    want = defaultdict(int)
    for _, ts, _, kind, _, _ in rows:
        start = ts.replace(minute=0, second=0, microsecond=0)
        for back in range(3):
            want[start - timedelta(hours=back), kind] += 1
    closed = max(ts for _, ts, *_ in rows) - timedelta(hours=1)
    width = timedelta(hours=3)
    assert got == sorted(
        (s, s + width, kind, n) for (s, kind), n in want.items() if s + width <= closed
    )


def test_repeats_are_dropped_within_and_across_batches(spark, tmp_path):
    def unique(events):
        return drop_repeats(events, ["event_id"], salts=2).select("event_id", "value")

    feed = Feed(spark, tmp_path, unique)
    # One event makes up a third of the rows of the first batch and comes in several files.
    feed.add(*[event(1, 0.5)] * 50, *[event(i, 0.6) for i in range(2, 52)])
    feed.add(*[event(1, 0.5)] * 50, *[event(i, 0.6) for i in range(40, 90)])
    want = [(i, 1.25) for i in range(1, 90)]
    assert feed.run() == want
    want.append((100, 1.25))
    assert feed.add(event(1, 0.5), event(89, 0.6), event(100, 0.7)).run() == want


def test_state_of_repeats_falls_between_batches(spark, tmp_path):
    """Files in time order, worked off in several micro-batches: no row is lost."""

    def held():
        state = spark.read.format("statestore").load(f"{tmp_path}/checkpoint")
        return state.count()

    feed = Feed(spark, tmp_path, lambda e: drop_repeats(e, ["event_id"]).select("event_id"))
    sizes = []
    for batch in range(6):
        rows = [event(100 * batch + i, 3 * batch + 0.02 * i) for i in range(100)]
        late = [event(100 * batch - 1, 3 * (batch - 1) + 1.98)] * 2 if batch else []
        got = feed.add(*rows, *rows[:30], *late).run()
        sizes.append(held())
    assert [r[0] for r in got] == list(range(600))
    assert max(sizes) < 300


def test_a_stream_keeps_the_settings_of_the_caller(spark, conf):
    conf("spark.sql.ansi.enabled", "false")
    conf("spark.sql.files.maxPartitionBytes", "1000000")
    conf("spark.sql.session.timeZone", "America/New_York")
    session = stream_session(spark)
    assert session.conf.get("spark.sql.ansi.enabled") == "false"
    assert session.conf.get("spark.sql.files.maxPartitionBytes") == "1000000"
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert session.conf.get("spark.sql.shuffle.partitions") == spark.conf.get(
        "spark.sql.shuffle.partitions"
    )


def spells(events, idle=timedelta(hours=3), buckets=4):
    events = events.select("ts", "user_id", units(F.col("value")).alias("units"))
    pane = timedelta(hours=1)
    result = stream_spell_totals(events, "user_id", "ts", "units", pane, idle, buckets)
    return result.select("user_id", "pane_start", "n", "spell_n", "spell_units")


def brute_spells(rows, closed, idle):
    panes = defaultdict(list)
    for _, ts, user, _, value, _ in rows:
        start = ts.replace(minute=0, second=0, microsecond=0)
        if start + timedelta(hours=1) <= closed:
            panes[user, start].append(round(value * 100))
    result, before = [], {}
    for (user, start), values in sorted(panes.items()):
        end, n, total = before.get(user, (start, 0, 0))
        if start - end >= idle:
            n, total = 0, 0
        before[user] = (start + timedelta(hours=1), n + len(values), total + sum(values))
        result.append((user, start, len(values), *before[user][1:]))
    return result


@pytest.mark.parametrize("buckets", [1, 3])
@pytest.mark.parametrize("idle", [timedelta(hours=3), timedelta(minutes=90)])
def test_spells_run_on_over_batches_and_end_when_idle(spark, tmp_path, idle, buckets):
    rows = []
    for i in range(120):
        user = 1 if i % 3 == 0 else 2 + i % 4
        gap = 5 * (i // 40) + (3 if i // 20 == 3 else 0)
        rows.append(event(i, 0.21 * i + gap, user=user, value=0.01 * i))
    feed = Feed(spark, tmp_path, lambda events: spells(events, idle, buckets))
    for start in range(0, 120, 30):
        got = feed.add(*rows[start : start + 30]).run()
    want = brute_spells(rows, max(r[1] for r in rows) - timedelta(hours=1), idle)
    assert got == want
    starts = [n == spell_n for _, _, n, spell_n, _ in want]
    assert any(starts) and not all(starts)


def test_spell_state_is_dropped_when_idle(spark, tmp_path):
    def users_in_state():
        reader = spark.read.format("statestore").option("operatorId", 0)
        state = reader.option("stateVarName", "spells").load(f"{tmp_path}/checkpoint")
        kept = [np.frombuffer(r["value"]["rows"], np.int64) for r in state.collect()]
        return {int(key) for rows in kept for key in rows.reshape(-1, 5)[:, KEY]}

    feed = Feed(spark, tmp_path, spells)
    feed.add(event(1, 0.5, user=1), event(2, 0.5, user=2), event(3, 2.5, user=2)).run()
    assert users_in_state() == {1, 2}
    feed.add(event(4, 6.2, user=3)).run()  # watermark 5.2: user 1 is idle since 1, user 2 since 3
    assert users_in_state() == {2}
    feed.add(event(5, 8.5, user=4)).run()  # watermark 7.5
    assert users_in_state() == {3}
