"""Running totals per key that start again after an idle time."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Ship the state function itself, so that executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUT = (
    "keyless boolean, key bigint, pane_start bigint, n bigint, units bigint, "
    "spell_n bigint, spell_units bigint"
)

# Columns of a bucket's state, one row of bigints per key.
KEYLESS, KEY, END, N, UNITS = range(5)


def _running(values: np.ndarray, opens: np.ndarray, carried: np.ndarray) -> np.ndarray:
    """Running totals that start again where ``opens``, from the ``carried`` value there."""
    total = np.cumsum(values)
    opened = np.maximum.accumulate(np.where(opens, np.arange(len(values)), 0))
    return total - (total - values)[opened] + carried[opened]


class SpellTotals(StatefulProcessor):
    """Adds running totals to the panes of a bucket of keys; forgets keys idle for ``idle`` seconds.

    All keys of a bucket are kept in one value and computed in one pass, so the
    calls, and the requests for state, grow with the buckets and not with the keys.
    """

    def __init__(self, pane: int, idle: int) -> None:
        self.pane = pane
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spells = handle.getValueState("spells", "rows binary, timer bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # A key has one row per pane, so this grows with time covered, not with events.
        panes = pd.concat(list(rows), ignore_index=True)
        names = ["keyless", "key", "pane_start", "n", "units"]
        keyless, keys, start, n, units = (panes[c].to_numpy().astype(np.int64) for c in names)
        order = np.lexsort((start, keys, keyless))
        keyless, keys, start, n, units = (x[order] for x in (keyless, keys, start, n, units))
        first = np.ones(len(keys), bool)
        first[1:] = (keys[1:] != keys[:-1]) | (keyless[1:] != keyless[:-1])

        old, timer = self.load()
        known = {(row[KEYLESS], row[KEY]): i for i, row in enumerate(old.tolist())}
        heads = np.flatnonzero(first)
        place = np.array([known.get(k, -1) for k in zip(keyless[heads], keys[heads])], np.int64)
        met = place >= 0
        previous_end = np.concatenate([[0], start[:-1] + self.pane])
        previous_end[heads] = start[heads]
        previous_end[heads[met]] = old[place[met], END]
        # A spell that goes on takes up its totals; every other one starts from nothing.
        idle = start - previous_end >= self.idle
        spell_n, spell_units = (
            _running(values, first | idle, self.carried(old, c, place, heads, idle))
            for values, c in ((n, N), (units, UNITS))
        )

        lasts = np.concatenate([heads[1:], [len(keys)]]) - 1
        new = np.column_stack(
            [keyless, keys, start + self.pane, spell_n, spell_units]
        )[lasts]
        left = np.ones(len(old), bool)
        left[place[met]] = False
        self.store(np.concatenate([old[left], new]), timer, timerValues)
        yield pd.DataFrame(
            {
                "keyless": keyless.astype(bool),
                "key": keys,
                "pane_start": start,
                "n": n,
                "units": units,
                "spell_n": spell_n,
                "spell_units": spell_units,
            }
        )

    @staticmethod
    def carried(old, column: int, place, heads, idle) -> np.ndarray:
        """What the first pane of each key takes up from the state."""
        carried = np.zeros(len(idle), np.int64)
        goes_on = (place >= 0) & ~idle[heads]
        carried[heads[goes_on]] = old[place[goes_on], column]
        return carried

    def load(self) -> tuple[np.ndarray, int | None]:
        value = self.spells.get()
        if value is None:
            return np.zeros((1, 5), np.int64)[:0], None
        return np.frombuffer(value[0], np.int64).reshape(-1, 5), value[1]

    def store(self, rows: np.ndarray, timer: int | None, timerValues) -> None:
        """Keeps the keys whose spells can go on, and one timer for when the first cannot."""
        # A pane that could continue a spell has ended by then, and so has arrived.
        expiry = (rows[:, END] + self.idle + self.pane) * 1000
        alive = expiry > timerValues.getCurrentWatermarkInMs()
        rows, expiry = rows[alive], expiry[alive]
        if len(rows) and timer is None:
            timer = int(expiry.min())
            self.handle.registerTimer(timer)
        if len(rows) or timer is not None:
            self.spells.update((rows.tobytes(), timer))
        else:
            self.spells.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.store(self.load()[0], None, timerValues)
        return iter(())

    def close(self) -> None:
        pass


def stream_spell_totals(
    stream: DataFrame,
    by: str,
    time: str,
    units: str,
    pane: timedelta,
    idle: timedelta,
    buckets: int = 256,
) -> DataFrame:
    """Per key and ``pane``: event count and units, and their running totals in the spell.

    A spell of activity ends when a key has no pane for ``idle`` or longer. ``by``
    is a bigint and ``time`` carries a watermark. Events are summed per pane
    first, with map-side combining, so the state function sees one row per key
    and pane however many events a key has. Panes arrive when the watermark has
    passed their end, hence in order. State is dropped by a timer once no pane
    can continue the spell.

    Keys are held in ``buckets`` by hash, 40 bytes a key, and a bucket is rewritten when any
    of its keys has a pane: take enough of them for some ten thousand live keys each. The
    number belongs to the state and must stay the same when a stream is taken up again.
    """
    pane_seconds, idle_seconds = int(pane.total_seconds()), int(idle.total_seconds())
    panes = (
        stream.groupBy(F.window(time, f"{pane_seconds} seconds").alias("_window"), by)
        .agg(F.count("*").alias("n"), F.coalesce(F.sum(units), F.lit(0)).alias("units"))
        .select(
            F.pmod(F.xxhash64(by), F.lit(buckets)).alias("bucket"),
            # A null key is told from 0 by a column of its own.
            F.col(by).isNull().alias("keyless"),
            F.coalesce(by, F.lit(0)).alias("key"),
            F.unix_seconds(F.col("_window.start")).alias("pane_start"),
            F.window_time("_window").alias("pane_time"),
            "n",
            "units",
        )
    )
    return (
        panes.groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=SpellTotals(pane_seconds, idle_seconds),
            outputStructType=OUTPUT,
            outputMode="Append",
            timeMode="EventTime",
        )
        .select(
            F.when(~F.col("keyless"), F.col("key")).alias(by),
            F.timestamp_seconds("pane_start").cast("timestamp_ntz").alias("pane_start"),
            *["n", "units", "spell_n", "spell_units"],
        )
    )
