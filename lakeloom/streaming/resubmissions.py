"""Resubmission numbers over a stream: one state per bucket of keys, rows waiting until the watermark has passed them."""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: State variables and timers need this state store.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
#: Hash buckets of keys. A call to the store costs as much as many rows, so keys share a state; a batch reads and writes the buckets it touches.
BUCKETS = 4096
#: Types that pandas keeps as they are, but for nulls in the first ones, which are therefore marked apart.
NUMBERS, OBJECTS = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.StringType, T.DateType, T.DecimalType, T.BinaryType)
#: Pandas counts nanoseconds; dates beyond move the watermark no further.
LAST = "TIMESTAMP '2262-01-01 00:00:00Z'"


def resubmissions(stream: DataFrame, by: Sequence[str], asked: str, decided: str, required: Column, tie: Sequence[str], lateness: str,
                  out: str = "resubmission", buckets: int = BUCKETS) -> DataFrame:
    """Rows (by, tie, out) in update mode: each row's number as ``windows.resubmissions`` gives it for all rows so far.

    Requests may come late by ``lateness``: as long as one can still come ahead of them, a key's rows wait in its state, and a row
    whose number changes is sent once more. Rows the watermark has passed are folded into a count and the last decision, so a state holds
    the rows of ``lateness`` and no more. Later rows than that, and rows without a date, have no number. Rows with equal dates
    are ordered by ``tie``, which must tell a key's rows apart; nulls come first. ``decided`` has the type of ``asked``.
    A checkpoint keeps to the number of ``buckets`` it began with; a bucket's keys and their waiting rows must fit one task.
    """
    stream.sparkSession.conf.set(*STORE)
    values, n = [*by, *tie], len(by)
    kinds = [x.dataType for x in stream.select(*values).schema]
    at, then = F.col(asked).cast("timestamp"), F.unix_micros(F.col(decided).cast("timestamp"))
    marks = [F.when(F.col(c).isNull(), 4 << i).otherwise(0) for i, (c, kind) in enumerate(zip(values, kinds)) if isinstance(kind, NUMBERS)]
    flags = reduce(add, marks, F.when(F.coalesce(required, F.lit(False)), 1).otherwise(0) + F.when(then.isNotNull(), 2).otherwise(0))
    rows = stream.select(F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int").alias("_bucket"), F.least(at, F.expr(LAST)).alias("_at"),
                         F.unix_micros(at).alias("_asked"), F.coalesce(then, F.lit(0)).alias("_decided"), flags.cast("long").alias("_flags"),
                         *[(F.coalesce(F.col(c), F.lit(0).cast(kind)) if isinstance(kind, NUMBERS) else F.col(c)).alias(f"_value{i}")
                           for i, (c, kind) in enumerate(zip(values, kinds))]).where("_asked is not null")
    told = T.StructType([*map(T.StructField, values, kinds), T.StructField(out, T.LongType())])
    keyed = rows.withWatermark("_at", lateness).groupBy("_bucket")
    if all(isinstance(kind, NUMBERS + OBJECTS) for kind in kinds):
        return keyed.transformWithStateInPandas(_Numbers(told.names, n), told, "Update", "EventTime")
    return keyed.transformWithState(_ByRow(told.names, n), told, "Update", "EventTime")


class _Numbers(StatefulProcessor):
    """A bucket's state is (timer, {key: [key's values, rows folded, last decision, waiting rows]}), packed as one value.

    A waiting row is (milliseconds, ties, asked, decided, required, number); times are microseconds.
    """

    def __init__(self, told: list[str], keys: int):
        self.told, self.keys = told, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", T.StructType([T.StructField("packed", T.BinaryType())]))

    def read(self, rows: Iterator) -> Iterator[tuple]:
        for frame in rows:
            yield from zip(*(frame.iloc[:, i].tolist() for i in range(2, frame.shape[1])))

    def write(self, told: list[tuple]) -> Iterator:
        import pandas as pd

        if told:
            yield pd.DataFrame(told, columns=self.told, dtype=object)

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        timer, held = self.load()
        fresh, keys = defaultdict(list), self.keys
        for asked, decided, flags, *values in self.read(rows):
            if flags > 3:
                values = [None if flags & 4 << i else v for i, v in enumerate(values)]
            same = tuple(map(_same, values[:keys]))
            if same not in held:
                held[same] = [tuple(values[:keys]), 0, None, []]
            fresh[same].append((asked // 1000, tuple(values[keys:]), asked, decided if flags & 2 else None, flags & 1, None))
        told = [row for same, added in fresh.items() for row in _numbered(held[same], added)]
        self.keep(timer, held, timerValues.getCurrentWatermarkInMs())
        return self.write(told)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        self.keep(None, self.load()[1], timerValues.getCurrentWatermarkInMs())
        return iter([])

    def close(self) -> None:
        pass

    def load(self) -> tuple[int | None, dict]:
        kept = self.kept.get()
        return pickle.loads(kept[0]) if kept else (None, {})

    def keep(self, timer: int | None, held: dict, watermark: int) -> None:
        """Fold what the watermark has passed, keep the rest, and come back when the next row can be folded."""
        first = None
        for one in held.values():
            waiting = one[3]
            if waiting and waiting[0][0] <= watermark:
                n = next((i for i, row in enumerate(waiting) if row[0] > watermark), len(waiting))
                one[1:] = one[1] + n, waiting[n - 1][3], waiting[n:]
            if one[3] and (first is None or one[3][0][0] < first):
                first = one[3][0][0]
        if timer != first:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)
        self.kept.update((pickle.dumps((first, held), pickle.HIGHEST_PROTOCOL),))


class _ByRow(_Numbers):
    """The same for values that pandas would change."""

    def read(self, rows: Iterator) -> Iterator[tuple]:
        return (row[2:] for row in rows)

    def write(self, told: list[tuple]) -> Iterator:
        return map(Row(*self.told).__call__, *zip(*told)) if told else iter([])


def _numbered(one: list, added: list[tuple]) -> Iterator[tuple]:
    """Set a key's rows in order and give those whose number is new."""
    values, n, decided, waiting = one
    rows = one[3] = [*waiting, *added]
    if len(rows) > 1:
        rows.sort(key=lambda r: (r[0], [(v is not None, v) if v is not None else (False, 0) for v in r[1]]))
    for i, (ms, ties, asked, then, required, before) in enumerate(rows):
        number = n if required and n and decided is not None and asked >= decided else 0
        n, decided = n + 1, then
        if number != before:
            yield (*values, *ties, number)
            rows[i] = (ms, ties, asked, then, required, number)


def _same(value):
    """A dictionary's key that is equal where Spark groups two values together."""
    if isinstance(value, float) and value != value:
        return "NaN"
    if isinstance(value, (list, tuple)):
        return tuple(map(_same, value))
    return bytes(value) if isinstance(value, bytearray) else value
