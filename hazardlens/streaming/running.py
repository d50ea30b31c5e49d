"""Running classification of each key of an event stream, for any transition table.

Two stateful steps. First the rows of a key and a time interval become one vector, the end state for each start state,
by a windowed aggregate that stays in the JVM; a key with a large share of the rows is spread over its intervals.
Then ``transformWithState`` carries the state of a key from interval to interval. The watermark closes intervals in the
order of time, so the second step sees a key's vectors in order and keeps nothing but a state number and a count.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType, TimestampType

from hazardlens.functions.text import let
from hazardlens.operators.classify import DEFAULT_TABLE, TransitionTable


class _Carry(StatefulProcessor):
    """The state of one key; its timer tells when the key has been idle for long enough to be let go."""

    def __init__(self, states: Sequence[str], columns: Sequence[str], idle_ms: int | None) -> None:
        self.states, self.columns, self.idle_ms = list(states), list(columns), idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.carried = handle.getValueState("carried", "state int, n_tokens long, interval_end timestamp")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kept = self.carried.get() if self.carried.exists() else (0, 0, None)
        state, n, end = kept
        for row in sorted(rows, key=lambda r: r["_end"]):
            state, n, end = row["_ends"][state], n + row["_n"], row["_end"]
            yield self._told(key, state, n, end, closed=False)
        self.carried.update((state, n, end))
        if self.idle_ms is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            self.handle.registerTimer(_millis(end) + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state, n, end = self.carried.get()
        self.carried.clear()
        yield self._told(key, state, n, end, closed=True)

    def _told(self, key, state: int, n: int, end: datetime, closed: bool) -> Row:
        return Row(*self.columns)(*key, end, n, self.states[state], closed)

    def close(self) -> None:
        pass


def _millis(at: datetime) -> int:
    # A row's timestamp is naive in the zone of the process, or aware.
    return int(at.astimezone(UTC).timestamp() * 1000)


def interval_vectors(
    events: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    ts: str = "ts",
    token: str = "token",
    interval: str = "1 minute",
    watermark: str = "10 minutes",
    table: TransitionTable = DEFAULT_TABLE,
) -> DataFrame:
    """Key, ``_end``, ``_n`` and ``_ends``: one vector for the rows of a key in an interval, taken by ``order``, then token.

    An interval is emitted once, when the watermark passes its end; its rows meet in one task, so it should be short for
    the busiest key.
    """
    rows = F.array_sort(F.collect_list(F.struct(*order, table.token_code(F.col(token)).alias("_code"))))
    vectors = let(
        F.transform(F.col("_rows"), lambda r: r["_code"]),
        lambda codes: F.transform(
            F.lit(list(range(len(table.states)))), lambda s: F.aggregate(codes, s, table.step)
        ),
    )
    return (
        events.where(F.col(ts).isNotNull())
        .withWatermark(ts, watermark)
        .groupBy(*key, F.window(ts, interval).alias("_w"))
        .agg(rows.alias("_rows"), F.count("*").alias("_n"))
        .select(*key, F.window_time("_w").alias("_at"), F.col("_w.end").alias("_end"), "_n", vectors.alias("_ends"))
    )


def running_labels(
    events: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    ts: str = "ts",
    token: str = "token",
    interval: str = "1 minute",
    watermark: str = "10 minutes",
    idle_seconds: int | None = None,
    table: TransitionTable = DEFAULT_TABLE,
) -> DataFrame:
    """State of each key after each of its intervals: key, interval_end, n_tokens, label, final_state, message, closed.

    ``order`` begins with ``ts``; its other columns settle rows of equal time, and rows equal in all of them are taken by
    token. ``n_tokens`` and the state cover everything of the key up to ``interval_end``. Rows behind the watermark are
    late and take no part; rows without a time have no place in the order and take none either. A key with nulls is a key.
    With ``idle_seconds``, a key that has no rows for so long after its last interval is told once more, with ``closed``,
    and let go; should it come back, it begins anew. Needs append mode and the RocksDB state store.
    """
    key = list(key)
    vectors = interval_vectors(events, key, order, ts, token, interval, watermark, table)
    fields = [vectors.schema[k] for k in key]
    output = StructType(
        [StructField(f.name, f.dataType, True) for f in fields]
        + [
            StructField("interval_end", TimestampType()),
            StructField("n_tokens", LongType()),
            StructField("_state", StringType()),
            StructField("closed", BooleanType()),
        ]
    )
    carry = _Carry(table.states, output.names, None if idle_seconds is None else idle_seconds * 1000)
    carried = vectors.groupBy(*key).transformWithState(
        statefulProcessor=carry, outputStructType=output, outputMode="Append", timeMode="EventTime"
    )
    parts = table.result(F.col("_state"), F.lit(False))
    return carried.select(
        *key, "interval_end", "n_tokens", *(parts[c].alias(c) for c in ("label", "final_state", "message")), "closed"
    )
