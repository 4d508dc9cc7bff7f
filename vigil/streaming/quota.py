"""Exact call quotas over a stream: keyed state that outlives micro-batches."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vigil.operators.corpus import PER_DAY, PER_MINUTE, known_limits, retry_after

_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _DayOfToken(StatefulProcessor):
    """Counters of a token's UTC day: calls of each minute, and calls that passed. A timer at the day's end drops them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.minutes = handle.getMapState("minutes", "minute int", "calls long")
        self.passed = handle.getValueState("passed", "calls long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        calls = pd.concat(list(rows), ignore_index=True).sort_values("ts", kind="stable", ignore_index=True)
        minute = (calls["ts"].dt.hour * 60 + calls["ts"].dt.minute).astype("int64")
        before = {m: self.minutes.getValue((m,))[0] if self.minutes.containsKey((m,)) else 0 for m in minute.unique().tolist()}
        in_minute = minute.map(before) + calls.groupby(minute).cumcount() + 1
        over_minute = in_minute > calls["per_minute"]
        passed = self.passed.get()[0] if self.passed.exists() else 0
        in_day = passed + (~over_minute).cumsum()
        over_day = ~over_minute & (in_day > calls["per_day"])
        for m, n in in_minute.groupby(minute).max().items():
            self.minutes.updateValue((int(m),), (int(n),))
        self.passed.update((int(passed + (~over_minute).sum()),))
        if not passed and not any(before.values()):
            day = key[-1]
            midnight = datetime(day.year, day.month, day.day, tzinfo=timezone.utc)
            self.handle.registerTimer(int(midnight.timestamp() * 1000) + 86_400_000)
        refused = pd.Series(None, index=calls.index, dtype=object).mask(over_minute, "minute").mask(over_day, "day")
        yield pd.DataFrame({"token": calls["token"], "ts": calls["ts"], "refused": refused})

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        self.minutes.clear()
        self.passed.clear()
        yield from ()

    def close(self) -> None:
        pass


def refuse_calls(calls: DataFrame, limits: DataFrame, per_minute: int = PER_MINUTE, per_day: int = PER_DAY, delay: str = "2 minutes") -> DataFrame:
    """Each arriving call (token, ts) with ``refused`` (minute, day or null) and ``retry_after`` seconds, as ``refused_calls`` has them for a whole table.

    State is kept for a token's UTC day, so one token's days part over tasks, and a restart goes on from the checkpoint. Calls of a
    micro-batch count by time, those of later batches after them; one that comes ``delay`` behind the newest call, when its day is
    over, is dropped. A task holds the calls of one token and day in a micro-batch, which the source's limit on a batch bounds. The
    session's state store becomes RocksDB, as keyed state with timers needs it. Limits are read anew with each batch.
    """
    calls.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _STATE_STORE)
    known = known_limits(calls.withWatermark("ts", delay), limits, per_minute, per_day)
    keyed = known.select("token", "ts", F.to_date("ts").alias("day"), "per_minute", "per_day").groupBy("token", "day")
    judged = keyed.transformWithStateInPandas(_DayOfToken(), "token string, ts timestamp, refused string", "Append", "EventTime")
    return judged.withColumn("retry_after", retry_after(F.col("ts"), F.col("refused")))
