"""State that a user's own function keeps for each key of a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: (key, the key's new rows in frames of bounded size, state or None) -> (new state, or None to forget the key; rows to give out)
Update = Callable[[tuple, Iterator[pd.DataFrame], tuple | None], tuple[tuple | None, list[tuple]]]
#: (key, state) -> rows to give out when a key has been idle for long enough and is forgotten
Expire = Callable[[tuple, tuple], list[tuple]]


class Kept(StatefulProcessor):
    """Calls the function with what is kept for a key and keeps what it returns."""

    def __init__(self, update: Update, state: str, columns: list[str], idle_ms: int | None, expire: Expire | None):
        self.update, self.state, self.columns, self.idle_ms, self.expire = update, state, columns, idle_ms, expire

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("kept", self.state)

    def _given(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            yield pd.DataFrame(rows, columns=self.columns)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept = self.value.get()  # None without a value; each question to the store is a round trip for every key
        kept, out = self.update(key, rows, kept)
        if kept is None:
            self.value.clear()
        else:
            self.value.update(kept)
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if kept is not None:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield from self._given(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.value.exists():
            out = self.expire(key, tuple(self.value.get())) if self.expire else []
            self.value.clear()
            yield from self._given(out)

    def close(self) -> None:
        pass


def update_state(df: DataFrame, keys: list[str], update: Update, state: str, out: str, idle_ms: int | None = None, expire: Expire | None = None) -> DataFrame:
    """The rows that ``update`` gives out, micro-batch by micro-batch, in update mode.

    ``state`` and ``out`` are schemas. State is checkpointed with the query, so a restart goes on where it stopped. A key
    without rows for ``idle_ms`` of processing time is forgotten, after ``expire`` has given out its last rows. Keys are
    dealt over the shuffle partitions and a key's rows come in several frames, so a hot key needs no memory for all of them.
    """
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    columns = StructType.fromDDL(out).fieldNames()
    processor = Kept(update, state, columns, idle_ms, expire)
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=out, outputMode="Update", timeMode="none" if idle_ms is None else "processingTime")


def running_total(value: str) -> Update:
    """State (n, total); gives out (key..., n, total)."""

    def update(key, rows, kept):
        n, total = kept or (0, 0.0)
        for part in rows:
            n, total = n + len(part), total + float(part[value].sum())
        return (n, total), [(*key, n, total)]

    return update


def last_values(value: str, order: list[str], k: int) -> Update:
    """State: the ``k`` latest values with their order columns; gives out (key..., values, oldest first)."""

    def update(key, rows, kept):
        held = [tuple(x) for x in zip(*kept)] if kept else []
        for part in rows:
            new = part.assign(**{c: part[c].astype(str) for c in order})[[*order, value]].itertuples(index=False, name=None)
            held = sorted([*held, *new])[-k:]
        columns = tuple(list(c) for c in zip(*held))
        return columns, [(*key, columns[-1])]

    return update
