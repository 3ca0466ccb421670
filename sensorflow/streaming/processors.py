"""Keyed stateful processors for ``transformWithStateInPandas``.

Each processor keeps per-key state in the RocksDB state store (spills to
disk, checkpointed with the query) and handles one key's rows of a
micro-batch as pandas frames, in ``seq`` order.  They are the API form of
timers and of processing-time expiry; keyed states on streams that may have
hot keys are scanned in two levels (:mod:`sensorflow.streaming.states`).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StructField, StructType

# Output schema (DDL)
TTL_OUT = "seq bigint, id string, vc int, state int"


def _rows(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    frames = [r for r in rows if len(r)]
    if not frames:
        return pd.DataFrame()
    return pd.concat(frames, ignore_index=True).sort_values("seq", kind="stable").reset_index(drop=True)


def _key(key) -> str:
    return key[0] if isinstance(key, tuple) else key


class TtlLastValue(StatefulProcessor):
    """Value state with a processing-time TTL (expired values are never
    returned; the library refreshes on read by re-writing what it read)."""

    def __init__(self, ttl_ms: int = 5000, write_above: int = 10):
        self.ttl_ms, self.write_above = ttl_ms, write_above

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_vc", StructType([StructField("v", IntegerType())]), self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows)
        if pdf.empty:
            return
        out = []
        for seq, vc in zip(pdf["seq"].tolist(), pdf["vc"].tolist()):
            cur = self.last.get()[0] if self.last.exists() else None
            if cur is not None:
                self.last.update((cur,))          # refresh on read
            out.append((seq, _key(key), int(vc), cur))
            if vc > self.write_above:
                self.last.update((int(vc),))
        yield pd.DataFrame(out, columns=["seq", "id", "vc", "state"]).astype({"state": "Int32"})


class EventTimeTimer(StatefulProcessor):
    """Register an event-time timer at a fixed time (re-registering the same
    time is one timer); fire once the watermark passes it.  The reference
    fires only when watermark > timer, Spark at watermark >= timer, so the
    timer is registered 1 ms later."""

    def __init__(self, at_ms: int = 5000):
        self.at_ms = at_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for _ in rows:
            pass
        self.handle.registerTimer(self.at_ms + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"id": [_key(key)], "timer_ms": [expiredTimerInfo.getExpiryTimeInMs() - 1],
                            "watermark_ms": [timerValues.getCurrentWatermarkInMs()]})


class ProcessingTimeTimer(StatefulProcessor):
    """Register a processing-time timer ``delay_ms`` after the first row of a
    key arrives; a later row of the key deletes the pending timer and sets a
    new one (timers can be listed and deleted).  Fires once per quiet key."""

    def __init__(self, delay_ms: int = 5000):
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for _ in rows:
            pass
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.delay_ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"id": [_key(key)], "timer_ms": [expiredTimerInfo.getExpiryTimeInMs()],
                            "fired_at_ms": [timerValues.getCurrentProcessingTimeInMs()]})
