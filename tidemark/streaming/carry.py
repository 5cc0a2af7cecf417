"""Bounded carry-forward as a stream: per entity the last real point and how often it was carried, with event-time timers.

A slot is given out once the watermark has passed its end: direct (observed there), existing (a stored row, strong or weak) or
carry (the last strong stored value or point again, at most cap slots that have none, weak stored rows counted). What was given
out doesn't change. An entity whose carries are used up and that has nothing waiting has no state left, so state is bounded
by the entities seen within cap slots of the watermark; skipped slots give no row.

Late rows (behind the watermark) are dropped by Spark; of rows in one slot the latest counts. Rows without a price are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from tidemark.functions.scratch import shared_dir
from tidemark.functions.timeutil import SLOT_MINUTES
from tidemark.streaming.late import equal_spans, in_runs

OBSERVED, STRONG, WEAK = 2, 0, 1
OUT = "id string, slot timestamp_ntz, action string, value double"
_GIVEN = "id string, slot_ms long, action string, value double"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def advance(state: tuple, waiting: dict[int, tuple], watermark: int, cap: int, step: int) -> tuple[tuple | None, list[tuple], list[int]]:
    """state: (anchor, carries used, next slot). Returns the new state (none: nothing to carry or to wait for), the slots to give
    out, as (slot, action, value), and the waiting slots among them. All times in milliseconds."""
    anchor, used, at = state
    order, out, gone = sorted(waiting), [], []
    k = 0
    while True:
        if anchor is None or used >= cap:
            if k == len(order):
                return None, out, gone
            at = max(at, order[k])
        if at + step > watermark:
            return (anchor, used, at), out, gone
        if k < len(order) and order[k] <= at:
            slot, k = order[k], k + 1
            gone.append(slot)
            if slot < at:
                continue  # given out before
            _, price, kind = waiting[slot]
            out.append((slot, "direct" if kind == OBSERVED else "existing", price))
            anchor, used = (anchor, used + 1) if kind == WEAK else (price, 0)
        else:
            used += 1
            out.append((at, "carry", anchor))
        at += step


class Carry(StatefulProcessor):
    """State of one entity: the row (anchor, used, next slot), and the latest row of each slot that is still open."""

    def __init__(self, cap: int, step: int):
        self.cap, self.step = cap, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.point = handle.getValueState("point", "anchor double, used int, next long")
        self.waiting = handle.getMapState("waiting", "slot long", "at long, price double, kind int")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        best: dict[int, tuple] = {}
        for part in rows:
            for slot, at, price, kind in part[["slot_ms", "at_us", "price", "kind"]].itertuples(index=False, name=None):
                if slot not in best or (at, price) > best[slot][:2]:
                    best[slot] = (int(at), float(price), int(kind))
        for slot, row in best.items():
            old = self.waiting.getValue((slot,)) if self.waiting.containsKey((slot,)) else None
            if old is None or row[:2] > (old[0], old[1]):
                self.waiting.updateValue((slot,), row)
        if best and not list(self.handle.listTimers()):
            self.handle.registerTimer(min(best) + self.step)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        waiting = {k[0]: v for k, v in self.waiting.iterator()}
        old = self.point.get() if self.point.exists() else (None, self.cap, min(waiting, default=0))
        state, out, gone = advance(tuple(old), waiting, timerValues.getCurrentWatermarkInMs(), self.cap, self.step)
        for slot in gone:
            self.waiting.removeKey((slot,))
        if state is None:
            self.point.clear()
        else:
            self.point.update(state)
            self.handle.registerTimer(state[2] + self.step)
        if out:
            slots, actions, values = zip(*out, strict=True)
            yield pd.DataFrame({"id": key[0], "slot_ms": slots, "action": actions, "value": values})

    def close(self) -> None:
        pass


def carried(stream: DataFrame, kind: Column, cap: int = 4, delay: str = "2 minutes", minutes: int = SLOT_MINUTES) -> DataFrame:
    """stream: id, ts, price. kind: OBSERVED, STRONG or WEAK. Rows of OUT, each slot of an entity once at most."""
    step = minutes * 60_000
    at = F.col("ts").cast("timestamp")
    s = stream.where(F.col("price").isNotNull() & F.col("ts").isNotNull() & F.col("id").isNotNull()).select(
        "id", at.alias("at"), (F.floor(F.unix_millis(at) / step) * step).cast("long").alias("slot_ms"), F.unix_micros(at).alias("at_us"), F.col("price").cast("double").alias("price"), kind.cast("int").alias("kind")
    )
    given = s.withWatermark("at", delay).groupBy("id").transformWithStateInPandas(Carry(cap, step), _GIVEN, "Append", "EventTime")
    return given.select("id", F.timestamp_millis("slot_ms").cast("timestamp_ntz").alias("slot"), "action", "value")


def replay(rows: DataFrame, kind: Column, batches: int = 3, cap: int = 4, delay: str = "2 minutes") -> DataFrame:
    """rows (id, ts, price) as they would arrive in so many runs, each of which starts from the state that the run before left.

    Each run takes what there is and ends, as a job does that is started every few minutes.
    """
    spark = rows.sparkSession
    base = f"{shared_dir(spark)}/carry-{uuid.uuid4().hex}"
    spark.createDataFrame([], OUT).write.parquet(f"{base}/out/batch=-1")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    def start(stream: DataFrame):
        given = carried(stream, kind, cap, delay).writeStream.foreachBatch(write).outputMode("append")
        return given.option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()

    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)  # the only one that has timers
    try:
        in_runs(rows, equal_spans(rows, F.col("ts"), batches), batches, f"{base}/in", start)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    return spark.read.schema(f"{OUT}, batch long").parquet(f"{base}/out").drop("batch")
