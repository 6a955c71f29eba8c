"""The latest state of each container as keyed stream state."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators import states

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have the package

HOUR = 3600
SEEN, HOUR_OF = "_seen", "_hour"


def _comparable(row: Sequence, places: list[int]) -> tuple:
    """Values that compare as Spark orders them, NULL before all others."""
    return tuple((row[i] is not None, row[i]) for i in places)


class Latest(StatefulProcessor):
    """Keeps a key's greatest row by the columns at `places`, and passes it on when it changes.

    With `reach_ms` the row is forgotten once the watermark is that much later than its time,
    which is the first of the places, in microseconds.
    """

    def __init__(self, schema: T.StructType, places: list[int], reach_ms: int | None):
        self.schema, self.places, self.reach_ms = schema, places, reach_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.row = handle.getValueState("row", self.schema)

    def _expiry(self, row: Sequence) -> int:
        return row[self.places[0]] // 1000 + self.reach_ms

    def handleInputRows(self, key: tuple, rows: Iterable[Row], timerValues) -> Iterator[Row]:
        before = tuple(self.row.get()) if self.row.exists() else None
        best = before
        for row in rows:
            row = tuple(row)[:len(self.schema)]
            if best is None or _comparable(row, self.places) > _comparable(best, self.places):
                best = row
        if best is before:
            return
        self.row.update(best)
        if self.reach_ms is not None:
            if before is not None:
                self.handle.deleteTimer(self._expiry(before))
            self.handle.registerTimer(self._expiry(best))
        yield Row(*self.schema.names)(*best)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.row.clear()
        return iter(())

    def close(self) -> None:
        pass


def _greatest(key: str, order: list[str]):
    """Arrow function that leaves the greatest row of each key in a batch."""
    def shrink(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column(key).dictionary_encode(null_encoding="encode").indices
            ranks = pa.table([codes, *[batch.column(c) for c in order]], names=["key", *map(str, range(len(order)))])
            at = pc.sort_indices(ranks, [(n, "ascending") for n in ranks.column_names], null_placement="at_start")
            keys = codes.take(at).to_numpy(zero_copy_only=False)
            last = np.append(keys[1:] != keys[:-1], True)
            yield batch.take(at.filter(pa.array(last)))
    return shrink


def _whole_numbers(df: DataFrame) -> DataFrame:
    """Times as microseconds, which Python workers of any time zone leave as they are."""
    return df.select(*[
        F.unix_micros(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in df.schema])


def latest_states(
    states: DataFrame, time: str, ties: list[str], path: str, checkpoint: str, key: str = "description",
    reach: str | None = None,
) -> StreamingQuery:
    """Append each container's state to a table whenever it is later than all before.

    Of a container's states the latest by `time` counts, among equals the greatest by `ties`.
    A batch adds one row per container at most and rewrites nothing; the table lies in folders
    by hour. Rows are reduced to one per container and Arrow batch before the shuffle, so a
    container with many states does not load its task.

    Without `reach` the state has one row per container ever seen. With `reach`, such as
    '1 hour', it has only those seen that long before the watermark, which is as far behind
    the latest state. States older than the watermark are dropped, as are those without a time:
    none can be the latest of its container within the reach. A container forgotten and seen
    again is new, and its state is later than the forgotten one. The state needs the store
    that `session.prepare` names.
    """
    schema = states.schema
    numbers = _whole_numbers(states)
    order = [time, *ties]
    rows = numbers.mapInArrow(_greatest(key, order), numbers.schema)
    reach_ms = None
    if reach is not None:
        reach_ms = _milliseconds(states.sparkSession, reach)
        rows = rows.filter(F.col(time).isNotNull()).withColumn(SEEN, F.timestamp_micros(time)).withWatermark(SEEN, reach)
    kept = Latest(numbers.schema, [numbers.columns.index(c) for c in order], reach_ms)
    changes = rows.groupBy(key).transformWithState(
        kept, numbers.schema, "Append", "None" if reach is None else "EventTime")
    whole = changes.select(*[
        F.timestamp_micros(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in schema])
    return (
        whole.withColumn(HOUR_OF, _hour(F.col(time))).writeStream.outputMode("append").format("parquet")
        .partitionBy(HOUR_OF).option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def _milliseconds(spark: SparkSession, interval: str) -> int:
    length = f"timestamp_seconds(0) + interval {interval}"
    return spark.range(1).select(F.expr(f"unix_millis({length})")).first()[0]


def _hour(time: Column) -> Column:
    return F.floor(F.unix_seconds(time) / HOUR).cast("bigint")


def stored_states(spark: SparkSession, path: str, time: str, ties: list[str], key: str = "description") -> DataFrame:
    """The latest state of every container in the table that `latest_states` wrote."""
    rows = spark.read.parquet(path).drop(HOUR_OF)
    return states.latest_per(rows, [key], F.struct(time, *ties))


def within_last_hour(
    spark: SparkSession, path: str, now: Column, time: str, ties: list[str], key: str = "description",
) -> DataFrame:
    """Containers seen in the hour up to `now`, each with its latest state; reads two folders.

    States later than `now` count, too.
    """
    start = now - F.expr("interval 1 hour")
    rows = spark.read.parquet(path).filter((F.col(HOUR_OF) >= _hour(start)) & (F.col(time) > start)).drop(HOUR_OF)
    return states.latest_per(rows, [key], F.struct(time, *ties))
