"""Walks of Arrow tasks over very many small groups of rows."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# Workers need not have the package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that are handed over at once, if they are whole groups.
ROWS = 20_000


def begins(batch: pa.RecordBatch | pa.Table, by: list[str]) -> np.ndarray:
    """Rows whose key differs from that of the row before, the first one left out."""
    new = np.zeros(max(0, batch.num_rows - 1), bool)
    for c in by:
        column = batch.column(c)
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
        new |= codes[1:] != codes[:-1]
    return np.flatnonzero(new) + 1


def parts_of(df: DataFrame) -> int:
    """Tasks for work that is slow for its bytes, which adaptive execution would put into few."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_groups(df: DataFrame, by: list[str], order: list[str], run, kinds: str, rows: int = ROWS) -> DataFrame:
    """`run(table, starts)` over tables of whole groups, sorted by `order` within a group; it gives one batch."""
    def walk(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < rows:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            starts = begins(table, by)
            if not len(starts):
                continue
            last = int(starts[-1])  # the last group may go on in the next batch
            yield run(table.slice(0, last).combine_chunks(), np.append(0, starts[:-1]))
            held = [b for b in table.slice(last).to_batches()]
            size = 0
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield run(table, np.append(0, begins(table, by)))

    return df.repartition(parts_of(df), *by).sortWithinPartitions(*by, *order).mapInArrow(walk, kinds)
