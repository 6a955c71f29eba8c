"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import sys
import types
import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session

#: A word: code points other than the space and the five control characters from tab on.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows and bytes that one Arrow batch may hold, so that long texts do not fill a worker.
BATCH_ROWS, BATCH_BYTES = "500", "2m"

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str) -> list[bytes]:
    """The words of a text in UTF-8. Splitting bytes knows just the six characters that part words."""
    return text.encode().split()


def lower_words(text: str) -> list[bytes]:
    """The words with A-Z in lower case, which are all that lowering bytes changes."""
    return text.encode().lower().split()


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the library, with bounded Arrow batches."""
    session.prepare(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")  # nothing here explodes before it is joined by estimate
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a data folder."""
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """The text with A-Z in lower case and every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def remainder(key: Column, modulus: int) -> Column:
    """CRC-32 of a key's text, modulo; null keys count as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def per_worker(key: object, make: Callable[[], object]) -> object:
    """A value made once in each Python worker and kept for its later tasks."""
    kept = sys.modules.setdefault("_llm_worker_state", types.ModuleType("_llm_worker_state")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def per_job(slot: str, job: str, make: Callable[[], object]) -> object:
    """As `per_worker`, for values of one job: the slot's value of an earlier job is dropped."""
    kept = per_worker(slot, dict)
    if job not in kept:
        kept.clear()
        kept[job] = make()
    return kept[job]


class Memo(dict):
    """A dictionary that works out missing entries and forgets those not asked for lately.

    When it holds `most` entries, it keeps them aside as the older half and starts anew.
    """

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}
        per_worker("memos", list).append(weakref.ref(self))

    def __missing__(self, key):
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


def forget() -> None:
    """Empties all memos of this worker, which earlier operators filled; for tasks that need the room and use none."""
    found = per_worker("memos", list)
    found[:] = [ref for ref in found if ref() is not None]
    for memo in [ref() for ref in found]:
        if memo is not None:
            memo.clear()
            memo.older = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers with every bit spread over all others."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def texts_of(column: pa.Array) -> list[str]:
    """The texts of a column; null becomes the empty text."""
    return [x or "" for x in column.to_pylist()]


def per_batch(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]]) -> DataFrame:
    """`mapInArrow` with a function that `make` builds once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            out = apply(batch)
            if out is not None and out.num_rows:
                yield out
    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, name: str) -> str:
    """A column name beginning with `name` that the table does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows, written once, with a number each that stays the same; and that column's name."""
    row = fresh(df, "row_number")
    return session.cut(df.withColumn(row, F.monotonically_increasing_id())), row
