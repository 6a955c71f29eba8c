"""Threshold-scaled sketches of documents.

A document's shingles are runs of five words in lower case (all its words when it has
fewer). Every distinct shingle hash below a fixed fraction of the hash range is kept, and of
a document with fewer such hashes the LEAST lowest of all. So the sketch grows with the
document, short documents keep all they have, sketches merge by union, and containment between
documents of very unequal length is estimated from the part of the smaller sketch found in the
larger. Sketches are compared on the range of hashes that both know in full.

A fingerprint is the number of distinct shingles, a colon, and the kept hashes in ascending
order, 14 hex digits each. Likeness is the Jaccard estimate of two sketches, exact if both
documents have at most LEAST shingles. Two documents without a shingle are alike (1.0).

Nulls count as empty texts. The next document is that of the next larger id; null ids come
first, and rows of equal id follow one another by text. An empty table gives an empty
result. Only the columns named are read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import common

SHINGLE = 5
#: One of so many shingle hashes is kept.
SCALE = 4
#: A sketch has at least so many hashes, if the document has.
LEAST = 16
#: Hashes have so many bits, written as hex digits of four bits each.
BITS = 56
MEMO = 400_000
#: Rows whose ids decide where the parts begin.
SAMPLE = 20_000
SOME = np.uint64(0x9E3779B97F4A7C15)


class Sketcher:
    """Sketches of texts; word hashes are kept between texts."""

    def __init__(self, shingle: int = SHINGLE, scale: int = SCALE):
        self.shingle, self.below = shingle, np.uint64((1 << BITS) // scale)
        self.word = common.Memo(xxhash.xxh3_64_intdigest, MEMO)

    def words(self, text: str) -> np.ndarray:
        found = common.lower_words(text)
        return np.fromiter(map(self.word.__getitem__, found), np.uint64, len(found))

    def sketch(self, hashes: np.ndarray) -> tuple[int, np.ndarray]:
        """Number of distinct shingles and the kept hashes, from the hashes of a text's words."""
        if not len(hashes):
            return 0, hashes
        span = min(self.shingle, len(hashes))
        n = len(hashes) - span + 1
        h = np.full(n, span, np.uint64)
        for i in range(span):
            h = common.mixed(h * SOME + hashes[i:i + n])
        h = np.unique(h >> np.uint64(64 - BITS))
        return len(h), h[:max(LEAST, np.searchsorted(h, self.below))]


def written(sketch: tuple[int, np.ndarray]) -> str:
    n, kept = sketch
    return f"{n}:" + kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8:].tobytes().hex()


def read(fingerprint: str) -> tuple[int, np.ndarray]:
    n, digits = fingerprint.split(":")
    raw = np.frombuffer(bytes.fromhex(digits), np.uint8).reshape(-1, BITS // 8)
    return int(n), np.pad(raw, ((0, 0), (8 - BITS // 8, 0))).reshape(-1).view(">u8").astype(np.uint64)


def known(sketch: tuple[int, np.ndarray], scale: int = SCALE) -> int:
    """The bound below which a sketch has every hash of its document."""
    n, kept = sketch
    return 1 << BITS if n == len(kept) else max((1 << BITS) // scale, int(kept[-1]) + 1)


def common_range(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray], scale: int = SCALE) -> tuple[int, np.ndarray, np.ndarray]:
    """The bound below which both sketches are complete, and their hashes there."""
    bound = min(known(a, scale), known(b, scale))
    return bound, *(s[1][:np.searchsorted(s[1], np.uint64(bound))] for s in (a, b))


def merged(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray], scale: int = SCALE) -> tuple[int, np.ndarray]:
    """Sketch of two documents together; its number of shingles is an estimate, but exact if both sketches have all."""
    bound, x, y = common_range(a, b, scale)
    both = np.union1d(x, y)
    below = int(np.searchsorted(both, np.uint64((1 << BITS) // scale)))
    kept = both[:max(LEAST, below)]
    # A number larger than that of the kept hashes tells that some are missing.
    return (len(both) if bound == 1 << BITS else max(a[0], b[0], scale * below, len(kept) + 1)), kept


def shared(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray], scale: int = SCALE) -> float:
    """Jaccard estimate."""
    if a[0] == b[0] == 0:
        return 1.0
    _, x, y = common_range(a, b, scale)
    common_ = shared(x, y)
    return common_ / (len(x) + len(y) - common_)


def containment(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray], scale: int = SCALE) -> float:
    """Estimated part of the first document's shingles that the second one has."""
    if not a[0]:
        return 1.0
    _, x, y = common_range(a, b, scale)
    return shared(x, y) / len(x) if len(x) else 0.0


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, fingerprint)` of every row."""
    def make():
        sketcher = common.per_worker("sketcher", Sketcher)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = [written(sketcher.sketch(sketcher.words(t))) for t in common.texts_of(batch.column(1))]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["doc_id", "fingerprint"])
        return apply

    return common.per_batch(docs.select(doc_id, text), f"doc_id {docs.schema[doc_id].dataType.simpleString()}, fingerprint string", make)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, text, part, tail)`: every document, partitioned and sorted so that the next follows.

    Documents are cut by id into parts at points taken from a bounded sample, which decides
    the size of the parts only. Within a part (a run of rows of one partition) documents
    ascend; the row with `tail` behind them is the first document of the next part.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = named.withColumn("h", F.xxhash64("text"))
    keys = cut(keyed.select("doc_id", "h"))
    sample = sorted(((r.doc_id is not None, r.doc_id, r.h) for r in keys.orderBy(F.xxhash64("doc_id", "h")).limit(SAMPLE).collect()),
                    key=lambda k: (k[0], k[1] if k[0] else 0, k[2]))
    kind = keys.schema["doc_id"].dataType
    points = sorted({(known, i if known else None, h) for known, i, h in (sample[len(sample) * k // (2 * tasks)] for k in range(1, 2 * tasks))},
                    key=lambda k: (k[0], k[1] if k[0] else 0, k[2])) if sample else []
    nulls, ordered = [h for known, _, h in points if not known], [(i, h) for known, i, h in points if known]

    @F.pandas_udf("int")
    def part_of(missing: pd.Series, ids: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(nulls, h) if m else len(nulls) + bisect_right(ordered, (i, h))
                          for m, i, h in zip(missing.tolist(), ids.tolist(), hashes.tolist())], dtype="int32")

    part = part_of(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0).cast(kind)), F.col("h"))
    firsts = keys.groupBy(part.alias("part")).agg(F.min(F.struct("doc_id", "h")).alias("k")).orderBy("part").collect()  # one per part
    heads = spark.createDataFrame(
        [(r.k.doc_id, r.k.h, firsts[i - 1].part) for i, r in enumerate(firsts)], f"head_id {kind.simpleString()}, head_h bigint, before int")
    found = keyed.withColumn("part", part).join(
        F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_h")), "left")
    places = F.array(F.struct(F.col("part").alias("part"), F.lit(0).alias("tail")), F.struct(F.col("before").alias("part"), F.lit(1).alias("tail")))
    placed = found.withColumn("place", F.explode(F.filter(places, lambda p: p.part.isNotNull())))
    return placed.select("doc_id", "text", "h", "place.part", "place.tail").repartition(tasks, "part").sortWithinPartitions(
        "part", "tail", "doc_id", "h", "text").select("doc_id", "text", "part", "tail")


def compared(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document beside its edited text and the next document.

    `(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next)`. The next document is that of the next larger id, after the last the first.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = common.per_worker("sketcher", Sketcher)
        open_ = None  # the document that waits for its successor
        for batch in batches:
            rows: list[tuple] = []
            for key, text_, part, tail in zip(*(c.to_pylist() for c in batch.columns)):
                same = open_ is not None and open_[2] == part
                if tail and not same:
                    continue
                sketch = sketcher.sketch(sketcher.words(text_))
                if same:
                    new = edited(open_[1], text_)
                    new_sketch = sketcher.sketch(sketcher.words(new))
                    rows.append((open_[0], len(open_[1]), hashlib.sha256(new.encode()).hexdigest(), written(open_[3]),
                                 written(new_sketch), likeness(open_[3], new_sketch), likeness(open_[3], sketch)))
                open_ = None if tail else (key, text_, part, sketch)
            if rows:
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], batch.schema.field(0).type), pa.array(columns[1], pa.int64()),
                     *(pa.array(c, pa.string()) for c in columns[2:5]), *(pa.array(c, pa.float64()) for c in columns[5:])], names)

    key = docs.schema[doc_id].dataType.simpleString()
    return with_next(docs, doc_id, text).mapInArrow(
        run, f"doc_id {key}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
