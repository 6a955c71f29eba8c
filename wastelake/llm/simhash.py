"""SimHash near-duplicates by a forest of vantage-point trees over Hamming distance.

The 64 bits are cut into ranges. Two fingerprints that differ in at most `max_bits` bits
differ in at most `max_bits // ranges` bits of one range, so one tree per range that finds
all partners within that radius misses none. A tree's node has a vantage point and a
distance: what lies nearer goes inside, the rest outside, and by the triangle bounds only
what lies within the radius of the border is also sent across it, as a visitor. A leaf is a
shard: its residents are compared with its residents and visitors on all 64 bits.

Trees are built from a bounded sample of fingerprints, which decides the shape of the
shards and never the result. Equal fingerprints are one node. A shard reports a spanning
forest of its links, never all pairs. A crowded shard is split by residents.

Nulls count as empty texts, whose fingerprint is zero; texts without a word link like any
other. Null ids take part and are never the smallest id unless a component has no other.
Repeated rows each get their row. An empty table gives an empty result. Only the columns
named are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cluster import components
from ..session import cut
from . import common

SEED = 42
RANGES = 3
SAMPLE = 65_536
SHARD_ROWS = 1024
LEAST_SAMPLE = 32
CROWD = 65_536
BLOCK = 1 << 16


def fingerprint(text: str, shingle: int) -> int:
    """Majority bits of the shingles' XXH64, unsigned."""
    found = common.lower_words(text)
    if not found:
        return 0
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    span = min(shingle, len(found))
    starts, ends = starts[:len(found) - span + 1].tolist(), ends[span - 1:].tolist()
    set_bits = np.zeros(64, np.int64)
    hash_ = xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        h = np.array([hash_(joined[a:b], SEED) for a, b in zip(starts[at:at + BLOCK], ends[at:at + BLOCK])], "<u8")
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns of every row and its fingerprint as `fp`, a signed 64-bit number."""
    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps = np.array([fingerprint(t, shingle) for t in common.texts_of(batch.column(0))], np.uint64)
            return pa.RecordBatch.from_arrays(
                [*(batch.column(i + 1) for i in range(len(carry))), pa.array(fps.view(np.int64), pa.int64())],
                [*(f"k{i}" for i in range(len(carry))), "fp"])
        return apply

    schema = ", ".join(f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry))
    made = common.per_batch(docs.select(F.col(text).alias("_text"), *carry), f"{schema}, fp bigint", make)
    return made.toDF(*carry, "fp")


def ranges_of(bits: int = 64, ranges: int = RANGES) -> list[np.uint64]:
    """Masks of the bit ranges."""
    edges = [bits * i // ranges for i in range(ranges + 1)]
    return [np.uint64(((1 << b) - 1) ^ ((1 << a) - 1)) for a, b in zip(edges, edges[1:])]


class Tree:
    """Vantage-point tree over one bit range; leaves are numbered from `first`."""

    def __init__(self, sample: np.ndarray, mask: np.uint64, radius: int, smallest: int, seed: int, first: int):
        self.mask, self.radius, self.leaves = mask, radius, first
        self.root = self.build(sample & mask, smallest, np.random.default_rng(seed))

    def build(self, points: np.ndarray, smallest: int, rng: np.random.Generator):
        if len(points) > smallest:
            for vantage in rng.choice(points, 4):
                d = np.bitwise_count(points ^ vantage).astype(np.int64)
                border = int(np.sort(d)[(len(d) - 1) // 2])
                inside = d <= border
                if not inside.all():
                    return (vantage, border, self.build(points[inside], smallest, rng), self.build(points[~inside], smallest, rng))
        self.leaves += 1
        return self.leaves - 1

    def route(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leaf, index and residence of every place where a value is needed."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def down(node, index: np.ndarray, at_home: np.ndarray) -> None:
            if not len(index):
                return
            if isinstance(node, int):
                out.append((np.full(len(index), node), index, at_home))
                return
            vantage, border, near, far = node
            d = np.bitwise_count((values[index] & self.mask) ^ vantage).astype(np.int64)
            to_near = d <= border + self.radius  # residents beyond the border visit
            to_far = (d > border) | ~at_home & (d > border - self.radius)
            down(near, index[to_near], (at_home & (d <= border))[to_near])
            down(far, index[to_far], at_home[to_far])

        down(self.root, np.arange(len(values)), np.ones(len(values), bool))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 2 + (np.empty(0, bool),)


def forest(sample: np.ndarray, total: int, max_bits: int, ranges: int, shard_rows: int) -> list[Tree]:
    """One tree per bit range, whose shards hold about `shard_rows` residents each."""
    smallest = max(LEAST_SAMPLE, round(len(sample) * shard_rows / max(1, total)))
    trees: list[Tree] = []
    for i, mask in enumerate(ranges_of(64, ranges)):
        trees.append(Tree(sample, mask, max_bits // ranges, smallest, i, trees[-1].leaves if trees else 0))
    return trees


def spanning(residents: np.ndarray, others: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the links between residents and others connect."""
    nodes, index = np.unique(np.concatenate([residents, others]), return_inverse=True)
    home, root = index[:len(residents)], np.arange(len(nodes))
    edges: list[tuple[int, int]] = []
    step = max(1, (1 << 22) // max(1, len(nodes)))
    for at in range(0, len(home), step):
        block = home[at:at + step]
        near = np.bitwise_count(nodes[block, None] ^ nodes[None, :]) <= max_bits
        for i in np.flatnonzero(near.sum(axis=1) > 1):
            roots = np.unique(root[np.flatnonzero(near[i])])
            if len(roots) > 1:
                edges += [(nodes[roots[0]], nodes[r]) for r in roots[1:]]
                root[np.isin(root, roots[1:])] = roots[0]
    found = np.array(edges, np.uint64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def links(distinct: DataFrame, max_bits: int, ranges: int = RANGES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges `(u, v)` between fingerprints that connect all within `max_bits` bits.

    `distinct` has each fingerprint once, as `fp`, and is materialised.
    """
    total = distinct.count()
    sample = distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE)  # a bounded number of them
    trees = forest(np.array([r.fp for r in sample.collect()], np.int64).view(np.uint64), total, max_bits, ranges, shard_rows)

    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            parts = [tree.route(values) for tree in trees]
            leaf, index, home = (np.concatenate(x) for x in zip(*parts))
            return pa.RecordBatch.from_arrays(
                [pa.array(leaf, pa.int32()), pa.array(values[index].view(np.int64), pa.int64()), pa.array(home, pa.bool_())],
                ["leaf", "fp", "home"])
        return apply

    routed = common.per_batch(distinct.select("fp"), "leaf int, fp bigint, home boolean", make)
    routed = cut(routed)
    crowded = routed.filter("home").groupBy("leaf").count().filter(F.col("count") > CROWD).select(
        "leaf", F.ceil(F.col("count") / CROWD).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("fp"), "parts").cast("int")
    shards = routed.join(crowded, "leaf", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("home", F.col("home") & (own == F.col("part")))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        values, home = rows["fp"].to_numpy(np.int64).view(np.uint64), rows["home"].to_numpy(bool)
        u, v = spanning(values[home], values[~home], max_bits)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return shards.select("leaf", "part", "fp", "home").groupBy("leaf", "part").applyInPandas(compare, "u bigint, v bigint").distinct()


def labelled(fps: DataFrame, max_bits: int) -> DataFrame:
    """`(fp, root)` of all distinct fingerprints of `fps`, which is materialised."""
    distinct = cut(fps.select("fp").distinct())
    roots = components(links(distinct, max_bits))
    return distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int, max_bits: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, fingerprint, component_id)`: the smallest id that links lead to."""
    fps = cut(fingerprints(docs, shingle, text, (doc_id,)).toDF("doc_id", "fp"))
    lows = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    rooted = cut(lows.join(labelled(fps, max_bits), "fp"))
    names = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return fps.join(rooted.select("fp", "root").join(names, "root").select("fp", "component_id"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int, max_bits: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every component, with all columns: the one of least id."""
    rows, row = common.numbered(docs)
    fps = cut(fingerprints(rows, shingle, text, (doc_id, row)).toDF("doc_id", "row", "fp"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    lows = fps.groupBy("fp").agg(F.min(order).alias("low"))
    kept = lows.join(labelled(fps, max_bits), "fp").groupBy("root").agg(F.min("low").alias("low")).select(
        F.col("low.row").alias(row))
    return rows.join(kept, row, "left_semi").select(*docs.columns)
