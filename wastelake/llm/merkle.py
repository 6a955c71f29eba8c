"""A Merkle manifest of a table, its blocks laid out after van Emde Boas.

Every row is a leaf: the SHA-256 (lower-case hex) of its columns, each `-` if null, else the
bytes of its value, a colon, and the value. The leaves of a tree ascend by key; runs of
ARITY consecutive nodes become their parent, the SHA-256 of their joined hex digests, until
one node is left; a lone leaf is the root. The last run may be shorter, down to one node.
The roots of all trees, ordered by tree name (null first), are the leaves of a last tree.

Trees are stored as blocks: aligned subtrees of LEVELS levels above their ARITY ** LEVELS
leaves. Inside a block the nodes lie in van Emde Boas order: the upper half of the levels
first, then every subtree of the lower half, each laid out the same way. `address` finds a
node by arithmetic alone; building a block and fetching siblings use nothing else. The roots
of the blocks are the leaves of the blocks above them, so a tree of n leaves needs
log(n) / log(4096) rounds, each one job over the roots of the round before. A task
holds one block at a time.

Defined results: null names and keys are values of their own and come first; rows of equal
key follow one another by leaf, and equal rows have equal leaves, so their order does not
matter. Equal rows are a leaf each. An empty table has no block, no root and no proofs.
Columns that are not asked for may have any name.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import ranked
from ..session import cut
from . import common

ARITY = 8
LEVELS = 4
DIGEST = 32
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SPAN = ARITY ** LEVELS


def subtree(height: int) -> int:
    """Nodes of a full subtree with so many levels of nodes."""
    return (ARITY ** height - 1) // (ARITY - 1)


def address(height: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of nodes of one depth in the layout of a subtree with `height` levels of nodes."""
    if height == 1:
        return np.zeros_like(index)
    upper = height // 2
    if depth < upper:
        return address(upper, depth, index)
    below = ARITY ** (depth - upper)
    return (subtree(upper) + index // below * subtree(height - upper)
            + address(height - upper, depth - upper, index % below))


def levels_of(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    levels = 0
    while ARITY ** levels < n:
        levels += 1
    return levels


def joined(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class Block:
    """An aligned subtree: its digests in one buffer, in van Emde Boas order."""

    def __init__(self, leaves: int, levels: int, nodes: bytearray):
        self.leaves, self.levels, self.nodes = leaves, levels, nodes
        self.rows = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)

    @classmethod
    def built(cls, digests: list[str], levels: int) -> Block:
        """The subtree over the digests, so many levels high."""
        block = cls(len(digests), levels, bytearray(subtree(levels + 1) * DIGEST))
        row = digests
        for depth in range(levels, -1, -1):
            at = address(levels + 1, depth, np.arange(len(row)))
            block.rows[at] = np.frombuffer(bytes.fromhex("".join(row)), np.uint8).reshape(-1, DIGEST)
            row = [joined(row[i:i + ARITY]) for i in range(0, len(row), ARITY)]
        return block

    def digests(self, depth: int, index: np.ndarray) -> list[str]:
        return [r.tobytes().hex() for r in self.rows[address(self.levels + 1, depth, index)]]

    def width(self, depth: int) -> int:
        """Nodes of one depth."""
        return -(-self.leaves // ARITY ** (self.levels - depth))

    def root(self) -> str:
        return self.digests(0, np.zeros(1, np.int64))[0]

    def paths(self, places: np.ndarray) -> list[list[list[str]]]:
        """For each leaf, the other nodes of its run and of the runs of its ancestors, level by level."""
        found: list[list[list[str]]] = [[] for _ in places]
        for depth in range(self.levels, 0, -1):
            runs: dict[int, list[str]] = {}
            for path, i in zip(found, places // ARITY ** (self.levels - depth)):
                first = int(i) // ARITY * ARITY
                if first not in runs:
                    runs[first] = self.digests(depth, np.arange(first, min(first + ARITY, self.width(depth))))
                path.append(runs[first][:i - first] + runs[first][i - first + 1:])
        return found


def folded(digest: str, place: int, n: int, siblings: list[str]) -> str:
    """Root that follows from a leaf at a place of a tree of n leaves and its siblings upwards."""
    at = 0
    while n > 1:
        own, run = place % ARITY, min(ARITY, n - place // ARITY * ARITY)
        others = siblings[at:at + run - 1]
        at += run - 1
        digest = joined(others[:own] + [digest] + others[own:])
        place, n = place // ARITY, -(-n // ARITY)
    return digest


def leaf(columns: list[Column]) -> Column:
    """SHA-256 of the values, each with its length before it."""
    def written(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.sha2(F.concat(*map(written, columns)), 256)


class Manifest(NamedTuple):
    """`leaves`: (tree, place, n, row columns, leaf); `blocks`: one table per round; `roots`: (tree, root, n)."""
    leaves: DataFrame
    blocks: list[DataFrame]
    roots: DataFrame


BLOCK_ROWS = "tree string, block bigint, leaves bigint, n bigint, levels int, root string, nodes binary"


def _blocks(nodes: DataFrame, base: int) -> DataFrame:
    """Blocks over nodes (tree, place, n, digest), `base` rounds above the leaves; n counts the tree's leaves."""
    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        n, first = table["n"][0].as_py(), table["place"][0].as_py()
        levels = max(0, min(LEVELS, levels_of(n) - LEVELS * base))
        block = Block.built(table["digest"].to_pylist(), levels)
        return pa.table({
            "tree": table["tree"][:1], "block": pa.array([first // SPAN], pa.int64()), "leaves": pa.array([block.leaves], pa.int64()),
            "n": pa.array([n], pa.int64()), "levels": pa.array([levels], pa.int32()),
            "root": pa.array([block.root()], pa.string()), "nodes": pa.array([bytes(block.nodes)], pa.binary())})

    dealt = nodes.select("tree", "place", "n", "digest", F.floor(F.col("place") / SPAN).alias("block"))
    return dealt.groupBy("tree", "block").applyInArrow(build, BLOCK_ROWS)


def forest(leaves: DataFrame) -> Manifest:
    """Blocks and roots of trees from leaves (tree, place, n, leaf, ...): places count from 0, n is the tree's size."""
    most = leaves.agg(F.max("n")).first()[0] or 0  # one number
    rounds = max(1, -(-levels_of(most) // LEVELS))
    nodes, blocks = leaves.withColumnRenamed("leaf", "digest"), []
    for base in range(rounds):
        if base:
            above = blocks[-1].filter(F.col("n") > SPAN ** base)
            nodes = above.select("tree", F.col("block").alias("place"), "n", F.col("root").alias("digest"))
        blocks.append(cut(_blocks(nodes, base)))
    # A tree's root is that of its only block in its last round.
    tops = [b.filter(F.col("n") <= F.lit(SPAN) * F.lit(SPAN ** base)).select("tree", "root", "n") for base, b in enumerate(blocks)]
    roots = tops[0]
    for base, top in enumerate(tops[1:], 1):
        roots = roots.unionByName(top.filter(F.col("n") > SPAN ** base))
    return Manifest(leaves, blocks, roots)


def ordered(rows: DataFrame, tree: str, keys: list[str], digest: str) -> DataFrame:
    """The rows with `tree`, `leaf`, `place` (from 0, by keys and leaf) and `n`, the number of the tree's rows."""
    written, row = common.numbered(rows.withColumnsRenamed({tree: "tree", digest: "leaf"}))
    placed = ranked(written, ["tree"], [*keys, "leaf", row], "place").withColumn("place", F.col("place") - 1).drop(row)
    sizes = written.groupBy("tree").agg(F.count("*").alias("n")).withColumnRenamed("tree", "of")
    return cut(placed.join(sizes, F.col("tree").eqNullSafe(F.col("of"))).drop("of"))


def manifest(docs: DataFrame, doc_id: str = "doc_id", tree: str = "lang", columns: list[str] = FIELDS,
             altered: dict[str, Column] | None = None) -> Manifest:
    """One tree per value of `tree`, its rows in the order of `doc_id`.

    `altered` names further columns for the leaves and what they hold.
    """
    extra = altered or {}
    rows = docs.select(F.col(doc_id).alias("key"), F.col(tree).cast("string").alias("tree"),
                       leaf([docs[c] for c in columns]).alias("leaf"), *[c.alias(name) for name, c in extra.items()])
    return forest(ordered(rows, "tree", ["key"], "leaf"))


def _with_paths(children: DataFrame, blocks: DataFrame, keep: list[str], schema: str, make) -> DataFrame:
    """Children (tree, place, ...) with what `make(table, block row, paths)` derives from their paths in their blocks."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own = {c: right[c][0].as_py() for c in right.column_names}
        block = Block(own["leaves"], own["levels"], bytearray(own["nodes"]))
        return make(left, own, block.paths(left["place"].to_numpy() % SPAN))

    dealt = children.select("tree", "place", *keep, F.floor(F.col("place") / SPAN).alias("block"))
    return dealt.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(run, schema)


def with_tails(found: Manifest) -> DataFrame:
    """The lowest blocks with `tail`: the siblings from a block's root up to the root of its tree."""
    def add(left: pa.Table, own: dict, paths: list) -> pa.Table:
        tails = ["".join("".join(level) for level in path) + own["tail"] for path in paths]
        return pa.table({"tree": left["tree"], "place": left["place"], "tail": pa.array(tails, pa.string())})

    below = None
    for base in range(len(found.blocks) - 1, -1, -1):
        blocks = found.blocks[base].filter(F.col("n") > SPAN ** base) if base else found.blocks[0]
        if below is None:
            below = blocks.withColumn("tail", F.lit(""))
            continue
        children = blocks.filter(F.col("n") > SPAN ** (base + 1)).select("tree", F.col("block").alias("place"))
        tails = _with_paths(children, below, [], "tree string, place bigint, tail string", add).withColumnsRenamed({"tree": "of", "place": "at"})
        same = F.col("tree").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at"))
        below = cut(blocks.join(tails, same, "left").drop("of", "at").withColumn("tail", F.coalesce("tail", F.lit(""))))
    return below


def proofs(found: Manifest, against: str = "leaf") -> DataFrame:
    """`(doc_id, tree, leaf, subroot, root, proof, proof_sha256, folded_root, verified)` of every leaf.

    `proof` are the siblings (64 hex digits each) from the leaf through its tree's root to the
    root of all. The leaf in column `against` is folded with them; `verified` says whether that
    gives the root.
    """
    tops = found.roots.withColumnsRenamed({"tree": "name", "root": "subroot", "n": "size"})
    listed = ordered(tops.withColumn("whole", F.lit("")), "whole", ["name"], "subroot")
    last = forest(listed)

    def lift(left: pa.Table, own: dict, paths: list) -> pa.Table:
        tails = ["".join("".join(level) for level in path) + own["tail"] for path in paths]
        return pa.table({"name": left["name"], "subroot": left["leaf"], "top_place": left["place"], "top_n": left["n"],
                         "top_tail": pa.array(tails, pa.string())})

    lifted = _with_paths(listed, with_tails(last), ["name", "leaf", "n"],
                         "name string, subroot string, top_place bigint, top_n bigint, top_tail string", lift)
    whole = last.roots.select(F.col("root").alias("all_root"))  # one row
    tops = lifted.crossJoin(F.broadcast(whole))
    blocks = with_tails(found).join(tops, F.col("tree").eqNullSafe(F.col("name"))).drop("name")

    def prove(left: pa.Table, own: dict, paths: list) -> pa.Table:
        out: dict[str, list] = {"proof": [], "proof_sha256": [], "folded_root": []}
        rest = own["tail"] + own["top_tail"]
        for path, place, digest in zip(paths, left["place"].to_pylist(), left["against"].to_pylist()):
            proof = "".join("".join(level) for level in path) + rest
            siblings = [proof[i:i + 2 * DIGEST] for i in range(0, len(proof), 2 * DIGEST)]
            split = len(siblings) - len(own["top_tail"]) // (2 * DIGEST)
            below = folded(digest, place, own["n"], siblings[:split])
            out["proof"].append(proof)
            out["proof_sha256"].append(hashlib.sha256(proof.encode()).hexdigest())
            out["folded_root"].append(folded(below, own["top_place"], own["top_n"], siblings[split:]))
        return pa.table({
            "doc_id": left["key"], "tree": left["tree"], "leaf": left["leaf"], "subroot": pa.array([own["subroot"]] * len(left), pa.string()),
            "root": pa.array([own["all_root"]] * len(left), pa.string()), **{k: pa.array(v, pa.string()) for k, v in out.items()},
            "verified": pa.array([r == own["all_root"] for r in out["folded_root"]], pa.bool_())})

    key = found.leaves.schema["key"].dataType.simpleString()
    leaves = found.leaves.withColumn("against", F.col(against))
    return _with_paths(leaves, blocks, ["key", "leaf", "against"],
                       f"doc_id {key}, tree string, leaf string, subroot string, root string, proof string, proof_sha256 string, "
                       "folded_root string, verified boolean", prove)


def tampered(docs: DataFrame, one_of: int = 3) -> Column:
    """Leaf of every row after lower-casing the A-Z of its text in one of so many rows, picked by CRC-32 of the id."""
    text = F.when(common.remainder(docs.doc_id, one_of) == 0, common.lower_ascii(docs.text)).otherwise(docs.text)
    return leaf([text if c == "text" else docs[c] for c in FIELDS])
