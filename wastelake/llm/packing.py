"""Packing of token sequences by first-fit decreasing over a tournament tree.

Every document becomes its token ids and one end id, and is cut into pieces of the sequence
length and a rest. Documents are dealt at random into groups of a bounded number of pieces.
Within a group the whole pieces fill sequences of their own; the rests go, longest first,
each into the leftmost sequence with room, which a tournament tree over the room left
finds in a number of steps that is the logarithm of the sequences. Groups are independent.

A null text is empty: its only id is the end id. Repeated rows and equal ids are documents
of their own. Ties in length go by document id, then by place. An empty table gives an
empty result. Only the two columns named are read.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import common, tokens

LENGTH = 1024
GROUP_PIECES = 4096
GROUP_SPAN = 1 << 32
MEMO = 700_000


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes, for a byte-level vocabulary file.

    Ids must follow the order of the merges, which is checked on loading; then merging by
    least id is the encoding that the file defines.
    """

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)
        to_byte = tokens.byte_characters()
        raw = lambda token: bytes(to_byte[c] for c in token)
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        ids = {raw(t): i for t, i in model["model"]["vocab"].items() if t not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        made = [ids[raw(a + b)] for a, b in merges]
        if made != sorted(made) or max(i for b, i in ids.items() if len(b) == 1) > made[0]:
            raise ValueError("ids do not follow the order of the merges")
        self.encoding = tiktoken.Encoding(
            "vocabulary", pat_str=tokens.PIECES, mergeable_ranks=ids, special_tokens={})
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in special.items()}
        self.split = re.compile("|".join(f"({re.escape(t)})" for t in special)).split if special else None
        self.runs = re.compile(tokens.RUNS).findall
        self.beside_blank = re.compile(tokens.BESIDE_BLANK).search
        self.run = common.Memo(self.encoded, MEMO)
        self.after_blank = common.Memo(lambda run: self.encoded(" " + run), MEMO)

    def encoded(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def plain(self, text: str) -> bytes:
        if not text:
            return b""
        if self.beside_blank(text):
            return b"".join(map(self.run.__getitem__, self.runs(text)))
        first, *rest = text.split(" ")
        return self.run[first] + b"".join(map(self.after_blank.__getitem__, rest))

    def ids(self, text: str) -> bytes:
        if not self.special or not any(t in text for t in self.special):
            return self.plain(text)
        return b"".join(self.special.get(p) or self.plain(p) for p in self.split(text) if p)


def pieces(docs: DataFrame, vocabulary: str, length: int = LENGTH, end: int = 0, keep_ids: bool = True,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, start, length, ids_crc32, doc_tokens, ids)` of every piece; `ids` only if kept."""
    last = np.array([end], "<u4").tobytes()

    def make():
        encoder = common.per_worker(("encoder", vocabulary), lambda: Encoder(vocabulary))

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, starts, lengths, sums, totals, kept = [], [], [], [], [], []
            for i, t in enumerate(common.texts_of(batch.column(1))):
                data = encoder.ids(t) + last
                for at in range(0, len(data), 4 * length):
                    part = data[at:at + 4 * length]
                    rows.append(i)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    totals.append(len(data) // 4)
                    if keep_ids:
                        kept.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(columns, names)
        return apply

    key = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {key}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return common.per_batch(docs.select(doc_id, text), schema + (", ids array<int>" if keep_ids else ""), make)


class Tournament:
    """Leftmost bin with room for a piece: each inner node knows the most room below it."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.most = [0] * self.leaves + [room] * bins + [0] * (self.leaves - bins)
        for i in range(self.leaves - 1, 0, -1):
            self.most[i] = max(self.most[2 * i], self.most[2 * i + 1])

    def place(self, size: int) -> tuple[int, int]:
        """Take `size` from the leftmost bin with that much room; the bin and its room before."""
        most, i = self.most, 1
        while i < self.leaves:
            i *= 2
            if most[i] < size:
                i += 1
        room = most[i]
        most[i] = room - size
        bin_ = i - self.leaves
        while i := i // 2:
            most[i] = max(most[2 * i], most[2 * i + 1])
        return bin_, room


def first_fit_decreasing(lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece; the pieces are taken longest first, in the order given."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    whole = lengths >= length
    bins[whole] = np.arange(int(whole.sum()))
    rest = np.flatnonzero(~whole)
    rest = rest[np.argsort(-lengths[rest], kind="stable")]
    tree = Tournament(max(1, len(rest)), length)
    for i in rest:
        b, room = tree.place(int(lengths[i]))
        bins[i], offsets[i] = b + int(whole.sum()), length - room
    return bins, offsets


def packed(cuts: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES, seed: int = 0) -> DataFrame:
    """The rows of `cuts` with `sequence_id` and `offset`.

    `cuts` is materialised, so its row numbers are the same whenever a task runs again; the
    group of a row is drawn from that number. A group holds about `group_pieces` rows, however
    often an id or a text is repeated.
    """
    table = cut(cuts)
    groups = F.greatest(F.lit(1), F.ceil(F.lit(table.count()) / group_pieces))
    numbered = table.withColumn("_row", F.monotonically_increasing_id())
    dealt = numbered.withColumn("_group", F.pmod(F.xxhash64(F.lit(seed), "_row"), groups))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "_row"], kind="stable", na_position="last")
        bins, rows["offset"] = first_fit_decreasing(rows["length"].to_numpy(), length)
        rows["sequence_id"] = rows["_group"] * GROUP_SPAN + bins
        return rows[out]

    carried = [c for c in table.columns if c != "ids"]
    out = [*carried, "sequence_id", "offset", "_row"]
    schema = ", ".join(f"`{c}` {table.schema[c].dataType.simpleString()}" for c in carried)
    placed = dealt.select("_group", "_row", *carried).groupBy("_group").applyInPandas(
        pack, f"{schema}, sequence_id bigint, offset bigint, _row bigint")
    if "ids" in table.columns:
        return placed.join(numbered.select("_row", "ids"), "_row").drop("_row")
    return placed.drop("_row")


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, keep_ids: bool = True, **options) -> DataFrame:
    """Pieces of all documents with the sequence and the offset that each one takes."""
    return packed(pieces(docs, vocabulary, length, keep_ids=keep_ids, **options), length)


def sequences(placed: DataFrame) -> DataFrame:
    """`(sequence_id, ids)` of pieces with ids: the token ids of each sequence in order."""
    listed = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return listed.select("sequence_id", F.flatten("parts.ids").alias("ids"))
