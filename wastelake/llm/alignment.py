"""Which tokens of two tokenizers stand for the same bytes, over a whole corpus.

Each text with one blank before it is encoded by a byte-level vocabulary of the tokenizers
library (A) and by a sentencepiece model (B), which puts the blank there by itself. The
spans of the tokens come from the libraries: character offsets of A and byte spans of
sentencepiece's proto (its successor of the immutable one) are coarse cuts. Where several tokens
share a character, or the byte tokens of one character share its span, the cuts between
them follow from the bytes that the tokens decode to. The joined bytes of both sides must equal the
text, else the text has no tokens. Tokens are linked where their bytes overlap. Places
where tokens of both sides end cut the text into groups.

Both sides fall apart at the same places: where white space follows other characters, and
no piece of B reaches over it. Such parts are encoded and linked once and kept; a text is
the run of its parts. Where this cannot be shown the text is one part.

Counting. Documents are written in blocks of a bounded number of links; a block numbers its
distinct id pairs, and a document holds the numbers of its own with how often each is linked. What is
shuffled is one row per block and pair with the number of its documents, added up over
all blocks, compared with the most of its A id, and sent back to the blocks that asked.
No pair is collected or broadcast, and a pair that every document has is one row per block.

A null or empty text has no tokens: its numbers are 0 and `groups` is empty. Repeated rows
are documents of their own; an empty table gives an empty result. Only the two columns
named are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate
from operator import add

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import work_path
from . import common
from .pieces import MARK, Pieces, without_normalisation
from .tokens import byte_characters

MEMO = 280_000
#: Longer parts are not kept between texts.
LONGEST_KEPT = 200
#: A block ends after so many documents or entries.
BLOCK_DOCS, BLOCK_ENTRIES = 4096, 500_000
#: Marks that A never joins to a letter before them.
MARKS = ".,;:!?'\")]}"
BYTE = re.compile(rb"<0x([0-9A-F]{2})>")


def refined(coarse: list[int], widths: Iterable[int]) -> list[int] | None:
    """Ends of tokens from coarse ends and the bytes that each token decodes to.

    A coarse end holds where the next token has another one; tokens that share an end lie
    side by side before it, each as wide as its bytes. None if the two disagree.
    """
    ends = list(accumulate(widths))
    if ends != coarse and not all(
            end == rough or i + 1 < len(ends) and coarse[i + 1] == rough for i, (end, rough) in enumerate(zip(ends, coarse))):
        return None
    return ends


def summed(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the amounts of each."""
    if len(keys) and keys[0:1].dtype.itemsize == 4 and int(amounts.max()) < 1 << 32:
        both = np.sort(keys.astype(np.uint64) << np.uint64(32) | amounts.astype(np.uint64))  # one sort, without an index
        keys, amounts = both >> np.uint64(32), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
    else:
        order = np.argsort(keys, kind="stable")
        keys, amounts = keys[order], amounts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first].astype(np.int64), np.add.reduceat(amounts, first) if len(first) else np.zeros(0, np.int64)


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the place of each key among them."""
    if len(keys) and len(keys) < 1 << 32 and int(keys.max()) < 1 << 32:
        both = np.sort(keys.astype(np.uint64) << np.uint64(32) | np.arange(len(keys), dtype=np.uint64))
        ordered, at = (both >> np.uint64(32)).astype(np.int64), both & np.uint64(0xFFFFFFFF)
        new = np.append(True, ordered[1:] != ordered[:-1])
        places = np.empty(len(keys), np.int64)
        places[at] = np.cumsum(new) - 1
        return ordered[new], places
    distinct, places = np.unique(keys, return_inverse=True)
    return distinct, places


class Aligner:
    """Tokens, links and groups of texts for two vocabularies."""

    def __init__(self, bytes_file: str, pieces_file: str):
        self.a = Tokenizer.from_file(bytes_file)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        to_byte = byte_characters()
        self.a_bytes = {i: bytes(to_byte[c] for c in t) if all(c in to_byte for c in t) else t.encode()
                        for t, i in self.a.get_vocab().items()}
        own = Pieces(pieces_file)
        with open(pieces_file, "rb") as f:
            self.b = sentencepiece.SentencePieceProcessor(model_proto=without_normalisation(f.read(), True))
        self.kept = own
        self.in_parts = own.in_parts and not own.map.units and not own.squeeze and own.prefix and own.escape
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i).encode()
            byte = BYTE.fullmatch(piece) if self.b.is_byte(i) else None
            self.b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace(MARK, b" "))
        self.span = len(self.b_bytes)
        #: Links as numbers of four bytes where the vocabularies allow it.
        self.code = "I" if (max(self.a_bytes) + 1) * self.span <= 1 << 32 else "q"
        #: Characters that stand side by side in some piece of B.
        self.beside = {two for p in map(self.b.id_to_piece, range(self.b.get_piece_size())) for two in map("".join, zip(p, p[1:]))}
        self.part = common.Memo(self.new, MEMO)

    def new(self, text: str) -> tuple[bytes, bytes, bytes, bool]:
        """What is known of a part; of a word and the marks behind it, from both, where no piece of B reaches over."""
        word = text.rstrip(MARKS)
        marks = text[len(word):]
        if not (self.in_parts and marks and word and word[-1].isalpha() and word[-1] + marks[0] not in self.beside):
            return self.made(text)
        (n, links, groups, good), (m, more, others, well) = self.part[word], self.part[marks]
        if not (good and well):
            return b"", b"", b"", False
        return array("q", map(add, array("q", n), array("q", m))).tobytes(), links + more, groups + b";" + others, True

    def a_ends(self, text: str, data: bytes) -> tuple[list[int], list[int] | None]:
        """Ids of A and the byte ends of its tokens."""
        found = self.a.encode(text, add_special_tokens=False)
        ids = found.ids
        tokens = [self.a_bytes[i] for i in ids]
        if b"".join(tokens) != data:
            return ids, None
        coarse = [e for _, e in found.offsets]
        if len(text) < len(data):  # from characters to bytes
            after = [0, *accumulate(len(c.encode()) for c in text)]
            coarse = [after[e] for e in coarse]
        return ids, refined(coarse, map(len, tokens))

    def b_ends(self, text: str, data: bytes) -> tuple[list[int], list[int] | None]:
        """Ids of B and the byte ends of its tokens; the text begins with the blank that B adds."""
        found = (self.b.encode(text, return_type="proto") if self.in_parts
                 else self.kept.library.encode(text[1:], return_type="proto")).pieces
        ids = [p.id for p in found]
        tokens = [self.b_bytes[i] for i in ids]
        if b"".join(tokens) != data:
            return ids, None
        coarse = [p.end for p in found]
        if len(text) < len(data) or not text.isprintable():
            # A byte token but the last of its character has an empty span; it shares the end of the next.
            for i in range(len(found) - 2, -1, -1):
                if found[i].begin == coarse[i]:
                    coarse[i] = coarse[i + 1]
        if not self.in_parts:
            coarse = [e + 1 for e in coarse]
        return ids, refined(coarse, map(len, tokens))

    def made(self, text: str) -> tuple[bytes, bytes, bytes, bool]:
        """Numbers of tokens, groups and links; the links as A id * size of B + B id; the groups; whether the bytes agree."""
        data = text.encode()
        a_ids, a_ends = self.a_ends(text, data)
        b_ids, b_ends = self.b_ends(text, data)
        if a_ends is None or b_ends is None:
            return b"", b"", b"", False
        links, groups, span = [], [], self.span
        i = j = 0
        group_a, group_b = "", ""
        while i < len(a_ids):
            # The next tokens of both sides overlap; the one that ends first is done.
            a, b, a_end, b_end = a_ids[i], b_ids[j], a_ends[i], b_ends[j]
            links.append(a * span + b)
            if a_end <= b_end:
                group_a += f",{a}"
                i += 1
            if b_end <= a_end:
                group_b += f",{b}"
                j += 1
            if a_end == b_end:
                groups.append(f"{group_a[1:]}|{group_b[1:]}")
                group_a = group_b = ""
        numbers = array("q", (i, j, len(groups), len(links)))
        return numbers.tobytes(), array(self.code, links).tobytes(), ";".join(groups).encode(), True

    def parts(self, text: str) -> list[str]:
        """The text, after its blank, as parts that both sides encode alone."""
        return self.kept.split(" " + text) if self.in_parts else [" " + text]

    def aligned(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
        """The four numbers of a text, its distinct links with how often each occurs, and its groups."""
        nothing = np.zeros(4, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), b""
        if not text or self.in_parts and MARK.decode() in text:
            return nothing
        parts = self.parts(text)
        often = Counter(parts)
        known = {p: self.part[p] if len(p) <= LONGEST_KEPT else self.made(p) for p in often}
        numbers, links, groups, agree = zip(*known.values())
        if not all(agree):
            return nothing
        times = np.fromiter(often.values(), np.int64, len(often))
        numbers = np.frombuffer(b"".join(numbers), np.int64).reshape(-1, 4)
        codes, counts = summed(np.frombuffer(b"".join(links), np.dtype(self.code)), np.repeat(times, numbers[:, 3]))
        of = dict(zip(known, groups))
        return times @ numbers, codes, counts, b";".join(map(of.__getitem__, parts))


def aligner(bytes_file: str, pieces_file: str) -> Aligner:
    return common.per_worker(("aligner", bytes_file, pieces_file), lambda: Aligner(bytes_file, pieces_file))


def narrow(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on in the fewest bytes each, that width first."""
    most = int(values.max()) if len(values) else 0
    kind = next(t for t in ("<u1", "<u2", "<u4", "<u8") if most <= np.iinfo(t).max)
    return kind[2].encode() + values.astype(kind).tobytes()


def widened(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u" + data[:1].decode(), offset=1).astype(np.int64)


WRITTEN = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, block string, own binary, times binary, pairs binary, pair_docs binary"


def written(docs: DataFrame, bytes_file: str, pieces_file: str, digests: bool, doc_id: str, text: str) -> DataFrame:
    """Documents with their links by number within their block; the block's pairs are in its last row."""
    key = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", *(part.split()[0] for part in WRITTEN.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        own = aligner(bytes_file, pieces_file)
        task, number = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []
        entries = 0

        def closed() -> pa.RecordBatch:
            nonlocal rows, entries, number
            pairs, places = numbered(np.concatenate([r[2] for r in rows]))
            numbers_of = np.split(places, np.cumsum([len(r[2]) for r in rows])[:-1])
            pair_docs = np.bincount(places, minlength=len(pairs)).astype(np.int64)
            n, counts = len(rows), np.array([r[1] for r in rows])
            last = [None] * (n - 1)
            out = pa.RecordBatch.from_arrays([
                pa.concat_arrays([r[0] for r in rows]), *(pa.array(counts[:, i], pa.int64()) for i in range(4)),
                pa.array([r[4] for r in rows], pa.string()), pa.array([f"{task}-{number}"] * n, pa.string()),
                pa.array([narrow(x) for x in numbers_of], pa.binary()), pa.array([narrow(r[3]) for r in rows], pa.binary()),
                pa.array([*last, pairs.tobytes()], pa.binary()), pa.array([*last, pair_docs.tobytes()], pa.binary())], names)
            rows, entries, number = [], 0, number + 1
            return out

        for batch in batches:
            for i, t in enumerate(common.texts_of(batch.column(1))):
                numbers, codes, counts, groups = own.aligned(t)
                shown = hashlib.sha256(groups).hexdigest() if digests and numbers[0] else groups.decode()
                rows.append((batch.column(0).slice(i, 1), numbers, codes, counts, shown))
                entries += len(codes)
                if len(rows) >= BLOCK_DOCS or entries >= BLOCK_ENTRIES:
                    yield closed()
        if rows:
            yield closed()

    made = docs.select(doc_id, text).mapInArrow(run, f"doc_id {key}, {WRITTEN}")
    path = work_path(docs.sparkSession, "links")
    made.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


def pair_counts(blocks: DataFrame, pieces: int) -> DataFrame:
    """`(pair, a, docs, best)`: documents that hold a pair linked, and whether no pair of its A id has more."""
    counted = blocks.groupBy("pair").agg(F.sum("docs").alias("docs")).withColumn("a", F.expr(f"pair div {pieces}"))
    most = counted.groupBy("a").agg(F.max("docs").alias("most"))
    return counted.join(most, "a").select("pair", "a", "docs", (F.col("docs") == F.col("most")).alias("best"))


def alignments(docs: DataFrame, bytes_file: str, pieces_file: str, digests: bool = False,
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)` of every row.

    A pair's count is the number of documents that hold it linked. `n_best` are the links whose
    count is the highest of their A id, ties included; `count_sum` adds up the counts of all links.
    `groups` reads `a1,a2|b1;a3|b2,b3`; with `digests` it is the SHA-256 of that (without tokens still empty),
    which saves writing and moving a text several times as long as the document.
    """
    pieces = len(aligner(bytes_file, pieces_file).b_bytes)
    table = written(docs, bytes_file, pieces_file, digests, doc_id, text)

    def unfolded(batch: pa.RecordBatch) -> pa.RecordBatch:
        blocks, pairs, counts = (c.to_pylist() for c in batch.columns)
        pairs, counts = ([np.frombuffer(x, np.int64) for x in column] for column in (pairs, counts))
        return pa.RecordBatch.from_arrays([
            pa.array(blocks, pa.string()).take(pa.array(np.repeat(np.arange(len(blocks)), [len(p) for p in pairs]))),
            pa.array(np.concatenate(pairs)), pa.array(np.concatenate(counts))], ["block", "pair", "docs"])

    blocks = common.per_batch(table.filter("pairs is not null").select("block", "pairs", "pair_docs"),
                              "block string, pair bigint, docs bigint", lambda: unfolded)
    answers = blocks.select("block", "pair").join(pair_counts(blocks, pieces).select("pair", "docs", "best"), "pair")

    def judged(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("pair")  # the numbers of a block follow its pairs
        docs_of, best_of = right["docs"].to_numpy(), right["best"].to_numpy(zero_copy_only=False).astype(np.int64)
        best, total = [], []
        for own, times in zip(left["own"].to_pylist(), left["times"].to_pylist()):
            own, times = widened(own), widened(times)
            best.append(int(best_of[own] @ times))
            total.append(int(docs_of[own] @ times))
        return pa.table({"doc_id": left["doc_id"], "n_a": left["n_a"], "n_b": left["n_b"], "n_groups": left["n_groups"], "n_links": left["n_links"],
                         "n_best": pa.array(best, pa.int64()), "count_sum": pa.array(total, pa.int64()), "groups": left["groups"]})

    key = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "own", "times"]
    return table.select("block", *names).groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        judged, f"doc_id {key}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string")
