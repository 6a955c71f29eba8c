"""Exact token counts of every prefix by dynamic programming over byte-pair encodings.

A text falls into pieces that are encoded alone. Inside a piece the table is built byte by
byte: the encoding of a prefix ends in the one token that may follow the encoding of what
precedes it, so its count is one more than the count stored there. Two tokens may stand
side by side when encoding their joined bytes gives just these two. The counts of a text's
prefixes are the running sum over its pieces plus the table inside the piece that is cut.

Nulls count as empty texts; an empty text has the single prefix count 0. Repeated rows are
counted each. Only the two columns named are read, so further columns may have any name.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import common

#: How the byte-level encoding cuts a text before merging: fixed by the vocabulary.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space in the sense of that pattern.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A run without white space with the blank before it is encoded alike wherever it stands.
RUNS = f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]"
BESIDE_BLANK = f"[{SPACE}] | [{SPACE}]|^[{SPACE}]|[{SPACE}]$"
MEMO = 700_000


def byte_characters() -> dict[str, int]:
    """The printable character by which a vocabulary file writes each byte, to the byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixCounter:
    """Token counts of texts and of their prefixes for one vocabulary file."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)
        to_byte = byte_characters()
        raw = lambda token: bytes(to_byte[c] for c in token)
        self.special = [t["content"] for t in model["added_tokens"] if t["special"]]
        self.vocabulary = {raw(t): i for t, i in model["model"]["vocab"].items() if t not in self.special}
        self.longest: dict[bytes, int] = {}  # by the last three bytes of the tokens
        for token in self.vocabulary:
            self.longest[token[-3:]] = max(len(token), self.longest.get(token[-3:], 2))
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.ranks = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
        self.pieces, self.pieces_in = regex.compile(PIECES).findall, regex.compile(PIECES).finditer
        self.runs = re.compile(RUNS).findall
        self.space = re.compile(f"[{SPACE}]*").match
        self.beside_blank = re.compile(BESIDE_BLANK).search
        self.split = re.compile("|".join(f"({re.escape(t)})" for t in self.special)).split if self.special else None
        self.follows = common.Memo(lambda pair: self.merged(pair[0] + pair[1]) == list(pair), MEMO)
        self.piece_table = common.Memo(self.short_table, MEMO)
        self.run_count = common.Memo(lambda run: sum(self.piece_table[p][-1] for p in self.pieces(run)), MEMO)
        self.after_blank = common.Memo(lambda run: self.run_count.make(" " + run), MEMO)

    def merged(self, data: bytes) -> list[bytes]:
        """The encoding of a few bytes by merging the pair of least rank again and again."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get((parts[i], parts[i + 1]), 1 << 60))
            if (pair := (parts[best], parts[best + 1])) not in self.ranks:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def table(self, data: bytes) -> list[int]:
        """Token counts of all byte prefixes of one piece, from the empty one on."""
        counts, last = [0], [b""]
        vocabulary, follows, longest = self.vocabulary, self.follows, self.longest
        for end in range(1, len(data) + 1):
            start = max(0, end - longest.get(data[end - 3:end], 2)) if end > 2 else 0
            while (token := data[start:end]) not in vocabulary or start and not follows[last[start], token]:
                start += 1
            counts.append(counts[start] + 1)
            last.append(token)
        return counts

    def short_table(self, piece: str) -> bytes | list[int]:
        counts = self.table(piece.encode())
        return bytes(counts) if len(counts) < 256 else counts

    def segments(self, text: str) -> tuple[list[str], int]:
        """The parts of a text between special tokens, and the number of those."""
        if not self.special or not any(t in text for t in self.special):
            return [text], 0
        parts = self.split(text)
        step = 1 + len(self.special)
        return parts[::step], len(parts[::step]) - 1

    def plain_count(self, text: str) -> int:
        if not text:
            return 0
        if self.beside_blank(text):
            return sum(map(self.run_count.__getitem__, self.runs(text)))
        first, *rest = text.split(" ")
        return self.run_count[first] + sum(map(self.after_blank.__getitem__, rest))

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        parts, special = self.segments(text)
        return special + sum(map(self.plain_count, parts))

    def prefixes(self, text: str) -> np.ndarray:
        """Token counts of text[:i] for every i from 0 to the length of the text."""
        out: list[int] = []
        base, rest = 0, text
        while True:
            found = min(((p, t) for t in self.special if (p := rest.find(t)) >= 0), default=None)
            if found is None:
                return np.array(out + [base + c for c in self.exact_prefixes(rest)], dtype=np.int64)
            place, token = found
            # A special token that is cut off is ordinary text.
            own = self.exact_prefixes(rest[:place] + token[:-1])
            out += [base + c for c in own]
            base += own[place] + 1
            rest = rest[place + len(token):]

    def exact_prefixes(self, text: str) -> list[int]:
        """Counts of text[:i]: pieces before the cut, and the table of the cut piece.

        White space at the end of a prefix is one piece however the whole text goes on, and
        a contraction that is cut falls into its mark and its letters.
        """
        counts = [0] * (len(text) + 1)
        at = total = 0  # total: tokens of the pieces before `at`
        before_space, space_from = 0, None
        for piece in self.pieces(text):
            blank = len(self.space(piece)[0])
            if blank and space_from is None:
                space_from, before_space = at, total
            own = self.piece_table[piece]
            width = 0
            contraction = piece[0] == "'" and len(piece) > 1 and piece[1].isalpha()
            for i, c in enumerate(piece, 1):
                width += len(c.encode())
                counts[at + i] = total + own[width]
                if contraction and i < len(piece):
                    counts[at + i] = total + i
            if blank:
                run = text[space_from:at + blank].encode()
                table, width = self.table(run), len(text[space_from:at].encode())
                for i in range(1, blank + 1):
                    width += len(piece[i - 1].encode())
                    counts[at + i] = before_space + table[width]
            at += len(piece)
            total += own[-1]
            if blank < len(piece):
                space_from = None
        return counts

    def cut(self, text: str, limit: int) -> int:
        """Code points of the longest prefix of at most `limit` tokens, from the stored counts.

        Whole pieces are counted up to the first settled place over the limit: one that has
        no white space before it, so that its count holds however the text goes on. Only the
        part after the last settled place within the limit needs its prefixes.
        """
        if any(t in text for t in self.special):
            return int(np.flatnonzero(self.prefixes(text) <= limit)[-1])
        at = total = from_at = from_total = 0
        for found in self.pieces_in(text):
            at = found.end()
            total += self.piece_table[found[0]][-1]
            if not self.space(found[0][-1])[0]:
                if total > limit:
                    break
                from_at, from_total = at, total
        counts = self.exact_prefixes(text[from_at:at])
        return from_at + max(i for i, c in enumerate(counts) if from_total + c <= limit)


def counter(vocabulary: str) -> PrefixCounter:
    return common.per_worker(("tokens", vocabulary), lambda: PrefixCounter(vocabulary))


def token_counts(docs: DataFrame, vocabulary: str, limit: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, n_bytes, n_tokens, over_limit, cut_chars)` of every row.

    `cut_chars` answers the truncation question from the prefix counts: the code points of
    the longest prefix of at most `limit` tokens.
    """
    def make():
        count = counter(vocabulary)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = common.texts_of(batch.column(1))
            tokens = [count.count(t) for t in texts]
            return pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_()),
                pa.array([count.cut(t, limit) if n > limit else len(t) for t, n in zip(texts, tokens)], pa.int64()),
            ], ["doc_id", "n_bytes", "n_tokens", "over_limit", "cut_chars"])
        return apply

    key = docs.schema[doc_id].dataType.simpleString()
    return common.per_batch(
        docs.select(doc_id, text), f"doc_id {key}, n_bytes bigint, n_tokens bigint, over_limit boolean, cut_chars bigint", make)


def prefix_counts(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, counts)`: counts[i] is the exact token count of the first i code points."""
    def make():
        count = counter(vocabulary)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            listed = [count.prefixes(t) for t in common.texts_of(batch.column(1))]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(listed, pa.list_(pa.int64()))], ["doc_id", "counts"])
        return apply

    key = docs.schema[doc_id].dataType.simpleString()
    return common.per_batch(docs.select(doc_id, text), f"doc_id {key}, counts array<bigint>", make)
