"""SentencePiece encoding with the original byte span of every piece, and decoding.

A text is normalised by the longest prefixes that the model's compiled character map knows:
a double array of states, walked byte by byte from each place, whose leaves point at the
replacements. Every normalised byte keeps the source bytes it came from: its own byte where
a character stays as it is, the whole matched prefix where it is replaced. The library
segments the normalised text (with its own normalisation switched off), and each piece is
projected through the kept alignment to a span of the original bytes. Pieces that are
bytes of one unchanged character get one byte each; a blank that the model puts before the
text is an empty span, and so are the begin and end ids.

A text is cut where a run of white space follows other characters, if no piece of the
vocabulary reaches over such a place; the parts are kept between texts. Where that cannot
be shown (other segmentation than byte pairs, a character map that joins blanks, blanks
that are dropped), the text is treated as one part; results are the same.

A null text is empty: it has the begin and end ids only, and decodes to the empty text.
Repeated rows are encoded each, an empty table gives an empty result. Only the two columns
named are read, so further columns may have any name.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from . import common
from .tokens import SPACE

MEMO = 400_000
#: Longer parts are not kept between texts.
LONGEST_KEPT = 200
BLANK, MARK = b" ", "▁".encode()
#: Fixed numbers of the model file: fields, kinds of pieces, kinds of segmentation.
PIECE, TRAINER, NORMALIZER = 1, 2, 3
UNUSED_KIND, NORMAL_KIND, USER_KIND, BYTE_KIND = 5, 1, 4, 6
BYTE_PAIRS = 2
PARTS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a message in protocol-buffer wire format."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(message):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, message[at:at + size]
            at += size


def without_normalisation(model: bytes, escape: bool = False) -> bytes:
    """The model with a normaliser that changes nothing, or blanks only: later values replace earlier ones."""
    flags = bytes([3 << 3, 0, 4 << 3, 0, 5 << 3, escape])  # prefix, extra blanks, escaped blanks
    rules = b"\x12\0" + flags + b"\x32\0"  # no character map, no rules
    return model + bytes([NORMALIZER << 3 | 2, len(rules)]) + rules


class CharacterMap:
    """The compiled map: longest known prefix at a place, and what it becomes."""

    def __init__(self, compiled: bytes):
        self.units: list[int] = []
        if compiled:
            size, = struct.unpack_from("<I", compiled)
            self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist()
            self.replacements = compiled[4 + size:]

    @staticmethod
    def step(unit: int) -> int:
        """Offset from a state to its children."""
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix of data[at:] and its replacement."""
        units, found = self.units, None
        if not units:
            return None
        state = self.step(units[0])
        for i in range(at, len(data)):
            state ^= data[i]
            if state >= len(units) or units[state] & 0x800000FF != data[i]:
                break
            leaf, state = units[state] & 256, state ^ self.step(units[state])
            if leaf:
                found = i + 1 - at, units[state] & 0x7FFFFFFF
        if found is None:
            return None
        end = self.replacements.index(b"\0", found[1])
        return found[0], self.replacements[found[1]:end]

    def keys(self) -> Iterator[bytes]:
        """All known prefixes."""
        open_ = [(self.step(self.units[0]), b"")] if self.units else []
        while open_:
            state, key = open_.pop()
            for byte in range(1, 256):
                child = state ^ byte
                if child < len(self.units) and self.units[child] & 0x800000FF == byte:
                    if self.units[child] & 256:
                        yield key + bytes([byte])
                    open_.append((child ^ self.step(self.units[child]), key + bytes([byte])))


class Pieces:
    """Encoding, spans and decoding for one model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = f.read()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=without_normalisation(model))
        pieces, trainer, rules = [], {}, {}
        for number, value in fields(model):
            if number == PIECE:
                pieces.append(dict(fields(value)))
            elif number == TRAINER:
                trainer.update(fields(value))
            elif number == NORMALIZER:
                rules.update(fields(value))
        self.map = CharacterMap(rules.get(2, b""))
        self.prefix, self.squeeze, self.escape = (bool(rules.get(n, 1)) for n in (3, 4, 5))
        self.as_suffix = bool(trainer.get(24, 0))
        self.unknown = self.plain.unk_id()
        kinds = [(p.get(1, b""), p.get(3, NORMAL_KIND)) for p in pieces]
        self.is_byte = [kind == BYTE_KIND for _, kind in kinds]
        self.widths = [1 if kind == BYTE_KIND else len(p) for p, kind in kinds]
        own = sorted((p for p, kind in kinds if kind == USER_KIND), key=len, reverse=True)
        self.own = re.compile(b"|".join(map(re.escape, own))) if own else None
        texts = [p.decode() for p, kind in kinds if kind in (NORMAL_KIND, USER_KIND, UNUSED_KIND)]
        blank = MARK.decode() if self.escape else " "
        joined = {c for p in texts if len(p) > 1 for c in set(p)}
        self.guard = next((i for i, (p, kind) in enumerate(kinds) if kind == NORMAL_KIND and p.isalpha() and p.isascii()), None)
        #: White space that no longer piece contains, beside the blank.
        self.alone = {c for c in map(chr, range(0x3001)) if c.isspace() and c not in joined}
        self.blank = blank
        reached = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " " and c not in self.alone]
        #: White space before which a piece may go on.
        self.reached = re.compile("[" + "".join(map(re.escape, reached)) + "]") if reached else None
        self.blanks_only = not self.map.units and not own and not self.squeeze and not self.as_suffix
        self.in_parts = (
            trainer.get(3, 1) == BYTE_PAIRS and not own and not self.as_suffix and self.guard is not None
            and not any(blank in p.lstrip(blank) for p in texts)
            and not any(re.search(f"[{SPACE}{blank}]", k.decode(errors="replace")[1:]) for k in self.map.keys()))
        self.part = common.Memo(lambda text: self.made(text, False), MEMO)
        self.first = common.Memo(lambda text: self.made(text, True), MEMO)

    def marked(self, data: bytes, first: bool) -> tuple[bytes, list[int], list[int]]:
        """As `normalised`, for a model whose rules leave all but blanks as they are."""
        if not data:
            return b"", [], []
        wide = len(MARK) if self.escape else 1
        run = len(data) - len(data.lstrip(BLANK))
        if data.find(BLANK, run) < 0:
            begins = [i for i in range(run) for _ in range(wide)] + list(range(run, len(data)))
        else:
            begins = [i for i, byte in enumerate(data) for _ in range(wide if byte == 0x20 else 1)]
        ends = [i + 1 for i in begins]
        if first and self.prefix:
            data, begins, ends = BLANK + data, [0] * wide + begins, [0] * wide + ends
        return (data.replace(BLANK, MARK) if self.escape else data), begins, ends

    def normalised(self, data: bytes, first: bool = True, last: bool = True) -> tuple[bytes, list[int], list[int]]:
        """The normal form and, for each of its bytes, where its source begins and ends."""
        if self.blanks_only:
            return self.marked(data, first)
        out, begins, ends = bytearray(), [], []
        mark = MARK if self.escape else BLANK

        def blank(begin: int, end: int) -> None:
            out.extend(mark)
            begins.extend([begin] * len(mark))
            ends.extend([end] * len(mark))

        found = []  # (source begin, source end, replacement or None where the source stays)
        at = 0
        while at < len(data):
            own = self.own.match(data, at) if self.own else None
            if own:
                found.append((at, own.end(), None))
            elif (hit := self.map.longest(data, at)) is not None:
                found.append((at, at + hit[0], hit[1]))
            else:
                width = 1
                while at + width < len(data) and data[at + width] & 0xC0 == 0x80:
                    width += 1
                found.append((at, at + width, None))
            at = found[-1][1]
        shown = [data[b:e] if r is None else r for b, e, r in found]
        start = 0
        if self.squeeze and first:
            while start < len(found) and shown[start] == BLANK:
                start += 1
        if start == len(found):
            return b"", [], []
        if first and self.prefix and not self.as_suffix:
            blank(found[start][0], found[start][0])
        after_blank = self.squeeze and first
        for (begin, end, replaced), text in zip(found[start:], shown[start:]):
            if after_blank:
                kept = text.lstrip(BLANK)
                if replaced is None:
                    begin += len(text) - len(kept)
                text = kept
            for i, byte in enumerate(text):
                source = (begin, end) if replaced is not None else (begin + i, begin + i + 1)
                if byte == 0x20 and self.escape:
                    blank(*source)
                else:
                    out.append(byte)
                    begins.append(source[0])
                    ends.append(source[1])
            if text:
                after_blank = self.squeeze and text.endswith(BLANK)
        if self.squeeze and last:
            while out.endswith(mark):
                del out[-len(mark):], begins[-len(mark):], ends[-len(mark):]
        if last and self.prefix and self.as_suffix:
            blank(len(data), len(data))
        return bytes(out), begins, ends

    def segmented(self, normal: str) -> tuple[list[int], list[int]]:
        """Ids of a normal form and where each begins in its bytes, with an end after the last."""
        ids = self.plain.encode(normal)
        if self.unknown not in ids:
            return ids, [0, *accumulate(map(self.widths.__getitem__, ids))]
        proto = self.plain.encode(normal, return_type="proto").pieces
        ids, places = [p.id for p in proto], [p.begin for p in proto] + [len(normal.encode())]
        # The library gives all bytes of a character the place of its first one.
        for i in range(1, len(ids)):
            if self.is_byte[ids[i]] and self.is_byte[ids[i - 1]] and proto[i].begin == proto[i - 1].begin:
                places[i] = places[i - 1] + 1
        return ids, places

    def made(self, text: str, first: bool, last: bool = False) -> tuple[bytes, bytes, bytes, int, int, str, bool]:
        """Ids, begins and ends of the pieces, their number, the source's length, the decoded text, and whether parts may meet here."""
        data = text.encode()
        normal, begins, ends = self.normalised(data, first, last)
        shown = normal.decode()
        ids, places = self.segmented(shown)
        if first or self.unknown in ids:
            before = [] if first else [self.guard]
            decoded = self.library.decode(before + ids)[len(self.library.decode(before)):]
        else:
            decoded = shown.replace(self.blank, " ")  # bytes of whole characters make these again
        meets = bool(shown) and shown[-1] != self.blank and (first or shown[0] == self.blank or shown[0] in self.alone)
        return (array("i", ids).tobytes(), array("i", [begins[p] for p in places[:-1]]).tobytes(),
                array("i", [ends[p - 1] for p in places[1:]]).tobytes(), len(ids), len(data), decoded, meets)

    def split(self, text: str) -> list[str]:
        """The text cut where white space follows other characters and no piece reaches over it."""
        found = PARTS.findall(text)
        if not self.reached or not self.reached.search(text):
            return found
        joined: list[list[str]] = [found[:1]]
        for part in found[1:]:
            if self.reached.match(part):
                joined[-1].append(part)
            else:
                joined.append([part])
        return ["".join(parts) for parts in joined]

    def parts(self, text: str) -> list[tuple]:
        """What is known of the parts of a text, in order."""
        if not text:
            return []
        if self.in_parts:
            found = self.split(text)
            known = [self.first[found[0]] if len(found[0]) <= LONGEST_KEPT else self.made(found[0], True)]
            known += [self.part[p] if len(p) <= LONGEST_KEPT else self.made(p, False) for p in found[1:]]
            if all(p[6] for p in known[:-1]) and (known[-1][6] or not self.squeeze and known[-1][5][:1] in self.alone | {" "}):
                return known
        return [self.made(text, True, True)]

    def encode(self, text: str) -> tuple[bytes, np.ndarray, np.ndarray, str]:
        """Ids as bytes, begins and ends of the pieces in the bytes of the text, and the decoded text."""
        known = self.parts(text)
        if not known:
            return b"", np.zeros(0, np.int32), np.zeros(0, np.int32), ""
        ids, begins, ends, counts, sizes, decoded, _ = zip(*known)
        sizes = np.array(sizes, np.int64)
        shift = np.repeat((np.cumsum(sizes) - sizes).astype(np.int32), counts)
        return (b"".join(ids), np.frombuffer(b"".join(begins), "<i4") + shift,
                np.frombuffer(b"".join(ends), "<i4") + shift, "".join(decoded))


def pieces_of(model: str) -> Pieces:
    return common.per_worker(("pieces", model), lambda: Pieces(model))


def encoded(docs: DataFrame, model: str, begin: bool = True, end: bool = True, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, n_tokens, ids, pieces, decoded)` of every row.

    `ids` are little-endian unsigned 32-bit numbers, `pieces` the same ids with the bytes of
    the original text that each stands for, `decoded` the text that decoding the ids gives.
    """
    def make():
        own = pieces_of(model)
        before = np.array([own.library.bos_id()] if begin and own.library.bos_id() >= 0 else [], "<u4").tobytes()
        after = np.array([own.library.eos_id()] if end and own.library.eos_id() >= 0 else [], "<u4").tobytes()

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            all_ids, begins, ends, decoded, counts = [], [], [], [], []
            for t in common.texts_of(batch.column(1)):
                ids, b, e, d = own.encode(t)
                whole = len(t.encode())
                all_ids.append(before + ids + after)
                begins += [np.zeros(len(before) // 4, np.int32), b, np.full(len(after) // 4, whole, np.int32)]
                ends += [np.zeros(len(before) // 4, np.int32), e, np.full(len(after) // 4, whole, np.int32)]
                decoded.append(d)
                counts.append(len(all_ids[-1]) // 4)
            flat = pa.StructArray.from_arrays(
                [pa.array(np.frombuffer(b"".join(all_ids), "<i4")), pa.array(np.concatenate(begins)), pa.array(np.concatenate(ends))],
                ["id", "begin", "end"])
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(all_ids, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), flat), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids", "pieces", "decoded"])

        return lambda batch: apply(batch) if batch.num_rows else None

    key = docs.schema[doc_id].dataType.simpleString()
    return common.per_batch(
        docs.select(doc_id, text),
        f"doc_id {key}, n_tokens bigint, ids binary, pieces array<struct<id:int,begin:int,end:int>>, decoded string", make)


def decoded(rows: DataFrame, model: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """The rows with the text of their ids (little-endian unsigned 32-bit numbers; null: the empty text) in the column `name`."""
    place = rows.columns.index(ids)

    def make():
        library = pieces_of(model).library

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = library.decode([np.frombuffer(x or b"", "<u4").tolist() for x in batch.column(place).to_pylist()])
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, name])
        return lambda batch: apply(batch) if batch.num_rows else None

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return common.per_batch(rows, f"{schema}, `{name}` string", make)
