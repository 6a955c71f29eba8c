"""Word bigrams under modified Kneser-Ney, each document scored by the others.

Documents that are read together form blocks, which are shuffled compressed. A block sends its distinct bigrams, a sorted array of
hashes with their counts, to ranges of hashes; a range adds up all blocks' counts and
answers each block in the order of its question. One of the blocks that have a bigram owns it, so
that blocks can add up, per word, how often it begins bigrams, how many different ones occur once,
twice and more, and how many end in it. Those sums go to ranges of words and come back likewise.
Nothing of the model is sent to the driver or held whole in one place, and each array is as large
as its block's share.

A document is scored by the counts of all others: its own are taken from those of its bigrams, of
its contexts and of its words, so rare words do not vouch for themselves. What bigrams leave goes
to words by how many different ones precede them, and what those leave to words by their letters:

    P(w | v) = (c(v w) - D(c(v w)) + g(v) P(w)) / c(v),   P(w) = (n(. w) - E(n(. w)) + h S(w)) / n(. .)

with the three discounts D of counts 1, 2 and more, E likewise for numbers of different words
before w, and g and h what they take away. A text's first word follows a start. Within a
block, words and bigrams are told apart by 64-bit hashes; between blocks by the first KEY_BITS of
them, so that of n different ones about n² / 2⁴⁵ pairs are taken for one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import common

#: Text and rows of a block, and the bytes that are hashed at a time.
BLOCK_BYTES, BLOCK_ROWS, CHUNK = 10 << 20, 50_000, 1 << 20
#: Blocks whose words one range holds together, and the bits of hashes that are sent.
RANGE_BLOCKS, KEY_BITS = 3, 44
#: Words of a block that are scored at a time, but for a document that has more.
AT_A_TIME = 200_000
START = np.uint64(0)
#: What is left to the lower level at least, as a count, where discounts are zero.
LEAST_MASS = 0.01
_BASE = 0x9E3779B97F4A7C15 | 5
_OF_BYTE = common.mixed(np.arange(1, 257, dtype=np.uint64))
_BETWEEN = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
DEALT = "block bigint, rows binary"
ASKED = "range int, block bigint, keys binary, numbers binary"
ANSWERED = "block bigint, range int, level int, numbers binary, totals binary"


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse, modulo 2⁶⁴; kept by the worker."""
    kept = common.per_worker("ngram powers", dict)
    if kept.get("n", 0) < n:
        size = max(n, CHUNK)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            kept[name] = np.cumprod(steps)
        kept["n"] = size
    return kept["up"], kept["down"]


def hashed_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and hash of every word in UTF-8 bytes that end in a character between words."""
    inner = ~_BETWEEN[data]
    turns = np.flatnonzero(np.diff(inner, prepend=False))
    starts, ends = turns[::2], turns[1::2]
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_OF_BYTE[data] * up[:len(data)], out=sums[1:])
    found = (sums[ends] - sums[starts]) * down[starts]
    return starts, ends, common.mixed(found + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def order_of(hashes: np.ndarray) -> np.ndarray:
    """The places of the numbers in rising order, equal ones by place: a sort of upper bits and places, mended where those tie."""
    mask = np.uint64((1 << len(hashes).bit_length()) - 1)
    keys = hashes & ~mask
    keys |= np.arange(len(hashes), dtype=np.uint64)
    keys.sort()
    order = (keys & mask).view(np.int64)
    keys &= ~mask
    found = hashes[order]
    for tied in np.unique(keys[1:][(keys[1:] == keys[:-1]) & (found[1:] != found[:-1])]):
        a, b = np.searchsorted(keys, tied, "left"), np.searchsorted(keys, tied, "right")
        order[a:b] = order[a:b][np.argsort(found[a:b], kind="stable")]
    return order


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different numbers in rising order, the first place of each, and which of them each place has."""
    wide = values.view(np.uint64)
    shift = 64 - int(wide.max()).bit_length() if len(wide) else 0
    order = order_of(wide << np.uint64(min(shift, 63)) if shift else wide)
    found = values[order]
    new = np.concatenate([np.ones(min(1, len(found)), bool), found[1:] != found[:-1]])
    place = np.empty(len(values), np.int64)
    place[order] = np.cumsum(new) - 1
    return found[new], order[new], place


def packed(numbers: np.ndarray) -> bytes:
    """Compressed 64-bit numbers, their bytes of equal weight together."""
    return pa.Codec("zstd", 1).compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes(), asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    raw = pa.Codec("zstd").decompress(data, 8 * n, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


class Block:
    """The words of some texts, and their distinct words and bigrams in order of hashes."""

    def __init__(self, texts: list[str]):
        encoded = [t.encode() for t in texts]
        self.joined = b"\n".join([*encoded, b""])
        self.first = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, encoded), np.int64, len(texts)) + 1, out=self.first[1:])
        data = np.frombuffer(self.joined, np.uint8)
        edges = np.unique(self.first[np.searchsorted(self.first[:-1], np.arange(0, self.first[-1] + CHUNK, CHUNK))])
        parts = [tuple(x + (a if i < 2 else 0) for i, x in enumerate(hashed_words(data[a:b])))
                 for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        small = np.int32 if len(self.joined) < 1 << 31 else np.int64  # for places, of which a worker holds many
        self.starts, self.ends, self.hashes = (np.concatenate(x, dtype=kind) for x, kind in zip(zip(none, *parts), (small, small, np.uint64)))
        del parts
        self.owner = (np.searchsorted(self.first, self.starts, "right") - 1).astype(small)
        self.count = np.bincount(self.owner, minlength=len(texts))
        # The start is a word, too, the least; it never ends a bigram.
        self.words, at, place = distinct(np.concatenate([[START], self.hashes]))
        self.word_at = (at - 1).astype(small)
        self.place = place[1:].astype(small)
        before = place[:-1]
        before[np.diff(self.owner, prepend=-1) > 0] = 0
        # Bigrams are numbered by their words, and asked for in the order of their hashes.
        _, at, pair = distinct(before * len(self.words) + self.place)
        self.pair = pair.astype(small)
        self.pair_counts = np.bincount(self.pair, minlength=len(at)).astype(np.int64)
        self.previous, self.next = before[at].astype(small), self.place[at]
        del before, place, pair
        keys = common.mixed(self.words[self.previous] * np.uint64(_BASE) + self.words[self.next])
        self.order = order_of(keys)
        self.pairs = keys[self.order]

    def listed(self) -> list[bytes]:
        """The distinct words; the start is an empty one."""
        at = self.word_at[1:]
        return [b"", *(self.joined[a:b] for a, b in zip(self.starts[at].tolist(), self.ends[at].tolist()))]

    def added(self, values: np.ndarray) -> np.ndarray:
        """Per text, the sum of a value of each distinct word over all its words."""
        return np.bincount(self.owner, values[self.place], len(self.count))

    def sums(self, counts: np.ndarray, owned: np.ndarray) -> np.ndarray:
        """Per distinct word, of the bigrams that the block owns: the count of those that it begins, how many
        of them occur once, twice and more, and how many end in it."""
        at = np.flatnonzero(owned)
        kind, n = np.minimum(counts[at], 3), len(self.words)
        begun = [np.bincount(self.previous[at], counts[at], n)]
        begun += [np.bincount(self.previous[at[kind == k]], minlength=n) for k in (1, 2, 3)]
        return np.stack([*begun, np.bincount(self.next[at], minlength=n)], 1).astype(np.int64)


def range_edges(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range of hashes begins and ends in a sorted array."""
    width = np.uint64(((1 << 64) - 1) // ranges)
    return np.concatenate([[0], np.searchsorted(hashes, np.arange(1, ranges, dtype=np.uint64) * width), [len(hashes)]])


def counts_of_counts(counts: np.ndarray) -> np.ndarray:
    """How many counts are 1, 2, 3 and 4, how many are above 2, and their sum."""
    return np.array([*((counts == i).sum() for i in range(1, 5)), (counts > 2).sum(), counts.sum()], np.int64)


def discount_values(n: np.ndarray) -> np.ndarray:
    """The discounts of counts 0, 1, 2 and more under modified Kneser-Ney, from counts of counts."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    return np.array([0.0] + [min(i, max(0.0, i - (i + 1) * y * n[i] / n[i - 1])) if n[i - 1] else 0.0 for i in (1, 2, 3)])


def discounted(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return values[np.minimum(counts, 3)]


def _rows(schema: str, rows: list[tuple]) -> pa.Table:
    types = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.table({name: pa.array(c, types[kind]) for (name, kind), c in zip(fields, columns)})


def _asked(block: int, ranges: int, hashes: np.ndarray, numbers: np.ndarray) -> pa.Table:
    """The keys of a block's sorted hashes and the numbers of each, cut into ranges; of every range a row, as each answers its totals."""
    edges = range_edges(hashes, ranges).tolist()
    keys = hashes >> np.uint64(64 - KEY_BITS)
    return _rows(ASKED, [(r, block, packed(np.diff(keys[a:b], prepend=np.uint64(0))), _numbers(numbers[a:b]))
                         for r, (a, b) in enumerate(zip(edges, edges[1:]))])


def _numbers(numbers: np.ndarray) -> bytes:
    """Packed numbers, column by column, after how many they are."""
    return numbers.size.to_bytes(8, "little") + packed(np.ascontiguousarray(numbers.T).ravel())


def _numbers_of(data: bytes, width: int) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    return unpacked(data[8:], n).reshape(width, n // width).T


def _in_order(found: pa.Table, level: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that all ranges answered, in the order of the question, and the sums of their totals."""
    rows = sorted((r, n, t) for r, l, n, t in zip(*(found.column(c).to_pylist() for c in ("range", "level", "numbers", "totals"))) if l == level)
    numbers = np.concatenate([np.zeros((0, width), np.int64), *(_numbers_of(n, width) for _, n, _ in rows)])
    return numbers, np.sum([np.frombuffer(t, np.int64) for _, _, t in rows] or [np.zeros(6, np.int64)], axis=0)


def _owned(found: pa.Table, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of the block's bigrams in all documents, whether the block owns them, and counts of counts."""
    numbers, totals = _in_order(found, 1, 1)
    numbers = numbers[:, 0]
    if len(numbers) != len(block.pairs):
        raise ValueError("a block has other texts than when it asked")
    placed = np.empty_like(numbers)
    placed[block.order] = numbers
    return placed >> 1, (placed & 1) == 1, totals


def _questions(asked: pa.Table, width: int) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """Block, range and length of the rows of a range, by block, and all their keys and numbers."""
    rows, keys, numbers = [], [], []
    for block, r, k, n in sorted(zip(*(asked.column(c).to_pylist() for c in ("block", "range", "keys", "numbers")))):
        numbers.append(_numbers_of(n, width))
        keys.append(np.cumsum(unpacked(k, len(numbers[-1]))))
        rows.append((block, r, len(numbers[-1])))
    return rows, np.concatenate(keys), np.concatenate(numbers)


def _answers(rows: list[tuple], level: int, numbers: np.ndarray, counts: np.ndarray) -> pa.Table:
    ends, totals = np.cumsum([n for _, _, n in rows]).tolist(), counts_of_counts(counts).tobytes()
    return _rows(ANSWERED, [(block, r, level, _numbers(numbers[a:b]), totals) for (block, r, _), a, b in zip(rows, [0, *ends], ends)])


def _pair_answers(asked: pa.Table) -> pa.Table:
    """The count of every bigram, doubled, plus one for the block of least number that has it."""
    rows, keys, counts = _questions(asked, 1)
    found, first, at = distinct(keys)
    total = np.bincount(at, counts[:, 0], len(found)).astype(np.int64)
    numbers = 2 * total[at]
    numbers[first] += 1
    return _answers(rows, 1, numbers[:, None], total)


def _word_answers(asked: pa.Table) -> pa.Table:
    """The five sums of every word, over all blocks."""
    rows, words, sums = _questions(asked, 5)
    found, _, at = distinct(words)
    total = np.stack([np.bincount(at, sums[:, i], len(found)) for i in range(5)], 1).astype(np.int64)
    return _answers(rows, 2, total[at], total[:, 4])


def log_probabilities(block: Block, found: pa.Table, letters: np.ndarray) -> np.ndarray:
    """Per text, the sum of the natural logarithms of its words' probabilities by the other documents.

    `letters` are the logarithms of the probabilities of the distinct words by their letters.
    """
    counts, _, of_counts = _owned(found, block)
    sums, of_words = _in_order(found, 2, 5)
    ends = np.concatenate([[0], np.cumsum(block.count)])
    # Documents are independent of each other from here on, so only some are in work at a time.
    edges = np.unique([*np.searchsorted(ends, np.arange(0, ends[-1], AT_A_TIME)), len(block.count)]).tolist()
    return np.concatenate([np.zeros(0), *(
        _of_documents(block, slice(ends[a], ends[b]), a, b - a, counts, of_counts, sums, of_words, letters) for a, b in zip([0, *edges], edges) if b > a)])


def _of_documents(block: Block, words: slice, first: int, docs: int, counts: np.ndarray, of_counts: np.ndarray,
                  sums: np.ndarray, of_words: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """`log_probabilities` of the `docs` texts from `first` on, whose words are those of `words`."""
    n_words = len(block.words)
    d, e = discount_values(of_counts), discount_values(of_words)
    # Distinct bigrams of each document, and what the others have of them.
    both, own = np.unique((block.owner[words] - first).astype(np.int64) * len(block.pairs) + block.pair[words], return_counts=True)
    doc, pair = both // len(block.pairs), both % len(block.pairs)
    left = counts[pair] - own
    lost, kept = np.minimum(counts[pair], 3), np.minimum(left, 3)
    # Contexts of each document, which lie together.
    before = block.previous[pair]
    new = (np.diff(doc, prepend=-1) != 0) | (np.diff(before, prepend=-1) != 0)
    contexts, at = before[new], np.cumsum(new) - 1
    of_context = sums[contexts]
    n = of_context[:, 0] - np.bincount(at, own, len(contexts))
    given = sum(d[k] * (of_context[:, k] - np.bincount(at[lost == k], minlength=len(contexts)) + np.bincount(at[kept == k], minlength=len(contexts)))
                for k in (1, 2, 3))
    lower = np.maximum(given, LEAST_MASS)
    # Words of each document.
    places, _, to = distinct(doc * n_words + block.next[pair])
    word = places % n_words
    leading = sums[word, 4] - np.bincount(to[left == 0], minlength=len(places))
    mass = e[1] * of_words[0] + e[2] * of_words[1] + e[3] * of_words[4]
    mass = mass + np.bincount(places // n_words, discounted(e, leading) - discounted(e, sums[word, 4]), docs)
    total = of_words[5] - np.bincount(doc[left == 0], minlength=docs)
    spelling = np.maximum(mass, LEAST_MASS)
    with np.errstate(divide="ignore"):
        share = (np.log(leading - discounted(e, leading)), np.log(spelling)[places // n_words] + letters[word])
        of_word = np.logaddexp(*share) - np.log(total + spelling - mass)[places // n_words]
        seen = n[at] > 0
        whole = np.log(np.where(seen, n[at] + lower[at] - given[at], 1.0))
        of_pair = np.logaddexp(np.log(left - discounted(d, left)), np.log(lower[at]) + of_word[to]) - whole
    return np.bincount(doc, own * np.where(seen, of_pair, of_word[to]), docs)


def dealt(docs: DataFrame, text: str) -> DataFrame:
    """The rows in blocks of about BLOCK_BYTES, each compressed in one row; equal blocks have equal numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, rows = [], 0, 0

        def block() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
                out.write_table(pa.Table.from_batches(held).combine_chunks())
            data = sink.getvalue().to_pybytes()
            number = int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([data], pa.binary())], ["block", "rows"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size, rows = size + batch.column(place).nbytes, rows + batch.num_rows
            if size >= BLOCK_BYTES or rows >= BLOCK_ROWS:
                yield block()
                held, size, rows = [], 0, 0
        if held:
            yield block()

    place = docs.columns.index(text)
    return docs.mapInArrow(run, DEALT)


def _opened(rows: pa.Table, text: str) -> tuple[pa.Table, list[str]]:
    """The rows of a block and their texts."""
    common.forget()
    table = pa.concat_tables([pa.ipc.open_stream(data).read_all() for data in rows.column("rows").to_pylist()])
    return table, common.texts_of(table.column(text))


def scored(docs: DataFrame, text: str, schema: StructType, score: Callable[[pa.Table, list[str], Block, pa.Table], pa.Table]) -> DataFrame:
    """What `score` makes of all rows. It is given a table of some rows, their texts and words, and the answers from
    which `log_probabilities` scores them; `schema` is that of its result."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    ranges = -(-max(1, size) // (RANGE_BLOCKS * BLOCK_BYTES))

    def ask_pairs(rows: pa.Table) -> pa.Table:
        block = Block(_opened(rows, text)[1])
        return _asked(rows.column("block")[0].as_py(), ranges, block.pairs, block.pair_counts[block.order, None])

    def ask_words(rows: pa.Table, found: pa.Table) -> pa.Table:
        block = Block(_opened(rows, text)[1])
        counts, owned, _ = _owned(found, block)
        return _asked(rows.column("block")[0].as_py(), ranges, block.words, block.sums(counts, owned))

    def score_rows(rows: pa.Table, found: pa.Table) -> pa.Table:
        table, texts = _opened(rows, text)
        return score(table, texts, Block(texts), found)

    blocks = dealt(docs, text)
    pairs = blocks.groupBy("block").applyInArrow(ask_pairs, ASKED).groupBy("range").applyInArrow(_pair_answers, ANSWERED)
    words = blocks.groupBy("block").cogroup(pairs.groupBy("block")).applyInArrow(ask_words, ASKED).groupBy("range").applyInArrow(_word_answers, ANSWERED)
    return blocks.groupBy("block").cogroup(pairs.unionByName(words).groupBy("block")).applyInArrow(score_rows, schema)
