"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

A byte goes if a string of `length` bytes that covers it also starts anywhere else. Every
such string contains an anchor: the position in it whose next KEY bytes hash lowest
(leftmost among equals), which depends on the string alone. So it suffices to index the
suffixes that begin at anchors, about one in sixty.

Each batch of documents gets its suffix array: the anchors' suffixes, in the order of the
hash of their first KEY bytes, cut into ranges that tasks handle alone. A new batch is
merge-scanned against the arrays of all existing levels, which yields the suffixes that
occur again, and is merged with the levels of its own size, like a carry in a binary
counter. So every pair of batches is compared once, and a suffix is rewritten as often as
the logarithm of the number of batches.

Anchors whose suffix occurs once cover nothing. For the others, strings sharing an anchor
form a span; a span found twice is repeated as a whole. In a span found once (the border of
a repeat) each string is asked for alone. Questions go out from parts, groups of documents of
bounded size, as sorted hashes that each part sends once, however often it has them, so a
passage that a third of all documents share is no large group anywhere. There are as many
hash ranges as parts; for tables of many TB, larger parts keep questions from splitting into
messages of single hashes.

Strings are compared by 64-bit hashes; among n different strings the chance of a wrong match
is about n * n / 2 ** 65. Nulls count as empty texts. Repeated rows repeat each other. An
empty table gives an empty result. Only the two columns named are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import common

LENGTH, KEY = 200, 64
BATCHES = 4
PART_BYTES = 8 << 20
CHUNK = 1 << 20
FACTOR = 0x9E3779B97F4A7C15
NONE = np.zeros(0, np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out


class Bytes:
    """A stretch of bytes of which any substring is hashed in one step."""

    def __init__(self, data: np.ndarray, length: int):
        self.up, self.down, letters = common.per_worker(("suffix powers", length), lambda: (
            powers(FACTOR, CHUNK + length), powers(pow(FACTOR, -1, 1 << 64), CHUNK + length),
            common.mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(FACTOR))))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(letters[data] * self.up[:len(data)], out=self.sums[1:])

    def raw(self, start, end) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def hashes(self, start: np.ndarray, end: np.ndarray, salt) -> np.ndarray:
        return common.mixed(self.raw(start, end) + np.asarray(salt, np.uint64))


def sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    n = len(h)
    padded = np.full(-(-n // width) * width, ~np.uint64(0), np.uint64)
    padded[:n] = h
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def leftmost_least(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost least value of every window."""
    least = sliding_least(h, width)
    n = len(least)
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    ends = np.concatenate([starts[1:], [n]])
    out = np.empty(n, np.int64)
    steps = np.arange(width)
    first = np.concatenate([s[:, None] + np.argmax(h[s[:, None] + steps] == least[s][:, None], axis=1)[:, None]
                            for s in np.array_split(starts, max(1, len(starts) // 4096))]).ravel()
    out[:] = np.repeat(first, ends - starts)
    for i in np.flatnonzero(first < ends - 1):  # the least value comes again before its windows end
        s, e = int(starts[i]), int(ends[i])
        equal = s + np.flatnonzero(h[s:e + width - 1] == least[s])
        out[s:e] = equal[np.searchsorted(equal, np.arange(s, e))]
    return out


class Anchors:
    """Anchors of one chunk: document, place of the strings' starts, and hashes."""

    def __init__(self, data: np.ndarray, docs: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int):
        """`data`: stretches of documents side by side, from `starts` to `ends`, that begin at `offsets` of `docs`."""
        self.length, self.text = length, Bytes(data, length)
        place = np.arange(len(data) - KEY + 1)
        h = self.text.hashes(place, place + KEY, 0)
        allowed = np.zeros(len(data) + 1, np.int64)
        long_ = ends - starts >= length
        np.add.at(allowed, starts[long_], 1)
        np.add.at(allowed, ends[long_] - length + 1, -1)
        at = np.flatnonzero(np.cumsum(allowed)[:len(data) - length + 1] > 0)
        anchor = leftmost_least(h, length - KEY + 1)[at]
        owner = np.searchsorted(starts, at, side="right") - 1
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])
        first = np.flatnonzero(new)
        self.place, self.first, self.last = anchor[first], at[first], at[np.concatenate([first[1:], [len(at)]]) - 1]
        owner = owner[first]
        self.doc, self.shift = docs[owner], offsets[owner] - starts[owner]
        self.key = h[self.place]

    def spans(self, of: np.ndarray) -> np.ndarray:
        """Hashes of all bytes that an anchor's strings cover, and of where it stands in them."""
        first, last = self.first[of], self.last[of]
        return self.text.hashes(first, last + self.length, (self.place[of] - first + 1) * 1_000_003 + last - first)

    def strings(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the anchors' strings, and the strings' hashes."""
        counts = self.last[of] - self.first[of] + 1
        starts = np.repeat(self.first[of] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return starts, self.text.hashes(starts, starts + self.length, 7)


def chunks(texts: list[bytes], length: int) -> Iterator[Anchors]:
    """Anchors of documents, in chunks of bounded size; a long document is cut with an overlap."""
    pieces = ((i, at, t[at:at + CHUNK]) for i, t in enumerate(texts) if len(t) >= length
              for at in range(0, len(t) - length + 1, CHUNK - length + 1))
    waiting: list[tuple[int, int, bytes]] = []
    size = 0

    def made() -> Anchors:
        lengths = np.array([len(p[2]) for p in waiting])
        ends = np.cumsum(lengths)
        return Anchors(np.frombuffer(b"".join(p[2] for p in waiting), np.uint8), np.array([p[0] for p in waiting]),
                       np.array([p[1] for p in waiting]), ends - lengths, ends, length)

    for piece in pieces:
        if size + len(piece[2]) > CHUNK and waiting:
            yield made()
            waiting, size = [], 0
        waiting.append(piece)
        size += len(piece[2])
    if waiting:
        yield made()


def by_range(keys: np.ndarray, log_ranges: int) -> Iterator[tuple[int, np.ndarray]]:
    """Sorted hashes cut by their highest bits."""
    if not len(keys):
        return
    place = (keys >> np.uint64(64 - log_ranges)).astype(np.int64) if log_ranges else np.zeros(len(keys), np.int64)
    starts = np.flatnonzero(np.diff(place, prepend=-1))
    for a, b in zip(starts, [*starts[1:], len(keys)]):
        yield int(place[a]), keys[a:b]


def blob(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys, "<u8").tobytes()


def unblob(data) -> np.ndarray:
    return np.frombuffer(data, "<u8")


def joined(blobs) -> np.ndarray:
    return np.concatenate([NONE, *map(unblob, blobs)])


def more_than_once(keys: np.ndarray) -> np.ndarray:
    """The hashes that occur twice or more, sorted."""
    ordered = np.sort(keys)
    return np.unique(ordered[1:][ordered[1:] == ordered[:-1]])


def held(keys: np.ndarray, array: np.ndarray) -> np.ndarray:
    """Whether each hash is in a sorted array."""
    if not len(array):
        return np.zeros(len(keys), bool)
    return array[np.minimum(np.searchsorted(array, keys), len(array) - 1)] == keys


class Family:
    """Suffix arrays of geometric sizes over the batches added so far.

    A level is a table `(range, keys)`: sorted hashes of the suffixes of 2 ** level batches.
    `matches` are tables of the suffixes that were met again when a batch was added.
    """

    def __init__(self, log_ranges: int, length: int = LENGTH):
        self.log_ranges, self.length = log_ranges, length
        self.levels: dict[int, DataFrame] = {}
        self.matches: list[DataFrame] = []

    def arrays(self, batch: DataFrame) -> DataFrame:
        """Sorted hashes of a batch's anchors, in parts of each range, and those met twice within a part."""
        length, log_ranges = self.length, self.log_ranges

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = np.concatenate([NONE, *(c.key for c in chunks([t.encode() for t in common.texts_of(b.column(0))], length))])
                twice = dict(by_range(more_than_once(found), log_ranges))
                rows = [(r, blob(keys), blob(twice.get(r, NONE))) for r, keys in by_range(np.unique(found), log_ranges)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], ["range", "keys", "twice"])

        return batch.select("text").mapInArrow(run, "range int, keys binary, twice binary")

    def add(self, batch: DataFrame) -> None:
        """Scan a batch against all levels and merge it with those of its size."""
        target = 0
        while target in self.levels:
            target += 1
        table = self.arrays(batch).withColumn("level", F.lit(-1))
        for level, array in self.levels.items():
            table = table.unionByName(array.select("range", "keys", F.lit(b"").alias("twice"), F.lit(level).alias("level")))

        def merge(rows: pd.DataFrame) -> pd.DataFrame:
            own = rows[rows["level"] < 0]
            new = joined(own["keys"])
            again = [joined(own["twice"]), more_than_once(new)]
            new = merged = np.unique(new)
            for level, keys in zip(rows["level"], rows["keys"]):
                if level >= 0:
                    again.append(new[held(new, unblob(keys))])
                    if level < target:
                        merged = np.union1d(merged, unblob(keys))
            return pd.DataFrame({"range": rows["range"].iloc[0], "kind": ["level", "match"],
                                 "keys": [blob(merged), blob(np.unique(np.concatenate(again)))]})

        done = cut(table.groupBy("range").applyInPandas(merge, "range int, kind string, keys binary"))
        for level in range(target):
            del self.levels[level]
        self.levels[target] = done.filter("kind = 'level'").select("range", "keys")
        self.matches.append(done.filter("kind = 'match'").select("range", "keys"))

    def repeated(self) -> DataFrame:
        """`(range, keys)`: the suffixes that occur twice or more, in several rows of a range."""
        out = self.matches[0]
        for table in self.matches[1:]:
            out = out.unionByName(table)
        return out


def asked(parts: DataFrame, answers: DataFrame | None, ask, log_ranges: int) -> DataFrame:
    """`(range, part, keys, twice)`: the hashes that `ask(texts, answers)` gives for each part.

    `answers` has `(part, kind, keys)`; `twice` are the hashes that the part itself has twice.
    """
    def out(part: int, texts: list[bytes], known: dict[str, np.ndarray]) -> pa.Table:
        found, repeated = ask(texts, known)
        twice = dict(by_range(repeated, log_ranges))
        rows = [(r, part, blob(keys), blob(twice.get(r, NONE))) for r, keys in by_range(found, log_ranges)]
        columns = list(zip(*rows)) if rows else [(), (), (), ()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["range", "part", "keys", "twice"])

    return with_answers(parts, answers, out, "range int, part int, keys binary, twice binary")


def known_of(table: pa.Table) -> dict[str, np.ndarray]:
    """Sorted hashes by kind."""
    rows = table.select(["kind", "keys"]).to_pylist()
    return {kind: np.unique(joined(r["keys"] for r in rows if r["kind"] == kind)) for kind in {r["kind"] for r in rows}}


def with_answers(parts: DataFrame, answers: DataFrame | None, out, schema: str) -> DataFrame:
    """`out(part, texts, answers by kind)` of every part."""
    encoded = lambda table: [t.encode() for t in common.texts_of(table.column("text"))]
    if answers is None:
        return parts.groupBy("part").applyInArrow(lambda table: out(table.column("part")[0].as_py(), encoded(table), {}), schema)

    def both(table: pa.Table, found: pa.Table) -> pa.Table:
        if not table.num_rows:
            return out(0, [], {})
        return out(table.column("part")[0].as_py(), encoded(table), known_of(found))

    return parts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(both, schema)


def told(questions: DataFrame, kind: str) -> DataFrame:
    """`(part, kind, keys)`: of the hashes that parts asked for, those that occur twice anywhere."""
    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        again = np.union1d(joined(rows["twice"]), more_than_once(joined(rows["keys"])))
        keys = [blob(k[held(k, again)]) for k in map(unblob, rows["keys"])]
        return pd.DataFrame({"part": rows["part"].to_numpy(), "kind": kind, "keys": keys})

    return questions.groupBy("range").applyInPandas(answer, "part int, kind string, keys binary")


def told_of(questions: DataFrame, table: DataFrame, kind: str) -> DataFrame:
    """`(part, kind, keys)`: of the hashes that parts asked for, those in a table of hashes."""
    def answer(rows: pd.DataFrame, of: pd.DataFrame) -> pd.DataFrame:
        array = np.unique(joined(of["keys"]))
        keys = [blob(k[held(k, array)]) for k in map(unblob, rows["keys"])]
        return pd.DataFrame({"part": rows["part"].to_numpy(np.int32), "kind": kind, "keys": keys})

    return questions.groupBy("range").cogroup(table.groupBy("range")).applyInPandas(answer, "part int, kind string, keys binary")


def unioned(*tables: DataFrame) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def classified(c: Anchors, known: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Anchors whose span is repeated as a whole, and other anchors whose suffix is."""
    candidates = np.flatnonzero(held(c.key, known.get("suffix", NONE)))
    whole = held(c.spans(candidates), known.get("span", NONE))
    return candidates[whole], candidates[~whole]


def covered(docs: DataFrame, family: Family, parts: DataFrame) -> DataFrame:
    """`(part, kind, keys)` that decide for every part which of its strings are repeated."""
    length, log_ranges = family.length, family.log_ranges

    def suffixes(texts, known):
        return np.unique(np.concatenate([NONE, *(c.key for c in chunks(texts, length))])), NONE

    def spans(texts, known):
        found = np.concatenate([NONE, *(c.spans(np.flatnonzero(held(c.key, known.get("suffix", NONE)))) for c in chunks(texts, length))])
        return np.unique(found), more_than_once(found)

    def borders(texts, known):
        """Suffixes of borders ask with a mark that spans found twice answer to."""
        whole, border = [NONE], [NONE]
        for c in chunks(texts, length):
            w, b = classified(c, known)
            whole.append(c.key[w])
            border.append(c.key[b])
        whole, border = np.unique(np.concatenate(whole)), np.unique(np.concatenate(border))
        # As `twice`, a border's suffix counts as met again, so that whoever has it learns of it.
        return np.union1d(whole, border), border

    def strings(texts, known):
        found = [NONE]
        for c in chunks(texts, length):
            whole, border = classified(c, known)
            own = np.concatenate([border, whole[held(c.key[whole], known.get("border", NONE))]])
            found.append(c.strings(own)[1])
        found = np.concatenate(found)
        return np.unique(found), more_than_once(found)

    suffix = told_of(asked(parts, None, suffixes, log_ranges), family.repeated(), "suffix")
    span = told(asked(parts, suffix, spans, log_ranges), "span")
    border = told_marked(asked(parts, unioned(suffix, span), borders, log_ranges), "border")
    string = told(asked(parts, unioned(suffix, span, border), strings, log_ranges), "string")
    return unioned(suffix, span, string)


def told_marked(questions: DataFrame, kind: str) -> DataFrame:
    """As `told`, but only what some part marked with `twice` is told of."""
    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        marked = np.unique(joined(rows["twice"]))
        keys = [blob(k[held(k, marked)]) for k in map(unblob, rows["keys"])]
        return pd.DataFrame({"part": rows["part"].to_numpy(), "kind": kind, "keys": keys})

    return questions.groupBy("range").applyInPandas(answer, "part int, kind string, keys binary")


def removed_runs(texts: list[bytes], known: dict[str, np.ndarray], length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Start and end of the maximal removed runs of each document."""
    docs, starts, ends = [], [], []
    for c in chunks(texts, length):
        whole, border = classified(c, known)
        docs.append(c.doc[whole])
        starts.append(c.first[whole] + c.shift[whole])
        ends.append(c.last[whole] + c.shift[whole] + length)
        at, h = c.strings(border)
        counts = c.last[border] - c.first[border] + 1
        again = held(h, known.get("string", NONE))
        docs.append(np.repeat(c.doc[border], counts)[again])
        shifted = (at + np.repeat(c.shift[border], counts))[again]
        starts.append(shifted)
        ends.append(shifted + length)
    out = [(np.zeros(0, np.int64),) * 2] * len(texts)
    if not docs:
        return out
    doc, start, end = map(np.concatenate, (docs, starts, ends))
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    edges = np.flatnonzero(np.diff(doc, prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(doc)]):
        s, e = start[a:b], np.maximum.accumulate(end[a:b])
        new = np.concatenate([[True], s[1:] > e[:-1]])
        first = np.flatnonzero(new)
        out[doc[a]] = s[first], e[np.concatenate([first[1:], [len(s)]]) - 1]
    return out


def deduplicated(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES, part_bytes: int = PART_BYTES,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`(doc_id, kept, starts, ends, n_bytes, n_removed, n_spans, kept_sha256)` of every row.

    `kept` are the bytes that stay, `starts` and `ends` the removed runs.
    """
    def finish(ids, data: list[bytes], known: dict[str, np.ndarray]) -> pa.Table:
        runs = removed_runs(data, known, length)
        kept = [b"".join(t[a:b] for a, b in zip([0, *e], [*s, len(t)])) for t, (s, e) in zip(data, runs)]
        return pa.table([
            ids, pa.array(kept, pa.binary()), pa.array([s for s, _ in runs], pa.list_(pa.int64())), pa.array([e for _, e in runs], pa.list_(pa.int64())),
            pa.array([len(t) for t in data], pa.int64()), pa.array([len(t) - len(k) for t, k in zip(data, kept)], pa.int64()),
            pa.array([len(s) for s, _ in runs], pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])],
            ["doc_id", "kept", "starts", "ends", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    total = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_parts = max(1, -(-total // part_bytes))
    log_ranges = max(0, n_parts - 1).bit_length()
    # From the row alone: every job reads the table anew, perhaps in other splits. Equal rows share a part.
    rows = named.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_parts)).cast("int"))
    family = Family(log_ranges, length)
    for i in range(batches):  # as if they came one after another
        family.add(rows.filter(F.col("part") % batches == i))
    answers = covered(docs, family, rows)

    def both(table: pa.Table, found: pa.Table) -> pa.Table:
        data = [t.encode() for t in common.texts_of(table.column("text"))]
        ids = table.column("doc_id").combine_chunks() if table.num_rows else pa.array([], table.schema.field("doc_id").type)
        return finish(ids, data, known_of(found) if found.num_rows else {})

    key = docs.schema[doc_id].dataType.simpleString()
    return rows.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        both, f"doc_id {key}, kept binary, starts array<bigint>, ends array<bigint>, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
