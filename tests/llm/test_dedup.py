import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from wastelake.llm import common, fingerprints, simhash, suffix_dedup

from .conftest import frame, prose


def simhash_of(text, shingle=4):
    words = re.findall(common.WORD, (text or "").translate(common.LOWER))
    n = min(shingle, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + n]).encode(), 42) for i in range(len(words) - n + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids_and_fps, bits):
    fps = sorted({f for _, f in ids_and_fps})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= bits:
                root[find(b)] = find(a)
    lows = {}
    for i, f in ids_and_fps:
        if i is not None:
            lows[find(f)] = min(i, lows.get(find(f), i))
    return {f: lows.get(find(f)) for f in fps}


def test_simhash_components_of_awkward_rows(docs, rows, nothing):
    expected = [(i, simhash_of(t)) for i, t, _, _ in rows]
    lows = components(expected, 4)
    got = sorted((str((r.doc_id, r.fingerprint, r.component_id)) for r in simhash.near_duplicates(docs, 4, 4).collect()))
    assert got == sorted(str((i, f"{f:016x}", lows[f])) for i, f in expected)
    assert simhash.near_duplicates(nothing, 4, 4).count() == 0
    kept = simhash.one_of_each(docs, 4, 4)
    assert kept.columns == docs.columns and kept.count() == len({lows[f] for _, f in expected})
    assert simhash.one_of_each(nothing, 4, 4).count() == 0


@pytest.mark.parametrize("ranges", [1, 3, 5])
def test_forest_finds_every_pair(ranges):
    rng = np.random.default_rng(3)
    points = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
    near = points[:200].copy()
    for _ in range(4):
        near ^= np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)
    points = np.unique(np.concatenate([points, near]))
    trees = simhash.forest(points[::3], 10_000, 4, ranges, 100)
    found = set()
    for tree in trees:
        leaf, index, home = tree.route(points)
        assert np.bincount(index[home], minlength=len(points)).tolist() == [1] * len(points)
        for shard in np.unique(leaf):
            inside, at_home = index[leaf == shard], home[leaf == shard]
            found |= {(min(a, b), max(a, b)) for a in inside[at_home] for b in inside}
    close = np.bitwise_count(points[:, None] ^ points[None, :]) <= 4
    assert {(a, b) for a, b in zip(*np.nonzero(close)) if a < b} <= found


def test_sketches_and_their_likeness():
    rnd = random.Random(4)
    sketcher = fingerprints.Sketcher()
    sketch = lambda text: sketcher.sketch(sketcher.words(text))
    long_, other = prose(rnd, 4000), prose(rnd, 4000)
    part = " ".join(long_.split(" ")[:400])
    assert fingerprints.written(sketch(long_)) == fingerprints.written(sketch(long_.upper()))
    assert fingerprints.containment(sketch(part), sketch(long_)) > 0.97
    assert abs(fingerprints.likeness(sketch(part), sketch(long_)) - 0.1) < 0.03
    assert fingerprints.likeness(sketch(long_), sketch(other)) < 0.02
    both = fingerprints.merged(sketch(long_), sketch(other))
    assert fingerprints.containment(sketch(other), both) == 1.0
    n, kept = fingerprints.read(fingerprints.written(sketch(long_)))
    assert n == sketch(long_)[0] and (kept == sketch(long_)[1]).all()
    assert fingerprints.likeness(sketch(""), sketch(" \n")) == 1.0 and fingerprints.likeness(sketch(""), sketch("a")) == 0.0


def test_short_texts_are_told_apart():
    rnd = random.Random(14)
    sketcher = fingerprints.Sketcher()
    sketch = lambda text: sketcher.sketch(sketcher.words(text))
    texts = [prose(rnd, n) for n in range(1, 41) for _ in range(5)]
    assert all(fingerprints.likeness(sketch(t), sketch(t)) == 1.0 for t in texts)
    written = [fingerprints.written(sketch(t)) for t in texts]
    assert len(set(written)) == len({t.lower() for t in texts})
    shingles = lambda t: {tuple(w[i:i + 5]) for w in [t.lower().split()] for i in range(max(1, len(w) - 4))}
    for n in (6, 9, 15, 20):  # exact as long as every hash is kept
        words = prose(rnd, n).split(" ")
        a, b = " ".join(words), " ".join(words[:-1] + ["other"])
        expected = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
        assert fingerprints.likeness(sketch(a), sketch(b)) == expected
        assert fingerprints.containment(sketch(a), sketch(b)) == len(shingles(a) & shingles(b)) / len(shingles(a))
    for t, u in zip(texts, texts[::-1]):  # merged sketches are those of the union
        x, y = sketch(t), sketch(u)
        hashes = np.union1d(*(sketcher_all(sketcher, s) for s in (t, u)))
        expected = hashes[:max(fingerprints.LEAST, np.searchsorted(hashes, sketcher.below))]
        assert (fingerprints.merged(x, y)[1] == expected).all()


def sketcher_all(sketcher, text):
    """All hashes of a text's shingles."""
    whole = fingerprints.Sketcher(scale=1)
    whole.word = sketcher.word
    return whole.sketch(whole.words(text))[1]


def test_each_document_meets_its_successor(spark, docs, rows, nothing):
    got = fingerprints.compared(docs).collect()
    assert len(got) == len(rows) and fingerprints.compared(nothing).count() == 0
    unique = [(i * 7, t) for i, (_, t, _, _) in enumerate(rows)]
    table = frame(spark, [(i, t, "en", "a") for i, t in unique]).repartition(5)
    texts = [t or "" for _, t in unique]
    expected = {}
    for k, (i, _) in enumerate(unique):
        half = len(texts[k]) // 2
        edited = texts[k][:len(texts[k]) - half] + texts[(k + 1) % len(texts)][:half]
        expected[i] = len(texts[k]), hashlib.sha256(edited.encode()).hexdigest()
    found = fingerprints.compared(table).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in found} == expected
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    plain = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(table).collect()}
    assert all(plain[r.doc_id] == r.fingerprint for r in found)


def removed(texts, length):
    counts = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if counts[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        yield sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()


def test_repeated_bytes_go(docs, rows, nothing):
    texts = [(t or "").encode() for _, t, _, _ in rows]
    expected = sorted(str((i, len(t), *r)) for (i, *_), t, r in zip(rows, texts, removed(texts, 200)))
    got = suffix_dedup.deduplicated(docs, 200, part_bytes=20_000)
    assert sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got.collect()) == expected
    assert suffix_dedup.deduplicated(nothing, 200).count() == 0


def test_repeats_are_found_though_the_splits_change(spark, rows, monkeypatch, tmp_path):
    """As when executors are lost or join between the jobs: every batch reads the table in other splits."""
    folder = str(tmp_path / "docs")
    frame(spark, rows).repartition(12).write.parquet(folder)
    turn, real = iter(range(100)), suffix_dedup.Family.add

    def add(self, batch):
        spark.conf.set("spark.sql.files.openCostInBytes", str([1, 200_000_000, 40_000_000][next(turn) % 3]))
        real(self, batch)

    monkeypatch.setattr(suffix_dedup.Family, "add", add)
    expected = sorted(str((i, *r)) for (i, *_), r in zip(rows, removed([(t or "").encode() for _, t, _, _ in rows], 200)))
    try:
        got = suffix_dedup.deduplicated(spark.read.parquet(folder), 200, part_bytes=5_000).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(str((r.doc_id, r.n_removed, r.n_spans, r.kept_sha256)) for r in got) == expected


def test_repeats_of_every_length_and_across_chunks(monkeypatch):
    rnd = random.Random(6)
    text = prose(rnd, 3000).encode()
    texts = [text[:5000], b"x" * 700, b"ab" * 400, text[5000:5100] + text[100:340], b"-" + text[700:900] + b"-", b"-" + text[950:1149] + b"-"]
    texts += [text[300:1500] + b"!" + text[1500:1600] + text[2000:2260], (b"line of text\n" * 60), text[9000:9400]]
    monkeypatch.setattr(suffix_dedup, "CHUNK", 900)
    keys = np.concatenate([c.key for c in suffix_dedup.chunks(texts, 200)])
    known = {"suffix": suffix_dedup.more_than_once(keys)}
    spans = [c.spans(np.flatnonzero(suffix_dedup.held(c.key, known["suffix"]))) for c in suffix_dedup.chunks(texts, 200)]
    known["span"] = suffix_dedup.more_than_once(np.concatenate(spans))
    known["string"] = suffix_dedup.more_than_once(np.concatenate(
        [c.strings(np.arange(len(c.key)))[1] for c in suffix_dedup.chunks(texts, 200)]))
    runs = suffix_dedup.removed_runs(texts, known, 200)
    assert [(int((e - s).sum()), len(s)) for s, e in runs] == [r[:2] for r in removed(texts, 200)]
