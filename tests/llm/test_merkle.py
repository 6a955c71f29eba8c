import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wastelake.llm import merkle

from .conftest import frame


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(nodes):
    """Levels from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, place):
    found = []
    for level in levels[:-1]:
        run = place // 8 * 8
        found.append([x for i, x in enumerate(level[run:run + 8], run) if i != place])
        place //= 8
    return found


def fold(levels, place, value):
    for level in levels[:-1]:
        run = place // 8 * 8
        value = digest(value if i == place else x for i, x in enumerate(level[run:run + 8], run))
        place //= 8
    return value


def expected(rows):
    """All columns of the proofs, worked out on whole trees. A row is (doc_id, text, lang, source, n_chars)."""
    def value(row, text):
        return leaf_of([row[0], row[3], row[2], row[4], text])

    names = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees, members = {}, {}
    for name in names:
        members[name] = sorted((r[0] is not None, r[0] or 0, value(r, r[1]), r) for r in rows if r[2] == name)
        trees[name] = tree([m[2] for m in members[name]])
    top = tree([trees[n][-1][0] for n in names])
    root = top[-1][0]
    out = []
    for at, name in enumerate(names):
        for place, (_, _, leaf, row) in enumerate(members[name]):
            own = trees[name]
            path = siblings(own, place) + siblings(top, at)
            text = row[1]
            if zlib.crc32(str("" if row[0] is None else row[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if c.isascii() else c for c in text)
            folded = fold(top, at, fold(own, place, value(row, text)))
            out.append((row[0], leaf, own[-1][0], root, digest(x for level in path for x in level), folded, folded == root))
    return sorted(out, key=str)


def got(docs):
    found = merkle.proofs(merkle.manifest(docs, altered={"now": merkle.tampered(docs)}), "now")
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in found.collect()), key=str)


def test_proofs_of_awkward_rows(docs, rows, nothing):
    made = got(docs)
    assert made == expected([(i, t, g, s, len(t or "")) for i, t, g, s in rows])
    assert not all(r[6] for r in made) and any(r[6] for r in made)
    assert got(nothing) == []


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 9, None: 1, "b": 8, "é": 65}, {g: 1 for g in map(str, range(70))}])
def test_trees_of_any_size(spark, sizes):
    rows = [(i, f"Text {i}", g, "s") for g, n in sizes.items() for i in range(n)]
    assert got(frame(spark, rows)) == expected([(i, t, g, s, len(t)) for i, t, g, s in rows])


def test_blocks_above_blocks(spark, monkeypatch):
    # Low blocks, so that few leaves need several rounds; the functions travel with the job.
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "SPAN", 8)
    rnd = random.Random(4)
    rows = [(i, f"Text {rnd.random()}", "en" if i % 10 else "de", "s") for i in range(700)]
    assert len(merkle.manifest(frame(spark, rows)).blocks) == 4
    assert got(frame(spark, rows)) == expected([(i, t, g, s, len(t)) for i, t, g, s in rows])


def test_one_key_and_equal_rows(spark):
    rows = [(1, "Same", "en", "s")] * 300 + [(2, f"T {i}", "en", "s") for i in range(300)]
    assert got(frame(spark, rows)) == expected([(i, t, g, s, len(t)) for i, t, g, s in rows])


@pytest.mark.parametrize("height", [1, 2, 3, 4, 5])
def test_layout_keeps_subtrees_together(height):
    places = [merkle.address(height, d, np.arange(8 ** d)) for d in range(height)]
    assert sorted(np.concatenate(places).tolist()) == list(range(merkle.subtree(height)))
    if height > 1:  # the upper half lies first, then each lower subtree in one run
        upper = height // 2
        assert np.concatenate(places[:upper]).max() == merkle.subtree(upper) - 1
        for i in range(8 ** upper):
            run = np.concatenate([places[d][i * 8 ** (d - upper):(i + 1) * 8 ** (d - upper)] for d in range(upper, height)])
            assert run.max() - run.min() + 1 == len(run)


def test_a_changed_row_changes_its_proof_only_upwards(spark):
    rows = [(i, f"text {i}", "en", "s") for i in range(20)]
    one = merkle.proofs(merkle.manifest(frame(spark, rows)))
    assert one.filter("verified").count() == 20
    rows[3] = (3, "another", "en", "s")
    two = merkle.proofs(merkle.manifest(frame(spark, rows)))
    assert one.join(two, "leaf").count() == 19
    assert one.join(two, "root").count() == 0
    assert two.select(F.length("proof") % 64).distinct().first()[0] == 0
