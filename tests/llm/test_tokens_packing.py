import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wastelake.llm import packing, tokens

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "the", " ", "  ", "\n", "\t", "'s", "'re", "'", "'ll", "!", "?!", "é", "日本", "1", "23", "²", "<|endoftext|>",
          "<|endo", "|>", " ", " ", "\x1c", "\x85", "_", "😀", "I'd", "xxxxx", "\r\n", "\x00"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_prefix_counts_equal_the_library(library):
    rnd, counter = random.Random(1), tokens.PrefixCounter(VOCABULARY)
    for _ in range(150):
        text = "".join(rnd.choices(PIECES, k=rnd.randint(0, 12)))
        expected = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert counter.prefixes(text).tolist() == expected, text
        assert counter.count(text) == expected[-1], text
        for limit in (0, 3, 9):
            assert counter.cut(text, limit) == max(i for i, n in enumerate(expected) if n <= limit), text


def test_token_counts_of_awkward_rows(docs, rows, nothing, library):
    limit = 50
    expected = sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _, _ in rows), key=str)
    got = tokens.token_counts(docs, VOCABULARY, limit).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == expected
    assert all(r.over_limit == (r.n_tokens > limit) for r in got)
    assert tokens.token_counts(nothing, VOCABULARY, limit).count() == 0
    listed = tokens.prefix_counts(docs.filter("doc_id < 5"), VOCABULARY).collect()
    assert all(len(r.counts) >= 1 and r.counts[0] == 0 for r in listed)


def test_packing_covers_every_id_once(docs, rows, nothing, library):
    placed = packing.pack(docs, VOCABULARY, 64).collect()
    whole = defaultdict(list)
    for r in placed:
        whole[r.sequence_id].append(r)
    for parts in whole.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == np.cumsum([0, *(r.length for r in parts)])[:-1].tolist()
        assert sum(r.length for r in parts) <= 64
    expected = sorted(str((i, at, zlib.crc32(np.array(ids[at:at + 64], "<u4").tobytes()), len(ids)))
                      for i, t, _, _ in rows for ids in [library.encode(t or "", add_special_tokens=False).ids + [0]] for at in range(0, len(ids), 64))
    assert sorted(str((r.doc_id, r.start, r.ids_crc32, r.doc_tokens)) for r in placed) == expected
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in placed)
    assert packing.pack(nothing, VOCABULARY).count() == 0


def test_sequences_are_the_pieces_in_order(docs):
    placed = packing.pack(docs.filter("doc_id < 10"), VOCABULARY, 64).cache()
    sizes = {r.sequence_id: r.n for r in placed.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()}
    assert {r.sequence_id: len(r.ids) for r in packing.sequences(placed).collect()} == sizes


def test_tournament_is_first_fit():
    rnd = random.Random(2)
    lengths = np.array([rnd.randint(1, 100) for _ in range(300)])
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    room: list[int] = [0] * int((lengths >= 100).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if lengths[i] < 100:
            b = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
            if b == len(room):
                room.append(100)
            assert (bins[i], offsets[i]) == (b, 100 - room[b])
            room[b] -= lengths[i]
