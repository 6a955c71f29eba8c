import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from wastelake.llm import alignment, pieces, tokens

from .conftest import frame

BYTES, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BITS = ["a", "the", " ", "  ", "\n", "\t", "é", "漢", "字", "☃", "𝔘", "<s>", "</s>", "<unk>", "<0x0A>", "foo", "\x00", "　", "\xa0",
        "-", "1", "\r\n", " the", " world", "\x85", "ﬁ", "Ａ", "ｶﾞ", "½", "™", "…", "​", "\xad", "<|endoftext|>", "n't"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def texts(n, bits, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(bits, k=rnd.randint(0, 12))) for _ in range(n)]


def with_rules(rule, prefix, squeeze, path):
    """The model with a compiled character map of the library."""
    made = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    spec = next(v for k, v in pieces.fields(made) if k == pieces.NORMALIZER) + bytes([3 << 3, prefix, 4 << 3, squeeze, 5 << 3, 1])
    size, n = b"", len(spec)
    while n > 127:
        size, n = size + bytes([n & 127 | 128]), n >> 7
    path.write_bytes(open(MODEL, "rb").read() + bytes([pieces.NORMALIZER << 3 | 2]) + size + bytes([n]) + spec)
    return str(path)


def test_pieces_equal_the_library_and_cover_the_text(library):
    own = pieces.Pieces(MODEL)
    assert own.in_parts
    for text in [*texts(1500, BITS + ["▁"]), "y" * 3000, "日本" * 500, " ".join(["word"] * 2000)]:
        ids, begins, ends, decoded = own.encode(text)
        ids = np.frombuffer(ids, "<i4").tolist()
        assert ids == library.encode(text), text
        assert decoded == library.decode(ids), text
        data = text.encode()
        assert b"".join(data[b:e] for b, e in zip(begins, ends)) == data, text


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("prefix,squeeze", [(1, 1), (1, 0), (0, 1)])
def test_compiled_maps_equal_the_library(rule, prefix, squeeze, tmp_path):
    own = pieces.Pieces(with_rules(rule, prefix, squeeze, tmp_path / "m.model"))
    normal = sentencepiece.SentencePieceProcessor(model_proto=open(tmp_path / "m.model", "rb").read())
    assert own.map.longest("ﬁx".encode(), 0) == (3, b"fi")
    for text in texts(700, BITS, 2):
        ids, begins, ends, decoded = own.encode(text)
        ids = np.frombuffer(ids, "<i4").tolist()
        assert ids == normal.encode(text) and decoded == normal.decode(ids), text
        assert all(0 <= b <= e <= len(text.encode()) for b, e in zip(begins, ends))
        assert (np.diff(begins) >= 0).all() and (np.diff(ends) >= 0).all()
    ids, begins, ends, _ = own.encode("x ﬁy")
    assert own.normalised("ﬁ".encode(), False)[1:] == ([0, 0], [3, 3])
    assert ends[-1] == 6


def test_encoded_rows(docs, rows, nothing, library):
    found = pieces.encoded(docs, MODEL)
    want = sorted(str((i, ids, library.decode(ids), t or "")) for i, t, _, _ in rows for ids in [library.encode(t or "", add_bos=True, add_eos=True)])
    made = found.collect()
    assert sorted(str((r.doc_id, np.frombuffer(r.ids, "<i4").tolist(), r.decoded, r.decoded)) for r in made) == want
    for r in made:
        assert [p.id for p in r.pieces] == np.frombuffer(r.ids, "<i4").tolist() and len(r.pieces) == r.n_tokens
        assert r.pieces[0].begin == r.pieces[0].end == 0 and r.pieces[-1].begin == r.pieces[-1].end == len(r.decoded.encode())
    again = pieces.decoded(found.select("doc_id", "ids", "decoded"), MODEL, name="again")
    assert again.filter("again = decoded").count() == len(rows)
    assert pieces.encoded(nothing, MODEL).count() == 0 == pieces.decoded(pieces.encoded(nothing, MODEL), MODEL, name="again").count()


def brute(found):
    """Numbers of every text from spans per byte, for whole texts encoded by the libraries."""
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    to_byte = tokens.byte_characters()
    linked, docs_of = [], Counter()
    for text in found:
        data = (" " + (text or "")).encode()
        a_ids, b_ids = a.encode(data.decode(), add_special_tokens=False).ids, b.encode(text or "")
        a_bytes = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in a_ids]
        b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
        if not text or b"".join(a_bytes) != data or b"".join(b_bytes) != data:
            linked.append(None)
            continue
        a_of = [k for k, x in enumerate(a_bytes) for _ in x]
        b_of = [k for k, x in enumerate(b_bytes) for _ in x]
        pairs = sorted(set(zip(a_of, b_of)))
        cuts = [0, *(i + 1 for i in range(len(data)) if i + 1 == len(data) or a_of[i] != a_of[i + 1] and b_of[i] != b_of[i + 1])]
        groups = [(sorted(set(a_of[x:y])), sorted(set(b_of[x:y]))) for x, y in zip(cuts, cuts[1:])]
        written = ";".join(",".join(str(a_ids[k]) for k in x) + "|" + ",".join(str(b_ids[k]) for k in y) for x, y in groups)
        occurrences = [(a_ids[x], b_ids[y]) for x, y in pairs]
        docs_of.update(set(occurrences))
        linked.append((len(a_ids), len(b_ids), len(groups), occurrences, written))
    most = defaultdict(int)
    for (x, _), n in docs_of.items():
        most[x] = max(most[x], n)
    return [(0, 0, 0, 0, 0, 0, "") if one is None else
            (one[0], one[1], one[2], len(one[3]), sum(docs_of[p] == most[p[0]] for p in one[3]), sum(docs_of[p] for p in one[3]), one[4]) for one in linked]


def numbers(made):
    return sorted(str((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups)) for r in made.collect())


def test_alignment_of_awkward_rows(docs, rows, nothing):
    want = sorted(str((i, *n)) for (i, *_), n in zip(rows, brute([t for _, t, _, _ in rows])))
    assert numbers(alignment.alignments(docs, BYTES, MODEL)) == want
    assert alignment.alignments(nothing, BYTES, MODEL).count() == 0


def test_alignment_of_mixed_characters_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_DOCS", 7)  # blocks of few documents; the functions travel with the job
    found = texts(250, BITS + ["▁"], 3)
    made = frame(spark, [(i, t, "en", "s") for i, t in enumerate(found)])
    want = sorted(str((i, *n)) for i, n in enumerate(brute(found)))
    assert numbers(alignment.alignments(made, BYTES, MODEL)) == want
    digests = {r.doc_id: r.groups for r in alignment.alignments(made, BYTES, MODEL, digests=True).collect()}
    assert all(digests[i] == (hashlib.sha256(n[6].encode()).hexdigest() if n[0] else "") for i, n in enumerate(brute(found)))


def test_coarse_cuts_must_agree_with_the_bytes():
    assert alignment.refined([3, 3, 5], [1, 2, 2]) == [1, 3, 5]
    assert alignment.refined([3, 4, 5], [1, 2, 2]) is None


@pytest.mark.parametrize("kind", [np.uint32, np.int64])
def test_sums_and_numbers_by_key(kind):
    r = np.random.default_rng(1)
    keys, amounts = r.integers(0, 1 << 31, 50).astype(kind)[r.integers(0, 50, 400)], r.integers(1, 9, 400)
    distinct, sums = alignment.summed(keys, amounts)
    assert dict(zip(distinct.tolist(), sums.tolist())) == {int(k): int(amounts[keys == k].sum()) for k in set(keys.tolist())}
    assert distinct.tolist() == sorted(distinct.tolist())
    again, places = alignment.numbered(keys.astype(np.int64))
    assert again.tolist() == distinct.tolist() and (again[places] == keys).all()
    for empty in (alignment.summed(keys[:0], amounts[:0]), alignment.numbered(keys[:0].astype(np.int64))):
        assert len(empty[0]) == len(empty[1]) == 0


@pytest.mark.parametrize("values", [[], [0, 255], [256], [1 << 16], [1 << 40]])
def test_numbers_in_few_bytes(values):
    assert alignment.widened(alignment.narrow(np.array(values, np.int64))).tolist() == values
