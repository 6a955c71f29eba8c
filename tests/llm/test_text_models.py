import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from wastelake.llm import common, lm_scoring, ngrams, quality, toxicity

from .conftest import frame, prose


def tokens(text):
    return re.findall(common.WORD, (text or "").translate(common.LOWER)) + [""]


def test_scores_of_awkward_rows(docs, rows, nothing):
    train = Counter()
    for i, t, _, _ in rows:
        if zlib.crc32(str("" if i is None else i).encode()) % 10:
            train.update(tokens(t))
    total, distinct = sum(train.values()), len(train)
    base = lambda t: sum(math.log10((train[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens(t))
    expected = sorted(str((i, zlib.crc32(str("" if i is None else i).encode()) % 10 == 0, len(tokens(t)), sum(w in train for w in tokens(t)), total,
                           round(base(t), 6))) for i, t, _, _ in rows)
    got = lm_scoring.scores(docs).collect()
    assert sorted(str((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))) for r in got) == expected
    assert all(r.score <= 0 for r in got)
    assert lm_scoring.scores(nothing).count() == 0


def test_tail_words_and_several_groups_of_segments(docs, monkeypatch):
    whole = {str((r.doc_id, r.n_tokens)): r for r in lm_scoring.scores(docs).collect()}
    monkeypatch.setattr(lm_scoring, "FREQUENT_BYTES", 2000)
    monkeypatch.setattr(lm_scoring, "SEGMENT_TOKENS", 1000)
    groups, real = [], lm_scoring.groups_of
    monkeypatch.setattr(lm_scoring, "groups_of", lambda table, most: groups.append(real(table, most)) or groups[-1])
    found = lm_scoring.scores(docs, most_bytes=24_000).collect()
    assert len(groups[0]) == 1 and len(groups[1]) > 1 and len(found) == docs.count()
    for r in found:
        same = whole[str((r.doc_id, r.n_tokens))]
        assert r.n_known == same.n_known and abs(r.base_score - same.base_score) < 1e-6
        assert abs(r.score - same.score) < 0.05 * abs(same.score) + 1


def test_groups_of_segments_meet_though_the_splits_change(spark, docs, monkeypatch, tmp_path):
    """As when executors are lost or join between the passes: every pass reads the table in other splits."""
    folder = str(tmp_path / "docs")
    docs.repartition(12).write.parquet(folder)
    table = spark.read.parquet(folder)
    monkeypatch.setattr(lm_scoring, "SEGMENT_TOKENS", 1000)
    whole = sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 6), r.score) for r in lm_scoring.scores(table).collect())
    turn, real = iter(range(1000)), lm_scoring.scored

    def scored(*given):
        spark.conf.set("spark.sql.files.openCostInBytes", str([1, 200_000_000, 40_000_000][next(turn) % 3]))
        return real(*given)

    monkeypatch.setattr(lm_scoring, "scored", scored)
    try:
        got = sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 6), r.score) for r in lm_scoring.scores(table, most_bytes=14_000).collect())
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert next(turn) > 1 and [r[:3] for r in got] == [r[:3] for r in whole]
    assert all(abs(a[3] - b[3]) < 1e-6 * abs(b[3]) + 1e-6 for a, b in zip(got, whole))


def test_filter_gives_counts_back():
    rng = np.random.default_rng(7)
    keys = np.unique(rng.integers(0, 2 ** 63, 5000, dtype=np.uint64) * np.uint64(2))
    counts = rng.integers(1, 2000, len(keys))
    parts = {s: lm_scoring.segment(keys[keys >> np.uint64(61) == s], counts[keys >> np.uint64(61) == s]) for s in range(8)}
    filter_ = lm_scoring.Filter({s: len(p) for s, p in parts.items()}, parts.items(), 3)
    levels = filter_.levels(keys)
    exact = lm_scoring.level_of(counts)
    assert (levels >= exact).all() and (levels == exact).mean() > 0.98  # never too low, seldom too high
    others = filter_.levels(rng.integers(0, 2 ** 63, 5000, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    assert (others == 0).mean() > 0.98
    low, high = lm_scoring.ends_of_levels()
    assert (low[exact] <= counts).all() and (counts <= high[exact]).all() and (high / np.maximum(low, 1)).max() < lm_scoring.BASE + 1e-9
    assert np.abs(levels - exact).max() > 0  # the chances below are those of errors that do occur
    first, further = np.mean([lm_scoring.errors_of(p) for p in parts.values()], axis=0)
    assert first < 1e-3 and abs((levels > exact).mean() - further) < 0.01


def test_scores_equal_a_plain_model(docs, rows, monkeypatch):
    """Words have exact counts here; bigrams those that their levels in the filter stand for, seldom one too high."""
    given, real = [], lm_scoring.scored
    monkeypatch.setattr(lm_scoring, "scored", lambda *all_given: given.append(all_given) or real(*all_given))
    got = lm_scoring.scores(docs).collect()
    bigrams, m = given[0][3:5]
    train = [tokens(t) for i, t, _, _ in rows if zlib.crc32(str("" if i is None else i).encode()) % 10]
    words, pairs = Counter(w for t in train for w in t), Counter(p for t in train for p in zip(["", *t], t))
    asked = sorted({p for _, t, _, _ in rows for p in zip(["", *tokens(t)], tokens(t))})
    before, after = (np.array([lm_scoring.word_key(w.encode()) for w in side], np.uint64) for side in zip(*asked))
    levels = dict(zip(asked, bigrams.levels(lm_scoring.bigram_keys(after, before)).tolist()))
    exact = {p: int(lm_scoring.level_of(np.array([pairs[p]]))[0]) if p in pairs else 0 for p in asked}
    assert all(levels[p] >= exact[p] for p in asked) and sum(levels[p] > exact[p] for p in asked) < 0.03 * len(asked)
    low, _ = lm_scoring.ends_of_levels()

    def score(text):
        listed = tokens(text)
        out = 0.0
        for v, w in zip(["", *listed], listed):
            word = (words[w] + 0.1) / (sum(words.values()) + 0.1 * (len(words) + 1)) / (1 + m.words_raised)
            both = min(low[levels[v, w]], words[v], words[w])
            out += math.log10((both + lm_scoring.MASS * word) / (words[v] * (1 + m.bigrams_raised) + lm_scoring.MASS + m.ghosts))
        return out
    expected = Counter((str(i), len(tokens(t)), round(score(t), 4)) for i, t, _, _ in rows)
    assert Counter((str(r.doc_id), r.n_tokens, round(r.score, 4)) for r in got) == expected


@pytest.mark.parametrize("distinct", [20_000, 200_000])
def test_probabilities_of_a_context_sum_to_at_most_one(distinct):
    rng = np.random.default_rng(3)
    zipf = 1 / np.arange(1, distinct + 1)
    sample = rng.choice(distinct, 10 * distinct, p=zipf / zipf.sum())
    hashes = common.mixed(np.arange(1, distinct + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    keys = hashes[sample]
    pairs = lm_scoring.segment(*np.unique(lm_scoring.bigram_keys(keys[1:], keys[:-1]), return_counts=True))
    counts = np.bincount(sample, minlength=distinct)
    seen = np.flatnonzero(counts)
    listed = lm_scoring.segment(hashes[seen], counts[seen])
    masses = lm_scoring.Masses.of(len(sample), len(seen), lm_scoring.errors_of(pairs), lm_scoring.errors_of(listed))
    low, high = lm_scoring.ends_of_levels()
    bigrams = lm_scoring.Filter({0: len(pairs)}, [(0, pairs)], 0)
    words = lm_scoring.Filter({0: len(listed)}, [(0, listed)], 0).levels(hashes[seen])
    ranked = seen[np.argsort(-counts[seen], kind="stable")]
    for rank in (0, 100, 1000, 10_000, len(seen) - 1):
        v = ranked[rank]
        before = high[words[np.flatnonzero(seen == v)[0]]]
        both = np.minimum(low[bigrams.levels(lm_scoring.bigram_keys(hashes[seen], np.full(len(seen), hashes[v])))], np.minimum(before, high[words]))
        total = masses.probability(both, np.full(len(seen), before), low[words]).sum()
        assert 0.6 < total <= 1.01, (rank, total)


def test_bigrams_beat_word_frequencies_on_held_out_repeats(spark):
    rnd = random.Random(8)
    passages = [prose(rnd, 40) for _ in range(10)]
    table = frame(spark, [(i, rnd.choice(passages) + " " + prose(rnd, 5), "en", "a") for i in range(200)])
    held = [r for r in lm_scoring.scores(table).collect() if r.held_out]
    assert held and sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)


def features(text):
    words = re.findall(common.WORD, text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if re.search(common.WORD, line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_features_of_awkward_rows(docs, rows, nothing):
    got = quality.verdicts(docs).collect()
    assert sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == sorted(
        str((i, *features(t))) for i, t, _, _ in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept) and (r.perplexity is None) == (r.n_words == 0)
    assert quality.verdicts(nothing).count() == 0
    kept = quality.kept(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)


def foretold(texts, model):
    """Per text, the mean negative logarithm of its words' probabilities, by counting all other texts anew."""
    texts = [re.findall(common.WORD, t or "") for t in texts]
    pairs_of = lambda some: Counter(p for words in some for p in zip([""] + words, words))
    every = pairs_of(texts)

    def discounts(counts):
        n = [sum(c == i for c in counts) for i in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        d = [0] + [max(0, i - (i + 1) * y * n[i] / n[i - 1]) if n[i - 1] else 0 for i in (1, 2, 3)]
        return lambda c: d[min(c, 3)]

    d, e = discounts(every.values()), discounts(Counter(w for _, w in every).values())
    found = []
    for i, words in enumerate(texts):
        pairs = pairs_of(texts[:i] + texts[i + 1:])
        before, begun, left = Counter(w for _, w in pairs), Counter(), Counter()
        for (v, _), c in pairs.items():
            begun[v] += c
            left[v] += d(c)
        mass, total = sum(map(e, before.values())), sum(before.values())
        h, score = max(mass, ngrams.LEAST_MASS), 0.0
        for v, w in zip([""] + words, words):
            spelt = math.exp(model.log_probabilities(quality.trigram_codes([w])[0]).sum())
            p = (before[w] - e(before[w]) + h * spelt) / (total + h - mass)
            if begun[v]:
                g = max(left[v], ngrams.LEAST_MASS)
                p = (pairs[v, w] - d(pairs[v, w]) + g * p) / (begun[v] + g - left[v])
            score -= math.log(p)
        found.append(score / len(words) if words else None)
    return found


def test_perplexity_is_that_of_word_bigrams_of_the_other_documents(spark, monkeypatch):
    """Also with a block per document, and when its words lie in many ranges."""
    rnd = random.Random(12)
    words = prose(rnd, 40).split(" ")
    texts = [" ".join(rnd.choices(words, k=rnd.randint(1, 60))) for _ in range(25)]
    texts += [texts[0], texts[1] + " é日 日", None, "", "x", " \t\x0b", "a\nb\x00 c  a b", texts[2] + "\r\n" + texts[2]]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    codes, counts = np.unique(np.concatenate([quality.trigram_codes(re.findall(common.WORD, t))[0] for t in texts if re.search(common.WORD, t or "")]), return_counts=True)
    expected = foretold(texts, quality.Model(codes, counts))
    for block, batch in ((1 << 20, 500), (200, 1)):
        table = frame(spark, rows).repartition(3)
        monkeypatch.setattr(ngrams, "BLOCK_BYTES", block)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
        got = {r.doc_id: r.perplexity for r in quality.verdicts(table).collect()}
        for i, x in enumerate(expected):
            assert got[i] is None if x is None else abs(math.log(got[i]) - x) < 1e-9, (block, i)
    common.prepare(spark)


def test_bands_reject_prose_whose_words_are_out_of_order(spark):
    """Its words are as common and as well spelt as before."""
    rnd = random.Random(13)
    words = [w.lower().strip(".") for w in prose(rnd, 150).split(" ")]
    follows = {w: rnd.sample(words, 3) for w in words}

    def text():
        out = [rnd.choice(words)]
        while len(out) < 150:
            out.append(rnd.choice(follows[out[-1]]))
        return out

    ordered = [text() for _ in range(120)]
    rows = [(i, " ".join(t), "en", "a") for i, t in enumerate(ordered)]
    rows += [(1000 + i, " ".join(rnd.sample(t, len(t))), "en", "a") for i, t in enumerate(ordered[:4])]
    found = {r.doc_id: r for r in quality.verdicts(frame(spark, rows)).collect()}
    assert all(found[i].kept for i in range(120)) and not any(found[1000 + i].kept for i in range(4))
    assert all(abs(found[1000 + i].spelling / found[i].spelling - 1) < 1e-9 and found[1000 + i].perplexity > 2 * found[i].perplexity for i in range(4))


def test_hashes_that_agree_in_their_upper_bits_are_sorted_whole():
    h = np.array([7, 3, 7, 1 << 60, 5, 3, (1 << 60) + 1], np.uint64)
    assert ngrams.order_of(h).tolist() == np.argsort(h, kind="stable").tolist()
    found, first, place = ngrams.distinct(h)
    assert (found == np.unique(h)).all() and (found[place] == h).all() and first.tolist() == [1, 4, 0, 3, 6]
    assert (ngrams.unpacked(ngrams.packed(h.view(np.int64)), len(h)).view(np.uint64) == h).all()


def test_trigrams_of_texts_are_those_of_their_words():
    texts = ["ab  c\n", "", " \x00 é\x1f\x85x", "日本 語"]
    words = [w for t in texts for w in re.findall(common.WORD, t)]
    assert quality.text_codes(texts).tolist() == quality.trigram_codes(words)[0].tolist()


def test_bands_reject_another_spelling_and_keep_the_rest(spark):
    rnd = random.Random(9)
    rows = [(i, prose(rnd, rnd.randint(30, 300)), "en", "a") for i in range(150)]
    rows += [(1000 + i, " ".join(w + rnd.choice(["###", "%%%"]) for w in prose(rnd, 80).split(" ")), "en", "a") for i in range(4)]
    rows += [(2000 + i, " ".join("an" for _ in range(20)) + " " + " ".join(f"an be{'.' * j}" for j in range(60)), "en", "a") for i in range(1)]
    kept = {r.doc_id for r in quality.verdicts(frame(spark, rows)).collect() if r.kept}
    assert {i for i, *_ in rows[:150]} <= kept and not kept & set(range(1000, 1004))


def test_probabilities_sum_to_one():
    rnd = random.Random(10)
    codes, _ = quality.trigram_codes(prose(rnd, 500).split(" "))
    found, counts = np.unique(codes, return_counts=True)
    model = quality.Model(found, counts)
    for context in [found[0] // quality.CLASSES, found[50] // quality.CLASSES, ord("z") * quality.CLASSES + ord("z")]:
        p = np.exp(model.log_probabilities(context * quality.CLASSES + np.arange(quality.CLASSES)))
        assert abs(p.sum() - 1) < 1e-6


@pytest.fixture(scope="module")
def decoder():
    rnd = random.Random(11)
    words = prose(rnd, 4000).lower().strip(".").split(" ") + ["idiot", "moron", "stupid", "trash"] * 40
    counts = Counter(words)
    codes, each = quality.trigram_codes(list(counts))
    found, inverse = np.unique(codes, return_inverse=True)
    return toxicity.Decoder(quality.Model(found, np.bincount(inverse, np.repeat(list(counts.values()), each)).astype(np.int64)))


@pytest.mark.parametrize("text, word", [
    ("1d10t", "idiot"), ("idiooooot", "idiot"), ("m0r0n!", "moron"), ("i.d.i.o.t", "idiot"), ("you i d i o t, go", "idiot"),
    ("$tup1d", "stupid"), ("mmmorrron", "moron"), ("tr@sh", "trash"), ("idiot", "idiot")])
def test_disguises_are_undone(decoder, text, word):
    assert word in decoder.words(text)


def test_disguises_of_any_length_are_undone(decoder):
    letters = " ".join("you are an idiot".replace(" ", "") * 12)
    assert len(letters) > 128 and any("idiot" in w for w in decoder.words(letters))
    assert "idiot" in decoder.words(" ".join("idiot") + " " + " ".join("moron" * 30))
    assert any("idiot" in w for w in decoder.words(".".join("idiot" * 20)))
    assert any("1" not in w and "idiotidiot" in w for w in decoder.words("1diot" * 20))
    assert decoder.words("m" + "o" * 100 + "ron") >= {"moron"}
    plain = "lo" * 50_000  # no search may take more than linear time
    assert decoder.words(plain) == {plain}


@pytest.mark.parametrize("text, word", [
    ("!diot", "idiot"), ("|d10t", "idiot"), ("$$tupid", "stupid"), ("(lown", "clown"), ("pathet!(", "pathetic"), ("a$$", "ass"), ("@$$", "ass"),
    ("455", "ass"), ("dumba$$!", "dumbass"), ("idiot$$$", "idiot"), ("***idiot", "idiot"), ("(idiot!", "idiot"), ("lo!!", "lo")])
def test_symbols_at_edges_are_letters_or_decoration(text, word):
    counts = Counter(prose(random.Random(13), 4000).lower().strip(".").split(" ") + ["idiot", "stupid", "clown", "pathetic", "ass", "dumbass"] * 40)
    codes, each = quality.trigram_codes(list(counts))
    found, inverse = np.unique(codes, return_inverse=True)
    model = quality.Model(found, np.bincount(inverse, np.repeat(list(counts.values()), each)).astype(np.int64))
    assert word in toxicity.Decoder(model).words(text)


def test_plain_words_stay(decoder):
    assert decoder.words("Lokano, an be-ci 2021 x86?") >= {"lokano", "an"}


def test_toxicity_learns_from_labels_that_are_not_held_out(spark, docs, nothing):
    rnd = random.Random(12)
    bad = ["idiot", "moron"]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        words = prose(rnd, 40).split(" ")
        if toxic:
            word = rnd.choice(bad)
            words[7] = word if i % 10 else word.replace("o", "0")
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, 0, int(toxic)))
    table = frame(spark, rows)
    marks = spark.createDataFrame(labels + [(None, 0, 1), (3, 0, None)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.scores(table, marks).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out == (i in held) for i in got)
    assert sum(got[i].predicted == labels[i][2] for i in held) >= 0.97 * len(held)
    mixed = toxicity.scores(docs, marks).collect()
    assert len(mixed) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in mixed)
    assert toxicity.scores(nothing, marks).count() == 0
    assert {r.score for r in toxicity.scores(docs, marks.filter("false")).collect()} == {0.0}


def test_scoring_a_block_holds_few_documents_at_a_time(monkeypatch):
    """With the same scores, whatever documents are in work together."""
    rnd = random.Random(14)
    vocabulary = prose(rnd, 400).split(" ")
    texts = ["", *(" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 120))) for _ in range(1500)), "", " "]
    block = ngrams.Block(texts)
    found = pa.concat_tables([
        ngrams._pair_answers(ngrams._asked(1, 2, block.pairs, block.pair_counts[block.order, None]).filter(pc.field("range") == r)) for r in range(2)] + [
        ngrams._word_answers(ngrams._asked(1, 2, block.words, block.sums(block.pair_counts, np.ones(len(block.pairs), bool))).filter(pc.field("range") == r)) for r in range(2)])
    letters = np.full(len(block.words), -9.0)

    def scored(at_a_time):
        monkeypatch.setattr(ngrams, "AT_A_TIME", at_a_time, raising=False)
        tracemalloc.start()
        try:
            return ngrams.log_probabilities(block, found, letters).tolist(), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    (whole, _), (parts, peak), (single, _) = scored(1 << 40), scored(4000), scored(1)
    assert whole == parts == single and len(whole) == len(texts)
    assert peak < 80 * len(block.hashes), peak / len(block.hashes)


def test_texts_are_not_shuffled_to_meet_the_medians_of_their_language(spark, capsys):
    rnd = random.Random(15)
    rows = [(i, prose(rnd, 100), rnd.choice(["en", "de", None]), "a") for i in range(300)]
    table = frame(spark, rows)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "40KB")  # more than the medians, less than the texts
    try:
        kept = quality.kept(table)
        capsys.readouterr()
        kept.explain()
        plan = capsys.readouterr().out
        assert kept.count() > 200
    finally:
        common.prepare(spark)
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan, plan


def test_blocks_are_read_without_the_memos_of_earlier_operators():
    memo = common.Memo(len, 2)
    assert [memo[w] for w in ("a", "bb", "ccc")] == [1, 2, 3] and memo and memo.older
    rows = pa.table({"t": ["x y"]})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    assert ngrams._opened(pa.table({"rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())}), "t")[1] == ["x y"]
    assert not memo and not memo.older and memo["dddd"] == 4
