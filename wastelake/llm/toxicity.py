"""Toxicity of texts after noisy-channel deobfuscation.

A token that may be disguised is read as a lattice: each character stands for itself or for
the letters it often replaces, a run of one letter for one, two or all of them, and a
separator between single letters for nothing or for a word's end. Viterbi decoding under a
character trigram model, counted over the words of all documents, picks the reading of
least cost. A token that cannot be disguised has one path, itself, and is not decoded. Tokens
and runs of single letters are decoded at any length, in time linear in it; a run is read both
as one word and as a sentence. Symbols at a word's edges are in the lattice, too, where they may
also be nothing; the word without them counts beside the reading.

The restored words are scored by what is learnt from labelled documents. A word's evidence
is the largest of its own and its beginnings' lower confidence bound of the log odds; a
document's features are its strongest words' evidence, and a logistic regression turns them
into a score. While learning, a document's own label is left out of its evidence.

Labelled documents beyond TRAIN_ROWS are not learnt from (the ones of least hash are); equal
texts are learnt from once. Only the text is scored. Nulls count as empty texts, which have
no evidence. Without labels of both kinds every score is 0. Repeated rows are scored each.
An empty table gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from heapq import nlargest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import common, quality

#: Letters that a character often replaces.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
    "*": "aeiou", "#": "aeiou", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i",
}
#: Costs of the channel, in natural logarithms: a replaced, repeated or separated character, and one kept that could be read.
REPLACED, SQUEEZED, JOINED, KEPT = 1.0, 1.0, 0.5, 6.0
#: Cost of a run of a symbol at a word's edge that is decoration, no letter: of three or more, and of fewer.
DECORATED, TRIMMED = 1.0, 4.0
#: Cost of a word's end at a separator where whole sentences are spelt in single letters.
BROKEN = 1.0
SEPARATORS = " .-_*~/"
EDGES = ".,;:!?\"'()[]{}<>|#%&*~`´…«»„“”-_/\\"
TRAIN_ROWS = 40_000
MOST_FEATURES = 100_000
BEGINNINGS = range(3, 8)
LEAST_DOCS = 4
TOP = 3
MEMO = 150_000
#: Tokens up to this length are remembered; longer ones are read anew each time.
SHORT = 64
PRIOR = 0.5

replacing = re.compile("[" + re.escape("".join(STANDS_FOR)) + "]").search
letter = re.compile(r"[^\W\d_]").search
tripled = re.compile(r"(.)\1\1").search
separated = re.compile(r"^(?:\w[.\-_*~/]){2,}\w$").match
spaced = re.compile(r"(?<![^\s])(?:[^\W_][.,]? ){3,}[^\W_](?![^\s.,;:!?])")
#: Symbols at a word's edge that may be decoration or letters; a single $ or @ is always a letter.
AMBIGUOUS = "!|(<*#$@"
#: Those that stand before or behind words in plain text, too; fewer than three of another are letters.
BEFORE, BEHIND = "(<*#", "!*#"
AROUND = "".join(sorted({*EDGES, *AMBIGUOUS}))
NO_LETTERS = str.maketrans(dict.fromkeys(set(EDGES) - set(AMBIGUOUS)))
runs = re.compile(r"(.)\1*", re.S).finditer
#: Two of a replacing character, which may stand for two letters.
doubled = re.compile("([" + re.escape("".join(STANDS_FOR)) + r"])(?<!\1\1)\1(?!\1)").search


def plain(token: str) -> bool:
    """Whether a token cannot be disguised; every search is linear in its length."""
    return len(token) < 2 or not (replacing(token) or tripled(token) or separated(token))


class Decoder:
    """Most likely reading of a token under a character trigram model."""

    def __init__(self, model: quality.Model):
        self.model = model
        self.cost = common.Memo(self.costs, MEMO)
        self.restored = common.Memo(self.decoded, MEMO)
        self.core = common.Memo(lambda word: self.restore(word.decode()), MEMO)
        self.edges = common.Memo(lambda key: self.with_edges(*key), MEMO)

    def costs(self, trigram: str) -> float:
        a, b, c = quality.folded(trigram)
        return -float(self.model.log_probabilities(np.array([(a * quality.CLASSES + b) * quality.CLASSES + c]))[0])

    @staticmethod
    def lattice(token: str, end_price: float = KEPT, literal: bool = False) -> list[list[tuple[str, float]]]:
        """For every run of a character, what it may stand for and at which cost; if `literal`, two replacing characters for two letters."""
        out: list[list[tuple[str, float]]] = []
        single = bool(separated(token)) or " " in token
        at = 0
        while at < len(token):
            c, end = token[at], at + 1
            while end < len(token) and token[end] == c:
                end += 1
            n, at = end - at, end
            if single and c in SEPARATORS:
                out.append([("", JOINED), ("\x00", end_price)])
                continue
            choices = [(c * n, 0.0 if n < 3 and c not in STANDS_FOR else KEPT)]
            for letter in [c] if c not in STANDS_FOR else STANDS_FOR[c]:
                price = REPLACED if letter != c else 0.0
                if literal and n == 2 and c in STANDS_FOR:
                    choices.append((letter * 2, price))
                    continue
                choices += [(letter, price + (SQUEEZED if n > 1 else 0.0)), *([(letter * 2, price + SQUEEZED * (n > 2))] if n > 1 else [])]
            out.append(choices)
        return out

    def decoded(self, token: str) -> str:
        """Words that a token is read as; letters spelt singly are read as one word and as a sentence."""
        one = self.path(self.lattice(token))
        if doubled(token):
            one = f"{one} {self.path(self.lattice(token, literal=True))}"
        if separated(token) or " " in token:
            return f"{one} {self.path(self.lattice(token, BROKEN))}"
        return one

    def with_edges(self, lead: str, word: str, tail: str) -> str:
        """The readings of a word with symbols at its edges, runs of which may be nothing."""
        def optional(symbols: str, usual: str, literal: bool) -> list[list[tuple[str, float]]]:
            out = []
            for run, choices in zip(runs(symbols), self.lattice(symbols, literal=literal)):
                n, letters = len(run[0]), choices[1:]  # not as it is
                out.append([("", DECORATED if n > 2 else TRIMMED), *letters] if n > 2 or run[1] in usual else letters)
            return out

        inner = [[(c, 0.0)] for c in word] if plain(word) else None
        return " ".join(dict.fromkeys(
            self.path([*optional(lead, BEFORE, literal), *(inner or self.lattice(word, literal=literal)), *optional(tail, BEHIND, literal)])
            for literal in ([False, True] if doubled(lead + word + tail) else [False])))

    def path(self, lattice: list[list[tuple[str, float]]]) -> str:
        best: dict[str, tuple[float, tuple | None]] = {"\x00\x00": (0.0, None)}  # by the last two characters
        for choices in [*lattice, [("\x00", 0.0)]]:
            after: dict[str, tuple[float, tuple | None]] = {}
            for state, (cost, text) in best.items():
                for letters, price in choices:
                    total, last = cost + price, state
                    for c in letters:
                        total += self.cost[last + c]
                        last = "\x00\x00" if c == "\x00" else last[1] + c
                    if last not in after or total < after[last][0]:
                        after[last] = (total, (text, letters))  # readings share their beginnings, so that any length is linear
            best = after
        (_, text), = best.values()  # all readings end with the word's end
        read = []
        while text is not None:
            text, letters = text
            read.append(letters)
        return "".join(reversed(read)).strip("\x00").replace("\x00", " ")

    def reading(self, token: str) -> str:
        """The token decoded, whatever its length; only short ones are kept."""
        return self.restored[token] if len(token) <= SHORT else self.decoded(token)

    def edged(self, lead: str, word: str, tail: str) -> str:
        """`with_edges`, by a memo; of a plain word only the two characters at either edge matter."""
        if len(word) > 1 and plain(word) and len(lead) + len(tail) <= SHORT:
            before = [r[:-2] for r in self.edges[lead, word[:2], ""].split(" ")] if lead else [""]
            after = [r[2:] for r in self.edges["", word[-2:], tail].split(" ")] if tail else [""]
            return " ".join(a + word + b for a in before for b in after)
        if len(lead) + len(word) + len(tail) <= SHORT:
            return self.edges[lead, word, tail]
        return self.with_edges(lead, word, tail)

    def restore(self, token: str) -> str:
        """A token in lower case without what surrounds the word, and undisguised; several words are parted by spaces.

        The word without the symbols at its edges, and a token without letters, are kept beside their readings.
        """
        token = token.lower()
        core = token.strip(AROUND)
        if len(core) == len(token):
            return core if plain(core) else self.inner(core)
        if not core:  # nothing but symbols: letters if they differ
            symbols = token.translate(NO_LETTERS)
            return self.reading(symbols) if len(set(symbols)) > 1 else ""
        at = len(token) - len(token.lstrip(AROUND))
        lead, tail = token[:at].translate(NO_LETTERS), token[at + len(core):].translate(NO_LETTERS)
        if lead in ("$", "@"):
            lead, core = "", lead + core
        if tail in ("$", "@"):
            core, tail = core + tail, ""
        found = core if plain(core) else self.inner(core)
        return f"{found} {self.edged(lead, core, tail)}" if lead or tail else found

    def inner(self, core: str) -> str:
        """The readings of a token that may be disguised, without symbols at its edges."""
        return self.reading(core) if letter(core) else f"{core} {self.reading(core)}"

    def words(self, text: str) -> set[str]:
        """The distinct words of a text, with those spelt in single letters put together."""
        words = set(common.words(text))
        if max(map(len, words), default=0) > SHORT:
            cores = [self.core[w] if len(w) <= SHORT else self.restore(w.decode()) for w in words]
        else:
            cores = map(self.core.__getitem__, words)
        found = set(" ".join(cores).split(" "))
        if text.count(" ") > 3:
            for match in spaced.finditer(text):
                found.update(self.reading(re.sub("[.,]", "", match[0].lower())).split(" "))
        found.discard("")
        return found


def letters_only(docs: DataFrame, text: str) -> DataFrame:
    """`(code, n)`: character trigrams of the plain words of all documents, in lower case."""
    plain = F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\s]+", " ")
    return quality.trigram_counts(docs.select(plain.alias("text")), "text")


def features_of(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word, *(f"{word[:n]}-" for n in BEGINNINGS if n <= len(word))]


def evidence(n1: np.ndarray, n0: np.ndarray, total1: float, total0: float) -> np.ndarray:
    """Lower confidence bound of the log odds that a feature gives."""
    a, b = np.maximum(n1, 0) + PRIOR, np.maximum(n0, 0) + PRIOR
    return np.log(a / (total1 + 2 * PRIOR)) - np.log(b / (total0 + 2 * PRIOR)) - 2 * np.sqrt(1 / a + 1 / b)


class Scorer:
    """Score of a text: evidence of its words, and a logistic regression over the strongest."""

    def __init__(self, decoder: Decoder, counts: dict[str, tuple[int, int]], totals: tuple[int, int], weights: np.ndarray | None = None):
        self.decoder, self.counts, self.totals, self.weights = decoder, counts, totals, weights
        found = np.array(list(counts.values()), np.float64).reshape(-1, 2)
        self.own = {None: dict(zip(counts, evidence(found[:, 0], found[:, 1], *totals).tolist()))}
        for label in (0, 1):  # as it were without one document of that label
            self.own[label] = dict(zip(counts, evidence(
                found[:, 0] - label, found[:, 1] - (1 - label), totals[0] - label, totals[1] - (1 - label)).tolist()))
        self.word = {label: common.Memo(lambda w, own=own: max((own.get(f, 0.0) for f in features_of(w)), default=0.0), MEMO)
                     for label, own in self.own.items()}

    def features(self, text: str, label: int | None = None) -> list[float]:
        memo = self.word[label]
        strong = [e for e in map(memo.__getitem__, self.decoder.words(text)) if e > 0]
        top = nlargest(TOP, strong)
        return [1.0, *top, *[0.0] * (TOP - len(top))]

    def score(self, text: str) -> float:
        if self.weights is None:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.weights, self.features(text)), -30, 30))))


def fitted(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1)) + 1e-6 * np.eye(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learnt(train: DataFrame, decoder: Decoder) -> Scorer:
    """A scorer from `(text, label)` rows, whose number is bounded by the caller."""
    spark = train.sparkSession
    shared, job = spark.sparkContext.broadcast(decoder.model), uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = common.per_job("toxicity decoder", job, lambda: Decoder(shared.value))
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(common.texts_of(batch.column(0)), batch.column(1).to_pylist()):
                counts[label].update({f for w in own.words(text) for f in features_of(w)})
        names = list(counts[0].keys() | counts[1].keys())
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names), *(pa.array([counts[k][f] for f in names], pa.int64()) for k in (1, 0))], ["f", "n1", "n0"])

    totals = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    pair = totals.get(1, 0), totals.get(0, 0)
    if not all(pair):
        return Scorer(decoder, {}, pair)
    found = train.mapInArrow(count, "f string, n1 bigint, n0 bigint").groupBy("f").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    rates = (F.col("n1") / pair[0]) / ((F.col("n0") + PRIOR) / pair[1])
    strongest = found.filter((F.col("n1") >= LEAST_DOCS) & (rates > 1)).orderBy(F.desc(F.col("n1") * F.log(rates)), "f").limit(MOST_FEATURES)
    scorer = Scorer(decoder, {r["f"]: (r["n1"], r["n0"]) for r in strongest.collect()}, pair)
    counts = spark.sparkContext.broadcast(scorer.counts)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = common.per_job("toxicity scorer", job, lambda: Scorer(Decoder(shared.value), counts.value, pair))
        for batch in batches:
            labels = batch.column(1).to_pylist()
            rows = [own.features(t, y) for t, y in zip(common.texts_of(batch.column(0)), labels)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.int32())], ["x", "y"])

    rows = train.mapInArrow(features, "x array<double>, y int").collect()  # as many as `train` has
    scorer.weights = fitted(np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], np.float64))
    return scorer


def scores(docs: DataFrame, labels: DataFrame, held_out=lambda key: common.remainder(key, 3) == 1, threshold: float = 0.7,
           doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """`(doc_id, held_out, score, predicted)` of every row.

    `labels` has ids and labels 0 or 1; ids that are held out are not learnt from. Of an id
    with several labels the largest holds; null ids and null labels teach nothing.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    decoder = Decoder(quality.model_of(letters_only(named, "text")))
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).filter(
        "doc_id is not null and label in (0, 1)").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    train = cut(named.join(F.broadcast(chosen), "doc_id").groupBy(F.xxhash64("text")).agg(  # at most TRAIN_ROWS ids
        F.first("text").alias("text"), F.max("label").alias("label")).select("text", "label").repartition(F.xxhash64("text")))
    scorer = learnt(train, decoder)
    shared, job = spark.sparkContext.broadcast((decoder.model, scorer.counts, scorer.totals, scorer.weights)), uuid.uuid4().hex

    def make():
        model, counts, totals, weights = shared.value
        own = common.per_job("toxicity scorer", job, lambda: Scorer(Decoder(model), counts, totals, weights))

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([own.score(t) for t in common.texts_of(batch.column(1))], pa.float64())], ["doc_id", "score"])
        return apply

    key = docs.schema[doc_id].dataType.simpleString()
    scored = common.per_batch(named, f"doc_id {key}, score double", make)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
