"""Quality rules: perplexity bands of modified Kneser-Ney models, beside simple counts.

Words are predicted from the word before, by the bigrams of all other documents (`ngrams`).
Words that are rare or unknown there are spelt by a second model: a word's characters and its
end are predicted from the two characters before. Spark counts the trigrams of all documents;
modified Kneser-Ney probabilities and back-off weights are put in arrays sorted by n-gram hash
and looked up by binary search. Characters are folded into a fixed number of classes, so the
model of spelling has at most CLASSES ** 3 entries whatever the corpus, which bounds what is
broadcast; the bigrams are not broadcast.

A document's perplexities, by words and by letters, are taken per word over all its words. The
bands of a language lie about its medians; as a mean over few words varies more, they are wider
for short documents, by the spread that the language's documents show. What lies above either
band, or below that of letters, is rejected. Words have no lower edge: a copy is foretold by its
copies, and which of them stays is for deduplication to say.

Nulls count as empty texts without words; they fail the base rules and have no perplexity.
Documents without a language are a language of their own. Repeated rows are counted each.
An empty table gives an empty result. Further columns are not read, or only carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..session import cut
from . import common, ngrams

#: Character classes: word border, the ASCII characters, and the rest dealt out by code point.
CLASSES = 192
SYMBOLS = frozenset("#*$%&|<>")
BETWEEN = " \t\n\x0b\x0c\r"  # what parts words
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
#: A band's reach in standard deviations of a document's mean, and what is added, in natural logarithms.
REACH, LEAST_REACH = 5.0, 0.25
ACCURACY = 10_000
SPELT = 50_000  # words that are spelt at a time
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Mean negative logarithms of a document's words: by the word before, and by their letters.
SCORES = ("log_perplexity", "log_spelling")


def folded(text: str) -> np.ndarray:
    """Class of every character."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(code < 128, code, 128 + code % np.uint32(CLASSES - 128)).astype(np.int64)


def trigram_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram hashes of words, one after another, and how many each has: its characters and its end."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    joined = folded("\x00\x00".join(words) + "\x00")
    padded = np.concatenate([[0, 0], joined])
    codes = (padded[:-2] * CLASSES + padded[1:-1]) * CLASSES + padded[2:]
    # Between two words stand two borders: the first ends a word, the second only begins the next.
    ends = np.cumsum(lengths + 2)[:-1] - 1
    return np.delete(codes, ends), lengths + 1


def text_codes(texts: list[str]) -> np.ndarray:
    """The trigram hashes of all words of texts, as `trigram_codes` has them."""
    joined = " ".join([*texts, ""])
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    between = (code == 32) | ((code >= 9) & (code <= 13))
    kind = np.where(between, 0, folded(joined)).astype(np.int32)
    padded = np.concatenate([np.zeros(2, np.int32), kind])
    first = np.concatenate([[True], between[:-1]])  # in a text, or after a character that parts words
    codes = (np.where(first, 0, padded[:-2]) * CLASSES + padded[1:-1]) * CLASSES + kind
    return codes[~(between & first)]


def trigram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """`(code, n)`: how often each character trigram occurs in the words of all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES ** 3, np.int64)
        for batch in batches:
            total += np.bincount(text_codes(common.texts_of(batch.column(0))), minlength=len(total))
        found = np.flatnonzero(total)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["code", "n"])

    return docs.select(text).mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def discounts(counts: np.ndarray) -> np.ndarray:
    """Discount of every count: the three of modified Kneser-Ney, from counts of counts."""
    return ngrams.discounted(ngrams.discount_values(ngrams.counts_of_counts(counts)), counts)


class Model:
    """Interpolated probabilities in sorted hash arrays."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        order = np.argsort(codes)
        self.three, n3 = codes[order], counts[order]
        pairs, n2 = np.unique(self.three % (CLASSES * CLASSES), return_counts=True)  # different characters before a pair
        singles, n1 = np.unique(pairs % CLASSES, return_counts=True)
        uniform = 1.0 / CLASSES
        total = max(1, n1.sum())
        d1 = discounts(n1)
        self.p1 = np.full(CLASSES, uniform * max(d1.sum(), 1e-9) / total)
        self.p1[singles] += (n1 - d1) / total
        self.p1 /= self.p1.sum()
        self.two, self.before_two, p2, self.gamma2 = pairs, *self.level(pairs // CLASSES, n2)
        self.p2 = p2 + self.gamma2[np.searchsorted(self.before_two, pairs // CLASSES)] * self.p1[pairs % CLASSES]
        self.before_three, p3, self.gamma3 = self.level(self.three // CLASSES, n3)
        self.p3 = p3 + self.gamma3[np.searchsorted(self.before_three, self.three // CLASSES)] * self.lower(self.three % (CLASSES * CLASSES))

    @staticmethod
    def level(contexts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted contexts, discounted probabilities of the entries, and the contexts' back-off weights."""
        found, inverse = np.unique(contexts, return_inverse=True)
        d = discounts(counts)
        total = np.bincount(inverse, counts, len(found))
        return found, (counts - d) / total[inverse], np.bincount(inverse, d, len(found)) / total

    @staticmethod
    def find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
        if not len(keys):
            return np.full(len(wanted), missing)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], missing)

    def lower(self, pairs: np.ndarray) -> np.ndarray:
        seen = self.find(self.two, self.p2, pairs, -1.0)
        return np.where(seen >= 0, seen, self.find(self.before_two, self.gamma2, pairs // CLASSES, 1.0) * self.p1[pairs % CLASSES])

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        p = self.find(self.three, self.p3, codes, -1.0)
        unseen = np.flatnonzero(p < 0)
        p[unseen] = self.find(self.before_three, self.gamma3, codes[unseen] // CLASSES, 1.0) * self.lower(codes[unseen] % (CLASSES * CLASSES))
        return np.log(np.maximum(p, 1e-12))


def model_of(counts: DataFrame) -> Model:
    """The model of trigram counts; there are at most CLASSES ** 3 of them."""
    rows: pd.DataFrame = counts.toPandas()
    return Model(rows["code"].to_numpy(np.int64), rows["n"].to_numpy(np.int64))


def repeated_words(ids: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Per text, words in windows of WINDOW words that it has twice or more; `ids` are the words' hashes, `owner` their texts."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return np.zeros(texts, np.int64)
    h = owner[:n].astype(np.uint64)
    for i in range(WINDOW):
        h = common.mixed(h + ids[i:i + n])
    at = np.flatnonzero(owner[:n] == owner[WINDOW - 1:])
    order = at[ngrams.order_of(h[at])]
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edges = np.bincount(np.flatnonzero(twice), minlength=len(ids) + 1) - np.bincount(np.flatnonzero(twice) + WINDOW, minlength=len(ids) + 1)
    return np.bincount(owner[np.cumsum(edges)[:-1] > 0], minlength=texts)


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        if line in seen:
            n += bool(line.strip(BETWEEN))
        else:
            seen.add(line)
    return n


def featured(docs: DataFrame, model: Model, text: str, carry: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """The carried columns of the rows and their features, and the columns' names by feature."""
    names = {f: common.fresh(docs, f"q_{f}") for f in (*FEATURES, *SCORES)}
    shared = docs.sparkSession.sparkContext.broadcast(model)
    read = docs.select(*carry, *([] if text in carry else [text]))

    def spelled(words: list[bytes]) -> np.ndarray:
        found = []
        for part in range(0, len(words), SPELT):
            codes, each = trigram_codes([w.decode() for w in words[part:part + SPELT]])
            found.append(np.add.reduceat(shared.value.log_probabilities(codes), np.concatenate([[0], np.cumsum(each)[:-1]])))
        return np.concatenate(found)

    def score(table: pa.Table, texts: list[str], block: ngrams.Block, found: pa.Table) -> pa.Table:
        letters = spelled(block.listed())
        sums, spellings = ngrams.log_probabilities(block, found, letters).tolist(), block.added(letters).tolist()
        repeats = repeated_words(block.hashes, block.owner, len(texts)).tolist()
        rows: list[tuple] = []
        for t, n, again, *scores in zip(texts, block.count.tolist(), repeats, sums, spellings):
            chars = len(t) - sum(map(t.count, BETWEEN))
            rows.append((n, chars, sum(map(t.count, SYMBOLS)), repeated_lines(t), again, *(-x / n if n else None for x in scores)))
        columns = list(zip(*rows))
        return pa.Table.from_arrays(
            [*(table.column(c) for c in carry), *(pa.array(c, pa.int64()) for c in columns[:5]), *(pa.array(c, pa.float64()) for c in columns[5:])],
            [*carry, *names.values()])

    added = [StructField(names[f], LongType()) for f in FEATURES] + [StructField(names[f], DoubleType()) for f in SCORES]
    return ngrams.scored(read, text, StructType([*docs.select(*carry).schema, *added]), score), names


def judged(docs: DataFrame, text: str, lang: str, carry: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """The carried columns, among them the language, with features, `base_failed` and `kept`, and the columns' names by meaning."""
    rows, names = featured(docs, model_of(trigram_counts(docs, text)), text, carry)
    rows = cut(rows)
    n = F.col(names["n_words"])
    language = common.fresh(rows, "q_lang")
    of_lang = F.col(lang).eqNullSafe(F.col(language))

    def with_medians(table: DataFrame, values: dict[str, Column]) -> tuple[DataFrame, dict[str, Column]]:
        """The rows with the median of each value in their language."""
        found = {f: common.fresh(table, f"q_of_{f}") for f in values}
        # Written, for its size to be known: else the rows with their texts are shuffled to meet a row per language.
        medians = cut(table.groupBy(F.col(lang).alias(language)).agg(
            *[F.percentile_approx(v, 0.5, ACCURACY).alias(found[f]) for f, v in values.items()]))
        return table.join(medians, of_lang, "left").drop(language), {f: F.col(c) for f, c in found.items()}

    centred, centre = with_medians(rows, {f: F.col(names[f]) for f in SCORES})
    off = {f: F.col(names[f]) - centre[f] for f in SCORES}
    placed, spread = with_medians(centred, {f: F.abs(off[f]) * F.sqrt(n) for f in SCORES})
    reach = {f: REACH * 1.4826 * spread[f] / F.sqrt(n) + LEAST_REACH for f in SCORES}
    failed = (n < LEAST_WORDS) | (100 * F.col(names["n_repeat_words"]) > MOST_REPEATED * n)
    inside = (off["log_perplexity"] <= reach["log_perplexity"]) & (F.abs(off["log_spelling"]) <= reach["log_spelling"])
    names |= {"base_failed": common.fresh(placed, "q_base_failed"), "kept": common.fresh(placed, "q_kept")}
    return placed.withColumn(names["base_failed"], failed).withColumn(names["kept"], ~failed & F.coalesce(inside, F.lit(False))), names


def verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """`(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, perplexity,
    spelling)`, the last two by words and by their letters."""
    rows, names = judged(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")), "text", "lang", ["doc_id", "lang"])
    return rows.select("doc_id", *[F.col(names[f]).alias(f) for f in (*FEATURES, "base_failed", "kept")],
                       F.exp(names["log_perplexity"]).alias("perplexity"), F.exp(names["log_spelling"]).alias("spelling"))


def kept(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows that the rules keep, with all columns."""
    rows, names = judged(docs, text, lang, docs.columns)
    return rows.filter(names["kept"]).select(*docs.columns)
