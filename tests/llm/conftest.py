import random

import pytest

from wastelake.llm import common

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, fp int, row_number string, part int, kept string"
SYLLABLES = "an be ci do el fu ga hi in jo ka lo mi no or pa qui re su ti".split()


def prose(rnd: random.Random, words: int) -> str:
    return " ".join("".join(rnd.choices(SYLLABLES, k=rnd.randint(1, 3))) for _ in range(words)).capitalize() + "."


def frame(spark, rows):
    """Documents from (doc_id, text, lang, source), with columns that clash with inner names."""
    common.prepare(spark)
    return spark.createDataFrame([(i, t, g, s, len(t or ""), "x", 1, "y", 2, "z") for i, t, g, s in rows], SCHEMA)


def awkward_rows():
    """Nulls in any column, empty and very long texts, repeated rows and equal texts."""
    rnd = random.Random(5)
    shared = prose(rnd, 60)
    rows = [(i, prose(rnd, rnd.randint(20, 80)), rnd.choice(["en", "de"]), rnd.choice(["a", "b", "c"])) for i in range(20)]
    rows += [(20, shared, "en", "a"), (21, shared, "en", "b"), (22, shared + " " + prose(rnd, 30), "de", "a")]
    rows += [(23, None, "en", "a"), (24, "", None, "b"), (25, " \t\n", "en", None), (None, prose(rnd, 30), "en", "a"), (None, None, None, None)]
    rows += [rows[3], rows[3], (26, prose(rnd, 15_000), "en", "a"), (27, "a" * 5000, "en", "c"), (28, "x", "en", "c")]
    rows += [(29, "日本語 é ß 😀 " * 20, "ja", "é")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return awkward_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
