import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, n long, row long, key string, mark1 long, spans string, kept boolean, stratum string, `odd name` int"


def odd_rows():
    """Nulls, empty and very long texts, repeated rows, ties, and extra columns with clashing names."""
    rng = random.Random(5)
    syllables = ["tion", "er", "an", "the", "re", "éa", "ß", "ing", "ha", "ço"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    prose = [" ".join(word() + rng.choice(["", "", ".", ","]) for _ in range(rng.randint(30, 120))) for _ in range(20)]
    texts = [None, "", "   \n\t ", "one", "a b c d", "a b c d", "A B C D", "a b c d e f g h", *prose, prose[0], prose[0] + " tail", prose[1].upper(), " ".join(word() for _ in range(60_000)), "x" * 300_000, "spam " * 400, "l1 same line\nl1 same line\nother\n\n  \nl1 same line", "İstanbul ΣΑΣ ﬁ  nbsp em \x1c\x85 é ́x", "<|endoftext|> <s> </s> <0x41> ▁▁ a  b", "nul \x00 byte 🙂 梦"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(8, prose[0]), (8, prose[0]), (None, prose[2]), (None, None), (-5, prose[3])]
    return [(i, t, rng.choice(["en", "fr", None]), "s", None if t is None else len(t), 1, 2, 3, "k", 4, "q", True, "z", 0) for i, t in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def pages(spark, folder):
    return spark.read.parquet(f"{folder}/pages.parquet")


def multiset(rows):
    return sorted(map(repr, rows))
