import random

import pytest
from pyspark.sql import functions as F

from pulsemart.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int) -> str:
    """Words of a small invented vocabulary, so that texts share words but no long passages."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("ba de fi go lu mer nat or sti".split()) for _ in range(rng.randint(1, 4))) for _ in range(words))


def rows() -> list[tuple]:
    """Copies, near copies, shared passages, empty, missing, short and long texts, repeated ids and rows."""
    out = [(i, prose(i, 60 + 7 * (i % 40)), "en" if i % 2 else "fr", f"s{i % 5}", 0) for i in range(60)]
    base, passage = prose(1000, 150), prose(2000, 90)
    out += [(100 + i, base, "en", "s0", None) for i in range(8)]  # exact copies
    out += [(110 + i, f"{base[:700]} edited{i} {base[700:]}", "en", "s0", 1) for i in range(8)]  # near copies
    out += [(130 + i, f"{prose(3000 + i, 50)} {passage} {prose(4000 + i, 50)}", None, "s1", 1) for i in range(6)]
    out += [(150, None, None, None, None), (151, "", "en", "", 0), (152, " \t\n ", "en", "s2", 4), (153, "two words", "en", "s2", 9)]
    out += [(154, "Two\x0bWORDS", "en", "s2", 9), (None, prose(5, 80), "en", None, 3), (None, None, None, None, None)]
    out += [(3, prose(6000, 70), "en", "s3", 1), out[4], out[4]]  # an id of two texts, and a row three times
    out += [(160, prose(7000, 9000), "fr", "s4", 1), (161, "ab " * 4000, "en", "s4", 1), (162, "x" * 30000, "en", "s1", 1)]
    out += [(163, "ümläut é ß 日本語 " * 40, "de", "s1", 1), (164, "a <|endoftext|> b", "en", "s1", 1)]
    return out


@pytest.fixture(scope="session")
def sample(spark):
    prepare(spark)
    return rows()


@pytest.fixture(scope="session")
def docs(spark, sample):
    return spark.createDataFrame(sample, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    """Extra columns that are called like the operators' own."""
    names = ("row", "key", "label", "bin", "n_words", "n_shingles", "set_key", "proposals", "c0", "t", "kept", "stratum", "mix_size", "_h")
    return docs.withColumns({n: F.lit(f"own {n}") for n in names})
