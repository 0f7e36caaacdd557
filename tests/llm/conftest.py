import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, row string, size int, kept int"


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, a long one, ties, repeated rows, and columns
    whose names the operators use themselves."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    data = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "fr", "b"), (None, "no id here at all", "en", None),
            (4, "One line.\nAnother line.\nOne line.", "en", "a"), (5, long, "en", "a"), (5, long, "en", "a"),
            (6, "é" * 300 + " 你好 wörld 12 34", "de", "b"), (7, "x", None, "c"), (7, "y", "fr", "c"),
            (8, " no break\u0085", "fr", "b"), (9, "</s>[INST] <|x|> [/INST]", "en", "a")]
    return spark.createDataFrame([(*d, "own row", 7, 9) for d in data], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def few_docs(spark):
    from ..conftest import SF_SMALL
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(4).cache()
