from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("block", T.StringType()),
        T.StructField("key", T.IntegerType()),
    ]
)


@pytest.fixture
def documents(spark):
    """A table of (id, text) rows with extra columns whose names operators could want for themselves."""

    def made(rows):
        return spark.createDataFrame([(i, t, "b", 1) for i, t in rows], DOCS)

    return made


def sentence(seed: int, words: int) -> str:
    chance = random.Random(seed)
    return " ".join("".join(chance.choices("abcdefgh", k=chance.randint(2, 6))) for _ in range(words))


@pytest.fixture
def odd_rows():
    """Missing, empty, blank, long and repeated texts, missing and repeated ids, ties."""
    long = " ".join(sentence(i, 30) + "\n" for i in range(400))
    return [
        (1, None),
        (2, ""),
        (3, "  \t\n "),
        (4, "one"),
        (5, "One "),
        (6, sentence(1, 40)),
        (7, sentence(1, 40)),
        (7, sentence(1, 40)),
        (None, sentence(2, 25)),
        (None, None),
        (8, long),
        (9, "x" * 20_000),
        (10, "é ö 日本語 \x00 ｆｕｌｌ 👍🏽 <|endoftext|> don't 12!!"),
    ]
