import random

import pytest
from pyspark.sql import functions as F

from logwarden.llm import common

LOREM = "the quick brown fox jumps over lazy dog while seven wizards quietly mix potions near old stone bridge at dawn".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, component_id string, hits int"


@pytest.fixture(autouse=True)
def _code(spark):
    common.ship(spark)


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(LOREM) + rng.choice(["", "s", "ly", "ed"]) for _ in range(words))


def document_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, copies, personal data, licenses."""
    base = prose(1, 120)
    texts = [
        base, base, base.replace("fox", "cat", 1), None, "", " \t\n", "x", prose(2, 4000), "9" * 3000,
        "Call +1 (555) 010-7788 or mail Jo.Doe@mail.example.com from 10.0.0.1, card 4111 1111 1111 1111.",
        "Released under the MIT License.\n" + prose(3, 40), "Licensed under CC BY-NC 4.0.", "Été ÀÇÉ 你好 🎉 K\x00k <|endoftext|> ▁▁",
        prose(4, 30) + " " + prose(5, 60) + " " + prose(6, 30), prose(5, 60), prose(5, 70), "ab" * 400, "ab" * 300 + prose(7, 20),
        "General  public\tlicense and APACHE-license mit license mit license",
    ]
    rows = [(k, text, "en", f"src{k % 3}", len(text or ""), "x", k) for k, text in enumerate(texts)]
    return [*rows, rows[0], rows[4], (None, prose(8, 25), None, None, None, None, None), (None, None, None, None, None, None, None)]


@pytest.fixture
def docs(spark):
    """With columns whose names clash with those that operators make."""
    return spark.createDataFrame(document_rows(), SCHEMA).repartition(3, F.col("hits"))


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
