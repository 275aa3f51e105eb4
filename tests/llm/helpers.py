"""Small tables and brute-force versions shared by the tests of the operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, mark string, component string"


def documents(spark, rows, sources=None):
    """(id, text) as a table with extra columns whose names the operators use inside."""
    sources = sources or [f"s{k % 3}" for k in range(len(rows))]
    return spark.createDataFrame(
        [(i, t, "en", s, None if t is None else len(t), "k", None, "c") for (i, t), s in zip(rows, sources, strict=True)], SCHEMA
    )


def sentence(rng: random.Random, n: int, words: int = 40) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


ODD = [None, "", "  \n\t ", "one", "One", "a\x0bb\x0cc", "é ü 日本", "x " * 3000]
