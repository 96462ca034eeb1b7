"""Small tables shared by the tests of the training-data operators."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def documents(spark, rows, *extra: str):
    """rows: (doc_id, text[, lang]); `extra`: more columns as SQL expressions."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    return df.selectExpr("*", *extra)
