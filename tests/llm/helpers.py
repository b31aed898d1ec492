"""Small tables and brute-force versions for the operator tests."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Extra columns whose names the operators use inside.
CLASHING = DOCS.fields + [T.StructField(n, T.StringType()) for n in ("_text", "_h", "size", "rate", "seed", "kept", "fp", "n", "component", "_id")]


def docs_frame(spark, rows):
    """rows: (doc_id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


def clashing_frame(spark, rows):
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, *["x"] * 10) for r in rows]
    return spark.createDataFrame(full, T.StructType(CLASHING))


def words(rng: random.Random, n: int, vocabulary: int = 5000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
