"""Small document tables with the awkward cases every operator must handle."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Extra columns whose names clash with the operators' own.
CLASH = ", fp bigint, key string, doc bigint, score string, kept int, row string, tag string, h bigint, c int, text_ string"


def word(rng: random.Random) -> str:
    return "".join(rng.choice("bcdfgklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(word(rng) for _ in range(n))


def documents(seed: int = 5) -> list[tuple]:
    """Plain, empty, null, copied, edited, very long and repetitive texts; repeated rows; a null id."""
    rng = random.Random(seed)
    passage = sentence(rng, 60)
    texts = [sentence(rng, rng.randint(3, 120)) for _ in range(25)]
    texts += [texts[0], texts[1] + " " + word(rng), texts[2].replace("a", "o", 1)]
    texts += [sentence(rng, 30) + "\n" + passage + "\n" + sentence(rng, 20) for _ in range(4)]
    texts += ["", None, "  \t\n", "a", "é ß ñ", "x " * 300, "ab" * 400, sentence(rng, 4000), "1 2 3 4 5", "don't it's we'll <|endoftext|> 日本語  z"]
    texts += [texts[3] + " " + texts[4], texts[4] + "\n" + texts[3]]
    rows = [(3 * i, t, ("en", "fr", None)[i % 3], "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], (rows[8][0], "another text with the same id as one before", "en", "s", 43), (None, texts[5], None, None, None)]
    return rows


def frame(spark, rows=None, extra: bool = False):
    df = spark.createDataFrame(documents() if rows is None else rows, SCHEMA)
    if extra:
        for part in CLASH[2:].split(", "):
            name, kind = part.split()
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit(None).cast(kind))
    return df.repartition(3) if rows is None else df
