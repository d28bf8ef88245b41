"""Inputs that every operator has to stand, and helpers."""

import random

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their own columns.
CLASHING = (
    "size", "score", "rep", "band", "ids", "decoded", "kept", "component", "digest", "n_words", "n_tokens", "label",
    "draws", "shard", "_block", "_lot", "registers", "found", "target", "a", "b", "u", "v", "id", "words", "_in0", "place",
)
VOCABULARY = [f"w{k}" for k in range(400)]


def prose(n, seed):
    pick = random.Random(seed)
    return " ".join(pick.choice(VOCABULARY) for _ in range(n))


def changed(text, every):
    return " ".join("x" + w if i % every == every - 1 else w for i, w in enumerate(text.split(" ")))


def odd_rows():
    base = prose(300, 1)
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One  one\none"), (6, base), (7, base.upper()), (8, changed(base, 100)),
        (9, changed(base, 3)), (10, prose(30_000, 2)), (6, base), (None, base), (None, None), (11, "é ü 日本   x y"),
        (12, "a" * 20_000), (13, " ".join(["same"] * 500)), (14, "one two three four five"), (15, "ONE two three four five"),
        (16, "Licensed under the Apache License, Version 2.0.\n" + prose(30, 3)), (17, "<|endoftext|> 'll \n\n  x"),
    ]
    out = [(d, t, "en", f"s{(d or 0) % 3}" if d != 9 else None, len(t or "")) for d, t in rows]
    return out + [(100 + k, prose(40, 50 + k), None, "s0", 0) for k in range(30)]


def odd_docs(spark, clash=False):
    df = spark.createDataFrame(odd_rows(), DOCS).repartition(3)
    return df.withColumns({c: F.lit("mine") for c in CLASHING}) if clash else df


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
