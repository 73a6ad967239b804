"""Fixtures shared by the operators' tests."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def prose(seed: int, n: int) -> str:
    """Invented words, different for every seed."""
    out, x = [], seed * 7919 + 13
    for i in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("".join("etaoinshrdlu"[(x >> (3 * k)) % 12] for k in range(2 + x % 6)) + (".\n" if i % 12 == 11 else ""))
    return " ".join(out)


def odd_rows():
    """Nulls, empties, ties, repeated rows, long and periodic texts."""
    shared = prose(900, 60)
    return [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, None), (None, "one two", "en", None, 7),
        (4, prose(4, 300), "en", "a", 1), (5, prose(4, 300), "en", "b", 1), (5, prose(4, 300), "en", "b", 1),
        (6, prose(6, 80) + " " + shared + " " + prose(7, 40), "en", "b", 1), (7, shared + " tail", "en", "c", 1),
        (8, "again " * 200, "en", "c", 1), (9, "a b " * 60 + "\nc", "en", "c", 1), (10, "x" * 30000 + " y", "en", "a", 1),
        (11, prose(11, 4000), "en", "d", 1), (12, "only three words", "en", "d", 1), (13, "only  three\twords", "en", "d", 1),
        (14, prose(4, 299), "de", "a", 1), (15, "é \U0001f600 ÀB 日本 x\x1cy", "fr", "a", 1), (16, "<|endoftext|> in <s> text", "en", "a", 1),
    ]


def odd_docs(spark):
    """With extra columns whose names clash with those the operators use."""
    df = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    for name in ("t", "row", "key", "n_words", "score", "size", "id", "h", "kept", "n_tokens"):
        df = df.withColumn(name, F.lit(name))
    return df


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def key(x):
    return -1 if x is None else x
