"""JSON documents parsed once to VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(df: DataFrame, documents: dict[str, Column], keep: dict[str, Column] | None = None) -> DataFrame:
    """One VARIANT column per document (null where it is no JSON) and the kept
    columns. They come out of a one-element ``explode``, which the optimizer does
    not copy into what follows: however many fields are read from a document, it
    is parsed once."""
    keep = keep or {}
    row = F.struct(*[c.alias(n) for n, c in keep.items()], *[F.try_parse_json(c.cast("string")).alias(n) for n, c in documents.items()])
    return df.select(F.explode(F.array(row)).alias("_doc")).select("_doc.*")
