"""Rows of a table of documents, known by what they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_key() -> Column:
    """128 bits of a digest of ``doc_id`` and ``text``: never null, equal for repeated rows only."""
    shown = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    text = F.coalesce(F.concat(F.lit("="), F.col("text")), F.lit("-"))
    return F.unhex(F.md5(F.concat(shown, text).cast("binary")))


def fresh(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores in front as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
