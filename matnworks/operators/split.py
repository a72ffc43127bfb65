"""Train, validation and test split by a hash of the key.

The split of a document never depends on partitioning or on other documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Percentage bounds of the 70/15/15 split.
BOUNDS = {"train": (0, 70), "val": (70, 85), "test": (85, 100)}


def bucket(key: str = "doc_id") -> Column:
    head = F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") % 100


def split_name(key: str = "doc_id") -> Column:
    b = bucket(key)
    return F.when(b < BOUNDS["train"][1], "train").when(b < BOUNDS["val"][1], "val").otherwise("test")


def take(df: DataFrame, name: str, key: str = "doc_id") -> DataFrame:
    low, high = BOUNDS[name]
    return df.filter((bucket(key) >= low) & (bucket(key) < high))
