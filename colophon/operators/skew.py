"""Joins that stay balanced when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than one row in HOT_PARTS; there are fewer than HOT_PARTS such keys by construction.
HOT_PARTS = 512
#: A table of at most so many bytes is broadcast as a whole.
SMALL_BYTES = 16 << 20


def lookup_join(facts: DataFrame, dim: DataFrame, keys: list[str], count_col: str) -> DataFrame:
    """Inner join of ``facts`` with ``dim``, where ``dim`` has one row a key and the key's rows in ``facts`` in ``count_col``.

    Both should be tables that are written already, since ``dim`` is measured first. Up to SMALL_BYTES it is broadcast. Beyond
    that the keys that hold more than 1/HOT_PARTS of the rows are joined map-side: they are fewer than HOT_PARTS
    rows, so their broadcast is bounded whatever the data; the other keys are joined by a shuffle in which no key
    is heavy. Keys are never null in ``dim``; rows of ``facts`` with a null key have no partner.
    """
    width = 32 * len(dim.columns)
    size = F.lit(width)
    for c, kind in dim.dtypes:
        if kind == "string":
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
    measured = dim.agg(F.sum(count_col).alias("total"), F.sum(size).alias("bytes")).first()
    if (measured["bytes"] or 0) <= SMALL_BYTES:
        return facts.join(F.broadcast(dim), keys, "inner")
    is_hot = F.col(count_col) * F.lit(HOT_PARTS) > F.lit(measured["total"])
    hot, cold = dim.where(is_hot), dim.where(~is_hot)
    head = facts.join(F.broadcast(hot), keys, "inner")
    tail = facts.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys, "inner")
    return head.unionByName(tail)
