"""Joins on keys of which a few hold a large share of the rows.

The ``KEEP`` most frequent keys are found by an aggregation, which combines before its shuffle. Their rows meet a broadcast
of the other side and are never shuffled; no other key holds more than one part in ``KEEP`` of the rows, so the
ordinary join of the rest is even. The broadcast has at most ``KEEP`` keys with as many rows each as the other side
has for a key, which the caller must bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP = 4096


def spread(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` over four tasks a core by ``key``: what costs much time a row in Python, but is read from few small files, is else one task."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, key)


def most_frequent(sizes: DataFrame, key: str, n: str, keep: int = KEEP) -> DataFrame:
    """key: the at most ``keep`` keys with the largest ``n``; null keys are left out."""
    return sizes.where(F.col(key).isNotNull()).orderBy(F.desc(n), key).limit(keep).select(key)


def split_join(rows: DataFrame, other: DataFrame, key: str, top: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``other`` on ``key``, whose keys in ``top`` go by broadcast; ``how`` is inner or left.

    ``top`` holds distinct keys. Null keys match nothing and stay in a left join.
    """
    few = F.broadcast(top)
    known = F.broadcast(other.join(few, key, "left_semi"))
    hot = rows.join(few, key, "left_semi").join(known, key, how)
    rest = rows.join(few, key, "left_anti").join(other, key, how)
    return hot.unionByName(rest)
