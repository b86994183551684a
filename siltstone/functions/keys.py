"""Keys and seeded choices: every random decision is a hash of a seed and a key, so that results repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = " \n\t\r"
UNIT = float(1 << 32)


def strip(c: Column) -> Column:
    """Trim spaces, tabs and line ends."""
    return F.btrim(c, F.lit(WHITE))


def short_hash(c: Column) -> Column:
    """The first 12 hex digits of SHA-256."""
    return F.substring(F.sha2(c, 256), 1, 12)


def text_hash(c: Column) -> Column:
    """SHA-256 of the stripped text."""
    return F.sha2(strip(c), 256)


def head_tail_hash(content: Column, size: int = 4096) -> Column:
    """SHA-256 of the first ``size`` bytes, with the last ones too if there are more; null stays null."""
    tail = F.when(F.octet_length(content) > size, F.substring(content, -size, size)).otherwise(F.lit(b""))
    return F.sha2(F.concat(F.substring(content, 1, size), tail), 256)


def origin_key(key: Column, parts: int = 2) -> Column:
    """The first ``parts`` underscore-separated parts of a pair key; 3 for derived examples."""
    return F.substring_index(key, "_", parts)


def seeded_uniform(seed: str, *key: Column) -> Column:
    """A number in [0, 1) from a seed and a key."""
    digest = F.sha2(F.concat_ws("|", F.lit(seed), *[k.cast("string") for k in key]), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / UNIT


def set_hash(values: Column, separator: str = "::") -> Column:
    """Short hash of a sorted set of strings (an aggregate)."""
    return short_hash(F.array_join(F.sort_array(F.collect_set(values)), separator))
