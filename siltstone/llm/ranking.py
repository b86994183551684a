"""Ranks with ties inside groups of any size, by a histogram of pairs.

A line belongs to a group and, within it, to a pair: two numbers that order the lines of the group. The lines are counted for
each group and pair, which combines before the shuffle; windows over these counts, of which a group has one for each of its pairs,
give every pair its place (1 plus the group's lines of earlier pairs) and how many lines tie in it. Only pairs with a place of at most ``top``
survive. Their lines are joined back, dealt out by range over the whole order (group, pair, the remaining columns and the line's number in the
scan, so that equal lines spread as well), numbered inside each range, and written. A pair that runs over the edge
of a range goes on counting from the ranges before; these offsets are at most one for each range (``ranges``,
a fixed number) and are the only thing that is broadcast. No group, pair or row set meets in one task.

Defined results: null keys are groups of their own; a null first number of the pair comes first, all such lines being equal in it; a
null second number comes last; a number that is not finite counts as null; equal lines are returned as often as they occur; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .store import materialize, table

#: Stand-ins for null in the two numbers of a pair; no rounded quotient of a number reaches them.
FIRST, LAST = -(1 << 63), (1 << 63) - 1


def numbered(keys: list[str]):
    """Adds _rank: the number, from 1, of a row among the rows of equal ``keys`` in its partition, which is sorted by them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            fresh = np.zeros(n, bool)
            for k in keys:
                x = b.column(k)
                values, null = np.asarray(pc.fill_null(x, 0)), np.asarray(pc.is_null(x))
                fresh[1:] |= (values[1:] != values[:-1]) | (null[1:] != null[:-1])
            head = tuple(b.column(k)[0].as_py() for k in keys)
            fresh[0] = head != last
            starts = np.flatnonzero(fresh)
            begin = np.zeros(n, np.int64)
            begin[starts] = starts
            rank = np.arange(n) - np.maximum.accumulate(begin) + 1
            if not fresh[0]:
                rank[: starts[0] if len(starts) else n] += count
            last, count = tuple(b.column(k)[n - 1].as_py() for k in keys), int(rank[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rank, pa.int64())], [*b.schema.names, "_rank"])

    return run


def pairs(lines: DataFrame, group: list[str], top: int) -> DataFrame:
    """The surviving pairs (_a, _b) of each group: with place, and tied, the count of their lines."""
    counts = lines.groupBy(*group, "_a", "_b").agg(F.count(F.lit(1)).alias("tied"))
    ahead = Window.partitionBy(*group).orderBy("_a", "_b").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("place", F.coalesce(F.sum("tied").over(ahead), F.lit(0)) + 1).where(F.col("place") <= top)


def ranked(df: DataFrame, group: dict[str, Column], pair: tuple[Column, Column], rest: dict[str, Column], top: int, ranges: int | None = None) -> DataFrame:
    """The lines of ``df`` whose pair has a place of at most ``top``: the columns of ``group`` and ``rest``, place, tied and pos.

    ``pair`` are two numbers, both ascending. pos counts the lines of a group from 1 in the order of the pairs, then of ``rest`` (ascending, nulls
    last). All values are whole numbers. ``ranges`` is the number of ranges dealt out (default: spark.sql.shuffle.partitions).
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group]
    nulls = [f"_null{i}" for i in range(len(keys))]
    columns = {k: c.cast("long") for k, c in (group | rest).items()}
    lines = df.select(*(c.alias(k) for k, c in columns.items()), F.coalesce(pair[0].cast("long"), F.lit(FIRST)).alias("_a"), F.coalesce(pair[1].cast("long"), F.lit(LAST)).alias("_b"), F.monotonically_increasing_id().alias("_line"))
    few = pairs(lines, keys, top).withColumnsRenamed(dict(zip(keys, nulls)) | {"_a": "_a2", "_b": "_b2"})
    same = (lines["_a"] == few["_a2"]) & (lines["_b"] == few["_b2"])
    for k, other in zip(keys, nulls):
        same &= lines[k].eqNullSafe(few[other])
    kept = lines.join(few, same).drop(*nulls, "_a2", "_b2")
    order = [*(F.col(k).asc_nulls_first() for k in keys), "_a", "_b", *(F.col(c).asc_nulls_last() for c in rest), "_line"]
    dealt = kept.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    dealt = dealt.drop("_line").withColumn("_range", F.spark_partition_id())
    out = StructType([*dealt.schema.fields, StructField("_rank", LongType())])
    held = materialize(dealt.mapInArrow(numbered([*keys, "_a", "_b"]), out), "ranked")
    here = held.groupBy("_range", *keys, "_a", "_b").agg(F.max("_rank").alias("_n"))
    ahead = Window.partitionBy(*keys, "_a", "_b").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    over = here.withColumn("_before", F.sum("_n").over(ahead)).where("_before IS NOT NULL")
    over = over.select(F.col("_range").alias("_at"), F.col("_a").alias("_a2"), F.col("_b").alias("_b2"), "_before", *(F.col(k).alias(o) for k, o in zip(keys, nulls)))
    same = (held["_range"] == over["_at"]) & (held["_a"] == over["_a2"]) & (held["_b"] == over["_b2"])
    for k, other in zip(keys, nulls):
        same &= held[k].eqNullSafe(over[other])
    pos = F.col("place") - 1 + F.coalesce("_before", F.lit(0)) + F.col("_rank")
    return held.join(F.broadcast(over), same, "left").select(*columns, "place", "tied", pos.cast("long").alias("pos"), "_a", "_b")


def finite(x: Column) -> Column:
    """``x`` as a double; null unless it is finite."""
    x = x.cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def op11_grouped_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "sale_lines")
    one = F.coalesce(F.crc32(F.col("sale_id").cast("string")) % 5 == 0, F.lit(False))
    month = F.coalesce(100 * F.year("shipped_at") + F.month("shipped_at"), F.lit(-1))
    group = {"vendor_id": F.col("vendor_id"), "part": F.coalesce(F.col("item_id") % 10, F.lit(-1)), "month": month}
    group = {k: F.when(one, -1).otherwise(c) for k, c in group.items()}
    tens = F.floor(F.col("quantity") / 10)
    percent = F.floor(100 * finite(F.col("discount")) + 0.5)
    rest = {"sale_id": F.col("sale_id"), "line_no": F.col("line_no"), "quantity": F.col("quantity"), "amount_cents": F.floor(100 * finite(F.col("amount")) + 0.5)}
    out = ranked(df, group, (-tens, percent), rest, 3)
    return out.select("vendor_id", "part", "month", "pos", "place", "sale_id", "line_no", "quantity", F.nullif("_b", F.lit(LAST)).alias("percent"), "amount_cents", "tied")


SQL = r"""
WITH RECURSIVE steps AS (
  SELECT i::BIGINT AS i, 0 AS k, i::BIGINT AS v FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8),
codes AS (SELECT list(v ORDER BY i) AS c FROM steps WHERE k = 8),
ones AS (
  SELECT sale_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(sale_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                                  lambda h, b: xor(h >> 8, c[(xor(h, b) & 255) + 1])), 4294967295) % 5 = 0 AS one
  FROM (SELECT DISTINCT sale_id FROM sale_lines WHERE sale_id IS NOT NULL), codes),
x AS (
  SELECT CASE WHEN one THEN -1 ELSE vendor_id END AS vendor_id,
         CASE WHEN one THEN -1 ELSE coalesce(item_id % 10, -1) END AS part,
         CASE WHEN one THEN -1 ELSE coalesce(100 * year(shipped_at) + month(shipped_at), -1) END AS month,
         floor(quantity / 10)::BIGINT AS tens, floor(100 * discount + 0.5)::BIGINT AS percent,
         l.sale_id, line_no::BIGINT AS line_no, quantity::BIGINT AS quantity, floor(100 * amount + 0.5)::BIGINT AS amount_cents
  FROM sale_lines l LEFT JOIN ones ON l.sale_id = ones.sale_id),
r AS (
  SELECT *, row_number() OVER (g ORDER BY tens DESC NULLS FIRST, percent NULLS LAST, sale_id NULLS LAST, line_no NULLS LAST, quantity NULLS LAST, amount_cents NULLS LAST) AS pos,
         rank() OVER (g ORDER BY tens DESC NULLS FIRST, percent NULLS LAST) AS place,
         count(*) OVER (PARTITION BY vendor_id, part, month, tens, percent) AS tied
  FROM x WINDOW g AS (PARTITION BY vendor_id, part, month))
SELECT vendor_id::BIGINT AS vendor_id, part::BIGINT AS part, month::BIGINT AS month, pos, place, sale_id, line_no, quantity, percent, amount_cents, tied
FROM r WHERE place <= 3
"""
