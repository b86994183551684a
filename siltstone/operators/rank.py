"""Ordered work on groups of any size: a hot group is cut into buckets in order, so no task sorts the whole of it.

Only groups with more than ``ROWS`` rows are cut. What is known of them (cuts, offsets, carried values) goes by broadcast: it has
at most two entries for each ``ROWS`` rows of the table. Rows are shuffled once, by group and bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written

ROWS, CUTS = 1 << 20, 1024


def bucketed(df: DataFrame, group: str, order: Column, spread: Column | None = None, size: int = ROWS) -> DataFrame:
    """``df`` with _b, the bucket of a row within its group (rising with ``order``), and _hot, whether the group was cut.

    ``spread`` must rise with ``order`` and lie in [0, 1); without it ``order`` is a number or a time, cut at approximate
    quantiles. Equal values share a bucket; null groups form one group. Groups are counted at once, by a pass over ``group``;
    where none is larger than ``size``, nothing else is read or joined for it.
    """
    parts = F.least(F.ceil(F.col("_n") / size), F.lit(CUTS)).cast("int")
    hot = df.groupBy(F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > size).select("_g", parts.alias("_k"))
    if hot.isEmpty():
        return df.withColumns({"_b": F.lit(0), "_hot": F.lit(False)})
    hot = written(hot, "hot")
    if spread is not None:
        own = F.floor(spread * F.col("_k")).cast("int")
    else:
        near = df.join(F.broadcast(hot), df[group].eqNullSafe(hot["_g"])).select("_g", "_k", order.alias("_v"))
        steps = near.groupBy("_g", "_k").agg(F.percentile_approx("_v", [i / CUTS for i in range(1, CUTS)], 8 * CUTS).alias("_p"))
        cuts = F.transform(F.sequence(F.lit(1), F.col("_k") - 1), lambda j: F.get(F.col("_p"), F.floor(j * CUTS / F.col("_k")).cast("int") - 1))
        hot = steps.select("_g", "_k", cuts.alias("_cuts"))
        own = F.size(F.filter("_cuts", lambda c: c < order))
    rows = df.join(F.broadcast(hot), df[group].eqNullSafe(hot["_g"]), "left")
    cut = F.col("_k").isNotNull()
    return rows.select(*[df[c] for c in df.columns], F.when(cut, F.coalesce(own, F.lit(-1))).otherwise(0).alias("_b"), cut.alias("_hot"))


def carried(rows: DataFrame, group: str, total: Column, before: Column, whole: Column | None = None) -> DataFrame:
    """``rows`` (from ``bucketed``) with _before: ``before`` (over _total) of the buckets ahead, and _whole of all of the group's.

    ``total`` is the aggregate _total of a bucket. Both are null in groups that were not cut.
    """
    sums = rows.where("_hot").groupBy(F.col(group).alias("_g"), F.col("_b").alias("_at")).agg(total.alias("_total"))
    ahead = Window.partitionBy("_g").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_g", "_at", before.over(ahead).alias("_before"), (before if whole is None else whole).over(Window.partitionBy("_g")).alias("_whole"))
    return rows.join(F.broadcast(sums), rows[group].eqNullSafe(sums["_g"]) & (rows["_b"] == sums["_at"]) & rows["_hot"], "left").drop("_g", "_at")


def row_numbers(df: DataFrame, group: str, out: str, by: list[str | Column], spread: Column | None = None, size: int = ROWS, total: str | None = None) -> DataFrame:
    """``df`` with ``out`` (long, from 0) in the order of ``by`` within each group, and the group's size as ``total``.

    The first of ``by`` decides the buckets, see ``bucketed``. Null groups form one group.
    """
    first = F.col(by[0]) if isinstance(by[0], str) else by[0]
    rows = carried(bucketed(df, group, first, spread, size), group, F.count(F.lit(1)), F.sum("_total"))
    here = Window.partitionBy(group, "_b")
    new = {out: (F.row_number().over(here.orderBy(*by)) - 1 + F.coalesce("_before", F.lit(0))).cast("long")}
    if total:
        new[total] = F.coalesce("_whole", F.count(F.lit(1)).over(here))
    return rows.withColumns(new).select(*df.columns, *new)


def last_before(df: DataFrame, group: str, by: list[str], value: Column, out: str, size: int = ROWS) -> DataFrame:
    """``df`` with the last ``value`` that is not null before each row, in the order of ``by`` (its first a number or a time)."""
    rows = bucketed(df.withColumn("_value", value), group, F.col(by[0]), size=size)
    latest = F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(*by)))
    rows = carried(rows, group, latest, F.last("_total", ignorenulls=True))
    ahead = Window.partitionBy(group, "_b").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(out, F.coalesce(F.last("_value", ignorenulls=True).over(ahead), "_before")).select(*df.columns, out)


def sessions(df: DataFrame, group: str, by: list[str], gap: Column, out: str, size: int = ROWS) -> DataFrame:
    """``df`` with the number of each row's session (from 1): one begins after a pause of more than ``gap``, in the order of ``by``."""
    at = F.col(by[0])
    rows = carried(bucketed(df, group, at, size=size), group, F.max(at), F.max("_total"))
    here = Window.partitionBy(group, "_b").orderBy(*by)
    pause = at - F.coalesce(F.lag(at).over(here), "_before")
    rows = rows.withColumn("_fresh", F.when(pause <= gap, 0).otherwise(1)).drop("_before", "_whole")
    rows = carried(rows, group, F.sum("_fresh"), F.sum("_total"))
    return rows.withColumn(out, F.sum("_fresh").over(here) + F.coalesce("_before", F.lit(0))).select(*df.columns, out)
