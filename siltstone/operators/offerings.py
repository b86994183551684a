"""Course components and their offerings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One period's offerings of a component.
OFFERING = (
    "struct<teachers:array<struct<name:string,hours:string>>,total_hours:int,schedule:struct<code:string,description:string>,"
    "vacancies_offered:int,vacancies_filled:int,location:string>"
)


def exploded(docs: DataFrame, offerings: str = "offerings") -> DataFrame:
    """file, code, name, year_period, offering, teacher from a map of components."""
    rows = docs.select("file", F.explode(offerings).alias("code", "c"))
    rows = rows.select("file", "code", "c.name", "c.year_period", F.explode("c.offerings").alias("offering"))
    return rows.select("*", F.explode_outer("offering.teachers").alias("teacher"))


def hours(teachers: Column) -> Column:
    """Sum of the teachers' hours; what is no number counts as 0."""
    return F.aggregate(teachers, F.lit(0), lambda s, t: s + F.coalesce(t["hours"].try_cast("int"), F.lit(0)))


def to_markdown(period: Column, offerings: Column) -> Column:
    """A block for one period: numbered offerings with teachers, hours, schedule, place and vacancies."""

    def one(o: Column, i: Column) -> Column:
        names = F.array_join(F.transform(o["teachers"], lambda t: F.concat(t["name"], F.lit(" ("), F.coalesce(t["hours"], F.lit("0")), F.lit("h)"))), "; ")
        return F.concat_ws(
            "\n",
            F.concat(F.lit("### "), (i + 1).cast("string")),
            F.concat(F.lit("- Teachers: "), names),
            F.concat(F.lit("- Hours: "), hours(o["teachers"]).cast("string")),
            F.concat(F.lit("- Schedule: "), o["schedule"]["code"], F.coalesce(F.concat(F.lit(" - "), o["schedule"]["description"]), F.lit(""))),
            F.concat(F.lit("- Place: "), o["location"]),
            F.concat(F.lit("- Vacancies: "), o["vacancies_filled"].cast("string"), F.lit("/"), o["vacancies_offered"].cast("string")),
        )

    return F.concat(F.lit("## Offerings "), period, F.lit("\n"), F.array_join(F.transform(offerings, one), "\n"))


def with_offerings(components: DataFrame, blocks: DataFrame, notice: str = "No offerings are listed for this period.") -> DataFrame:
    """components (code, text) with each period's block appended, in order of period.

    ``blocks`` has code, period, file, block. For each period the first file that holds the code gives its block; where
    none does but a file of the same three-letter unit exists, the notice is appended.
    """
    first = blocks.groupBy("code", "period").agg(F.min_by("block", "file").alias("block"))
    units = blocks.groupBy(F.substring("code", 1, 3).alias("unit"), "period").agg(F.lit(1).alias("_one")).drop("_one")
    due = components.select("code").distinct().withColumn("unit", F.substring("code", 1, 3)).join(units, "unit").join(first, ["code", "period"], "left")
    part = F.coalesce("block", F.concat(F.lit("## Offerings "), F.col("period"), F.lit(f"\n{notice}")))
    joined = due.groupBy("code").agg(F.array_sort(F.collect_list(F.struct("period", part.alias("b")))).alias("bs"))
    tail = F.concat(F.lit("\n\n"), F.array_join(F.transform("bs", lambda x: x["b"]), "\n\n"))
    return components.join(joined, "code", "left").select("code", F.concat("text", F.coalesce(tail, F.lit(""))).alias("text"))
