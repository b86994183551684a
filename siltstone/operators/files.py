"""Files of a crawl: filters, kinds, exact copies, names, keys and cached stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import strip
from ..functions.urls import glob_regex
from .rank import row_numbers

#: What names a page of questions, and words that open a question.
FAQ_NAMES = ("faq", "perguntas", "frequentes", "duvidas", "q&a")
QUESTION_WORDS = ("como", "existe", "existem", "qual", "quais", "o que", "onde", "quando", "por que", "posso")


def has_extension(path: Column, extensions: list[str]) -> Column:
    out = F.lit(False)
    for e in extensions:
        out = out | F.lower(path).endswith(e.lower())
    return out


def not_ignored(path: Column, globs: list[str]) -> Column:
    return ~path.rlike(glob_regex(globs)) if globs else F.lit(True)


def asks(text: Column) -> Column:
    """Whether a text ends as a question or begins like one."""
    return strip(text).endswith("?") | F.lower(strip(text)).rlike(f"^(?:{'|'.join(QUESTION_WORDS)})")


def is_faq(name: Column, title: Column, n_details: Column, n_summary: Column, bold: Column) -> Column:
    """A name of such pages in file name or title, more than two foldable questions, or more than three question-like bold texts."""
    named = F.lower(F.concat_ws("\n", name, title)).rlike("|".join(FAQ_NAMES))
    return named | F.coalesce((n_details > 2) & (n_summary > 2), F.lit(False)) | (F.size(F.filter(bold, asks)) > 3)


def is_component(path: Column, code: Column, folder: str = "components") -> Column:
    stem = F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)
    return (F.coalesce(code, F.lit("")) != "") | (path.contains(f"/{folder}/") & stem.rlike(r"^[A-Z]{3}\d{4}_.+"))


def is_offerings(path: Column, folder: str = "offerings") -> Column:
    parent = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    stem = F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)
    return path.contains(f"/{folder}/") & parent.rlike(r"^\d{4}-\d$") & stem.rlike(r"^[A-Z]{3}_.+")


def file_type(path: Column, faq: Column, component: Column, offerings: Column) -> Column:
    """First match wins: faq, component, offerings, regular; other than HTML is regular."""
    html = F.lower(path).rlike(r"\.html?$")
    no = F.lit(False)
    yes = lambda c: html & F.coalesce(c, no)
    return F.when(yes(faq), "faq").when(yes(component), "component").when(yes(offerings), "offerings").otherwise("regular")


def component_code(code: Column, path: Column) -> Column:
    return F.coalesce(F.nullif(code, F.lit("")), F.substring(F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1), 1, 7))


def title_or_stem(title: Column, path: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(title), F.lit("")), F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1))


def first_of(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key, the one that sorts first (of rows that tie, one); null keys are all kept.

    The choice is an aggregation that carries the row and combines before its shuffle, so a hot key moves one row a task.
    """
    rank = F.struct(F.col(order).isNull(), F.col(order), F.xxhash64(*[c for c in df.columns if not df.schema[c].dataType.typeName() == "map"]))
    first = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*df.columns), rank).alias("_row"))
    return first.select("_row.*").unionByName(df.where(F.col(key).isNull()))


def collision_suffix(df: DataFrame, name: str, key: str, at_end: bool = False) -> DataFrame:
    """``name`` made unique: the second owner of a name gets _1 before its suffix (or ``at_end``), the third _2, by key (a number or a time)."""
    n = F.col("_owner")
    if at_end:
        return row_numbers(df, name, "_owner", [key]).withColumn("unique_name", F.when(n == 0, F.col(name)).otherwise(F.concat(name, F.lit("_"), n))).drop("_owner")
    stem, ext = F.regexp_extract(name, r"^(.*?)(\.[^./]*)?$", 1), F.regexp_extract(name, r"(\.[^./]*)$", 1)
    return row_numbers(df, name, "_owner", [key]).withColumn("unique_name", F.when(n == 0, F.col(name)).otherwise(F.concat(stem, F.lit("_"), n, ext))).drop("_owner")


def with_default(df: DataFrame, known: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """``df`` with ``value`` looked up by ``key`` in ``known`` (key, value), ``default`` where it is not there."""
    return df.join(known.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def with_source(df: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    """Each file with the columns of the page that it came from; files without a known page keep nulls."""
    return df.join(sources, key, "left")


def stage_order(kind: Column) -> Column:
    """The stage that a file is worked on in: offerings before all others, which look them up."""
    return F.when(kind == "offerings", 0).otherwise(1)


def without_parts(path: Column, other: Column) -> Column:
    """The parts of a path that another path does not have, in order and with repeats."""
    gone = F.split(other, "/")
    return F.array_join(F.filter(F.split(path, "/"), lambda p: ~F.array_contains(gone, p)), "/")


def not_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a cached stage still has to do."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def valid_groups(items: DataFrame, cached: DataFrame, group: str) -> DataFrame:
    """Cached rows of groups whose count equals the input's; others must be made again."""
    a = items.groupBy(group).agg(F.count(F.lit(1)).alias("_in"))
    b = cached.groupBy(group).agg(F.count(F.lit(1)).alias("_got"))
    return cached.join(a.join(b, group).where("_in = _got").select(group), group, "left_semi")


def backfill(df: DataFrame, weak: dict[str, str], strong: dict[str, str]) -> DataFrame:
    """Fill ``weak`` columns only where null; ``strong`` ones overwrite where the new value is not null."""
    out = df
    for old, new in weak.items():
        out = out.withColumn(old, F.coalesce(F.col(old), F.col(new)))
    for old, new in strong.items():
        out = out.withColumn(old, F.coalesce(F.col(new), F.col(old)))
    return out


def group_files(df: DataFrame, path: str) -> DataFrame:
    """dir, files: paths by directory."""
    return df.groupBy(F.regexp_extract(path, r"^(.*)/[^/]*$", 1).alias("dir")).agg(F.sort_array(F.collect_list(path)).alias("files"))
