"""Directory trees, text and JSON files, stage tables and published splits."""

from __future__ import annotations

import gc
from collections.abc import Callable
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.urls import glob_regex


#: For trees that are worked off by folders: what an opened file counts as in a partition, and no cache of lists of files that are not read again.
SMALL = {"spark.sql.files.openCostInBytes": str(128 << 10), "spark.sql.hive.filesourcePartitionFileCacheSize": "0"}


@dataclass(frozen=True)
class Config:
    """Settings of a run; loaded once and never written back."""

    base_dir: str
    extensions: tuple[str, ...] = (".html", ".pdf", ".txt", ".md", ".csv", ".json")
    ignore: tuple[str, ...] = ()
    only_folder: str | None = None
    max_pdf_chars: int = 600_000
    split_chars: int = 40_000
    batch: int = 5
    component_batch: int = 10
    distractors: int = 4
    golden_probability: float = 1.0
    min_cluster: int = 2
    top_k: int = 5
    val_ratio: float = 0.13
    seed: str = "3407"
    extra: dict = field(default_factory=dict)

    @classmethod
    def load(cls, path: str, base_dir: str | None = None) -> "Config":
        import yaml

        with open(path, encoding="utf-8") as f:
            raw = yaml.safe_load(f) or {}
        names = set(cls.__dataclass_fields__) - {"extra"}
        known = {k: tuple(v) if isinstance(v, list) else v for k, v in raw.items() if k in names}
        if base_dir:
            known["base_dir"] = base_dir
        return cls(**known, extra={k: v for k, v in raw.items() if k not in names})


def tree(spark: SparkSession, config: Config) -> DataFrame:
    """path, length, content, ext, dir of a tree's files: the configured extensions, not ignored, not empty.

    Suffixes are a glob of the listing and the length is pushed to the scan, so bodies of other files are not read.
    """
    root = config.base_dir.rstrip("/") + (f"/{config.only_folder}" if config.only_folder else "")
    either = lambda e: "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e)
    glob = "*{" + ",".join(either(e) for e in config.extensions) + "}"
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    keep = F.col("length") > 0
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    keep = keep & ext.isin(*config.extensions)
    if config.ignore:
        keep = keep & ~F.col("path").rlike(glob_regex([f"*{g}" for g in config.ignore]))
    return df.where(keep).select("path", "length", "content", ext.alias("ext"), F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"))


def by_folder(spark: SparkSession, config: Config, work: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """``work`` of a tree, whose files all lie in folders below its base, as a Parquet table in ``path``.

    Whatever reads files lists them on the driver. The folders are worked off in turn with the settings ``SMALL``, so the driver
    holds the list of one at a time; ``work`` may not depend on other folders.
    """
    root = config.base_dir.rstrip("/") + (f"/{config.only_folder}" if config.only_folder else "")
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(x.getPath().getName() for x in store.listStatus(at) if x.isDirectory()) if store.exists(at) else []
    if not names:
        return work(spark.createDataFrame([], "path string, length long, content binary, ext string, dir string"))
    before = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    try:
        for name in names:
            work(tree(spark, replace(config, base_dir=root, only_folder=name))).write.mode("append").parquet(path)
            gc.collect()  # Python's cycles hold the plan with its list
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.parquet(path)


@F.pandas_udf(StringType())
def decode_utf8(content: pd.Series) -> pd.Series:
    """UTF-8 with bad bytes left out."""
    return content.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))


def extract_text(tree: DataFrame, max_pdf_chars: int = 600_000, pdf: Callable[[bytes], str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """path, text of a tree's files by suffix, and the columns ``keep``: HTML as Markdown, plain formats decoded, PDF through ``pdf``. Each file is read once.

    ``pdf`` (bytes -> text) is whatever library there is; without one PDF files have a null text. A PDF whose text is longer
    than ``max_pdf_chars`` gives an empty text; other suffixes give a null one.
    """
    from ..operators.markdown import to_markdown

    @F.pandas_udf(StringType())
    def of_pdf(content: pd.Series) -> pd.Series:
        return content.map(lambda b: None if b is None or pdf is None else pdf(bytes(b)))

    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    html, papers, plain = ext.isin(".html", ".htm"), ext == ".pdf", ext.isin(".txt", ".md", ".csv", ".json")
    decoded, paper = decode_utf8(F.when(html | plain, F.col("content"))), of_pdf(F.when(papers, F.col("content")))
    whole = F.when(F.length(paper) > max_pdf_chars, "").otherwise(F.trim(paper))
    marked = to_markdown(F.when(html, decoded), F.col("path"))
    return tree.select("path", F.when(html, marked).when(papers, whole).when(plain, decoded).alias("text"), *keep)


def texts(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, text of whole files."""
    df = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object a line; non-ASCII letters are kept."""
    df.write.mode(mode).json(path)


def gather_jsonl(spark: SparkSession, path: str, schema: StructType | str, glob: str = "*.json*", ignore: tuple[str, ...] = ()) -> DataFrame:
    """The union of JSON-lines files; lines that are no objects, and ignored folders, are left out."""
    df = spark.read.schema(schema).option("mode", "DROPMALFORMED").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").json(path)
    if ignore:
        df = df.where(~F.col("_metadata.file_path").rlike(glob_regex([f"*/{g}/*" for g in ignore])))
    return df


def combine_json(spark: SparkSession, path: str, schema: StructType | str, folders: tuple[str, ...], glob: str = "*.json") -> DataFrame:
    """The objects of JSON list files below folders of the given names; other items and files are left out, each file is read once."""
    files = texts(spark, path, glob).where(F.col("path").rlike(rf"/(?:{'|'.join(folders)})/"))
    items = files.select(F.explode(F.from_json("text", "array<string>")).alias("item")).where(F.ltrim("item").startswith("{"))
    shape = schema if isinstance(schema, str) else schema.simpleString()
    return items.select(F.from_json("item", shape).alias("x")).select("x.*")


def publish(rows: DataFrame, path: str, split: str = "split") -> None:
    """Parquet partitioned by split."""
    rows.write.mode("overwrite").partitionBy(split).parquet(path)


def load_split(spark: SparkSession, path: str, split: str, seed: str | None = None) -> DataFrame:
    """The rows of one split, in a seeded order if a seed is given."""
    rows = spark.read.parquet(path).where(F.col("split") == split)
    if seed is None:
        return rows
    return rows.orderBy(F.sha2(F.concat_ws("|", F.lit(seed), F.to_json(F.struct(*rows.columns))), 256))


class Stage:
    """A stage's output table, keyed: computes only what it does not hold yet."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path, key

    def read(self, schema: StructType | None = None) -> DataFrame | None:
        from pyspark.errors import AnalysisException

        try:
            return self.spark.read.parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], schema) if schema else None

    def run(self, rows: DataFrame, compute) -> DataFrame:
        """Append compute(rows without a cached result), then return the cached table's rows for ``rows``."""
        done = self.read()
        todo = rows if done is None else rows.join(done.select(self.key), self.key, "left_anti")
        compute(todo).write.mode("append").parquet(self.path)
        return self.spark.read.parquet(self.path).join(rows.select(self.key).distinct(), self.key, "left_semi")

    def renew(self, rows: DataFrame, group: str) -> DataFrame:
        """The cached rows of groups that are complete; others count as missing."""
        from ..operators.files import valid_groups

        return valid_groups(rows, self.spark.read.parquet(self.path), group)


def write_batches(df: DataFrame, path: str, group: str, key: str) -> None:
    """JSON lines in one folder for each batch, named by the hash of the set of its keys; a batch is the rows of one ``group``.

    A batch that is written again replaces its own folder and no other, so a run that is repeated leaves each row once.
    """
    from ..functions.keys import set_hash
    from .recorded import write_lines

    names = df.groupBy(group).agg(set_hash(F.col(key).cast("string")).alias("batch")).withColumnRenamed(group, "_group")
    rows = df.join(names, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
    write_lines(rows.select(F.format_string("batch=%s/part.json", "batch").alias("path"), F.to_json(F.struct(*df.columns)).alias("line")), path)
