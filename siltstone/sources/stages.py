"""A graph of cached stages: what depends on a change is worked out again, and nothing else.

A stage's output for a key depends on the rows of its inputs that have this key. It is remembered under a mark: a hash of the content
of those rows and of the stage's version. A run goes through the graph in topological order; of each stage it computes the keys
whose mark is new, drops those that no input has any more, and leaves the rest alone. A stage whose output for a key comes out as before
ends the change there. Outputs are appended, and a narrow table of marks, written anew by each run, tells which of them hold; a run that
is broken off leaves the marks of the one before. Outputs that no longer hold are listed beside the marks, so those that do are read by leaving
that list out: it is as small as the changes, and wide rows need not be shuffled to meet the marks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import removed

HELD = ["_key", "_run"]


@dataclass(frozen=True)
class Step:
    """A stage: its output's ``key`` column, its inputs with the column of each that holds the key, and what it computes from them."""

    name: str
    key: str
    inputs: dict[str, str]
    compute: Callable[[dict[str, DataFrame]], DataFrame]
    version: str = "1"


def content(df: DataFrame, key: str) -> DataFrame:
    """_key, _mark: of each key, a hash of its rows that does not depend on their order. Null keys are left out."""
    row = F.xxhash64(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
    other = F.xxhash64(F.lit("other"), F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
    parts = [F.count(F.lit(1)), F.bit_xor(row), F.sum(row.cast("decimal(38,0)")), F.sum(other.cast("decimal(38,0)"))]
    return df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("_key")).agg(F.concat_ws("|", *(p.cast("string") for p in parts)).alias("_mark"))


class Graph:
    """Stages with their tables below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, steps: list[Step]):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.steps = {s.name: s for s in steps}
        if len(self.steps) < len(steps):
            raise ValueError("two stages have one name")
        #: The stages in the order in which they run; a circle is an error.
        self.order = [n for n in TopologicalSorter({s.name: s.inputs for s in steps}).static_order() if n in self.steps]

    def latest(self, name: str) -> tuple[int, DataFrame | None]:
        """The number of the last whole run of a stage, and its marks (_key, _mark, _run, _round)."""
        try:
            marks = self.spark.read.parquet(f"{self.folder}/{name}/marks")
        except AnalysisException:
            return 0, None
        last = marks.agg(F.max("run")).first()[0]
        return (0, None) if last is None else (last, marks.where(F.col("run") == last).drop("run"))

    def table(self, name: str) -> DataFrame:
        """The output that holds of a stage, with _round: the run that computed the row."""
        n, marks = self.latest(name)
        rows = self.spark.read.parquet(f"{self.folder}/{name}/rows").join(F.broadcast(marks.select("_run", "_round").distinct()), "_run")
        dead = self.spark.read.parquet(f"{self.folder}/{name}/dead/run={n}")
        return (rows if dead.isEmpty() else rows.join(dead, HELD, "left_anti")).drop(*HELD)

    def run(self, sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Bring all stages up to date with ``sources``; the outputs by name."""
        tables = dict(sources)
        for name in self.order:
            self.update(self.steps[name], {k: tables[k] for k in self.steps[name].inputs})
            tables[name] = self.table(name).drop("_round")
        return {n: tables[n] for n in self.order}

    def update(self, step: Step, inputs: dict[str, DataFrame]) -> None:
        n, old = self.latest(step.name)
        run, at = uuid.uuid4().hex, f"{self.folder}/{step.name}"
        marks = [content(inputs[k], c).withColumnRenamed("_mark", f"_mark{i}") for i, (k, c) in enumerate(step.inputs.items())]
        want = reduce(lambda a, b: a.join(b, "_key", "full"), marks)
        mark: Column = F.sha2(F.concat_ws(" ", F.lit(step.version), *(F.coalesce(f"_mark{i}", F.lit("-")) for i in range(len(marks)))), 256)
        want = want.select("_key", mark.alias("_mark"))
        if old is None:
            new = want.withColumns({"_run": F.lit(run), "_round": F.lit(n + 1)})
        else:
            known = old.select("_key", "_mark", F.col("_run").alias("_old"), F.col("_round").alias("_was"))
            new = want.join(known, ["_key", "_mark"], "left").select("_key", "_mark", F.coalesce("_old", F.lit(run)).alias("_run"), F.coalesce("_was", F.lit(n + 1)).alias("_round"))
        pending = f"{at}/pending-{run}"
        new.write.parquet(pending)
        new = self.spark.read.parquet(pending)
        if old is None:
            part = {k: inputs[k].where(F.col(c).isNotNull()) for k, c in step.inputs.items()}
        else:
            new.where(F.col("_run") == run).select(F.col("_key").alias("_todo")).write.parquet(f"{at}/todo-{run}")
            todo = self.spark.read.parquet(f"{at}/todo-{run}")
            part = {k: inputs[k].join(todo, inputs[k][c].cast("string") == todo["_todo"], "left_semi") for k, c in step.inputs.items()}
        out = step.compute(part).withColumns({"_key": F.col(step.key).cast("string"), "_run": F.lit(run)}).where("_key IS NOT NULL")
        out.write.mode("append").parquet(f"{at}/rows")
        held = self.spark.read.parquet(f"{at}/rows").select(*HELD).join(F.broadcast(new.select("_run").distinct()), "_run")
        held.join(new, HELD, "left_anti").select(*HELD).distinct().write.mode("overwrite").parquet(f"{at}/dead/run={n + 1}")
        new.write.parquet(f"{at}/marks/run={n + 1}")
        removed(self.spark, pending)
        removed(self.spark, f"{at}/todo-{run}")
