"""Page sources: where a crawl gets its pages. A snapshot table stands for the network."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import REJECT_EXT, defrag, ext_of
from ..functions.urls import host as url_host

PAGE = "url string, status int, content_type string, body string"


class Fetcher(Protocol):
    """Gets one page; called inside executors with bounded retries."""

    def __call__(self, url: str) -> tuple[int, str, str]: ...


def from_snapshot(frontier: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The snapshot's pages for a frontier of url; what it lacks has a null body."""
    key = frontier.select(defrag(F.col("url")).alias("url")).distinct()
    return key.join(snapshot.withColumn("url", defrag(F.col("url"))), "url", "left")


def fetched(frontier: DataFrame, fetch: Fetcher, attempts: int = 3) -> DataFrame:
    """url, status, content_type, body through a fetcher; rejected suffixes are never fetched, failures have status -1."""
    todo = frontier.select("url").where(~F.substring(ext_of(F.col("url")), 2, 9).isin(*REJECT_EXT))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for u in b["url"]:
                got = (-1, None, None)
                for _ in range(attempts):
                    try:
                        got = fetch(u)
                        break
                    except OSError:
                        continue
                rows.append((u, *got))
            yield pd.DataFrame(rows, columns=["url", "status", "content_type", "body"])

    return todo.mapInPandas(run, PAGE)


def probed(frontier: DataFrame, head: Callable[[str], str | None], host: str, attempts: int = 3) -> DataFrame:
    """url, content_type: what a HEAD request says of URLs on other hosts; null on ``host`` itself, which is not asked, and after failures."""

    def one(u: str) -> str | None:
        for _ in range(attempts):
            try:
                return head(u)
            except OSError:
                continue
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"url": b["url"], "content_type": pd.Series([one(u) if away else None for u, away in zip(b["url"], b["away"])], dtype=object)})

    return frontier.select("url", (url_host(F.col("url")) != host).alias("away")).mapInPandas(run, "url string, content_type string")


def crawl(seeds: DataFrame, snapshot: DataFrame, depth: int) -> DataFrame:
    """url, depth, body reached from ``seeds`` (url) through a snapshot (url, body), level by level."""
    from ..operators.graph import links, reach, resolved, wanted

    edges = resolved(wanted(links(snapshot.withColumnRenamed("body", "html")))).select(defrag(F.col("src_url")).alias("src"), defrag(F.col("dst_url")).alias("dst"))
    found = reach(edges, seeds.select(defrag(F.col("url")).alias("node")), depth)
    return from_snapshot(found.select(F.col("node").alias("url")), snapshot).join(found.withColumnRenamed("node", "url"), "url")


def placeholders(components: DataFrame, programmes: DataFrame, text: str = "No syllabus is available.") -> DataFrame:
    """code, body: each component's syllabus, or a placeholder where there is none."""
    return components.join(programmes, "code", "left").withColumn("body", F.coalesce("body", F.concat_ws(" - ", "code", F.lit(text))))
