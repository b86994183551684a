"""Rate windows, remembered out-of-domain questions, and incremental ingestion."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.keys import text_hash


def request_rate(events: DataFrame, key: str, ts: str = "ts", seconds: int = 60, slide: int = 10, late: str = "2 minutes") -> DataFrame:
    """Requests of each key in sliding windows, with a watermark; ``ts`` without a zone is read in the session's."""
    rows = events.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", late)
    return rows.groupBy(F.window("_at", f"{seconds} seconds", f"{slide} seconds"), key).agg(F.count(F.lit(1)).alias("n"))


def limiter(events: DataFrame, key: str, limit: int, seconds: int = 60, late: str = "2 minutes") -> DataFrame:
    """key, event_id, admitted, wait_s: a trailing-window limiter with state for each key.

    Every request counts once it is admitted, including one that had to wait; events of a batch are taken by time. A
    key's state goes when the watermark has passed its last admission by the window.
    """
    kind = events.schema[key].dataType.simpleString()

    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        times = list(state.get[0]) if state.exists else []
        rows = []
        for f in frames:
            for r in f.sort_values(["at", "event_id"]).itertuples():
                at = float(r.at)
                times = [t for t in times if t > at - seconds]
                wait = 0.0 if len(times) < limit else max(0.0, sorted(times)[-limit] + seconds - at)
                times.append(at + wait)
                rows.append((k[0], r.event_id, wait == 0.0, wait))
        state.update((times[-limit:],))
        state.setTimeoutTimestamp(max(int((max(times) + seconds) * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(rows, columns=[key, "event_id", "admitted", "wait_s"])

    rows = events.select(key, "event_id", F.col("ts").cast("timestamp").alias("_at"), F.col("ts").cast("timestamp").cast("double").alias("at")).withWatermark("_at", late)
    return rows.groupBy(key).applyInPandasWithState(
        run, f"{key} {kind}, event_id long, admitted boolean, wait_s double", "times array<double>", "append", GroupStateTimeout.EventTimeTimeout
    )


def flagged_questions(turns: DataFrame, outside: Column) -> DataFrame:
    """conv_id, text_hash of user questions outside the domain: the set that filters later history.

    Keyed by conversation; on a stream the set is kept by deduplication within the watermark.
    """
    return turns.where((F.col("role") == "user") & outside).select("conv_id", text_hash(F.col("text")).alias("text_hash")).dropDuplicates(["conv_id", "text_hash"])


def ingest(source: DataFrame, key: str, target: str, compute: Callable[[DataFrame], DataFrame], checkpoint: str):
    """Run ``compute`` on rows whose key the target table lacks, batch by batch, until the source is drained."""
    from ..sources.files import Stage

    def batch(rows: DataFrame, _: int) -> None:
        Stage(rows.sparkSession, target, key).run(rows.dropDuplicates([key]), compute)

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
