"""Stateful processors: a chat history that forgets flagged questions, and a rate limiter in the order of time.

Both keep their state by key in the state store (RocksDB), so a restart goes on from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..functions.keys import strip, text_hash
from ..operators import rank
from ..sources.shared import removed

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Requests of a key and batch that one task numbers.
ROWS = 1 << 18


@contextmanager
def state_store(spark: SparkSession):
    """The state store that processors need, while a stream is started; the session's own setting comes back after it."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


class DomainHistory(StatefulProcessor):
    """The history of each user turn, without questions flagged so far and the replies that came after them.

    State of a conversation: the hashes of flagged questions (map) and its turns (list), which go ``ttl`` milliseconds after they were
    last written. A flagged question hides all earlier turns of the same text from then on, and the next turn of another role after each.
    """

    def __init__(self, n: int, ttl: int | None):
        self.n, self.ttl = n, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.flagged = handle.getMapState("flagged", "hash string", "turn long", self.ttl)
        self.turns = handle.getListState("turns", "turn long, role string, text string, hash string", self.ttl)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        turns = [tuple(t) for t in self.turns.get()]
        flagged = {k[0] for k in self.flagged.keys()}
        fresh = []
        for r in sorted(rows, key=lambda r: r["turn"]):
            if r["role"] == "user":
                yield Row(conv_id=key[0], turn=r["turn"], history="\n".join(self.lines(turns, flagged)[-self.n :]))
                if r["flagged"]:
                    flagged.add(r["hash"])
                    self.flagged.updateValue((r["hash"],), (r["turn"],))
            turns.append((r["turn"], r["role"], r["text"], r["hash"]))
            fresh.append(turns[-1])
        if fresh:
            self.turns.appendList(fresh)

    @staticmethod
    def lines(turns: list[tuple], flagged: set[str]) -> list[str]:
        out, skip = [], False
        for _, role, text, own in turns:
            if role == "user":
                if own in flagged:
                    skip = True
                    continue
            elif skip:
                skip = False
                continue
            out.append(f'{role}: "{text}"')
        return out

    def close(self) -> None:
        pass


def domain_histories(turns: DataFrame, flagged: Column, n: int = 4, ttl: int | None = None) -> DataFrame:
    """conv_id, turn, history (the last ``n`` lines) of each user turn of a stream (conv_id, turn, role, text).

    The turns of a conversation arrive in order over the batches, in any order inside one. Blank turns are left out. With ``ttl`` the stream
    is one that runs until it is stopped.
    """
    rows = turns.where(strip(F.col("text")) != "").select("conv_id", "turn", "role", "text", text_hash(F.col("text")).alias("hash"), F.coalesce(flagged & (F.col("role") == "user"), F.lit(False)).alias("flagged"))
    kind = turns.schema["conv_id"].dataType.simpleString()
    return rows.groupBy("conv_id").transformWithState(DomainHistory(n, ttl), f"conv_id {kind}, turn long, history string", "append", "none" if ttl is None else "processingTime")


class Limiter(StatefulProcessor):
    """At most ``limit`` admissions of a key in any ``window`` microseconds; requests are admitted in the order of their time.

    A request waits in the state until the watermark has passed its time, so late ones still take their place. State of a key: the
    requests that wait (list), and its last ``limit`` admissions (value). One timer, at the earliest request, wakes it.
    """

    def __init__(self, limit: int, window: int):
        self.limit, self.window = limit, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, event_id long")
        self.admitted = handle.getValueState("admitted", "times array<long>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        fresh = [(r["at"], r["event_id"]) for r in rows]
        if fresh:
            self.waiting.appendList(fresh)
            self.handle.registerTimer(min(fresh)[0] // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted(tuple(r) for r in self.waiting.get())
        due, rest = [r for r in rows if r[0] < now], [r for r in rows if r[0] >= now]
        if not due:
            return
        times = list(self.admitted.get()[0]) if self.admitted.exists() else []
        for at, event_id in due:
            start = at if len(times) < self.limit else max(at, times[-self.limit] + self.window)
            times = [*times, start][-self.limit :]
            yield Row(key=key[0], event_id=event_id, at=at, wait=start - at, admitted=start == at)
        self.admitted.update((times,))
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(rest[0][0] // 1000 + 1)
        else:
            self.waiting.clear()

    def close(self) -> None:
        pass


def limited(events: DataFrame, key: str, limit: int, seconds: int = 60, late: str = "2 minutes") -> DataFrame:
    """key, event_id, at, wait (microseconds), admitted (without waiting) of a stream (key, event_id, ts); null times are left out.

    Every request counts once it is admitted, including one that had to wait. A request goes out once the watermark, ``late`` behind the newest
    time seen, has passed it; one that arrives after that is dropped.
    """
    ts = F.col("ts").cast("timestamp")
    rows = events.where("ts IS NOT NULL").select(F.col(key).alias("key"), "event_id", ts.alias("ts"), F.unix_micros(ts).alias("at")).withWatermark("ts", late)
    kind = events.schema[key].dataType.simpleString()
    return rows.groupBy("key").transformWithState(Limiter(limit, seconds * 1_000_000), f"key {kind}, event_id long, at long, wait long, admitted boolean", "append", "eventTime")


def admissions(due: DataFrame, lanes: DataFrame, limit: int, window: int, at: str, size: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """``due`` (key, event_id, at) with wait and admitted, and the new ``lanes``; what Limiter does, for keys of any size.

    Request i of a key starts at its time or ``window`` after the start of request i - limit. Those ``limit`` lanes of requests do not
    touch, and in each the start is the largest (time - steps * window) so far, plus steps * window: a number and a running maximum.
    ``lanes`` (key, lane, n, top) holds each lane's requests and largest value so far. Keys are cut in order where they have over ``size`` rows;
    numbered rows are kept at ``at`` while the results are in use.
    """
    before = lanes.groupBy("key").agg(F.sum("n").alias("_n"), F.map_from_entries(F.collect_list(F.struct("lane", "top"))).alias("_tops"))
    rows = rank.row_numbers(due, "key", "_i", ["at", "event_id"], size=size)
    rows = rows.join(before.withColumnRenamed("key", "_key"), F.col("key").eqNullSafe(F.col("_key")), "left").withColumn("_i", F.col("_i") + F.coalesce("_n", F.lit(0)))
    lane = (F.col("_i") % limit).cast("int")
    rows = rows.select("key", "event_id", "at", "_i", lane.alias("lane"), F.try_element_at("_tops", lane).alias("_top"))
    rows = rows.withColumn("_pushed", F.expr(f"_i DIV {limit}") * window).withColumn("_own", F.col("at") - F.col("_pushed")).withColumn("_lane", F.struct("key", "lane"))
    rows.write.mode("overwrite").parquet(at)
    rows = due.sparkSession.read.schema(rows.schema).parquet(at)
    cut = rank.carried(rank.bucketed(rows, "_lane", F.col("_i"), size=size), "_lane", F.max("_own"), F.max("_total"))
    here = Window.partitionBy("_lane", "_b").orderBy("_i")
    start = F.greatest(F.max("_own").over(here), "_before", "_top") + F.col("_pushed")
    out = cut.withColumn("wait", start - F.col("at")).select("key", "event_id", "at", "wait", (F.col("wait") == 0).alias("admitted"))
    new = rows.groupBy("key", "lane").agg(F.count(F.lit(1)).alias("n"), F.max("_own").alias("top"))
    return out, lanes.unionByName(new).groupBy("key", "lane").agg(F.sum("n").alias("n"), F.max("top").alias("top"))


def limited_table(events: DataFrame, path: str, key: str, limit: int, seconds: int = 60, late: int = 120, size: int = ROWS) -> DataFrame:
    """The rows of ``limited`` as a table below ``path``, for few keys with many requests: each batch is worked on by all cores.

    Runs the stream to its end; a later run goes on from there. What a batch leaves for the next (requests that wait, lanes, the newest time)
    is written under its number, so a batch that is run again gives the same. ``late`` is in seconds.
    """
    spark = events.sparkSession
    kind = events.schema[key].dataType.simpleString()
    ts = F.col("ts").cast("timestamp")
    rows = events.where("ts IS NOT NULL").select(F.col(key).alias("key"), F.col("event_id").cast("long").alias("event_id"), F.unix_micros(ts).alias("at"))
    held = {"waiting": f"key {kind}, event_id long, at long", "lanes": f"key {kind}, lane int, n long, top long", "newest": "at long"}

    def batch(fresh: DataFrame, n: int) -> None:
        own = fresh.sparkSession
        waiting, lanes, newest = (own.read.schema(s).parquet(f"{path}/{name}/{n - 1}") if n else own.createDataFrame([], s) for name, s in held.items())
        before = newest.agg(F.max("at")).first()[0]
        if before is not None:
            fresh = fresh.where(F.col("at") >= before - late * 1_000_000)
        now = newest.unionByName(fresh.select("at")).agg(F.max("at").alias("at")).first()[0]
        passed = F.col("at") < (now or 0) - late * 1_000_000
        both = waiting.unionByName(fresh)
        out, lanes = admissions(both.where(passed), lanes, limit, seconds * 1_000_000, f"{path}/numbered", size)
        out.write.mode("overwrite").parquet(f"{path}/out/batch={n}")
        for name, df in (("waiting", both.where(~passed)), ("lanes", lanes), ("newest", own.createDataFrame([(now,)], held["newest"]))):
            df.write.mode("overwrite").parquet(f"{path}/{name}/{n}")
            if n > 1:
                removed(own, f"{path}/{name}/{n - 2}")
        removed(own, f"{path}/numbered")

    rows.writeStream.foreachBatch(batch).option("checkpointLocation", f"{path}/offsets").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(f"key {kind}, event_id long, at long, wait long, admitted boolean").parquet(f"{path}/out").drop("batch")


def drained(stream: DataFrame, path: str) -> DataFrame:
    """Run a stream to its end into a Parquet table below ``path``, with its checkpoint beside it; the table's rows."""
    spark = stream.sparkSession
    with state_store(spark):
        stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/offsets").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(StructType(stream.schema.fields)).parquet(f"{path}/out")
