"""Stateful processors against plain versions, at different splits into batches."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siltstone.plans import streams
from siltstone.streaming import processors


def stream(spark, batches, schema, path):
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
    df = spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    return df


def histories(turns, n):
    out, by = {}, defaultdict(list)
    for conv, turn, role, text, flag in turns:
        by[conv].append((turn, role, text, flag))
    for conv, rows in by.items():
        flagged, before = set(), []
        for turn, role, text, flag in sorted(rows):
            if not (text or "").strip():
                continue
            if role == "user":
                kept, skip = [], False
                for r, t in before:
                    if r == "user" and t.strip() in flagged:
                        skip = True
                    elif r != "user" and skip:
                        skip = False
                    else:
                        kept.append(f'{r}: "{t}"')
                out[conv, turn] = "\n".join(kept[-n:])
                if flag:
                    flagged.add(text.strip())
            before.append((role, text))
    return out


@pytest.mark.parametrize("cuts", [[], [1, 2, 7]])
def test_domain_histories(spark, tmp_path, cuts):
    r = random.Random(len(cuts))
    turns = [(conv, turn, r.choice(["user", "user", "assistant", "system"]), r.choice(["a", "b ", " b", "c", "", None, "é\nx"]), r.random() < 0.3) for conv in range(12) for turn in range(10)]
    cuts = [0, *cuts, 99]
    batches = [r.sample(b, len(b)) for lo, hi in zip(cuts, cuts[1:]) if (b := [t for t in turns if lo <= t[1] < hi])]
    df = stream(spark, batches, "conv_id long, turn long, role string, text string, flag boolean", tmp_path)
    before = spark.conf.get(processors.PROVIDER)
    got = processors.drained(processors.domain_histories(df, F.col("flag"), 4), str(tmp_path)).collect()
    assert {(x["conv_id"], x["turn"]): x["history"] for x in got} == histories(turns, 4)
    assert spark.conf.get(processors.PROVIDER) == before


def test_state_with_a_time_to_live(spark, tmp_path):
    """Such a stream runs until it is stopped."""
    turns = [(1, 0, "user", "a", True), (1, 1, "assistant", "b", False), (1, 2, "user", "c", False)]
    df = stream(spark, [turns], "conv_id long, turn long, role string, text string, flag boolean", tmp_path)
    with processors.state_store(spark):
        out = processors.domain_histories(df, F.col("flag"), 4, ttl=3_600_000)
        q = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/offsets").start()
        try:
            for _ in range(40):
                if q.lastProgress and q.lastProgress["batchId"] > 0 or q.awaitTermination(1):
                    break
        finally:
            q.stop()
    got = spark.read.schema(out.schema).parquet(f"{tmp_path}/out").collect()
    assert {x["turn"]: x["history"] for x in got} == {0: "", 2: ""}


def admissions(events, limit, window):
    out, by = {}, defaultdict(list)
    for key, event_id, ts in events:
        if ts is not None:
            by[key].append((ts, event_id))
    for key, rows in by.items():
        times = []
        for ts, event_id in sorted(rows):
            start = ts if len(times) < limit else max(ts, times[-limit] + timedelta(seconds=window))
            times.append(start)
            out[event_id] = (key, (start - ts) // timedelta(microseconds=1), start == ts)
    return out


@pytest.mark.parametrize("parts", [1, 4])
def test_limited_at_any_split(spark, tmp_path, parts):
    """Events arrive up to a minute late, so batches overlap in time; a null key is a key of its own."""
    r = random.Random(parts)
    t0 = datetime(2024, 1, 1)
    events = [(r.choice(["a", "a", "b", None]), i, None if i % 50 == 49 else t0 + timedelta(milliseconds=r.randrange(1_200_000))) for i in range(200)]
    arrival = sorted(events, key=lambda e: (e[2] or t0) + timedelta(seconds=r.random() * 60))
    size = -(-len(arrival) // parts)
    batches = [arrival[i : i + size] for i in range(0, len(arrival), size)] + [[("end", -1, t0 + timedelta(hours=9))]]
    df = stream(spark, batches, "k string, event_id long, ts timestamp_ntz", tmp_path)
    got = processors.drained(processors.limited(df, "k", 3, 60, "2 minutes"), str(tmp_path)).collect()
    assert {x["event_id"]: (x["key"], x["wait"], x["admitted"]) for x in got if x["event_id"] >= 0} == admissions(events, 3, 60)


@pytest.mark.parametrize("size", [16, 1 << 18])
def test_limited_table_cuts_keys(spark, tmp_path, monkeypatch, size):
    """Four batches of several files, which overlap in time; where keys are cut, no task takes the whole of one."""
    r = random.Random(size)
    t0 = datetime(2024, 1, 1)
    events = [(r.choice(["a", "a", "b", None]), i, None if i % 50 == 49 else t0 + timedelta(seconds=r.randrange(1_200))) for i in range(300)]
    arrival = sorted(events, key=lambda e: (e[2] or t0) + timedelta(seconds=r.random() * 60))
    schema = "k string, event_id long, ts timestamp_ntz"
    parts = [spark.createDataFrame(b, schema).repartition(3) for b in (arrival[:80], arrival[80:81], arrival[81:200], arrival[200:], [("end", -1, t0 + timedelta(hours=9))])]
    buckets, cut = [], processors.rank.bucketed
    monkeypatch.setattr(processors.rank, "bucketed", lambda *a, **k: buckets.append(cut(*a, **k)) or buckets[-1])
    out = streams._fed(parts, parts[0].schema, str(tmp_path), lambda s: processors.limited_table(s, str(tmp_path), "k", 3, 60, 120, size))
    got = out.collect()
    assert len(got) == 300 - 6 and out.columns == ["key", "event_id", "at", "wait", "admitted"]
    assert {x["event_id"]: (x["key"], x["wait"], x["admitted"]) for x in got} == admissions(events, 3, 60)
    assert len(list(tmp_path.glob("out/batch=*"))) == 5 and len(list(tmp_path.glob("in/*.parquet"))) > 5
    assert any("_k" in b._jdf.queryExecution().optimizedPlan().toString() for b in buckets) == (size == 16)
