"""Rows that share a doc_id, null and text doc_ids, through every operator that drops rows, against brute force."""

import random

import pytest

from siltstone.llm import decontaminate, exact_dedup, near_dedup, store

from .test_brute import near_copies, sets

W = "one two three four five six seven eight nine ten eleven twelve thirteen"
V = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def as_set(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


@pytest.fixture(scope="module")
def shared(spark):
    rows = [(1, W), (7, W), (7, V), (9, V + " phi"), (None, W), (None, "alone here"), (None, None), (11, None), (12, ""), (11, "other text that nobody else has")]
    return spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, h string, n_shingles int")


def test_exact_copies_by_row(shared):
    got = as_set(exact_dedup.drop_copies(shared))
    want = [(1, W), (7, V), (9, V + " phi"), (None, "alone here"), (11, None), (11, "other text that nobody else has")]
    assert got == sorted(repr((*r, "x", 3)) for r in want)


def test_near_copies_by_row(shared):
    rows = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_components(shared, 4).collect()}
    assert {(1, 10, 1, True), (7, 10, 1, False), (7, 17, 7, True), (9, 18, 7, False), (None, 10, None, True), (11, 3, 11, True), (11, 0, 11, True)} <= rows
    got = as_set(near_dedup.drop_near_copies(shared, 4))
    want = [(1, W), (7, V), (None, W), (None, "alone here"), (None, None), (11, None), (12, ""), (11, "other text that nobody else has")]
    assert got == sorted(repr((*r, "x", 3)) for r in want)


def test_leaks_by_row(spark, shared):
    items = spark.createDataFrame([(1, V)], "item_id long, text string")
    got = as_set(decontaminate.drop_contaminated(shared, items))
    want = [(1, W), (7, W), (None, W), (None, "alone here"), (None, None), (11, None), (12, ""), (11, "other text that nobody else has")]
    assert got == sorted(repr((*r, "x", 3)) for r in want)
    leak = spark.createDataFrame([(1, W)], "item_id long, text string")
    assert None not in {r["doc_id"] for r in decontaminate.drop_contaminated(shared, leak).where(f"text = '{W}'").collect()}


def row_components(rows, w, percent):
    """Brute force: each row a node of its own; the smallest doc_id that a row reaches."""
    s = [sets(t, w) for _, t in rows]
    seen, out = set(), {}
    for i in range(len(rows)):
        if i in seen or rows[i][0] is None or not s[i]:
            continue
        part, todo = {i}, [i]
        while todo:
            x = todo.pop()
            for y in range(len(rows)):
                if y not in part and rows[y][0] is not None and s[y] and 100 * len(s[x] & s[y]) >= percent * len(s[x] | s[y]):
                    part.add(y)
                    todo.append(y)
        seen |= part
        out |= dict.fromkeys(part, min(rows[k][0] for k in part))
    return sorted((repr(rows[i][0]), len(s[i]), repr(out.get(i, rows[i][0]))) for i in range(len(rows)))


@pytest.mark.parametrize("kind", ["long", "string"])
def test_shared_ids_through_the_hot_path(spark, kind, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3000)
    g = random.Random(3)
    made = near_copies(6, 3, 70, 12)
    name = (lambda i: i) if kind == "long" else (lambda i: f"d{i:04d}")
    rows = [(name(g.randrange(150)) if g.random() > 0.03 else None, t) for _, t in made]
    rows += rows[:5]
    docs = spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(3)
    got = near_dedup.near_components(docs, 4).collect()
    assert sorted((repr(r["doc_id"]), r["n_shingles"], repr(r["component_id"])) for r in got) == row_components(rows, 4, 80)
    kept = [r for r in got if r["kept"]]
    assert near_dedup.drop_near_copies(docs, 4).count() == len(kept)


def test_folder_is_named_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        store.shared_dir(Session())
