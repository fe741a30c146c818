"""A keyed table kept on disk: merged segments give the state of the whole log, and only touched ranges are rewritten."""

import random
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from opinio.operators import keyed
from opinio.sources import keyed_store as store

SCHEMA = "seq long, op string, row_key string, family string, qualifier string, value string"


def _log(n, rows, seed=3):
    rnd = random.Random(seed)
    out = []
    for seq in range(1, n + 1):
        op = rnd.choice(["put"] * 6 + ["delete_column"] * 2 + ["delete_row"])
        row = rnd.choice(rows)
        out.append((seq, op, row, "info", None if op == "delete_row" else rnd.choice("abc"), str(seq) if op == "put" else None))
    return out


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _files(base):
    return {p: p.stat().st_mtime_ns for p in Path(base).rglob("*.parquet")}


@pytest.mark.parametrize("order", ["as written", "late", "repeated"])
def test_segments_equal_the_replay_of_the_whole_log(spark, tmp_path, order):
    log = _log(600, [f"r{i}" for i in range(40)] + ["é", "", None])
    segments = [log[:200], log[200:400], log[400:]]
    if order == "late":
        segments = [log[2::3], log[0::3], log[1::3]]
    if order == "repeated":
        segments = [log[:300], log[100:500], log[:200], log[400:]]
    base = str(tmp_path / "store")
    store.create(spark.createDataFrame(segments[0], SCHEMA), base, ranges=5)
    for s in segments[1:]:
        store.merge(spark.createDataFrame(s, SCHEMA), base)
    want = keyed.apply_log(spark.createDataFrame(log, SCHEMA))
    assert _rows(store.state(spark, base)) == _rows(want)
    for key in ("r39", "absent"):
        assert _rows(store.get_row(spark, base, key)) == _rows(keyed.get_row(want, key))


def test_only_touched_ranges_are_rewritten(spark, tmp_path):
    base = str(tmp_path / "store")
    keys = [f"k{i:03d}" for i in range(100)]
    store.create(spark.createDataFrame([(i, "put", k, "f", "q", "v") for i, k in enumerate(keys)], SCHEMA), base, ranges=4)
    before = _files(f"{base}/cells")
    assert len({p.parent for p in before}) == 4
    touched = store.merge(spark.createDataFrame([(200, "put", "k060", "f", "q", "new"), (201, "delete_row", "k061", None, None, None)], SCHEMA), base)
    assert touched == [2]
    after = _files(f"{base}/cells")
    assert all(after[p] == t for p, t in before.items())
    assert {p.parent.name for p in after.keys() - before.keys()} == {"range=2"}
    got = {r.row_key: r.value for r in store.state(spark, base).collect()}
    assert got["k060"] == "new" and "k061" not in got and len(got) == 99
    # what nobody reads any more goes, the state stays
    assert store.vacuum(spark, base) == 1
    assert {r.row_key: r.value for r in store.state(spark, base).collect()} == got


def test_a_range_may_become_empty(spark, tmp_path):
    base = str(tmp_path / "store")
    store.create(spark.createDataFrame([(1, "put", "a", "f", "q", "v"), (2, "put", "b", "f", "q", "v")], SCHEMA), base, ranges=2)
    store.merge(spark.createDataFrame([(3, "delete_row", "a", None, None, None)], SCHEMA), base)
    store.forget_deletes(spark, base, before=10)
    assert _rows(store.kept(spark, base)) == [("b", "f", "q", 2, "put", "v")]
    store.merge(spark.createDataFrame([(11, "put", "a", "f", "q", "again")], SCHEMA), base)
    assert _rows(store.state(spark, base)) == [("a", "f", "q", "again"), ("b", "f", "q", "v")]


def test_deletes_outlive_late_puts(spark, tmp_path):
    base = str(tmp_path / "store")
    store.create(spark.createDataFrame([(5, "delete_row", "a", None, None, None), (6, "delete_column", "b", "f", "q", None)], SCHEMA), base)
    store.merge(spark.createDataFrame([(1, "put", "a", "f", "q", "old"), (2, "put", "b", "f", "q", "old"), (7, "put", "a", "f", "p", "new")], SCHEMA), base)
    assert _rows(store.state(spark, base)) == [("a", "f", "p", "new")]


def test_empty_logs(spark, tmp_path):
    base = str(tmp_path / "store")
    nothing = spark.createDataFrame([], SCHEMA)
    store.create(nothing, base)
    assert store.merge(nothing, base) == [] and store.state(spark, base).count() == 0
    store.merge(spark.createDataFrame([(1, "put", "a", "f", "q", "v")], SCHEMA), base)
    assert _rows(store.state(spark, base)) == [("a", "f", "q", "v")]


def test_an_unfinished_merge_is_not_seen(spark, tmp_path):
    base = str(tmp_path / "store")
    store.create(spark.createDataFrame([(1, "put", "a", "f", "q", "v")], SCHEMA), base, ranges=1)
    spark.createDataFrame([("a", "f", "q", 9, "put", "half")], store.CELLS).write.parquet(f"{base}/cells/version=9/range=0")
    assert _rows(store.state(spark, base)) == [("a", "f", "q", "v")]


def test_a_second_merge_at_once_fails(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "store")
    store.create(spark.createDataFrame([(1, "put", "a", "f", "q", "v")], SCHEMA), base, ranges=1)
    monkeypatch.setattr(store, "published", lambda s, b: s.createDataFrame([], store._PUBLISHED))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        store.merge(spark.createDataFrame([(2, "put", "a", "f", "q", "w")], SCHEMA), base)


def test_ranges_by_bisection(spark):
    bounds = sorted(f"{i:02d}" for i in range(1, 60, 3))
    keys = spark.createDataFrame([(f"{i:02d}",) for i in range(100)] + [("",), (None,), ("é",)], "k string")
    for r in keys.select("k", store.range_of(F.col("k"), bounds).alias("r")).collect():
        assert r.r == sum(b <= (r.k or "") for b in bounds)
