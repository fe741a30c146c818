import pytest
from llm_helpers import DOCS, clashing, rows
from pyspark.sql import functions as F

from opinio.llm import mixing


def count(text):
    return len((text or "").encode().split())


def shares(sizes, weights=(1, 2, 3), epochs=3):
    """Targets by the letter: share by weight, stop at the most, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, rest = {}, set(order), float(sum(sizes.values()))
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * unit > epochs * sizes[s]}
        if not full:
            return target | {s: weight[s] * unit for s in open_}
        target |= {s: epochs * sizes[s] for s in full}
        rest -= sum(epochs * sizes[s] for s in full)
        open_ -= full
    return target


def check(docs, got):
    sizes, largest = {}, {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + count(r.text)
        largest[r.source] = max(largest.get(r.source, 0), count(r.text))
    want = shares(sizes)
    total, taken = sum(sizes.values()), {}
    assert len(got) == docs.count()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
    assert sum(taken.values()) <= total
    assert total - sum(taken.values()) <= max(largest.values(), default=0)
    slack = 2 * max(largest.values(), default=0)
    assert all(abs(taken[s] - want[s]) <= largest[s] + slack * want[s] / max(1, total) for s in sizes)


def test_odd_documents(spark, odd_docs, no_docs):
    for docs in (odd_docs, clashing(odd_docs)):
        got = mixing.mix(docs).collect()
        check(docs, got)
        assert sorted((r.id, r.size) for r in got if r.id) == sorted((r.doc_id, count(r.text)) for r in docs.collect() if r.doc_id)
    assert mixing.mix(no_docs).count() == 0
    assert mixing.apply(no_docs).count() == 0


def test_hot_source_and_equal_rows(spark):
    data = [(i, "w " * (i % 7 + 1), None, "hot" if i % 3 == 0 else f"s{i % 10}", None) for i in range(600)]
    data += [(7, "same text here", None, "copies", None)] * 300
    docs = spark.createDataFrame(data, DOCS)
    check(docs, mixing.mix(docs).collect())


def test_reruns_and_layouts_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    cols = ["id", "source", "size", "copies"]
    once = rows(mixing.mix(docs), *cols)
    assert once == rows(mixing.mix(docs), *cols) == rows(mixing.mix(docs.repartition(5)), *cols)
    assert once != rows(mixing.mix(docs, seed=1), *cols)


def test_targets_share_the_excess(spark):
    sizes = {"a": 1, "b": 1, "c": 1000, "d": 10, None: 300}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(shares(sizes)) and sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_apply_repeats_rows(spark, odd_docs):
    docs = clashing(odd_docs)
    mixed = mixing.apply(docs)
    assert mixed.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in mixed.collect())
    want = [(r.id is None, r.id or 0, r.size) for r in mixing.mix(docs).collect() for _ in range(r.copies)]
    assert [(a, b, count(t)) for a, b, t in got] == sorted(want)


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = mixing.op4(spark, sf)
    joined = got.join(docs.select("doc_id", "source", "text"), "doc_id").withColumn("copies", (F.col("taken") / F.greatest(F.lit(1), "size")).cast("int"))
    rows_ = joined.collect()
    check(docs, rows_)
    assert all(r.size == count(r.text) and r.taken == r.size * r.copies for r in rows_)


def test_copies_of_one_row_are_dealt_over_tasks(spark):
    """A row that is a third of all: no task makes many of its copies, and the rows are the same as ever."""
    docs = spark.createDataFrame([(7, "Same words", "en", "a", 4)] * 30_000 + [(i, f"T{i} x", "en", "b", 2) for i in range(60_000)], DOCS)
    mixed = mixing.mix(docs)
    assert mixed.count() == 90_000
    made = mixing.numbered(spark.createDataFrame([(1, 2, 100_000), (2, 3, 1), (3, 4, 4097)], "tag long, id long, n long"), "n", "copy", "chunk", ["tag", "id"])
    assert made.columns == ["tag", "id", "n", "copy"]
    got = made.groupBy("tag").agg(F.count("*"), F.min("copy"), F.max("copy"), F.count_distinct("copy")).orderBy("tag").collect()
    assert [tuple(r) for r in got] == [(1, 100_000, 1, 100_000, 100_000), (2, 1, 1, 1, 1), (3, 4097, 1, 4097, 4097)]
    per_task = [r["n"] for r in made.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(per_task) < 60_000 and len(per_task) > 3
    taken = {r.id: r.n for r in mixed.groupBy("id").agg(F.sum("copies").alias("n")).collect()}
    out = mixing.apply(docs).groupBy("doc_id").agg(F.count("*").alias("n"))
    assert {r.doc_id: r.n for r in out.collect()} == {k: n for k, n in taken.items() if n}
