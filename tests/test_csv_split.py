"""Multi-line CSV files read from byte ranges give the rows that were written."""

import csv
import random

import pytest

from opinio.sources import csv_split, files

SCHEMA = "id int, text string, note string"


def _write(path, rows, newline="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=newline)
        w.writerow(["id", "text", "note"])
        w.writerows(rows)


def _read(spark, path):
    return sorted(map(repr, map(tuple, csv_split.read_csv_split(spark, str(path), SCHEMA).collect())))


def _want(rows):
    return sorted(repr((i, t or None, n or None)) for i, t, n in rows)


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in names}
    spark.conf.set(names[0], "700")
    spark.conf.set(names[1], "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_records_across_ranges(spark, tmp_path, small_ranges):
    rnd = random.Random(5)
    bits = ["a", "é", ",", '"', '""', "\n", "\r\n", " ", "word", "\n\n", '",\n"']
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.choice([1, 5, 30]))), rnd.choice(["", "x", "y\nz"])) for i in range(400)]
    # a record over many ranges, one of line breaks alone, and copies
    rows[50] = (50, "line\n" * 2000, 'q"' * 400)
    rows[51] = (51, "\n" * 3000, "")
    rows[120:125] = [rows[120]] * 5
    _write(tmp_path / "a.csv", rows)
    _write(tmp_path / "b.csv", rows[:30], newline="\r\n")
    _write(tmp_path / "c.csv", [])
    assert _read(spark, tmp_path) == _want(rows + rows[:30])
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path / "a.csv"))
    assert lines.rdd.getNumPartitions() > 20


def test_equals_the_reader_of_whole_files(spark, tmp_path, small_ranges):
    rows = [(i, "a\n" * (i % 7) + 'b "c", d', "" if i % 3 else " e ") for i in range(200)]
    _write(tmp_path / "a.csv", rows)
    whole = files.read_csv_multiline(spark, str(tmp_path), SCHEMA).collect()
    assert _read(spark, tmp_path) == sorted(map(repr, map(tuple, whole))) == _want(rows)


def test_unpaired_quote_is_an_error(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('id,text,note\n1,"open,x\n2,b,c\n')
    with pytest.raises(ValueError, match="not closed"):
        csv_split.read_csv_split(spark, str(tmp_path), SCHEMA)


def test_no_rows(spark, tmp_path):
    _write(tmp_path / "a.csv", [])
    assert _read(spark, tmp_path) == []
