"""Keyed table replay: the put / update / delete-column / delete-row walk-through."""

from opinio.operators import keyed

LOG = [
    (1, "put", "101", "info", "name", "Rahul"),
    (2, "put", "101", "info", "age", "20"),
    (3, "put", "101", "info", "course", "BCA"),
    (4, "put", "102", "info", "name", "Priya"),
    (5, "put", "102", "info", "age", "21"),
    (6, "put", "102", "info", "course", "MCA"),
    (7, "put", "101", "info", "age", "22"),
    (8, "delete_column", "101", "info", "age", None),
    (9, "delete_row", "102", "info", None, None),
]
SCHEMA = "seq long, op string, row_key string, family string, qualifier string, value string"


def test_replay_matches_walkthrough(spark):
    log = spark.createDataFrame(LOG, SCHEMA)
    state = keyed.apply_log(log)
    assert sorted(map(tuple, keyed.scan(state).collect())) == [
        ("101", "info", "course", "BCA"), ("101", "info", "name", "Rahul")]
    assert sorted(map(tuple, keyed.get_row(state, "102").collect())) == []


def test_update_keeps_other_cells(spark):
    log = spark.createDataFrame(LOG[:7], SCHEMA)
    got = {r.qualifier: r.value for r in keyed.get_row(keyed.apply_log(log), "101").collect()}
    assert got == {"name": "Rahul", "age": "22", "course": "BCA"}


def test_put_after_row_delete_lives(spark):
    log = spark.createDataFrame(LOG + [(10, "put", "102", "info", "name", "Asha")], SCHEMA)
    got = sorted(map(tuple, keyed.get_row(keyed.apply_log(log), "102").collect()))
    assert got == [("info", "name", "Asha")]


def test_latest_cells_ignores_deletes(spark):
    log = spark.createDataFrame(LOG, SCHEMA)
    got = {(r.row_key, r.qualifier): (r.value, r.seq) for r in keyed.latest_cells(log).collect()}
    assert got[("101", "age")] == ("22", 7) and got[("102", "name")] == ("Priya", 4)


def test_row_map_view(spark):
    log = spark.createDataFrame(LOG[:7], SCHEMA)
    got = keyed.get_row_map(keyed.apply_log(log), "101").collect()
    assert len(got) == 1
    assert got[0].cells == {"info:age": "22", "info:course": "BCA", "info:name": "Rahul"}
    assert keyed.get_row_map(keyed.apply_log(log), "nope").count() == 0
