"""Published versions: a write that fails anywhere leaves the previous content current."""

import pytest

from listingmart.sources.store import TableStore


def _store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "wh"))


def test_failed_write_keeps_the_previous_version(spark, tmp_path):
    store = _store(spark, tmp_path)
    one, two = spark.range(3), spark.range(5)
    store.replace("t", one)
    two.write.parquet(store.path("t") + "/v=2-x")  # data written, not published
    again = _store(spark, tmp_path)
    assert again.current_version("t") == 1 and again.read("t", one.schema).count() == 3
    again.replace("t", two)
    assert _store(spark, tmp_path).read("t", one.schema).count() == 5


@pytest.mark.parametrize("folder", ["v=1-abc", "v=2-abc"])
def test_lost_publications_are_an_error(spark, tmp_path, folder):
    store = _store(spark, tmp_path)
    spark.range(3).write.parquet(f"{store.path('t')}/{folder}")
    with pytest.raises(FileNotFoundError):
        store.read("t", spark.range(1).schema)


def test_two_writers_cannot_publish_one_version(spark, tmp_path):
    a, b = _store(spark, tmp_path), _store(spark, tmp_path)
    a.replace("t", spark.range(2))
    assert b.current_version("t") == 1
    a.replace("t", spark.range(7))
    with pytest.raises(FileExistsError):
        b.replace("t", spark.range(4))
    assert _store(spark, tmp_path).read("t", spark.range(1).schema).count() == 7
    assert len([n for n in a.names(a.path("t")) if n.startswith("v=")]) == 2  # the loser's folder is gone
    b.replace("t", spark.range(9))  # it sees the winner now
    assert b.current_version("t") == 3 and _store(spark, tmp_path).read("t", spark.range(1).schema).count() == 9


def test_a_run_that_died_while_publishing(spark, tmp_path):
    store = _store(spark, tmp_path)
    store.replace("t", spark.range(3))
    store.write_note(store.path("t") + "/_published/2", "")  # taken, names no folder
    again = _store(spark, tmp_path)
    assert again.current_version("t") == 1 and again.read("t", spark.range(1).schema).count() == 3
    again.replace("t", spark.range(5))
    assert again.current_version("t") == 3 and _store(spark, tmp_path).read("t", spark.range(1).schema).count() == 5


def test_landing_a_batch_again_replaces_it(spark, tmp_path):
    store = _store(spark, tmp_path)
    for batch, n in (("d1", 3), ("d2", 4), ("d1", 5)):
        store.land("raw", spark.range(n), batch)
    assert spark.read.parquet(store.path("raw") + "/data").count() == 9


def test_vacuum_keeps_the_last_versions(spark, tmp_path):
    store = _store(spark, tmp_path)
    for n in (1, 2, 3, 4):
        store.replace("t", spark.range(n))
    spark.range(1).write.parquet(store.path("t") + "/v=1-nobody")  # a failed attempt of long ago
    assert store.vacuum_all(keep=2) == {"t": [1, 2]}
    assert sorted(n[:3] for n in store.names(store.path("t")) if n.startswith("v=")) == ["v=3", "v=4"]
    assert _store(spark, tmp_path).read("t", spark.range(1).schema).count() == 4


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_an_upsert_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    store, schema = TableStore(spark, str(tmp_path / "wh"), buckets=8), "k long, title string, n int"
    first = spark.createDataFrame([(i, f"t{i}", i) for i in range(200)] + [(None, "null", 1)], schema)
    assert store.upsert_buckets("f", first.schema, ["k"], [(first, ["n"])]) == list(range(8))
    before = store._current("f")[1].split("\n")
    batch = spark.createDataFrame([(3, "new", 1000), (None, "again", 2)], schema)
    late = spark.createDataFrame([(3, "newer", 2000)], schema)
    touched = store.upsert_buckets("f", first.schema, ["k"], [(batch, ["n"]), (late, ["n"])])
    after = store._current("f")[1].split("\n")
    assert 1 <= len(touched) <= 2 and sum(a != b for a, b in zip(before, after, strict=True)) == len(touched)
    want = [(i, f"t{i}", 2000 if i == 3 else i) for i in range(200)] + [(None, "null", 1), (None, "again", 2)]
    fresh = TableStore(spark, str(tmp_path / "wh"))
    assert _rows(fresh.read("f", first.schema)) == sorted(want, key=str)
    assert [r.n for r in fresh.read_keys("f", first.schema, ["k"], [(3,), (999,)]).collect()] == [2000]
    assert store.upsert_buckets("f", first.schema, ["k"], [(batch.limit(0), ["n"])]) == []
    fresh.rebucket("f", first.schema, ["k"], 3)
    assert _rows(fresh.read("f", first.schema)) == sorted(want, key=str) and len(fresh._current("f")[1].split("\n")) == 4
    assert fresh.vacuum("f", keep=1) == [1, 2] and _rows(fresh.read("f", first.schema)) == sorted(want, key=str)


def test_vacuum_keeps_folders_that_later_versions_share(spark, tmp_path):
    store, schema = TableStore(spark, str(tmp_path / "wh"), buckets=4), "k long, n int"
    first = spark.createDataFrame([(i, i) for i in range(50)], schema)
    store.upsert_buckets("f", first.schema, ["k"], [(first, ["n"])])
    for i in range(3):
        store.upsert_buckets("f", first.schema, ["k"], [(spark.createDataFrame([(i, -1)], schema), ["n"])])
    store.vacuum("f", keep=1)
    assert sorted(r.n for r in TableStore(spark, str(tmp_path / "wh")).read("f", first.schema).collect())[:3] == [-1, -1, -1]
    assert store.read("f", first.schema).count() == 50


def test_a_table_without_buckets_gets_them(spark, tmp_path):
    store, schema = TableStore(spark, str(tmp_path / "wh"), buckets=4), "k long, n int"
    store.replace("f", spark.createDataFrame([(1, 1), (2, 2)], schema))
    store.upsert_buckets("f", store.read("f", spark.createDataFrame([], schema).schema).schema, ["k"],
                         [(spark.createDataFrame([(2, 5), (9, 9)], schema), ["n"])])
    assert _rows(store.read("f", spark.createDataFrame([], schema).schema)) == [(1, 1), (2, 5), (9, 9)]


def test_upsert_in_place_equals_upsert_without_a_shuffle_of_the_target(spark, tmp_path):
    from listingmart.operators.merge import upsert, upsert_in_place
    schema = "k long, title string, n int"
    t = spark.createDataFrame([(i, f"t{i}", i) for i in range(40)] + [(None, "x", 0)], schema)
    s = spark.createDataFrame([(i, f"s{i}", -i) for i in range(30, 60)] + [(None, "y", 0)], schema)
    t.write.parquet(str(tmp_path / "t"))
    t = spark.read.schema(t.schema).parquet(str(tmp_path / "t"))
    assert _rows(upsert_in_place(t, s, ["k"], ["n"])) == _rows(upsert(t, s, ["k"], ["n"])) == _rows(
        upsert_in_place(t, s, ["k"], ["n"], max_broadcast_keys=1))
    plan = upsert_in_place(t, s, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


LOCATED = "k string, title string, day date"


def _located(spark, store, rows):
    import datetime as dt
    df = spark.createDataFrame([(k, t, dt.date(2025, 6, d)) for k, t, d in rows], LOCATED)
    return df.schema, lambda: store.upsert_located("s", df.schema, ["k"], "day", df, ["title", "day"])


def _days(store, schema):
    return sorted((r.k, r.title, r.day.day) for r in store.read("s", schema).collect())


def test_a_moved_key_leaves_its_old_date(spark, tmp_path):
    import datetime as dt
    store = TableStore(spark, str(tmp_path / "wh"), buckets=4)
    schema, first = _located(spark, store, [(f"j{i}", "a", 1 + i % 3) for i in range(9)])
    assert first() == ["2025-06-01", "2025-06-02", "2025-06-03"]
    parts = store._current("s")[1]
    _, move = _located(spark, store, [("j0", "b", 4), ("new", "b", 4)])
    assert move() == ["2025-06-01", "2025-06-04"]
    kept = [x for x in parts.split("\n") if x.startswith(("part 2025-06-02", "part 2025-06-03"))]
    assert len(kept) == 2 and set(kept) < set(store._current("s")[1].split("\n"))  # other dates' folders stay
    want = sorted([("j0", "b", 4), ("new", "b", 4)] + [(f"j{i}", "a", 1 + i % 3) for i in range(1, 9)])
    assert _days(TableStore(spark, str(tmp_path / "wh")), schema) == want
    assert [r.k for r in store.read_partition("s", schema, "day", dt.date(2025, 6, 9)).collect()] == []
    _, move = _located(spark, store, [("j3", "c", 4), ("j6", "c", 4)])
    assert move() == ["2025-06-04"] and store.read_partition("s", schema, "day", dt.date(2025, 6, 1)).count() == 0
    assert store.vacuum("s", keep=1) == [1, 2] and len(_days(store, schema)) == 10
    _, again = _located(spark, store, [("j0", "d", 2)])  # found through a locator bucket of an earlier version
    again()
    assert [x for x in _days(store, schema) if x[0] == "j0"] == [("j0", "d", 2)]


def test_a_crash_before_publication_changes_nothing(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "wh"), buckets=4)
    schema, first = _located(spark, store, [("j0", "a", 1), ("j1", "a", 1)])
    first()
    _, move = _located(spark, store, [("j0", "b", 2)])
    publish = TableStore._publish
    monkeypatch.setattr(TableStore, "_publish", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        move()
    monkeypatch.setattr(TableStore, "_publish", publish)
    assert _days(TableStore(spark, str(tmp_path / "wh")), schema) == [("j0", "a", 1), ("j1", "a", 1)]
    move()
    move()  # the retry, and one more
    assert _days(store, schema) == [("j0", "b", 2), ("j1", "a", 1)]


def test_a_table_of_dates_is_taken_over(spark, tmp_path):
    import datetime as dt
    store = TableStore(spark, str(tmp_path / "wh"), buckets=4)
    old = spark.createDataFrame([("j0", "a", dt.date(2025, 6, 1)), ("j1", "a", dt.date(2025, 6, 1))], LOCATED)
    store.overwrite_partitions("s", old, "day")
    schema, move = _located(spark, store, [("j0", "b", 2)])
    move()
    assert _days(store, schema) == [("j0", "b", 2), ("j1", "a", 1)]
