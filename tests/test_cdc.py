import random

import pytest
from pyspark.sql import functions as F

from moraine.operators.cdc import SchemaMismatchError, apply_cdc_events, latest, merged, normalize, survivors, upsert
from moraine.registry import TableSpec
from moraine.sources.versioned import VersionedTable

WIDGET = TableSpec("widget", "id", "id bigint, name string, amount double")
DDL = "op string, lsn bigint, id bigint, name string, amount double"


def rows(spark, path):
    return sorted(tuple(r) for r in VersionedTable(spark, path).read().select("id", "name", "amount").collect())


def apply(spark, path, events, **options):
    return apply_cdc_events(spark, spark.createDataFrame(events, DDL), path, WIDGET, **options)


def test_newest_event_of_a_key_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    m = apply(spark, path, [("u", 9, 1, "new", 2.0), ("c", 3, 1, "old", 1.0)])
    assert rows(spark, path) == [(1, "new", 2.0)]
    assert (m.input_events, m.inserted, m.updated, m.deleted, m.skipped) == (2, 1, 0, 0, 1)


def test_delete_of_an_absent_key_does_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    m = apply(spark, path, [("d", 1, 5, None, None)])
    assert rows(spark, path) == [] and (m.deleted, m.skipped) == (0, 1)


def test_lifecycle_over_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    apply(spark, path, [("c", 1, 1, "a", 1.0), ("r", 2, 2, "b", 2.0)])
    m = apply(spark, path, [("u", 3, 1, None, None), ("c", 4, 3, "c", 3.0)])
    assert rows(spark, path) == sorted([(1, None, None), (2, "b", 2.0), (3, "c", 3.0)])  # an update to null is an update
    assert (m.inserted, m.updated) == (1, 1)
    m = apply(spark, path, [("d", 5, 2, "b", 2.0)])
    assert m.deleted == 1 and [r[0] for r in rows(spark, path)] == [1, 3]


def test_create_and_delete_in_one_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    apply(spark, path, [("c", 1, 1, "a", 1.0), ("d", 2, 1, "a", 1.0)])
    assert rows(spark, path) == []


def test_same_batch_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    events = [("c", 1, 1, "a", 1.0), ("u", 2, 1, "b", 1.0), ("c", 3, 2, "c", None)]
    apply(spark, path, events)
    before = rows(spark, path)
    apply(spark, path, events)
    assert rows(spark, path) == before


def test_streams_count_their_own_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    apply(spark, path, [("c", 1, 1, "a", 1.0)], batch_id=0, stream="one")
    assert apply(spark, path, [("c", 2, 2, "b", 1.0)], batch_id=0, stream="two").inserted == 1  # a fresh checkpoint starts at 0 again
    assert apply(spark, path, [("u", 3, 2, "c", 1.0)]).updated == 1
    apply(spark, path, [("d", 4, 1, "a", 1.0)], batch_id=0, stream="one")  # a replay behind other commits
    assert sorted(r["id"] for r in VersionedTable(spark, path).read().collect()) == [1, 2]


def test_replayed_batch_id_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    first = apply(spark, path, [("c", 1, 1, "a", 1.0)], batch_id=4)
    assert apply(spark, path, [("c", 1, 1, "a", 1.0)], batch_id=4) == first
    assert len(VersionedTable(spark, path).history()) == 1


def test_empty_batch_makes_no_table(spark, tmp_path):
    path = str(tmp_path / "t")
    m = apply(spark, path, [])
    assert m.input_events == 0 and not VersionedTable(spark, path).exists()


def test_null_keys_are_dropped(spark, tmp_path):
    path = str(tmp_path / "t")
    apply(spark, path, [("c", 1, None, "a", 1.0), ("c", 2, 1, "b", 1.0)])
    assert rows(spark, path) == [(1, "b", 1.0)]


def test_schema_guard_and_evolution(spark, tmp_path):
    path = str(tmp_path / "t")
    apply(spark, path, [("c", 1, 1, "a", 1.0)])
    wider = spark.createDataFrame([("c", 2, 2, "b", 2.0, "red")], DDL + ", colour string")
    with pytest.raises(SchemaMismatchError) as e:
        apply_cdc_events(spark, wider, path, WIDGET)
    assert e.value.added == {"colour"} and e.value.dropped == set()
    apply_cdc_events(spark, wider, path, WIDGET, allow_schema_evolution=True)
    assert {tuple(r) for r in VersionedTable(spark, path).read().select("id", "colour").collect()} == {(1, None), (2, "red")}
    with pytest.raises(SchemaMismatchError):
        apply_cdc_events(spark, wider.drop("name"), path, WIDGET, allow_schema_evolution=True)


def test_envelope_takes_the_right_image(spark):
    row = "struct<id:bigint,name:string,amount:double>"
    events = spark.createDataFrame([("d", 1, 7, (1, "was", 1.0), None), ("u", 2, None, (1, "was", 1.0), (1, "is", 2.0)), (None, 3, 1, None, None)], f"op string, lsn bigint, ts_ms bigint, before {row}, after {row}")
    got = {(r["op"], r["name"], r["ts_ms"]) for r in normalize(events, WIDGET.columns).collect()}
    assert got == {("d", "was", 7), ("u", "is", 0)}


def test_guarded_merge_doesn_t_depend_on_how_events_are_cut(spark, tmp_path):
    rng = random.Random(3)
    events = [(rng.choice("cud"), lsn, rng.randrange(8), f"n{lsn}", float(lsn)) for lsn in range(60)]
    rng.shuffle(events)
    newest = {}
    for e in events:
        if e[2] not in newest or e[1] > newest[e[2]][1]:
            newest[e[2]] = e
    expected = sorted((e[2], e[3], e[4]) for e in newest.values() if e[0] != "d")
    path = str(tmp_path / "t")
    for k in range(0, 60, 23):
        apply(spark, path, events[k : k + 23], guard_lsn=True)
    assert rows(spark, path) == expected


def test_merge_reads_and_writes_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    apply(spark, path, [("c", i, i, "a", 1.0) for i in range(50)], buckets=8)
    apply(spark, path, [("u", 99, 7, "b", 1.0)])
    last = VersionedTable(spark, path).commit()
    assert sorted(last.buckets.values()).count(1) == 1 and len(rows(spark, path)) == 50
    assert VersionedTable(spark, path).read(0).filter("name = 'b'").count() == 0  # older versions stay readable


def test_ties_are_broken_the_same_way_in_any_order(spark):
    rows_ = [("u", 1, 1, "a", 1.0), ("u", 1, 1, "b", 2.0)]
    pick = [latest(normalize(spark.createDataFrame(r, DDL), WIDGET.columns), "id").first()["name"] for r in (rows_, rows_[::-1])]
    assert pick[0] == pick[1]


def test_merge_of_empty_sides(spark):
    t = spark.createDataFrame([], "id long, name string, amount double")
    s = normalize(spark.createDataFrame([], DDL), WIDGET.columns)
    assert survivors(merged(t, s, "id")).count() == 0


def test_upsert_by_composite_key(spark, tmp_path):
    path = str(tmp_path / "u")
    upsert(spark, spark.createDataFrame([("a", "x", 1), ("a", None, 2)], "t string, c string, v int"), path, ["t", "c"])
    upsert(spark, spark.createDataFrame([("a", None, 3), ("b", "x", 4)], "t string, c string, v int"), path, ["t", "c"])
    assert sorted((r["t"], str(r["c"]), r["v"]) for r in VersionedTable(spark, path).read().collect()) == [("a", "None", 3), ("a", "x", 1), ("b", "x", 4)]


def test_upsert_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.range(100).selectExpr("id AS k", "id AS v")
    upsert(spark, rows, path, ["k"])
    upsert(spark, spark.sql("SELECT 7 AS k, 70L AS v UNION ALL SELECT null, 1"), path, ["k"])  # an int finds the stored bigint's bucket
    upsert(spark, spark.sql("SELECT CAST(null AS BIGINT) AS k, 2L AS v"), path, ["k"])
    upsert(spark, rows.limit(0), path, ["k"])
    store = VersionedTable(spark, path)
    assert len(store.history()) == 3 and 0 in store.commit().buckets.values()
    got = {r["k"]: r["v"] for r in store.read().collect()}
    assert store.read().count() == 101 and got[7] == 70 and got[None] == 2 and got[8] == 8
    with pytest.raises(SchemaMismatchError):
        upsert(spark, rows.withColumn("w", F.lit(1)), path, ["k"])
    with pytest.raises(ValueError):
        upsert(spark, rows, path, ["v"])


def test_two_rows_of_one_key_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k long, v string")
    with pytest.raises(ValueError):
        upsert(spark, twice, path, ["k"])
    assert not VersionedTable(spark, path).exists()
    upsert(spark, twice.filter("v <> 'b'"), path, ["k"])
    for odd in (twice, spark.createDataFrame([(None, "x"), (None, "y")], "k long, v string")):
        with pytest.raises(ValueError):
            upsert(spark, odd, path, ["k"])
    assert len(VersionedTable(spark, path).history()) == 1


def test_a_record_that_was_lost_halfway_disturbs_nobody(spark, tmp_path):
    path, rows_ = str(tmp_path / "t"), spark.range(5).selectExpr("id AS k", "id AS v")
    store = VersionedTable(spark, path)
    upsert(spark, rows_, path, ["k"])
    (tmp_path / "t" / "_commits" / "000000001.json").touch()  # an empty record, as a writer of old could leave it
    (tmp_path / "t" / "_commits" / "_000000001-aside").write_text("{")  # and one that was never renamed
    assert store.read().count() == 5 and store.commit().version == 0
    upsert(spark, spark.sql("SELECT 2L AS k, 20L AS v"), path, ["k"])
    assert {r["k"]: r["v"] for r in store.read().collect()}[2] == 20 and [c.version for c in store.history()] == [0, 1]


def test_a_version_is_written_once(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, spark.range(3).selectExpr("id AS k", "id AS v"), path, ["k"])
    store = VersionedTable(spark, path)
    with pytest.raises(FileExistsError):
        store._record(store.commit())
    assert [f for f in (tmp_path / "t" / "_commits").iterdir() if f.name.startswith("_0")] == []


def test_a_grown_table_gets_more_buckets(spark, tmp_path, monkeypatch):
    from moraine.operators import cdc

    path = str(tmp_path / "t")
    apply(spark, path, [("c", i, i, "a", 1.0) for i in range(60)], buckets=2, guard_lsn=True)
    apply(spark, path, [("d", 100, 7, "a", 1.0)], guard_lsn=True, batch_id=3, stream="s")
    assert VersionedTable(spark, path).commit().bucket_count == 2
    largest = max(cdc.bucket_bytes(spark, path).values())
    monkeypatch.setattr(cdc, "BUCKET_BYTES", largest // 2)
    apply(spark, path, [("u", 101, 8, "b", 1.0)], guard_lsn=True)
    last = VersionedTable(spark, path).commit()
    assert last.bucket_count in (4, 8) and last.operation == "split" and last.applied["s"]["batch"] == 3
    monkeypatch.setattr(cdc, "BUCKET_BYTES", 1 << 30)
    apply(spark, path, [("u", 50, 7, "late", 1.0), ("u", 102, 9, "c", 1.0)], guard_lsn=True)  # the tombstone is still there
    got = rows(spark, path)
    assert len(got) == 59 and (8, "b", 1.0) in got and (9, "c", 1.0) in got
