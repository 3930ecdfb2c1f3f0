import json
import random

import pytest
from pyspark.sql import functions as F

from moraine.operators.cdc import normalize
from moraine.plans.pipeline import Paths, ingest_log
from moraine.registry import TableSpec
from moraine.sources.change_log import Log, append_log, capped, read_log
from moraine.sources.connectors import read_change_log
from moraine.sources.versioned import VersionedTable
from moraine.streaming.ingest import ProgressLog, change_log_source, decode_json, stream_table
from moraine.streaming.lag import OffsetLedger, committed, lag, lag_frame
from moraine.streaming.newest import newest_only
from moraine.streaming.versions import decode_versions, frame, load_schemas, save_schema, schema_id, stream_messages, unreadable

WIDGET = TableSpec("widget", "id", "id bigint, name string, amount double")


def messages(spark, events):
    """(op, lsn, id, name, amount) as keyed JSON envelopes."""
    rows = []
    for op, lsn, key, name, amount in events:
        row = {"id": key, "name": name, "amount": amount}
        rows.append((str(key), lsn, json.dumps({"op": op, "before": row if op == "d" else None, "after": None if op == "d" else row, "source": {"lsn": lsn, "ts_ms": 1}})))
    return spark.createDataFrame(rows, "k string, o long, v string")


def append(spark, path, events, partitions=3):
    append_log(messages(spark, events), path, key="k", value="v", order="o", partitions=partitions)


def random_events(n, keys=9, seed=3):
    rng = random.Random(seed)
    return [(rng.choice("cuud"), lsn, rng.randrange(keys), f"n{lsn}", float(lsn)) for lsn in range(n)]


def newest(events):
    top = {}
    for e in sorted(events, key=lambda e: e[1]):
        top[e[2]] = e
    return sorted((e[2], e[3], e[4]) for e in top.values() if e[0] != "d")


def stored(spark, path):
    return sorted(map(tuple, VersionedTable(spark, path).read().select("id", "name", "amount").collect()))


def test_places_have_no_gaps_and_keys_keep_their_order(spark, tmp_path):
    path, events = str(tmp_path / "log"), random_events(200)
    append(spark, path, events[:120])
    append(spark, path, events[120:])
    rows = read_log(spark, path).select("partition", "offset", F.col("key").cast("string").alias("k"), F.get_json_object(F.col("value").cast("string"), "$.source.lsn").cast("int").alias("lsn"), "timestamp").collect()
    assert sorted(r["lsn"] for r in rows) == list(range(200)) and all(r["timestamp"] for r in rows)
    for p in {r["partition"] for r in rows}:
        own = sorted((r["offset"], r["lsn"]) for r in rows if r["partition"] == p)
        assert [o for o, _ in own] == list(range(len(own)))
        for k in {r["k"] for r in rows if r["partition"] == p}:
            mine = [r["lsn"] for r in sorted(rows, key=lambda r: r["offset"]) if r["k"] == k]
            assert mine == sorted(mine)
    assert len({(r["k"], r["partition"]) for r in rows}) == len({r["k"] for r in rows})
    assert not (tmp_path / "log" / "_incoming").exists() or not list((tmp_path / "log" / "_incoming").iterdir())


def test_reads_between_places(spark, tmp_path):
    path = str(tmp_path / "log")
    append(spark, path, random_events(100))
    ends = Log(path).ends()
    p = next(p for p, e in ends.items() if e > 10)
    part = read_log(spark, path, start={**ends, p: 3}, end={**ends, p: 8})
    assert sorted((r["partition"], r["offset"]) for r in part.collect()) == [(int(p), o) for o in range(3, 8)]
    assert read_log(spark, path, start="latest").count() == 0 and read_log(spark, str(tmp_path / "none")).count() == 0
    append_log(spark.createDataFrame([(None, 1, None), ("a", 2, None)], "k string, o long, v string"), path, key="k", value="v", order="o", partitions=3)
    assert read_log(spark, path).filter("value is null").count() == 2
    with pytest.raises(Exception):
        messages(spark, [("c", 1, 1, "a", 1.0)]).selectExpr("0 AS partition", "0L AS offset", "now() AS timestamp", "binary(k) AS key", "binary(v) AS value").write.format("change_log").option("path", path).mode("overwrite").save()


def test_raw_messages_up_to_a_number(spark, tmp_path):
    path = str(tmp_path / "log")
    append(spark, path, random_events(100))
    some = read_change_log(spark, path, 10)
    assert 10 <= some.count() <= 12 and set(some.columns) == {"partition", "offset", "timestamp", "key", "value"}
    assert read_change_log(spark, path).count() == 100 and read_change_log(spark, path, 1000).count() == 100


def test_caps_are_shared_by_what_waits():
    assert capped({"0": 5}, {"0": 5, "1": 100}, 10) == {"0": 5, "1": 10}
    assert capped({}, {"0": 3, "1": 4}, 7) == {"0": 3, "1": 4} and capped({"0": 9}, {"0": 9}, 1) == {"0": 9}
    for most in (1, 2, 5):
        at, head, steps = {}, {"0": 90, "1": 10, "2": 1}, 0
        while at != head:
            at, steps = capped(at, head, most), steps + 1
            assert steps < 200


def run_stream(spark, log, target, checkpoint, **options):
    seen = []
    source = decode_json(change_log_source(spark, log, max_offsets=options.pop("max_offsets", None)), WIDGET.schema)
    stream_table(spark, WIDGET, source, target_path=target, checkpoint_path=checkpoint, available_now=True, guard_lsn=True, on_batch=lambda i, m: seen.append((i, m.input_events)), **options).awaitTermination(180)
    return seen


def test_a_stream_goes_on_where_it_was(spark, tmp_path):
    log, target, checkpoint = (str(tmp_path / x) for x in ("log", "t", "cp"))
    events = random_events(90)
    append(spark, log, events[:50])
    assert sum(n for _, n in run_stream(spark, log, target, checkpoint)) == 50
    assert run_stream(spark, log, target, checkpoint) == []
    append(spark, log, events[50:])
    again = run_stream(spark, log, target, checkpoint)
    assert sum(n for _, n in again) == 40 and again[0][0] == 1  # batch numbers go on too
    assert stored(spark, target) == newest(events)


def test_capped_batches_read_it_all_once(spark, tmp_path):
    log, target, checkpoint = (str(tmp_path / x) for x in ("log", "t", "cp"))
    events = random_events(60)
    append(spark, log, events)
    seen = []
    source = decode_json(change_log_source(spark, log, max_offsets=20), WIDGET.schema)
    query = stream_table(spark, WIDGET, source, target_path=target, checkpoint_path=checkpoint, interval="0 seconds", guard_lsn=True, on_batch=lambda i, m: seen.append(m.input_events))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert sum(seen) == 60 and len(seen) >= 3 and max(seen) <= 22  # a message more for each partition at most
    assert stored(spark, target) == newest(events)
    append(spark, log, [("u", 999, 1, "later", 1.0)])
    assert run_stream(spark, log, target, checkpoint) == [(len(seen), 1)]


def test_stale_events_go_by_state(spark, tmp_path):
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "cp")
    events = random_events(80)
    rng = random.Random(1)
    shuffled = events[:]
    rng.shuffle(shuffled)
    got = []

    def run():
        flat = normalize(decode_json(change_log_source(spark, log), WIDGET.schema), WIDGET.columns)
        kept = newest_only(flat, "id")
        query = kept.writeStream.foreachBatch(lambda df, i: got.append([tuple(r) for r in df.collect()])).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination(180)
        assert query.exception() is None

    before = spark.conf.get("spark.sql.shuffle.partitions")
    for cut in (shuffled[:30], shuffled[30:55], shuffled[55:]):
        append_log(messages(spark, cut).withColumn("i", F.monotonically_increasing_id()), log, key="k", value="v", order="i", partitions=2)
        run()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    top, expected = {}, []
    for cut in (shuffled[:30], shuffled[30:55], shuffled[55:]):
        best = {}
        for op, lsn, key, name, amount in cut:
            if lsn > max(top.get(key, -1), best.get(key, (-1,))[0]):
                best[key] = (lsn, (key, name, amount, op, lsn, 1))
        top |= {k: b[0] for k, b in best.items()}
        expected.append(sorted(b[1] for b in best.values()))
    assert [sorted(g) for g in got if g] == expected


@pytest.mark.parametrize("cuts", [(80,), (13, 40, 41, 80)])
def test_any_cut_gives_the_guarded_merge(spark, tmp_path, cuts):
    events = random_events(80, seed=7)
    rng = random.Random(2)
    shuffled = events[:]
    rng.shuffle(shuffled)
    log, target, checkpoint = (str(tmp_path / x) for x in ("log", "t", "cp"))
    a = 0
    for b in cuts:
        append_log(messages(spark, shuffled[a:b]).withColumn("i", F.monotonically_increasing_id()), log, key="k", value="v", order="i", partitions=2)
        flat = normalize(decode_json(change_log_source(spark, log), WIDGET.schema), WIDGET.columns)
        stream_table(spark, WIDGET, newest_only(flat, "id"), target_path=target, checkpoint_path=checkpoint, available_now=True).awaitTermination(180)
        a = b
    assert stored(spark, target) == newest(events)  # without the merge's own guard


def test_lag_comes_from_offsets(spark, tmp_path):
    log, ledger_path = str(tmp_path / "log"), str(tmp_path / "ledger")
    append(spark, log, random_events(40))
    assert sum(lag(log, {}).values()) == 40 and committed(spark, ledger_path, "cdc_widget") == {}
    ledger, progress = OffsetLedger(), ProgressLog()
    spark.streams.addListener(ledger)
    spark.streams.addListener(progress)
    try:
        run_stream(spark, log, str(tmp_path / "t"), str(tmp_path / "cp"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        for _ in range(100):
            if ledger.heard:
                break
            import time

            time.sleep(0.1)
    finally:
        spark.streams.removeListener(ledger)
        spark.streams.removeListener(progress)
    ledger.store(spark, ledger_path)
    assert committed(spark, ledger_path, "cdc_widget") == Log(log).ends() and ledger.heard == {}
    assert progress.frame(spark).filter("name = 'cdc_widget' and rows >= 40").count() == 1  # a batch may be read more than once
    append(spark, log, random_events(25, seed=4))
    assert sum(lag(log, committed(spark, ledger_path, "cdc_widget")).values()) == 25
    assert lag_frame(spark, log, ledger_path, "cdc_widget").agg(F.sum("lag")).first()[0] == 25
    ledger.note("files", 0, '{"logOffset": 3}')
    ledger.note("broken", 0, "none")
    ledger.note("nothing", 0, None)
    assert ledger.heard == {}


def test_ingest_decides_before_it_reads(spark, tmp_path, monkeypatch):
    from moraine.plans import pipeline

    monkeypatch.setitem(pipeline.TABLES, "widget", WIDGET)
    monkeypatch.setattr(pipeline, "LAG_LIMIT", 30)
    log, paths, events = str(tmp_path / "log"), Paths(str(tmp_path / "m")), random_events(75)
    append(spark, log, events[:45])
    run = dict(ingest_log(spark, paths, {"widget": log}).steps)
    assert run["widget: lag"] == {"messages": 45, "mode": "bulk"} and sum(m.input_events for m in run["widget: merge"]) == 45
    append(spark, log, events[45:])
    run = dict(ingest_log(spark, paths, {"widget": log}).steps)
    assert run["widget: lag"] == {"messages": 30, "mode": "normal"} and sum(m.input_events for m in run["widget: merge"]) == 30
    assert dict(ingest_log(spark, paths, {"widget": log}).steps)["widget: lag"]["messages"] == 0
    assert stored(spark, paths.of("bronze", "widget")) == newest(events)


def test_each_message_has_its_own_schema(spark, tmp_path):
    row = WIDGET.schema
    bodies = [
        (1, '{"op":"c","after":{"id":1,"name":"old"},"source":{"lsn":1}}'),
        (2, '{"op":"c","after":{"id":2,"name":"new","amount":2.5},"source":{"lsn":2,"ts_ms":5}}'),
        (3, '{"op":"u","after":{"id":3,"name":"text","amount":"7.5"},"source":{"lsn":3}}'),
        (3, '{"op":"u","after":{"id":4,"name":"text","amount":"many"},"source":{"lsn":4}}'),
        (9, '{"op":"c","after":{"id":5}}'),
        (2, "broken"),
    ]
    df = spark.createDataFrame([(i, n, b) for i, (n, b) in enumerate(bodies)], "i int, n int, b string")
    framed = F.coalesce(*[F.when(F.col("n") == n, frame(n, F.col("b"))) for n in (1, 2, 3, 9)])
    raw = df.select("i", framed.alias("value")).union(spark.createDataFrame([(90, None), (91, bytearray(b"xx"))], "i int, value binary"))
    assert {r["i"]: r["s"] for r in raw.select("i", schema_id(F.col("value")).alias("s")).collect()} == {0: 1, 1: 2, 2: 3, 3: 3, 4: 9, 5: 2, 90: None, 91: None}
    path = str(tmp_path / "schemas")
    for n, ddl in ((1, "id bigint, name string"), (2, "id bigint, name string, amount double"), (3, "amount string, name string, id int")):
        from pyspark.sql.types import StructType

        save_schema(spark, path, WIDGET.value_subject(), n, StructType.fromDDL(ddl))
    with pytest.raises(ValueError):
        save_schema(spark, path, WIDGET.value_subject(), 3, row)
    schemas = load_schemas(VersionedTable(spark, path).read(), WIDGET.value_subject())
    assert sorted(schemas) == [1, 2, 3] and load_schemas(VersionedTable(spark, path).read(), "other") == {}
    got = sorted(tuple(r) for r in normalize(decode_versions(raw, schemas, row), WIDGET.columns).collect())
    assert got == [(1, "old", None, "c", 1, 0), (2, "new", 2.5, "c", 2, 5), (3, "text", 7.5, "u", 3, 0), (4, "text", None, "u", 4, 0)]
    assert sorted((r["i"], r["schema_id"]) for r in unreadable(raw, schemas, row).collect()) == [(4, 9), (5, 2), (91, None)]
    assert decode_versions(raw, {}, row).count() == 0


def test_one_call_from_messages_to_the_table(spark, tmp_path):
    from pyspark.sql.types import StructType

    log, target, checkpoint = (str(tmp_path / x) for x in ("log", "t", "cp"))
    schemas = {1: StructType.fromDDL("id bigint, name string"), 2: WIDGET.schema}
    events = random_events(60, seed=11)
    rng = random.Random(5)
    rng.shuffle(events)
    for cut in (events[:35], events[35:]):
        framed = messages(spark, cut).withColumn("i", F.monotonically_increasing_id()).withColumn("v", F.when(F.col("o") % 2 == 0, frame(1, F.col("v"))).otherwise(frame(2, F.col("v"))))
        append_log(framed, log, key="k", value="v", order="i", partitions=2)
        stream_messages(spark, WIDGET, change_log_source(spark, log), schemas=schemas, drop_stale=True, target_path=target, checkpoint_path=checkpoint, available_now=True).awaitTermination(180)
    expected = [(k, name, None if amount % 2 == 0 else amount) for k, name, amount in newest(events)]
    assert stored(spark, target) == sorted(expected)


def test_state_goes_after_its_time(spark, tmp_path):
    import time

    log, checkpoint, got = str(tmp_path / "log"), str(tmp_path / "cp"), []

    def run():
        flat = normalize(decode_json(change_log_source(spark, log), WIDGET.schema), WIDGET.columns)
        query = newest_only(flat, "id", ttl_ms=2000).writeStream.foreachBatch(lambda df, i: got.extend(r["lsn"] for r in df.collect())).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination(180)

    append(spark, log, [("c", 10, 1, "a", 1.0)])
    run()
    time.sleep(2.5)
    append(spark, log, [("u", 5, 1, "late", 1.0), ("u", 4, 1, "later", 1.0)])
    run()
    assert got == [10, 5]
