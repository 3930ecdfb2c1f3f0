import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from moraine.operators import gold, profile, serving
from moraine.plans import queries as Q
from moraine.plans import stateful  # noqa: F401  registers its queries
from moraine.plans.pipeline import GateFailed, Paths, backfill, build_gold, ingest, promote, reconcile_all
from moraine.registry import TABLES, TableSpec
from moraine.sources.connectors import load_table
from moraine.sources.entities import entity
from moraine.sources.versioned import VersionedTable
from moraine.streaming.ingest import decode_json, file_source, stream_table, strip_frame

SF = "/root/testdata/sf0.001"
WIDGET = TableSpec("widget", "id", "id bigint, name string, amount double")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(rows):
    from decimal import Decimal

    return sorted(repr([round(float(v), 6) if isinstance(v, (float, Decimal)) else v for v in r]) for r in rows)


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = Q.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rel = duck.execute(f"SELECT {', '.join(columns)} FROM ({Q.SQL[name]})")
    assert plain(tuple(r) for r in df.select(columns).collect()) == plain(rel.fetchall())


def envelopes(path, name, rows):
    with open(f"{path}/{name}.json", "w") as f:
        for op, lsn, row in rows:
            f.write(json.dumps({"op": op, "before": row if op == "d" else None, "after": None if op == "d" else row, "source": {"lsn": lsn, "ts_ms": 1}}) + "\n")
        f.write("not json\n")


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    inbox, target = tmp_path / "in", str(tmp_path / "t")
    inbox.mkdir()

    def run():
        seen = []
        stream_table(spark, WIDGET, file_source(spark, str(inbox), WIDGET.schema), target_path=target, checkpoint_path=str(tmp_path / "cp"), available_now=True, guard_lsn=True, on_batch=lambda i, m: seen.append((i, m.input_events))).awaitTermination(120)
        return seen

    envelopes(inbox, "1", [("c", 1, {"id": 1, "name": "a", "amount": 1.0}), ("u", 5, {"id": 1, "name": "b", "amount": 2.0}), ("c", 2, {"id": 2, "name": "x", "amount": 0.0})])
    assert run() == [(0, 3)] and run() == []
    envelopes(inbox, "2", [("u", 3, {"id": 1, "name": "late", "amount": 9.0}), ("d", 6, {"id": 2, "name": "x", "amount": 0.0})])
    assert run() == [(1, 2)]
    assert [tuple(r) for r in VersionedTable(spark, target).read().select("id", "name").collect()] == [(1, "b")]


def test_frames(spark):
    raw = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07") + bytearray(b'{"op":"c","after":{"id":1}}'),), (None,)], "value binary")
    assert raw.select(strip_frame(F.col("value")).cast("string")).first()[0].startswith('{"op"')
    assert decode_json(raw, WIDGET.schema, framed=True).count() == 1


def test_pipeline_end_to_end(spark, tmp_path):
    paths = Paths(str(tmp_path))
    events = {t: entity(spark, SF, t).withColumns({"op": F.lit("c"), "lsn": F.col(TABLES[t].primary_key), "ts_ms": F.lit(0).cast("long")}) for t in ("orders", "customers", "inventory", "products")}
    ingest(spark, paths, events)
    as_of = F.lit("2005-01-01").cast("timestamp_ntz")
    run = promote(spark, paths, list(events), suites=["silver_inventory_suite"], as_of=as_of, baseline=str(tmp_path / "baseline"))
    assert dict(run.steps)["silver_inventory_suite"] is True
    with pytest.raises(GateFailed):
        promote(spark, paths, [], suites=["silver_customers_suite"])  # regions outside the set
    build_gold(spark, paths, full=True)
    before = sorted(map(tuple, VersionedTable(spark, paths.of("gold", "gold_revenue_daily")).read().collect()))
    build_gold(spark, paths)
    assert sorted(map(tuple, VersionedTable(spark, paths.of("gold", "gold_revenue_daily")).read().collect())) == before
    summary = reconcile_all(spark, paths, {"orders": VersionedTable(spark, paths.of("silver", "orders")).read()})
    assert summary.first()["reconciliation_status"] == "RECONCILED"
    assert serving.scorecard(summary).first()["verdict"] == "HEALTHY" and serving.scorecard(summary.limit(0)).first()["verdict"] == "PENDING"
    assert serving.overview(summary).count() == 1
    assert load_table(spark, "orders", paths.of("silver"), {"path": paths.of("warehouse")}) == summary.first()["target_rows"]


def test_backfill_takes_its_range(spark, tmp_path):
    events = spark.createDataFrame([("c", i, i, f"n{i}", 1.0) for i in range(10)], "op string, lsn bigint, id bigint, name string, amount double")
    m = backfill(spark, events, str(tmp_path / "t"), WIDGET, column="lsn", start=3, end=6)
    assert m.inserted == 3
    assert backfill(spark, events, str(tmp_path / "t"), WIDGET, column="lsn", start=0, end=2, reset=True).inserted == 2
    assert VersionedTable(spark, str(tmp_path / "t")).read().count() == 2


def test_profiles_and_catalog(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 2.0), (2, None, 4.0)], "id bigint, name string, x double")
    p = profile.profile(df, "t")
    rows = {r["column_name"]: r for r in p.collect()}
    assert rows["x"]["mean_value"] == 3.0 and rows["name"]["null_count"] == 1 and rows["name"]["mean_value"] is None and rows["id"]["min_value"] == "1"
    assert sorted(rows["id"]["sample_values"]) == ["1", "2"]
    docs = profile.catalog_documents(p)
    texts = {r["column_name"]: r["text"] for r in docs.collect()}
    assert "null rate 33.3%" in texts["x"] and texts[None].startswith("Table t contains columns: id, name, x.")
    assert profile.search(profile.index_documents(docs), "Represents name", limit=1).first()["column_name"] == "name"
    assert profile.profile(df.limit(0), "t").filter("null_rate = 0").count() == 3


def test_percentile_picks_by_rank(spark):
    values = spark.createDataFrame([(i,) for i in (5, 1, 9, 9, 3)], "v int")
    assert {r["percent"]: r["value"] for r in serving.percentile(values, "v", [0, 50, 99, 100]).collect()} == {0: 1, 50: 5, 99: 9, 100: 9}
    many = spark.range(20_000).selectExpr("IF(id % 3 = 0, 7, id) AS v", "IF(id % 2 = 0, null, 'g') AS g")  # a value with a third of all rows, and a null group
    for group, odd in ((None, 0), ("g", 1)):
        exact = sorted(7 if i % 3 == 0 else i for i in range(odd, 20_000, 2))
        got = {r["percent"]: r["value"] for r in serving.percentile(many, "v", [5, 50, 99], ["g"]).collect() if r["g"] == group}
        assert got == {p: exact[round(p / 100 * (len(exact) - 1))] for p in (5, 50, 99)}
    assert serving.percentile(values.limit(0), "v", [50]).count() == 0
    days = spark.sql("SELECT timestampadd(DAY, CAST(id AS INT), timestamp_ntz'2024-01-01') AS v FROM range(11)")
    assert serving.percentile(days, "v", [50]).first()["value"].day == 6
    with pytest.raises(TypeError):
        serving.percentile(spark.sql("SELECT 'a' AS v"), "v", [50])
    once = serving.percentile(spark.range(1000).selectExpr("id % 7 AS v", "id % 2 AS g"), "v", [50], ["g"])
    once.collect()
    assert "ReusedExchange" in once._jdf.queryExecution().executedPlan().toString()  # the counts are made once


def test_names_of_schemas():
    assert gold.schema_name("gold ", "raw") == "GOLD" and gold.schema_name(None, "raw") == "RAW"


def test_entry_works_without_the_llm_part(tmp_path):
    import shutil
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{repo}/moraine", tmp_path / "moraine", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{repo}/__spark_entry__.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"], cwd=tmp_path, capture_output=True, text=True)
    assert out.stdout.split()[2:] == ["False"], out.stderr
