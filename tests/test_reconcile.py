from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from moraine.functions.values import canonical, number, row_hash
from moraine.operators.reconcile import compare_row, full_diff, reconcile_table, reconciled, sample_diff
from moraine.registry import TABLES

COLUMNS = ["order_id", "quantity", "status", "unit_price", "created_at"]


@pytest.mark.parametrize(
    ("a", "b", "expected"),
    [
        ({"quantity": 5}, {"quantity": Decimal("5")}, []),
        ({"unit_price": Decimal("10.00")}, {"unit_price": Decimal("10.004")}, []),
        ({"unit_price": Decimal("10.00")}, {"unit_price": Decimal("10.05")}, ["unit_price"]),
        ({"created_at": datetime(2025, 1, 1, tzinfo=timezone.utc)}, {"created_at": datetime(2025, 1, 1)}, []),
        ({"created_at": datetime(2025, 1, 1)}, {"created_at": datetime(2025, 1, 1, 0, 0, 5)}, ["created_at"]),
        ({"created_at": datetime(2025, 11, 11, 0, 9, 23, 426196)}, {"created_at": "2025-11-11T00:09:23.426196Z"}, []),
        ({"status": None}, {"status": "x"}, ["status"]),
        ({"status": None}, {"status": ""}, []),
        ({"created_at": None}, {"created_at": datetime(2025, 1, 1)}, ["created_at"]),
    ],
)
def test_compare_row(spark, a, b, expected):
    assert list(compare_row(COLUMNS, a, b, spark=spark)) == expected


def test_canonical_and_numbers(spark):
    row = spark.sql("SELECT CAST('100.00' AS DECIMAL(12,2)) AS a, CAST('1.50' AS DECIMAL(12,2)) AS b, true AS c, CAST(null AS INT) AS d")
    assert [row.select(canonical(F.col(f.name), f.dataType)).first()[0] for f in row.schema] == ["100", "1.5", "true", ""]
    assert spark.sql("SELECT 'x' AS v").select(number(F.col("v"))).first()[0] is None


def orders(spark, n=200):
    return spark.range(n).select(F.col("id").alias("order_id"), (F.col("id") % 7).alias("customer_id"), (F.col("id") % 5).alias("product_id"), F.lit(2).alias("quantity"), F.lit("1.50").cast("decimal(12,2)").alias("unit_price"), F.lit("pending").alias("status"), F.lit("web").alias("channel"), F.lit("2025-01-01").cast("timestamp_ntz").alias("created_at"), F.lit("2025-01-01").cast("timestamp_ntz").alias("updated_at"))


def test_status_precedence(spark):
    spec, a = TABLES["orders"], orders(spark)
    r = reconcile_table(a, a, spec)
    assert (r.status, r.checksum_match, r.sample_size, r.sample_mismatches) == ("RECONCILED", True, 200, 0)
    assert reconcile_table(a, a.withColumn("status", F.when(F.col("order_id") == 3, "lost").otherwise(F.col("status"))), spec).status == "CHECKSUM_MISMATCH"
    r = reconcile_table(a, a.withColumn("unit_price", (F.col("unit_price") + 1).cast("decimal(12,2)")), spec)
    assert r.status == "SAMPLE_MISMATCH" and r.sample_mismatches == 200 and len(r.discrepancies) == 20
    r = reconcile_table(a, a.filter("order_id >= 50"), spec)
    assert (r.status, r.checksum_match) == ("COUNT_MISMATCH", None) and len(r.discrepancies) == 20  # the cap covers missing rows
    none = a.limit(0)
    assert reconciled(none, none, spec).first()["status"] == "RECONCILED"


def test_checksum_ignores_order_and_partitions(spark):
    a = orders(spark)
    total = lambda df: df.agg(F.sum(row_hash(["order_id", "status"]))).first()[0]
    assert total(a) == total(a.repartition(7).orderBy(F.desc("order_id")))
    pair = spark.sql("SELECT * FROM VALUES ('a', null, 'b'), ('a', 'b', null) AS t(x, y, z)")
    assert pair.select(row_hash(["x", "y", "z"])).distinct().count() == 1 and pair.select(row_hash(["x", "y", "z"], null_marker="~")).distinct().count() == 2


def test_differences(spark):
    a = orders(spark, 30)
    b = a.filter("order_id <> 4").union(a.filter("order_id = 5").withColumn("order_id", F.lit(99).cast("long")))
    assert {(r["order_id"], r["missing_in_target"]) for r in sample_diff(a, b, "order_id", COLUMNS).collect()} == {(4, True)}
    assert {(r["order_id"], r["kind"]) for r in full_diff(a, b, "order_id", COLUMNS).collect()} == {(4, "missing_in_target"), (99, "extra_in_target")}


def test_the_target_is_cut_to_the_sample_before_any_shuffle(spark, tmp_path):
    orders(spark, 5000).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    diff = sample_diff(orders(spark, 5000).withColumn("status", F.lit("lost")), target, "order_id", COLUMNS, size=50)
    assert diff.count() == 50
    plan = diff._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin [order_id" in plan and "LeftSemi" in plan
    assert diff.count() == sample_diff(orders(spark, 5000).withColumn("status", F.lit("lost")), target, "order_id", COLUMNS, size=50, seed=3).count()
