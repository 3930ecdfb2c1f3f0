"""Rows that several passes need are made once, and hashed and put in order no more often than they must."""

import hashlib
import random

from pyspark.sql import functions as F

from moraine.operators import hash_tree, profile
from moraine.plans import queries, stateful

SF = "/root/testdata/sf0.001"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_samples_hash_distinct_values(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(40), rng.choice(["a", "b", None]), None) for _ in range(500)]
    df = spark.createDataFrame(rows, "n int, s string, nothing string")
    got = {r["column_name"]: (r["exact"], r["sample_values"]) for r in profile.sampled(df).collect()}
    for i, c in enumerate(df.columns):
        texts = {str(r[i]) for r in rows if r[i] is not None}
        lowest = {}
        for h, t in sorted((hashlib.md5(t.encode()).hexdigest(), t) for t in texts):
            lowest.setdefault(int(h[31], 16) % profile.SHOWN, (h, t))
        assert got[c] == (len(texts), [t for _, t in sorted(lowest.values())])
    hashing = [line for line in optimized(profile.profile(df, "t")).split("\n") if "md5(" in line]
    assert len(hashing) == 1 and hashing[0].lstrip(" :+-").startswith("Aggregate [i#")  # on groups' values


def test_a_catalog_reads_its_profile_once(spark):
    rows = profile.profile(spark.range(9).selectExpr("id", "'x' AS s"), "t", samples=False).withColumn("sample_values", F.lit(None).cast("array<string>"))
    documents = profile.catalog_documents(rows)
    assert optimized(documents).count("Range (") == 1
    assert [(r["doc_id"], r["kind"], r["column_name"]) for r in documents.collect()] == [(0, "column", "id"), (1, "column", "s"), (2, "table", None)]


def test_exact_counts_are_apart_from_texts_and_sums(spark):
    plan = profile.profile(spark.range(9).selectExpr("id", "'x' AS s"), "t", exact=True, samples=False)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and not [line for line in plan[: plan.index("Expand")].split("\n") if "SortAggregate(key=[" in line and "key=[]" not in line]


def test_unique_orders_are_put_in_order_behind_the_shuffle_only(spark):
    plan = queries.recon_checksum(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan and plan.rindex("SortAggregate") < plan.index("Exchange hashpartitioning(order_id")


def test_suites_get_orders_that_are_made_once(spark, monkeypatch):
    orders = queries._checked_orders(spark, SF)["orders"]
    assert "Join" not in optimized(orders) and orders.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    seen = []
    monkeypatch.setattr(queries.expectations, "validate", lambda ctx, _: seen.append(ctx) or [])
    queries._suite(spark, "silver_orders_suite", queries._checked_orders(spark, SF))
    assert "Join" not in optimized(seen[0]["orders"])


def test_trees_compare_orders_that_are_made_once(spark, monkeypatch):
    given = []
    monkeypatch.setattr(stateful.hash_tree, "diff_by_tree", lambda s, t, *_: given.extend([s, t]) or s.select("order_id", F.array(F.lit("x")).alias("fields")))
    stateful.recon_tree_diff(spark, SF)
    assert all("Join" not in optimized(df) for df in given)


def test_a_tree_stores_no_hash_of_a_row(spark, tmp_path):
    tree = hash_tree.write_tree(spark.range(50).selectExpr("id AS k", "'a' AS v"), str(tmp_path / "t"), "k", ["k", "v"], levels=2)
    assert set(tree.rows().columns) == {"k", "v", "_leaf", "_folder"} and tree.nodes(2).agg(F.sum("n")).first()[0] == 50
