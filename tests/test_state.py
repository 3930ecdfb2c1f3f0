import random
from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from moraine.operators import drift, gold, hash_tree, lineage, profile, reconcile, revenue_state, serving
from moraine.sources.versioned import VersionedTable

COLUMNS = ["order_id", "status", "unit_price"]
DDL = "order_id long, status string, unit_price decimal(12,2)"


def found(df):
    return Counter((r["order_id"], r["kind"], tuple(r["fields"])) for r in df.collect())


@pytest.mark.parametrize("seed", range(2))
def test_tree_diff_equals_the_full_one(spark, tmp_path, seed):
    rng = random.Random(seed)
    source = [(i if rng.random() < 0.98 else None, rng.choice(["a", "b", None]), Decimal(i) / 4) for i in range(400)]
    target = [(k, s if rng.random() < 0.95 else "z", p + rng.choice([0, 0, 0, Decimal("0.01"), Decimal("0.5")])) for k, s, p in source if rng.random() < 0.97] + [(10_000, "a", None), (-5, None, None)]
    s, t = spark.createDataFrame(source, DDL), spark.createDataFrame(target, "order_id int, status string, unit_price decimal(14,3)")
    got = found(hash_tree.diff_by_tree(s, t, "order_id", COLUMNS, str(tmp_path / "d")))
    assert got == found(reconcile.full_diff(s, t, "order_id", COLUMNS)) and got
    if seed:
        return
    keyed = s.filter("order_id is not null")
    assert found(hash_tree.diff_by_tree(keyed, keyed, "order_id", COLUMNS, str(tmp_path / "e"))) == Counter()
    assert hash_tree.diff_by_tree(s.limit(0), t.limit(0), "order_id", COLUMNS, str(tmp_path / "f")).collect() == []


def test_repeated_rows_and_equal_texts_are_told_apart(spark, tmp_path):
    s = spark.createDataFrame([(1, "ab", None), (2, "x", None), (2, "x", None)], DDL)
    t = spark.createDataFrame([(1, "ab", None), (2, "x", None)], DDL)
    trees = [hash_tree.write_tree(df, str(tmp_path / n), "order_id", COLUMNS, levels=3) for n, df in (("s", s), ("t", t))]
    assert hash_tree.unequal(*trees, 3, None).count() == 1
    one = hash_tree.write_tree(spark.createDataFrame([(1, "a", "bc")], "order_id long, p string, q string"), str(tmp_path / "one"), "order_id", ["order_id", "p", "q"], levels=2)
    two = hash_tree.write_tree(spark.createDataFrame([(1, "ab", "c")], "order_id long, p string, q string"), str(tmp_path / "two"), "order_id", ["order_id", "p", "q"], levels=2)
    assert hash_tree.unequal(one, two, 1, None).count() == 1
    with pytest.raises(ValueError):
        hash_tree.tree_diff(trees[0], one, COLUMNS, str(tmp_path / "x"))


def test_equal_branches_are_not_read_again(spark, tmp_path):
    s = spark.range(20_000).selectExpr("id AS order_id", "'a' AS status", "CAST(id AS DECIMAL(12,2)) AS unit_price")
    t = s.withColumn("status", F.when(F.col("order_id") == 77, "b").otherwise(F.col("status")))
    trees = [hash_tree.write_tree(df, str(tmp_path / n), "order_id", COLUMNS, levels=hash_tree.levels_for(20_000)) for n, df in (("s", s), ("t", t))]
    diff = hash_tree.tree_diff(*trees, COLUMNS, str(tmp_path / "d"))
    assert [(r["order_id"], r["kind"], r["fields"]) for r in diff.collect()] == [(77, "different", ["status"])]
    plan = diff._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_folder") and "_folder" in plan
    scans = [n for n in diff._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in n and "PartitionFilters: [isnotnull(_folder" in n]
    assert len(scans) >= 2
    assert trees[0].levels == 2 and len(trees[0].rows().select("_folder").distinct().collect()) == 16
    for level in range(1, trees[0].levels + 1):  # one node a level is opened
        assert spark.read.parquet(str(tmp_path / "d" / f"unequal={level}")).count() == 1
    assert hash_tree.levels_for(10) == 2 and hash_tree.levels_for(10**9) == 5


def test_sketches_of_parts_make_the_profile_of_the_whole(spark, tmp_path):
    rng = random.Random(0)
    rows = [(rng.randrange(-50, 5000), rng.choice("abc") if rng.random() < 0.9 else None, rng.random() * 9 - 4, None) for _ in range(3000)]
    df = spark.createDataFrame(rows, "n bigint, s string, x double, nothing string")
    path = str(tmp_path / "sketches")
    for v in range(4):
        profile.store_sketches(df.filter(F.pmod("n", F.lit(4)) == v), "t", f"v{v}", path)
    profile.store_sketches(df.filter(F.pmod("n", F.lit(4)) == 2), "t", "v2", path)  # again
    merged = {r["column_name"]: r for r in profile.merged_profile(VersionedTable(spark, path).read()).collect()}
    exact = {r["column_name"]: r for r in profile.profile(df, "t", exact=True, samples=False).collect()}
    for c in df.columns:
        m, e = merged[c], exact[c]
        assert (m["row_count"], m["null_count"], m["data_type"]) == (e["row_count"], e["null_count"], e["data_type"])
        assert abs(m["distinct_count"] - e["distinct_count"]) <= 3 * 1.04 / 64 * e["distinct_count"] + 1
        if c == "x":
            assert float(m["min_value"]) == pytest.approx(float(e["min_value"]), abs=1e-9)
        else:
            assert (m["min_value"], m["max_value"]) == (e["min_value"], e["max_value"])
        assert (m["mean_value"] is None) == (e["mean_value"] is None) and (m["mean_value"] is None or m["mean_value"] == pytest.approx(e["mean_value"]))
    assert merged["nothing"]["distinct_count"] == 0 and merged["nothing"]["null_rate"] == 1.0
    wide = profile.merged_profile(profile.sketched(spark.sql("SELECT 1e300D AS x UNION ALL SELECT double('NaN')"), "t", "v")).first()
    assert (wide["row_count"], wide["min_value"], wide["max_value"]) == (2, None, None)
    empty = profile.merged_profile(profile.sketched(df.limit(0), "t", "none")).collect()
    assert {r["null_rate"] for r in empty} == {0.0} and {r["distinct_count"] for r in empty} == {0}


def test_samples_don_t_depend_on_order_or_cut(spark):
    df = spark.range(500).selectExpr("CAST(id % 90 AS STRING) AS s", "IF(id = 3, 'x', null) AS one", "CAST(null AS INT) AS none")
    one, two = ({r["column_name"]: r["sample_values"] for r in profile.profile(d, "t").collect()} for d in (df.coalesce(1), df.orderBy(F.desc("s")).repartition(7)))
    assert one == two and len(set(one["s"])) == 5 and one["one"] == ["x"] and one["none"] == []


def test_profiles_are_stored_and_found(spark, tmp_path):
    path = str(tmp_path / "profiles")
    assert profile.stored_profiles(spark, path).collect() == []
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    profile.store_profile(profile.profile(df, "b"), path)
    profile.store_profile(profile.profile(df, "a"), path)
    profile.store_profile(profile.profile(df.limit(1), "b"), path)
    rows = profile.stored_profiles(spark, path)
    assert [(r["table_name"], r["column_name"], r["row_count"]) for r in rows.collect()] == [("a", "id", 2), ("a", "name", 2), ("b", "id", 1), ("b", "name", 1)]
    assert [r["column_name"] for r in serving.profile_of(rows, "a").collect()] == ["id", "name"] and serving.profile_of(rows, "a", "name").first()["null_rate"] == 0.5


def orders(spark, rows):
    return spark.createDataFrame([(i, date(2024, 1, d), c, s, None if t is None else Decimal(t)) for i, (d, c, s, t) in enumerate(rows)], "order_id long, order_date date, customer_id long, status string, total_amount decimal(18,2)")


def test_state_equals_the_rebuilt_mart(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.randrange(1, 5), rng.choice([None, 1, 2, 32_768, 32_769, 10**9, rng.randrange(1, 200_000)]), rng.choice(["new", "cancelled", None]), rng.choice([None, rng.randrange(1, 99)])) for _ in range(300)]
    whole, path = orders(spark, rows), str(tmp_path / "state")
    for part in range(3):
        assert revenue_state.append(spark, path, whole.filter(F.col("order_id") % 3 == part), batch=("daily", part), buckets=4)
    assert not revenue_state.append(spark, path, whole.filter("order_id % 3 = 1"), batch=("daily", 1))  # a replay
    assert revenue_state.append(spark, path, whole.limit(0), batch=("daily", 3))
    plain = lambda df: sorted(map(tuple, df.select("revenue_date", "order_count", "unique_customers", "gross_revenue", "cancelled_revenue", "net_revenue", "avg_order_value").collect()))
    state = VersionedTable(spark, path).read()
    assert plain(revenue_state.revenue_daily_of(state)) == plain(gold.revenue_daily(whole))
    assert len(plain(revenue_state.revenue_daily_of(state, days=F.col("revenue_date") == F.lit("2024-01-02").cast("date")))) == 1


def test_append_touches_its_days_only(spark, tmp_path):
    path = str(tmp_path / "state")
    revenue_state.append(spark, path, orders(spark, [(d, d, "new", 1) for d in range(1, 29)]), buckets=64)
    revenue_state.append(spark, path, orders(spark, [(3, 3, "new", 1)]))
    assert 1 <= sorted(VersionedTable(spark, path).commit().buckets.values()).count(1) <= 2


def test_a_scalar_mark_prunes_partitions(spark, tmp_path):
    whole = orders(spark, [(d, d, "new", 1) for d in range(1, 29)])
    whole.write.partitionBy("order_date").parquet(str(tmp_path / "o"))
    stored = spark.read.parquet(str(tmp_path / "o"))
    mart = gold.revenue_daily(stored.filter("order_date <= DATE '2024-01-26'"))
    mart.write.parquet(str(tmp_path / "mart"))
    built = gold.revenue_daily(stored, since=spark.read.parquet(str(tmp_path / "mart")).agg(F.max("revenue_date")).scalar())
    assert sorted(r["revenue_date"].day for r in built.collect()) == [26, 27, 28]
    plan = built._jdf.queryExecution().executedPlan()
    text = plan.toString()
    scan = next(line for line in text.split("\n") if "FileScan" in line and "order_date" in line and "mart" not in line)
    assert "PartitionFilters" in scan and "subquery" in scan.split("PartitionFilters")[1]

    def files(node):
        kids = node.children()
        own = node.metrics().get("numFiles").get().value() if node.nodeName().startswith("Scan") and node.metrics().contains("numFiles") else 0
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return files(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return files(node.plan())
        return own + sum(files(kids.apply(i)) for i in range(kids.size()))

    assert files(plan) == 3


def test_refresh_reads_its_mark_in_the_plan(spark, tmp_path):
    whole = orders(spark, [(d, d, "new", 1) for d in range(1, 9)])
    path = str(tmp_path)
    gold.refresh(spark, path, "m", lambda m: gold.revenue_daily(whole.filter("order_date < DATE '2024-01-06'") if m is None else whole, since=m), "revenue_date", "revenue_date")
    seen = []
    gold.refresh(spark, path, "m", lambda m: seen.append(m) or gold.revenue_daily(whole, since=m), "revenue_date", "revenue_date")
    assert VersionedTable(spark, f"{path}/m").read().count() == 8 and seen[0] is not None


def test_reach_by_plain_search(spark):
    rng = random.Random(9)
    edges = [(f"n{a}", f"n{rng.randrange(a + 1, 31)}") for a in range(30) for _ in range(2)] + [("n0", None), (None, "n1"), ("n0", "n1"), ("n0", "n1")]
    got = {(r["root"], r["node"]): r["depth"] for r in lineage.reach(spark.createDataFrame(edges, lineage.EDGES_DDL), spark.createDataFrame([("n0",), ("n7",), (None,), ("alone",)], "root string")).collect()}
    expected = {}
    for root in ("n0", "n7"):
        depth, now = {}, {root}
        for d in range(1, 40):
            now = {b for a, b in edges if a in now and b is not None}
            for x in now:
                depth.setdefault(x, d)
        expected |= {(root, x): d for x, d in depth.items()}
    assert got == expected
    with pytest.raises(Exception):
        lineage.reach(spark.createDataFrame([("a", "b"), ("b", "a")], lineage.EDGES_DDL), spark.createDataFrame([("a",)], "root string")).collect()


def test_reach_follows_meeting_paths_once(spark):
    """Two to the power of 21 paths, and more rows than Spark's recursive queries may have."""
    edges = [("top", f"0{x}") for x in "ab"] + [(f"{k}{x}", f"{k + 1}{y}") for k in range(20) for x in "ab" for y in "ab"]
    got = {(r["node"], r["depth"]) for r in lineage.reach(spark.createDataFrame(edges, lineage.EDGES_DDL), spark.createDataFrame([("top",)], "root string")).collect()}
    assert got == {(f"{k}{x}", k + 1) for k in range(21) for x in "ab"}


def test_drift_is_explained_once(spark, tmp_path):
    assert lineage.downstream(spark, "orders") == ["stg_orders", "gold_customer_segments", "gold_migration_summary", "gold_revenue_daily"]
    assert lineage.downstream(spark, "nothing") == []
    report = drift.classify_drift({"id": "bigint", "v": "string"}, {"id": "bigint", "v": "int", "w": "int"}, "orders")
    first = lineage.explain_drift(spark, report, str(tmp_path / "x"))
    again = lineage.explain_drift(spark, report, str(tmp_path / "x"))
    assert not first["cached"] and again["cached"] and first["affected"] == again["affected"] and first["action"] == "halt" and "gold_revenue_daily" in again["summary"]
    none = lineage.explain_drift(spark, drift.classify_drift({"id": "int"}, {"id": "int"}, "orders"), str(tmp_path / "x"))
    assert none["affected"] == [] and none["action"] == "none" and len(VersionedTable(spark, str(tmp_path / "x")).read().collect()) == 2


def test_a_verdict_is_explained(spark):
    ddl = "table_name string, run_id string, status string, source_count long, target_count long, sample_size long, sample_mismatches long, discrepancies string, reconciled_at int"
    rows = [("t", "a", "RECONCILED", 5, 5, 5, 0, "[]", 1), ("t", "b", "COUNT_MISMATCH", 5, 3, 5, 2, "[1]", 2), ("u", "c", "SAMPLE_MISMATCH", 5, 5, 5, 2, "[2]", 3)]
    history = spark.createDataFrame(rows, ddl)
    assert tuple(lineage.explain_reconciliation(history, "t").first()) == ("t", "b", "COUNT_MISMATCH", 2, "2 rows apart", "[1]")
    assert lineage.explain_reconciliation(history, "u").first()["cause"] == "2 of 5 sampled rows differ" and lineage.explain_reconciliation(history, "v").collect() == []
