"""``python -m moraine.cli COMMAND``: the operators from a shell.

merge, stream, ingest, promote, load, gold, reconcile, quality, profile,
catalog-index, catalog-search, catalog-profile, drift, explain,
inject-bad-rows. A failed suite or a breaking drift exits with 1; reconcile
reports and exits with 0.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict, is_dataclass

from pyspark.sql import functions as F

from moraine.operators import cdc, drift, expectations, lineage, profile, reconcile, serving, silver
from moraine.plans import pipeline
from moraine.registry import TABLES
from moraine.session import session
from moraine.sources.connectors import load_table
from moraine.sources.versioned import VersionedTable
from moraine.streaming.ingest import file_source, stream_table


def _show(value: object) -> None:
    print(json.dumps(asdict(value) if is_dataclass(value) else value, default=str, indent=1))


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="moraine", description=__doc__)
    parser.add_argument("command", choices="merge stream ingest promote load gold reconcile quality profile catalog-index catalog-search catalog-profile drift explain inject-bad-rows".split())
    parser.add_argument("names", nargs="*", help="tables, a suite, or the words of a search")
    parser.add_argument("--root", required=True, help="where the tables are")
    parser.add_argument("--events", help="JSON or Parquet change events (merge), or a folder of envelopes (stream)")
    parser.add_argument("--logs", help="folder of change logs (ingest)")
    parser.add_argument("--source", help="folder of source tables as Parquet (reconcile, drift)")
    parser.add_argument("--once", action="store_true", help="stream what is there and stop")
    parser.add_argument("--guard-lsn", action="store_true")
    parser.add_argument("--evolve", action="store_true")
    parser.add_argument("--full", action="store_true")
    parser.add_argument("--limit", type=int, default=5)
    a = parser.parse_args(args)
    spark, paths = session("moraine-cli"), pipeline.Paths(a.root)
    names = a.names or list(TABLES)
    if a.command == "merge":
        for n in names:
            reader = spark.read.parquet if a.events.endswith(".parquet") else spark.read.json
            _show(cdc.apply_cdc_events(spark, reader(a.events), paths.of("bronze", n), TABLES[n], guard_lsn=a.guard_lsn, allow_schema_evolution=a.evolve))
    elif a.command == "stream":
        queries = [stream_table(spark, TABLES[n], file_source(spark, f"{a.events}/{n}", TABLES[n].schema), target_path=paths.of("bronze", n), checkpoint_path=paths.of("checkpoints", n), available_now=a.once, guard_lsn=a.guard_lsn) for n in names]
        for q in queries:
            q.awaitTermination()
    elif a.command == "ingest":
        _show([(step, [asdict(m) for m in out] if isinstance(out, list) else out) for step, out in pipeline.ingest_log(spark, paths, {n: f"{a.logs}/{n}" for n in names}).steps])
    elif a.command == "promote":
        for n in names:
            _show(silver.bronze_to_silver(spark, n, paths.of("bronze", n), paths.of("silver", n), paths.of("quarantine", n)))
    elif a.command == "load":
        _show({n: load_table(spark, n, paths.of("silver"), {"path": paths.of("warehouse")}) for n in names})
    elif a.command == "gold":
        _show(pipeline.build_gold(spark, paths, full=a.full).steps)
    elif a.command == "reconcile":
        for n in names:
            _show(reconcile.reconcile_table(spark.read.parquet(f"{a.source}/{n}"), VersionedTable(spark, paths.of("silver", n)).read(), TABLES[n]))
    elif a.command == "quality":
        results = [expectations.run_suite(spark, n, paths.of("silver"), results_path=paths.of("meta", "validation_results")) for n in a.names or [s for s in expectations.SUITES if s.startswith("silver")]]
        for r in results:
            _show({"suite": r.suite, "success": r.success, "results": [asdict(x) for x in r.results]})
        return int(not all(r.success for r in results))
    elif a.command == "profile":
        for n in names:
            p = profile.profile(VersionedTable(spark, paths.of("silver", n)).read(), n)
            profile.store_profile(p, paths.of("meta", "profiles"))
            p.show(truncate=40)
    elif a.command == "catalog-index":
        profiles = profile.stored_profiles(spark, paths.of("meta", "profiles"))
        profile.index_documents(profile.catalog_documents(profiles)).write.mode("overwrite").parquet(paths.of("meta", "catalog"))
    elif a.command == "catalog-search":
        profile.search(spark.read.parquet(paths.of("meta", "catalog")), " ".join(a.names), limit=a.limit).show(truncate=False)
    elif a.command == "catalog-profile":
        serving.profile_of(profile.stored_profiles(spark, paths.of("meta", "profiles")), *a.names[:2]).show(truncate=False)
    elif a.command == "explain":  # the newest verdict on each table
        history = spark.read.option("mergeSchema", "true").parquet(paths.of("meta", "reconciliation_history"))
        for n in names:
            _show([r.asDict() for r in lineage.explain_reconciliation(history, n).collect()])
    elif a.command == "drift":
        reports = [drift.detect_drift(spark.read.parquet(f"{a.source}/{n}"), n, paths.of("baseline")) for n in names]
        for r in reports:
            _show({"table": r.table, "action": r.recommended_action, "changes": [asdict(c) for c in r.changes], "explained": lineage.explain_drift(spark, r, paths.of("meta", "drift_explanations"))})
        return int(any(r.has_breaking for r in reports))
    elif a.command == "inject-bad-rows":
        for n in names:  # a row with a negative quantity, to see the suites fail
            table = VersionedTable(spark, paths.of("silver", n))
            rows = table.read()
            bad = rows.limit(1).withColumn("quantity", F.lit(-1).cast(rows.schema["quantity"].dataType)).withColumn(TABLES[n].primary_key, F.lit(-1).cast("long"))
            table.write(rows.unionByName(bad), key=[TABLES[n].primary_key], operation="inject")
    return 0


if __name__ == "__main__":
    sys.exit(main())
