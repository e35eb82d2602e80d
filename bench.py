"""Headline queries, timed on the driver tables; prints one JSON line.

Every query is run to completion with the ``noop`` sink, so no rows travel to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlake.plans import registry
from ledgerlake.session import build_session

HEADLINE = (
    "AGG-16_lacking_now",
    "AGG-16_lacking_last_year",
    "AGG-16_lacking_fixed_year",
    "AGG-14_fine_grain_share",
    "AGG-14_wide_grain_share",
    "WIN-04_validity_interval",
    "WIN-05_scd2_profile",
    "JOIN-03_fact_item",
    "AGG-06_fact_year",
    "AGG-01_exam_by_school",
    "WIN-09_inspection_priority",
    "JOIN-05_full_reconciliation",
    "AGG-22_table_fingerprint",
    "AGG-36_month_comparison",
    "AGG-17_national",
    "AGG-18_full_scan",
    "SNK-04_insert_if_absent",
    "SNK-07_compaction",
    "STR-01_streamed_events",
    "WIN-11_delivery_order",
)


def stored_reads(spark, folder: str) -> dict[str, float]:
    """Build the star schema once, then ask the stored tables."""
    from ledgerlake.operators import facts, history, metrics, workload
    from ledgerlake.plans import storage
    from ledgerlake.plans.adapter import LAST_YEAR, Lake

    times = {}

    def timed(name, action):
        began = time.perf_counter()
        out = action()
        if hasattr(out, "write"):
            out.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
        return out

    lake = Lake(spark, folder)
    timed("events_prepared", lambda: lake.stored("event") and None)
    star = timed("star_build", lambda: storage.build_star(lake))
    fine, wide = star.read("fato_vistoria_item"), star.read("fato_infra_escola_ano")
    schools, places = star.read("dim_escola"), star.read("dim_municipio")
    timed("stored_lacking_now", lambda: metrics.lacking_now(history.latest_state(fine), schools, "item_2"))
    timed("stored_lacking_last_year", lambda: metrics.lacking_last_year(facts.last_year_rows(wide, ["item_2"]), schools, "item_2"))
    timed("stored_lacking_fixed_year", lambda: metrics.lacking_in_year(wide, schools, "item_2", LAST_YEAR))
    timed("stored_fine_grain_share", lambda: metrics.fine_grain_share(fine, schools, places, "item_3", LAST_YEAR))
    timed("stored_wide_grain_share", lambda: metrics.wide_grain_share(wide, schools, places, "item_3", LAST_YEAR))
    timed("stored_absent_per_item", lambda: workload.absent_per_item(fine))
    timed("stored_school_history", lambda: workload.school_history(fine, 5, "item_2"))
    return times


def stored_tables(spark, folder: str) -> dict[str, float]:
    """Questions to a stored event table and one streamed pass, each without its preparation."""
    from pyspark.sql import functions as F

    from ledgerlake.plans import storage, streams
    from ledgerlake.plans.adapter import Lake
    from ledgerlake.session import work_dir
    from ledgerlake.streaming import run, windows

    times = {}

    def timed(name, action):
        began = time.perf_counter()
        out = action()
        if hasattr(out, "write"):
            out.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)

    lake = Lake(spark, folder)
    events = lake.stored("event")
    table = storage.events_table(lake)
    later = (F.col("vistoria_id") % 50) == 0
    table.append(events.where(~later))
    timed("insert_if_absent", lambda: table.insert_if_absent(events.where(later)))
    timed("insert_repeated", lambda: table.insert_if_absent(events.where(later)))
    timed("fingerprint", lambda: table.fingerprint())
    timed("month_comparison", lambda: windows.compare_with_table(events, table))
    timed("compaction", lambda: table.compact())
    timed("one_school", lambda: table.read(only={"co_entidade": (5, 5)}))
    path = f"{work_dir(spark)}/envelope"
    lake.changes.write.parquet(path)
    tables, headers = streams._table(lake), lake.stream_headers
    timed("streamed_pass", lambda: run.run_once(spark, path, lambda: headers, tables, work_dir(spark)))
    return times


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry.load()
    names = sys.argv[1:] or HEADLINE
    # One untimed pass over the inputs: JVM and page-cache warm-up.
    for table in ("orders", "lineitem", "customer", "events"):
        spark.read.parquet(f"{folder}/{table}.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        began = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    if not sys.argv[1:]:
        times.update(stored_reads(spark, folder))
    total = round(sum(times.values()), 3)
    stored = {} if sys.argv[1:] else stored_tables(spark, folder)  # beside the total, which stays comparable
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "stored_tables": stored, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
