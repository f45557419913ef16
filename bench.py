"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from ledgerline.registry import QUERIES
from ledgerline.session import local_session

HEADLINE = [
    "fin00_revenue_margin_growth", "fin02_filing_metrics", "fin03_kpi_table", "fin04_gold", "fin05_flow_edges", "fin07_detailed_flow",
    "prj10_year_indicator", "win04_deposit_per_year", "win09_dedup_activities", "jn01_target_facts", "jn05_denormalise", "jn06_decode_activities",
    "jn14_document_list", "agg08_sector_breakdown", "agg12_version_map", "ent01_silver", "ent02_rich", "ent03_sector_targets", "ent04_translated",
    "ent05c_directory_name", "ent06_sector_page", "ent07_profile", "mrg04_set_columns", "str03_parse_amount", "flt11_any_token",
    "htm02_card_fields", "htm08_publications", "stm01_tail", "stm05_resumable_upsert", "stm07_gold_refresh",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the workers
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    rows = {t: spark.read.parquet(f"{sf}/{t}.parquet").count() for t in ("customer", "orders", "lineitem", "documents", "pages", "events")}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"), "cpus": cpus, "spark": spark.version, "rows": rows,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
