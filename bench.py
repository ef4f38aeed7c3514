"""Seconds of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from registra import queries
from registra.plans import files
from registra.sources import ingest

#: The registry's headline queries. roles_from_json reads and flattens nested roles that are already on disk: it is
#: the one with a published figure, in rows a second.
HEADLINE = (
    "snapshot_diff", "panel_quarter", "series_multi_fn", "role_diff", "board_summary", "flows_with_exits", "replay_asof", "sync_changelog",
    "interlock_edges", "survival", "field_prevalence",
)


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", tempfile.mkdtemp(prefix="spark-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    path = files.folder(spark, "bench-roles")
    files.nested_roles(spark, sf_dir).write.json(path)
    made = {n: (lambda f=queries.QUERIES[n]: f(spark, sf_dir)) for n in HEADLINE}
    made["roles_from_json"] = lambda: ingest.flatten_roles(ingest.read_json(spark, path, ingest.ROLE_INPUT, lines=True))
    seconds = {}
    for name, query in made.items():
        runs = []
        for _ in range(3):
            began = time.perf_counter()
            query().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    rows_per_second = round(made["roles_from_json"]().count() / seconds["roles_from_json"])
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf, "roles_flattened_per_sec": rows_per_second,
    }))


if __name__ == "__main__":
    main()
