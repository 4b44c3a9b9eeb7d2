"""Time the headline queries and print one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from gridloom.plans import workload
from gridloom.session import session

HEADLINE = (
    "regrid_renorm", "regrid_all_variables", "regrid_dense_grid", "regrid_land_fraction", "regrid_ocean_fraction", "fx_by_map",
    "pressure_interp", "zonal_mean_pressure", "depth_overlap_remap", "hybrid_output", "derive_formula", "derive_many_formulas",
    "formula_steps", "vertical_sum_capped", "sums_over_indices", "hemisphere_area", "bounds_lon", "roll_lon", "monotone_axis",
    "sigma_axis", "corner_bounds", "cf_time_noleap", "index_axis_long", "slices_to_series", "year_blocks", "merge_first_wins",
    "spatial_mean_series", "time_mean_map", "assemble_targets", "required_inputs", "catalog_gap", "produced_inventory",
    "dimension_inventory", "log_rollup", "unmapped_from_log", "expected_minus_produced",
    "prepare_general", "prepare_zonal", "prepare_hybrid", "prepare_native",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(
        "bench",
        f"local[{cpus}]",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "6g"),
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")
    only = sys.argv[1:]
    seconds = {}
    for name in only or HEADLINE:
        # One run to warm up, then the median; the noop sink computes every row and keeps none.
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            workload.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 4)
    total = round(sum(seconds.values()), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
