import json
import math

import pytest
from pyspark.sql import functions as F

from gridloom.operators import series as sr
from gridloom.sources import sinks, tables
from gridloom.streaming import slices as live


def slice_rows(spark, years=(2000, 2001, 2002, 2003), cells=3):
    rows = [(y * 12 + m, c, float(y), float(c)) for y in years for m in range(2) for c in range(cells)]
    return spark.createDataFrame(rows, "time_idx int, cell bigint, TS double, PS double")


def series_rows(spark, **kw):
    return sr.slices_to_series(slice_rows(spark, **kw), ["time_idx", "cell"], ["TS", "PS"])


def year():
    return F.floor(F.col("time_idx") / 12).cast("int")


def test_slices_turn_without_a_shuffle(spark):
    series = series_rows(spark)
    assert series.count() == 2 * slice_rows(spark).count()
    assert "Exchange" not in series._jdf.queryExecution().executedPlan().toString()


def test_blocks(spark):
    blocks = sr.year_blocks(series_rows(spark), 2000, 2002, 2, year())
    assert {(r["block"], r["y"]) for r in blocks.select("block", year().alias("y")).distinct().collect()} == {(2000, 2000), (2000, 2001), (2002, 2002), (2002, 2003)}
    assert {r["block"] for r in sr.year_blocks(series_rows(spark), 2001, 2001, 1, year()).select("block").distinct().collect()} == {2001}


def test_written_blocks_are_kept_or_replaced(spark, tmp_path):
    out = str(tmp_path / "series")
    first = sr.year_blocks(series_rows(spark, years=(2000,)), 2000, 2000, 1, year())
    sinks.write_blocks(spark, first, out)
    changed = sr.year_blocks(series_rows(spark, years=(2000, 2001)).withColumn("value", F.lit(-1.0)), 2000, 2001, 1, year())
    sinks.write_blocks(spark, changed, out)
    values = lambda b: {r["value"] for r in spark.read.parquet(out).filter(f"block = {b} and var = 'TS'").collect()}
    assert values(2000) == {2000.0} and values(2001) == {-1.0}
    sinks.write_blocks(spark, changed.filter("block = 2000"), out, overwrite=True)
    assert values(2000) == {-1.0} and values(2001) == {-1.0}


def test_scan_reads_only_the_wanted_variables(spark, tmp_path):
    out = str(tmp_path / "series")
    rows = series_rows(spark).withColumn("value", F.when(F.col("cell") == 0, F.lit(math.nan)).otherwise(F.col("value")))
    fractions = spark.createDataFrame([(t, c, c / 2.0, "landfrac") for t in (1, 2) for c in range(3)], "time_idx int, cell bigint, value double, var string")
    sinks.write_series(rows.unionByName(fractions).withColumn("freq", F.lit("mon")), out)
    moving, static = tables.scan_series(spark, [out], ["TS", "landfrac"])
    assert {r["var"] for r in moving.select("var").distinct().collect()} == {"TS"}
    assert moving.filter("value is null").count() == 8 and moving.filter("isnan(value)").count() == 0
    assert sorted((r["cell"], r["value"]) for r in static.collect()) == [(0, 0.0), (1, 0.5), (2, 1.0)]
    assert "PartitionFilters: [var" in moving._jdf.queryExecution().executedPlan().toString()


def test_tree(spark, tmp_path):
    rows = series_rows(spark).withColumn("var", F.concat(F.lower("var"), F.lit("_tavg-u"))).withColumn("value", F.when(F.col("cell") > 0, F.col("value")))
    facets = dict(zip(("mip_era", "activity_id", "institution_id", "source_id", "experiment_id", "variant_label"), "eaisxv")) | {"frequency": "mon"}
    root = str(tmp_path / "tree")
    sinks.write_tree(sinks.with_facets(sinks.prepare_output(rows), facets), root)
    folder = "mip_era=e/activity_id=a/institution_id=i/source_id=s/experiment_id=x/variant_label=v/region=glb/frequency=mon/variable_id=ts/branding_suffix=tavg-u/grid_label=gr"
    assert (tmp_path / "tree" / folder).is_dir()
    back = spark.read.parquet(root)
    assert back.count() == rows.count() and dict(back.dtypes)["value"] == "float"
    assert back.filter("cell = 0").select(F.min("value")).first()[0] == pytest.approx(1e20)


def test_stored_fixed_fields_need_the_same_grid(spark, tmp_path):
    grid = spark.createDataFrame([(0, 1.0, 2.0), (1, 3.0, 4.0)], "cell bigint, lat double, lon double")
    path = str(tmp_path / "fx")
    grid.withColumn("var", F.lit("orog")).withColumn("value", F.lit(5.0)).write.parquet(path)
    assert tables.load_existing_fx(spark, path, "orog", grid).count() == 2
    assert tables.load_existing_fx(spark, path, "basin", grid) is None
    assert tables.load_existing_fx(spark, path, "orog", grid.withColumn("lat", F.col("lat") + 1)) is None
    assert tables.load_existing_fx(spark, path, "orog", grid.limit(1)) is None


def test_marked_fixed_fields_are_known_by_their_fingerprint(spark, tmp_path):
    grid = spark.createDataFrame([(0, -0.0, 2.0), (1, 3.0, 4.0), (2, 3.0, None)], "cell bigint, lat double, lon double")
    path = str(tmp_path / "fx")
    fields = spark.createDataFrame([("orog", c, 5.0) for c in range(3)] + [("area", 0, 1.0)], "var string, cell bigint, value double")
    sinks.write_fx(fields, grid, path)
    same = grid.unionByName(grid).orderBy(F.desc("cell")).withColumn("lat", F.abs("lat"))
    kept = tables.load_existing_fx(spark, path, "orog", same)
    assert sorted(kept.columns) == ["cell", "value", "var"] and kept.count() == 3
    for other in (grid.withColumn("lat", F.col("lat") + 1), grid.limit(1), grid.limit(0), grid.withColumn("cell", F.col("cell") + 1)):
        assert tables.load_existing_fx(spark, path, "orog", other) is None
    assert tables.load_existing_fx(spark, path, "basin", grid) is None
    sinks.write_fx(fields.filter("var = 'orog'").withColumn("value", F.lit(6.0)), grid.limit(1), path)  # replaces one, keeps the other
    assert tables.load_existing_fx(spark, path, "orog", grid) is None and tables.load_existing_fx(spark, path, "area", grid).count() == 1
    assert {r["value"] for r in tables.load_existing_fx(spark, path, "orog", grid.limit(1)).collect()} == {6.0}


def test_lines_of_a_file_in_many_splits(spark, tmp_path):
    long = [f"{i} " + "é" * (i * 7 % 50) for i in range(400)]
    long[17] = ""
    (tmp_path / "a.log").write_text("\n".join(long) + "\n")
    (tmp_path / "b.log").write_text("one\r\n\ntwo")
    (tmp_path / "c.log").write_text("")
    read = lambda: tables.read_lines(spark, str(tmp_path / "*.log"))
    whole = sorted(map(tuple, read().collect()))
    assert whole == [("a.log", i, t) for i, t in enumerate(long)] + [("b.log", 0, "one\r"), ("b.log", 1, ""), ("b.log", 2, "two")]
    for name, value in (("maxPartitionBytes", "300"), ("openCostInBytes", "1")):
        spark.conf.set(f"spark.sql.files.{name}", value)
    try:
        lines = read()
        assert lines.select(F.spark_partition_id().alias("p")).distinct().count() > 20
        assert sorted(map(tuple, lines.collect())) == whole
        assert lines.filter("line_no = 399").first()["line"] == long[399]
    finally:
        for name in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{name}")


def test_fixed_fields_are_computed_once_per_map_and_source(spark, tmp_path):
    path = str(tmp_path / "fx")
    static = spark.createDataFrame([(0, 0.5)], "cell bigint, landfrac double")
    maps = lambda *m: spark.createDataFrame([(x, 0, 0, 1.0) for x in m], "map_id string, src_cell bigint, dst_cell bigint, w double")
    assert sinks.ensure_fx(spark, path, static, maps("a"), "s1").count() == 1
    other = static.withColumn("landfrac", F.lit(1.0))
    rows = {r["map_id"]: r["sftlf"] for r in sinks.ensure_fx(spark, path, other, maps("a", "b"), "s1").collect()}
    assert rows == {"a": 50.0, "b": 100.0}
    assert [r["sftlf"] for r in sinks.ensure_fx(spark, path, other, maps("a"), "s2").collect()] == [100.0]


def test_a_folder_with_most_rows_is_split(spark, tmp_path):
    rows = spark.range(0, 400000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 7)).alias("var"),
        F.lit("mon").alias("freq"), (F.col("id") % 997).cast("int").alias("time_idx"), F.rand(1).alias("value"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        sinks.write_series(rows, str(tmp_path / "s"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "s" / "var=hot" / "freq=mon").glob("*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "s")).count() == 400000


def test_report(spark, tmp_path):
    root = str(tmp_path / "report")
    counts = spark.createDataFrame([(3, 1)], "expected_variables int, missing_variables int")
    logs = spark.createDataFrame([("tas", ["a", "b"])], "variable string, error_lines array<string>")
    sinks.write_report(root, counts, {"log_records": logs})
    assert spark.read.json(f"{root}/validation_summary").first()["expected_variables"] == 3
    row = spark.read.option("header", True).option("escape", "\\").csv(f"{root}/log_records").first()
    assert json.loads(row["error_lines"]) == ["a", "b"]


def test_lines_and_listing(spark, tmp_path):
    (tmp_path / "cmor_20250101T000000Z_tas.log").write_text("x\nError: y")
    lines = tables.read_lines(spark, str(tmp_path / "*.log"))
    assert [(r["file"][-7:], r["line_no"], r["line"]) for r in lines.collect()] == [("tas.log", 0, "x"), ("tas.log", 1, "Error: y")]
    assert tables.list_files(spark, str(tmp_path), "*.log").count() == 1


def test_streamed_slices_equal_the_batch(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    slice_rows(spark, years=(2000, 2001)).write.parquet(src)

    def run():
        stream = live.stream_slices(spark, src, ["time_idx", "cell"], ["TS", "PS"])
        query = live.append_series(stream, out, check, 2000, 2)
        query.awaitTermination()

    run()
    slice_rows(spark, years=(2002,)).write.mode("append").parquet(src)
    run()  # takes only what is new
    rows = lambda df: sorted(map(tuple, df.select("var", "block", "time_idx", "cell", "value").collect()))
    batch = sr.year_blocks(series_rows(spark, years=(2000, 2001, 2002)), 2000, 2002, 2, year())
    assert rows(spark.read.parquet(out)) == rows(batch)


def test_monthly_means_wait_for_late_slices_and_are_amended(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "time_idx int, cell bigint, TS double"
    month = F.floor(F.col("time_idx") / 30)

    def arrive(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = live.stream_slices(spark, src, ["time_idx", "cell"], ["TS"], schema)
        live.append_means(live.monthly_means(stream, month, 1), out, check).awaitTermination()

    got = lambda: {(r.month, r.cell): (r.value, r.n) for r in spark.read.schema("cell bigint, month int, value double, n bigint, var string").parquet(out).collect()}
    arrive((0, 1, 1.0), (29, 1, 3.0), (30, 1, 10.0))
    assert got() == {}, "month 0 may still get slices"
    arrive((5, 1, 8.0), (6, 2, None), (65, 1, 20.0))  # late, but in time
    arrive((95, 1, 30.0), (None, 1, 5.0))
    arrive((125, 1, 40.0))
    assert got()[(0, 1)] == (4.0, 3) and got()[(0, 2)] == (None, 1) and got()[(1, 1)] == (10.0, 1)
    arrive((31, 1, 20.0), (33, 3, 7.0), (190, 1, 0.0))  # too late for month 1
    means = spark.read.parquet(out)
    stored = sr.slices_to_series(spark.read.parquet(src), ["time_idx", "cell"], ["TS"])
    mended = {(r.month, r.cell): (r.value, r.n, r.late) for r in live.amended_means(means, stored, month).collect()}
    assert mended[(1, 1)] == (15.0, 2, 1) and mended[(1, 3)] == (7.0, 1, 1) and mended[(0, 1)] == (4.0, 3, 0)
    batch = stored.filter("time_idx IS NOT NULL").groupBy(month.cast("int").alias("m"), "cell").agg(F.avg("value").alias("v"), F.count("*").alias("n"))
    want = {(r.m, r.cell): (r.v, r.n) for r in batch.collect()}
    assert {k: v[:2] for k, v in mended.items()} == {k: v for k, v in want.items() if k[0] in {m for m, _ in mended}}
