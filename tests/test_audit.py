import pytest
from pyspark.sql import functions as F

from gridloom.operators import audit as au


def test_logs(spark):
    name = "cmor_20250101T000000Z_{}.log"
    rows = [(name.format("tas"), i, f" Error: number {i}\t") for i in range(12)] + [(name.format("tas"), 12, "run completed")]
    rows += [(name.format("pr"), 0, "all finished"), (name.format("x"), 0, "nothing"), ("notes.txt", 0, "Error: not a log")]
    lines = spark.createDataFrame(rows, "file string, line_no int, line string")
    got = {r["variable"]: r for r in au.log_rollup(lines).collect()}
    assert set(got) == {"tas", "pr", "x"}
    assert got["tas"]["has_error"] and got["tas"]["has_success"] and got["tas"]["error_count"] == 12
    assert not got["pr"]["has_error"] and got["pr"]["error_count"] == 0 and not got["x"]["has_success"]
    assert sorted((r["line_no"], r["line"]) for r in au.log_errors(lines).collect()) == [(i, f"Error: number {i}") for i in range(12)]
    assert sorted(r["line_no"] for r in au.log_errors(lines, first=10).collect()) == list(range(10))
    expected = spark.createDataFrame([("pr",)], "name string")
    assert [r["variable"] for r in au.log_rollup(lines, expected=expected).collect()] == ["pr"]


def test_first_lines_are_cut_before_the_shuffle(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("g"), "id")
    plan = au.top_per_group(rows, ["g"], ["id"], 5)._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange")[-1]
    assert "WindowGroupLimit" in below
    assert sorted(r["id"] for r in au.top_per_group(rows, ["g"], ["id"], 2).collect()) == [0, 1, 2, 3]


def paths(spark, *values):
    return spark.createDataFrame([(p,) for p in values], "path string")


def test_inventory(spark):
    base = "CMIP/INST/M3/hist/r1/{}/mon/tas/tavg-h2m-hxy-u/gr/{}.nc"
    listed = paths(spark, base.format("glb", "a"), base.format("nh", "b"), base.format("glb", "c").replace("INST", "OTHER"), "CMIP/INST/short.nc")
    assert {r["region"] for r in au.produced_inventory(listed, institution="INST").collect()} == {"glb", "nh"}
    assert au.produced_inventory(listed).count() == 3 and au.produced_inventory(listed, member="r2").count() == 0
    expected = spark.createDataFrame([("pr_tavg-u-hxy-u",)], "name string")
    assert au.produced_inventory(listed, expected=expected).count() == 0


def test_dimension_inventory(spark):
    rows = [("tas", f"/p/{i}", "time, lat, lon", "b1", "gr", "tas", i) for i in (3, 1, 2, 0)]
    out = au.dimension_inventory(spark.createDataFrame(rows, "variable string, path string, dims string, branding string, grid string, data_var string, sizes int")).first()
    assert out["dims"] == ["time, lat, lon"] and out["sample_sizes"] == [0, 1, 2, 3] and out["sample_path"] == "/p/0"


def test_expected_missing_and_counts(spark):
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "name string")
    entries = names("a", "b", "c")
    assert {r["name"] for r in au.expected_variables(entries).collect()} == {"a", "b", "c"}
    expected = au.expected_variables(entries, names("a", "b", "z"))
    assert {r["name"] for r in au.expected_variables(entries, names("a", "b"), names("b")).collect()} == {"b"}
    assert [r["name"] for r in au.missing_variables(expected, names("b")).collect()] == ["a"]
    logs = spark.createDataFrame([("a", True), ("a", True), ("b", False)], "variable string, has_error boolean")
    counts = au.audit_counts(expected, names("b", "b"), logs, names("q")).first()
    assert tuple(counts) == (2, 1, 1, 1, 1)


def test_unmapped(spark):
    rows = [("No mapping for tas_x in /a/b",), ("Variable pr processed with status: ERROR cesm input variable not found.",), ("Source variable(s) not found for ua, skipping",), ("fine",)]
    got = au.unmapped_from_log(spark.createDataFrame(rows, "line string")).collect()
    assert sorted((r["kind"], r["name"]) for r in got) == [("no_input", "pr"), ("no_input", "ua"), ("no_mapping", "tas_x")]


def test_means(spark):
    rows = [("v", t, lev, c, float(10 * t + c) if c else None) for t in range(2) for lev in range(2) for c in range(3)]
    field = spark.createDataFrame(rows, "var string, time_idx int, lev int, cell int, value double")
    assert {r["time_idx"]: r["value"] for r in au.spatial_mean_series(field).collect()} == {0: 1.5, 1: 11.5}
    assert {r["cell"]: r["value"] for r in au.time_mean_map(field).collect()} == {0: None, 1: 6.0, 2: 7.0}
    with pytest.raises(ValueError):
        au.time_mean_map(field, spatial=("lat",))


def test_lines_of_whole_texts(spark):
    texts = spark.createDataFrame([(1, "a\nb\n")], "doc int, text string")
    assert [(r["line_no"], r["line"]) for r in au.split_lines(texts, "doc").collect()] == [(0, "a"), (1, "b"), (2, "")]
