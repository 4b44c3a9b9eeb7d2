"""Entry points as whole plans: series, audit, catalog sheet."""

import json

import pytest

from gridloom.operators.catalog import CATALOG_SCHEMA
from gridloom.plans import chains
from gridloom.sources import sinks

PATTERNS = {"m": {"atmos": {"mon": ["cam.h0a"], "day": ["cam.h1a"]}}}


def slices(spark, root, name, years, value):
    rows = [(y * 12 + m, c, value) for y in years for m in range(2) for c in range(3)]
    spark.createDataFrame(rows, "time_idx int, cell bigint, TS double").coalesce(1).write.mode("overwrite").parquet(str(root / f"run.{name}"))
    for part in (root / f"run.{name}").glob("part-*.parquet"):
        part.rename(root / f"run.{name}.{years[0]}.parquet")


def test_series_of_a_realm(spark, tmp_path):
    raw, out = tmp_path / "hist", str(tmp_path / "series")
    raw.mkdir()
    slices(spark, raw, "cam.h0a", (2000, 2001), 1.0)
    slices(spark, raw, "other", (2000,), 9.0)
    run = lambda **kw: chains.generate_series(spark, str(raw), out, "m", "atmos", patterns=PATTERNS, years=(2000, 2003, 2), **kw)
    assert run() == ["cam.h0a"]
    slices(spark, raw, "cam.h0a", (2000, 2001, 2002), 2.0)
    values = lambda: {(r["block"], r["freq"], r["value"]) for r in spark.read.parquet(out).select("block", "freq", "value").distinct().collect()}
    run()
    assert values() == {(2000, "mon", 1.0), (2002, "mon", 2.0)}
    run(overwrite=True)
    assert values() == {(2000, "mon", 2.0), (2002, "mon", 2.0)}
    whole = str(tmp_path / "whole")
    chains.generate_series(spark, str(raw), whole, "m", "atmos", patterns=PATTERNS)
    assert spark.read.parquet(whole).count() == 18
    with pytest.raises(ValueError, match="no patterns"):
        chains.generate_series(spark, str(raw), out, "m", "land", patterns=PATTERNS)


def test_report_is_written(spark, tmp_path):
    catalog = spark.createDataFrame([("a_x",), ("b_x",)], "name string")
    produced = spark.createDataFrame([("b_x", "b", "p")], "name string, variable string, path string")
    lines = spark.createDataFrame([("cmor_20240101T000000Z_a_x.log", 0, "Error: no input"), ("cmor_20240101T000000Z_a_x.log", 1, "fine")], "file string, line_no int, line string")
    summary, report = chains.audit_report(catalog, produced, lines)
    assert summary.first().asDict() == {"expected_variables": 2, "produced_variables": 1, "variables_with_log_errors": 1, "missing_variables": 1, "inspection_errors": 0}
    assert [r["name"] for r in report["missing_variables"].collect()] == ["a_x"]
    assert report["log_errors"].count() == 1
    sinks.write_report(str(tmp_path), summary, report)
    assert spark.read.option("header", True).csv(str(tmp_path / "expected_variables")).count() == 2


def test_report_has_sizes_of_all_paths(spark):
    names = spark.createDataFrame([("tas_x",)], "name string")
    lines = spark.createDataFrame([], "file string, line_no int, line string")
    rows = [("tas_x", "tas", f"/p/{i}", "time, lat", "x", "gr", "tas", i) for i in (4, 1, 3, 0, 2)]
    opened = spark.createDataFrame(rows, "name string, variable string, path string, dims string, branding string, grid string, data_var string, sizes int")
    _, report = chains.audit_report(names, opened.select("name", "variable", "path"), lines, inspected=opened)
    assert report["dimension_inventory"].first()["sample_sizes"] == [0, 1, 2]
    assert sorted((r["variable"], r["path"], r["sizes"]) for r in report["dimension_sizes"].collect()) == [("tas", f"/p/{i}", i) for i in range(5)]


def test_sheet_has_entries_and_stubs(spark):
    entry = ("a", "atmos", "K", None, None, None, None, None, None, None, [["time", "lat", "lon"]], [("T", None, None)], None, None)
    catalog = spark.createDataFrame([entry], CATALOG_SCHEMA)
    request = spark.createDataFrame([("a", "e1", 1, "pa"), ("b", "e1", 2, "pb"), ("b", "e2", 1, "pb"), ("c", "e1", 3, "pc")], "name string, experiment string, priority int, parameter string")
    definitions = spark.createDataFrame([("b", "land", "1", ["time", "plev19", "lat"]), ("d", "land", "1", [])], "name string, table string, units string, dims array<string>")
    rows, unknown = chains.merged_sheet(catalog, request, definitions)
    got = {r["name"]: (r["is_stub"], r["priority"], r["experiments"], r["levels_name"], json.loads(r["dims"])) for r in rows.collect()}
    assert got == {"a": (False, 1, ["e1"], "", ["time", "lat", "lon"]), "b": (True, 1, ["e1", "e2"], "plev19", ["time", "plev19", "lat"])}
    assert [r["name"] for r in unknown.collect()] == ["c"]
