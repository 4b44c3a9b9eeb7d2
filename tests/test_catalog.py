import json

import pytest
from pyspark.sql import functions as F

from gridloom.operators import catalog as ct
from gridloom.operators import series as sr
from gridloom.sources import tables as src

YAML = """
dataset_overrides: {source_id: M}
variables:
  tas_tavg-h2m-hxy-u:
    table: CMIP7_atmos
    units: K
    dims: [time, lat, lon]
    sources: [{model_var: TREFHT}]
  siarea_tavg-u-hm-u:
    table: seaIce
    units: m2
    dims: [time]
    sources: [{alias: siconc, freq: day, model_var: siconc_d}, {freq: mon, model_var: siconc}, {model_var: tarea}]
    variants:
      - {formula: siconc * tarea, long_name: North, region: nh}
      - {formula: siconc - tarea, long_name: South, region: sh}
  pr_tavg-u-hxy-u:
    table: atmos
    units: kg m-2 s-1
    dims: [time, lat, lon]
    formula: PRECC + PRECL
    sources: [{model_var: PRECC}, {model_var: PRECL}]
  ta_tavg-p19-hxy-air:
    table: atmos
    units: K
    dims: [time, plev, lat, lon]
    levels: {name: plev19, units: Pa}
    sources: [{model_var: T}]
  ua_tavg-al-hxy-u:
    table: atmos
    units: m s-1
    dims: [time, lev, lat, lon]
    levels: {name: standard_hybrid_sigma, units: '1', src_axis_name: lev, src_axis_bnds: ilev}
    sources: [{model_var: U}]
  sos_tavg-u-hxy-sea:
    table: ocean
    units: '1'
    dims: [[time, latitude, longitude], [time, lat, lon]]
    sources: [{model_var: sos}]
"""


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("catalog") / "one.yaml"
    path.write_text(YAML)
    return src.read_catalog(spark, str(path))


def entry(catalog, short):
    return catalog.filter(F.startswith("name", F.lit(short)))


def names(df, column="model_var"):
    return [s[column] for s in df]


def test_entries_keep_their_nesting(catalog):
    rows = {r["name"].split("_")[0]: r for r in catalog.collect()}
    assert len(rows) == 6 and rows["sos"]["dims"] == [["time", "latitude", "longitude"], ["time", "lat", "lon"]]
    assert rows["siarea"]["variants"][1]["region"] == "sh" and rows["ta"]["levels"]["name"] == "plev19"
    assert ct.split_targets(entry(catalog, "sos")).count() == 2


def test_bad_catalog_file(spark, tmp_path):
    (tmp_path / "bad.yaml").write_text("nothing: here")
    with pytest.raises(Exception, match="variables"):
        src.read_catalog(spark, str(tmp_path / "bad.yaml")).collect()


@pytest.mark.parametrize("freq, expected", [("day", ["siconc_d", "tarea"]), ("mon", ["siconc", "tarea"]), ("yr", ["tarea"]), (None, ["siconc_d", "siconc", "tarea"])])
def test_sources_for_freq(catalog, freq, expected):
    row = entry(catalog, "siarea").select(ct.sources_for_freq(F.col("sources"), freq).alias("s")).first()
    assert names(row["s"]) == expected


def test_tagged_sources_without_match_fall_back_to_all(spark):
    df = spark.createDataFrame([([("a", None, "day"), ("b", None, "mon")],)], "sources array<struct<model_var:string,alias:string,freq:string>>")
    assert names(df.select(ct.sources_for_freq(F.col("sources"), "yr").alias("s")).first()["s"]) == ["a", "b"]
    assert df.select(ct.supports_freq(F.col("sources"), "yr").alias("s")).first()["s"] is False
    assert df.select(ct.supports_freq(F.col("sources"), "day").alias("s")).first()["s"] is True


def test_variants_and_aliases(catalog):
    rows = ct.expand_variants(entry(catalog, "siarea")).orderBy("variant").collect()
    assert [(r["variant"], r["region"], r["long_name"]) for r in rows] == [(0, "nh", "North"), (1, "sh", "South")]
    day = ct.normalize_catalog(ct.expand_variants(entry(catalog, "siarea")), "day").first()
    assert day["source_aliases"] == {"siconc": "siconc_d", "tarea": "tarea"} and day["source"] is None


def test_normalized_entries(spark, catalog):
    rows = {r["name"].split("_")[0]: r for r in ct.normalize_catalog(catalog).collect()}
    assert rows["tas"]["table"] == "atmos" and rows["tas"]["source"] == "TREFHT" and rows["tas"]["raw_variables"] is None
    assert rows["pr"]["raw_variables"] == ["PRECC", "PRECL"]
    with pytest.raises(Exception, match="no sources"):
        ct.normalize_catalog(entry(catalog, "tas").withColumn("sources", F.filter("sources", lambda s: F.lit(False)))).collect()


def test_required_inputs(spark, catalog):
    needs = {}
    for r in ct.required_inputs(catalog).collect():
        needs.setdefault(r["name"].split("_")[0], set()).add(r["var"])
    static = {"area", "landmask", "landfrac", "TLAT"}
    assert needs["tas"] == static | {"TREFHT"}
    assert needs["ta"] == static | {"T", "PS", "hyam", "hybm", "P0"}
    assert needs["ua"] == static | {"U", "PS", "hyam", "hybm", "hyai", "hybi", "P0", "ilev"}
    asked = spark.createDataFrame([("tas_tavg-h2m-hxy-u",), ("unknown",)], "name string")
    assert [r["var"] for r in ct.required_variables(catalog, asked).collect()] == sorted(static | {"TREFHT"})


def test_files_by_variable_token(spark):
    files = spark.createDataFrame([("/d/cam.h0.TS.0001-01.nc",), ("/d/cam.h0.TAS.001.nc",), ("/d/TS.nc",), ("/d/x.TS.001.nc",)], "path string")
    wanted = spark.createDataFrame([("TS",)], "var string")
    assert {r["path"] for r in ct.select_files(files, wanted).collect()} == {"/d/cam.h0.TS.0001-01.nc", "/d/x.TS.001.nc"}
    assert {r["path"] for r in ct.select_files(files, wanted, ".001.").collect()} == {"/d/x.TS.001.nc"}


def test_targets_need_every_source(spark, catalog):
    have = spark.createDataFrame([("PRECC",), ("TREFHT",)], "var string")
    left = {r["name"].split("_")[0] for r in ct.drop_targets_without_inputs(catalog, have).collect()}
    assert left == {"tas"}


def test_assembled_targets(spark, catalog):
    asked = spark.createDataFrame([("pr_tavg-u-hxy-u", 2, "pr"), ("pr_tavg-u-hxy-u", 1, "first")], "name string, ord int, parameter string")
    rows = {r["name"].split("_")[0]: r for r in ct.assemble_targets(catalog, asked).collect()}
    assert (rows["pr"]["parameter"], rows["pr"]["is_synthetic"]) == ("first", False)
    assert rows["tas"]["is_synthetic"] and rows["tas"]["parameter"] == "tas_tavg-h2m-hxy-u"


def test_routes_and_levels(spark):
    def way(dims, realm, model, level=None):
        lit = F.array(*[F.lit(x) for x in dims])
        return spark.range(1).select(ct.route(lit, F.lit(realm), model, F.lit(level)).alias("r")).first()["r"]

    assert way(["time", "latitude", "longitude"], "ocean", "cesm") == "ocean_native"
    assert way(["time", "latitude", "longitude"], "land", "cesm") == "general"
    assert way(["time"], "seaIce", "cesm") == "seaice_native"
    assert way(["time", "nj", "ni"], "seaIce", "cesm") == "general"
    assert way(["time", "nj", "ni"], "seaIce", "noresm") == "seaice_native"
    assert way(["time", "plev", "lat"], "atmos", "cesm", "plev39") == "zonal_pressure"
    kind = lambda d, n, r: spark.range(1).select(ct.level_kind(F.array(*[F.lit(x) for x in d]), F.lit(n), F.lit(r)).alias("k")).first()["k"]
    assert kind(["lev"], None, "atmosChem") == "hybrid" and kind(["plev"], "plev7h", "atmos") == "plev7h" and kind(["z_l"], None, "ocean") == "z_l"
    with pytest.raises(Exception, match="hybrid sigma"):
        kind(["lev"], None, "land")


def test_request_rows(spark):
    rows = [("a", 1, "atmos", "mon", "x", "glb"), ("a", 0, "atmos", "mon", "x", None), ("b", 2, "atmos", "mon", "x", "30S-90S"), ("c", 3, "land", "mon", "x", "glb")]
    request = spark.createDataFrame(rows, "name string, ord int, realm string, frequency string, experiment string, region string")
    kept = ct.request_filter(request, "atmos", "mon", "x")
    assert sorted((r["name"], r["ord"]) for r in kept.collect()) == [("a", 0), ("a", 1)]
    assert [(r["name"], r["ord"]) for r in ct.restrict_to_names(request, ["c", "a"]).collect()] == [("a", 0), ("c", 3)]


def test_catalog_survives_the_sheet(spark, catalog):
    """Entry to flat rows, back to entries: the same content."""
    flat = ct.catalog_to_rows(catalog)
    back = ct.group_catalog_rows(ct.sheet_to_catalog(flat.withColumn("ord", F.col("variant"))).drop("variant"))
    had, got = ({r["name"]: r for r in df.collect()} for df in (catalog, back))
    assert set(had) == set(got)
    for name, row in had.items():
        other = got[name]
        assert other["sources"] == row["sources"] and other["levels"] == row["levels"] and other["units"] == row["units"]
        assert [list(d) for d in other["dims"]] == [list(d) for d in row["dims"]]
        assert (other["formula"] or None) == row["formula"] and other["variants"] == row["variants"]


def test_only_sea_ice_rows_become_variants(spark):
    rows = [("a", 0, "land", "x", "f", "r"), ("a", 1, "land", "y", "g", "s"), ("i", 0, "seaIce", "n", "f", "nh"), ("i", 1, "seaIce", "s", "g", "sh")]
    out = {r["name"]: r for r in ct.group_catalog_rows(spark.createDataFrame(rows, "name string, ord int, table string, long_name string, formula string, region string")).collect()}
    assert out["a"]["formula"] == "f" and out["a"]["variants"] is None
    assert out["i"]["formula"] is None and [v["region"] for v in out["i"]["variants"]] == ["nh", "sh"]


def test_gap_and_merge(spark):
    request = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "name string")
    tables = spark.createDataFrame([("b", "land"), ("z", "atmos")], "name string, table string")
    entries = spark.createDataFrame([("a",)], "name string")
    gap = ct.catalog_gap(request, tables, entries)
    assert {(r["name"], r["table"], r["kind"]) for r in gap.collect()} == {("b", "land", "stub"), ("c", None, "not_in_tables")}
    meta = spark.createDataFrame([("a", "pa", 1, "[x]"), ("b", "pb", 2, "[y]")], "name string, parameter string, priority int, experiments string")
    merged = {r["name"]: (r["is_stub"], r["parameter"]) for r in ct.merge_catalog_rows(entries, gap.filter("kind = 'stub'").select("name", "table"), meta).collect()}
    assert merged == {"a": (False, "pa"), "b": (True, "pb")}


def test_tables_json(spark, tmp_path):
    body = {"long_name": "Temp", "units": "K", "dimensions": ["time", "lat"], "modeling_realm": "ocnBgchem ocean"}
    (tmp_path / "CMIP7_atmos.json").write_text(json.dumps({"Header": {}, "variable_entry": {"tas": body, "fx": body | {"dimensions": "longitude latitude", "modeling_realm": ""}}}))
    (tmp_path / "CMIP7_zland.json").write_text(json.dumps({"variable_entry": {"tas": body | {"long_name": "later"}}}))
    (tmp_path / "CMIP7_grids.json").write_text(json.dumps({"variable_entry": {"skipped": body}}))
    rows = {r["name"]: r for r in src.read_tables(spark, str(tmp_path / "*.json")).collect()}
    assert set(rows) == {"tas", "fx"}
    assert (rows["tas"]["long_name"], rows["tas"]["table_id"], rows["tas"]["table"]) == ("later", "zland", "ocnBgchem")
    assert rows["fx"]["dims"] == ["longitude", "latitude"] and rows["fx"]["table"] == "atmos"
    level = lambda *d: spark.range(1).select(ct.stub_levels(F.array(*[F.lit(x) for x in d])).alias("l")).first()["l"]
    assert (level("time", "plev19"), level("time", "alevel"), level("time")) == ("plev19", "standard_hybrid_sigma", None)


def test_requested_levels(spark):
    text = lambda *v: json.dumps({"axis_entry": {"plev3": {"requested": list(v)}, "other": {"units": "1"}}})
    rows = [("/t/CMIP6_coordinate.json", text("1", "2")), ("/t/CMIP7_coordinate.json", text("90000.", "70000.", "50000."))]
    tables = spark.createDataFrame(rows, "path string, value string")
    assert src.requested_levels(tables, "plev3") == [90000.0, 70000.0, 50000.0]
    assert src.requested_levels(tables.limit(1), "plev3") == [1.0, 2.0]
    with pytest.raises(KeyError):
        src.requested_levels(tables, "plev19")
    with pytest.raises(FileNotFoundError):
        src.requested_levels(tables.filter("false"), "plev3")


def test_patterns(spark):
    assert sr.include_patterns(sr.fixed.HISTORY_PATTERNS, "noresm", "land", "3hr") == ["clm2.h2a"]
    with pytest.raises(ValueError):
        sr.include_patterns(sr.fixed.HISTORY_PATTERNS, "cesm", "land", "3hr")
    files = spark.createDataFrame([("/a/x.cice.h.0001.nc",), ("/a/x.cice.h1.0001.nc",)], "path string")
    table = sr.pattern_table(spark).filter("realm = 'seaIce' and model = 'cesm'")
    assert {(r["pattern"], r["files"]) for r in sr.pattern_counts(files, table).collect()} == {("cice.h.", 1), ("cice.h1.", 1)}


def test_latest_month(spark):
    files = lambda *n: spark.createDataFrame([(f"/d/{x}",) for x in n], "path string")
    row = sr.latest_month(files("a.2001-02.nc", "b.2001-11.nc", "c.2001-11.nc", "d.2001-13.nc", "e.2002-01.txt")).first()
    assert (row["path"], row["year"], row["month"]) == ("/d/c.2001-11.nc", 2001, 11)
    assert sr.latest_month(files("nothing.txt")).count() == 0
    with pytest.raises(Exception, match="mixed"):
        sr.latest_month(files("a.2001-02.nc", "b.200103.nc")).collect()
