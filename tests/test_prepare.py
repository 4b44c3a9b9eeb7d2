"""The whole way from native fields and a catalog to output rows."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridloom.operators import catalog as ct
from gridloom.operators.catalog import CATALOG_SCHEMA
from gridloom.plans import bindings, prepare_queries
from gridloom.plans import prepare as pp

CELLS, LEVELS = 4, 3


def entry(name, table, sources, dims, formula=None, level=None, variants=None):
    sources = [(s, None, None) if isinstance(s, str) else s for s in sources]
    return (name, table, "1", formula, None, None, None, None, None, None, [dims], sources, (level, None, None, None) if level else None, variants)


@pytest.fixture(scope="module")
def setup(spark):
    latlon = ["time", "lat", "lon"]
    rows = [
        entry("tas_x", "atmos", ["T2M"], latlon),
        entry("pr_x", "atmos", ["A", "B"], latlon, "A + B / C0"),
        entry("mrso_x", "land", ["W", "F"], latlon, "verticalsum(W, capped_at=5) * F"),
        entry("ta_x", "atmos", ["T"], ["time", "plev", "lat", "lon"], level="plev2"),
        entry("tz_x", "atmos", ["T"], ["time", "plev", "lat"], level="plev39"),
        entry("siarea_x", "seaIce", [("ice_d", "ice", "day"), ("ice", None, "mon"), "tarea"], ["time"], None, None,
              [("N", "(ice * tarea / 100.).where(ice.coords['TLAT'] > 0).sum(dim=['nj', 'ni'])", "nh"),
               ("S", "(ice * tarea / 100.).where(ice.coords['TLAT'] < 0).sum(dim=['nj', 'ni'])", "sh")]),
        entry("sos_x", "ocean", ["SO"], ["time", "latitude", "longitude"]),
        entry("ua_x", "atmos", ["T"], ["time", "lev", "lat", "lon"], level="standard_hybrid_sigma"),
        entry("lost_x", "atmos", ["NOPE"], latlon),
        entry("both_x", "atmos", ["A", "B"], latlon),
        entry("odd_x", "atmos", ["A"], latlon, "mystery(A)"),
    ]
    rows[1] = (*rows[1][:11], [("A", None, None), ("B", None, None), ("C", "C0", None)], *rows[1][12:])
    catalog = spark.createDataFrame(rows, CATALOG_SCHEMA)
    surface = {"T2M": lambda c, k: 10.0 * c, "A": lambda c, k: 1.0, "B": lambda c, k: 4.0, "C": lambda c, k: float(c), "ice": lambda c, k: 50.0, "SO": lambda c, k: 35.0, "PS": lambda c, k: 100000.0}
    deep = {"T": lambda c, k: 200.0 + 10 * k, "W": lambda c, k: float(k + 1), "F": lambda c, k: 0.5}
    values = [(n, 0, 0, c, f(c, 0)) for n, f in surface.items() for c in range(CELLS)]
    values += [(n, 0, k, c, f(c, k)) for n, f in deep.items() for c in range(CELLS) for k in range(LEVELS)]
    field = spark.createDataFrame(values, "var string, time_idx int, lev int, cell bigint, value double")
    maps = spark.createDataFrame([("cesm", "r", "conservative", "c"), ("cesm", "r", "bilinear", "b")], "model string, resolution string, method string, map_id string")
    weights = spark.createDataFrame([(m, c, c // 2, 1.0) for m in "cb" for c in range(CELLS)], "map_id string, src_cell bigint, dst_cell bigint, w double")
    static = spark.createDataFrame([(c, c - 1.5, 1e3, [0.5, 1.0, 0.0, 1.0][c]) for c in range(CELLS)], "cell bigint, tlat double, tarea double, landfrac double")
    coefficients = spark.createDataFrame([(k, 0.0, (k + 1) / LEVELS) for k in range(LEVELS)], "lev int, hyam double, hybm double")
    targets = pp.plan_targets(catalog, "cesm", "mon", maps, "r")
    outputs, status = pp.prepare(
        spark, field, targets, weights=weights, static=static, coefficients=coefficients, levels={"plev2": [50000.0, 100000.0], "plev39": [100000.0]}, lon_cells=1
    )
    return outputs, dict(status)


@pytest.fixture(scope="module")
def small_field(spark):
    values = [("A", 0, k, c, float(k + 1)) for k in range(LEVELS) for c in range(CELLS)] + [("S", 0, None, c, 2.0) for c in range(CELLS)]
    return spark.createDataFrame(values, "var string, time_idx int, lev int, cell bigint, value double")


def native_target(name, formula=None, source=None, region=None, **aliases):
    return pp.Target(name, "ocean_native", source, aliases, formula, region, None, None)


def native(spark, field, targets):
    static = spark.createDataFrame([(c, 10.0 * c) for c in range(CELLS)], "cell bigint, landfrac double")
    weights = spark.createDataFrame([], "map_id string, src_cell bigint, dst_cell bigint, w double")
    outputs, status = pp.prepare(spark, field, targets, weights=weights, static=static)
    return outputs["ocean_native"], status


def test_operands_of_both_grains(spark, small_field):
    out, status = native(spark, small_field, [
        native_target("mixed", "A * S", A="A", S="S"), native_target("land", "A + f", A="A", f="landfrac"),
        native_target("flat", "S + f", S="S", f="landfrac"), native_target("beside", "verticalsum(A) - A * S", A="A", S="S"),
        native_target("still", source="landfrac"), native_target("zero", "A / (A - A)", A="A"),
    ])
    assert {s for _, s in status} == {"ok"}
    got = {(r["var"], r["lev"], r["cell"]): r["value"] for r in out.collect()}
    assert {k[1:]: v for k, v in got.items() if k[0] == "mixed"} == {(k, c): 2.0 * (k + 1) for k in range(LEVELS) for c in range(CELLS)}
    assert {k[1:]: v for k, v in got.items() if k[0] == "beside"} == {(k, c): 6.0 - 2.0 * (k + 1) for k in range(LEVELS) for c in range(CELLS)}
    assert got["land", 1, 3] == 32.0 and got["still", None, 2] == 20.0 and got["zero", 0, 0] is None
    assert {k[1:]: v for k, v in got.items() if k[0] == "flat"} == {(None, c): 2.0 + 10 * c for c in range(CELLS)}


def test_targets_that_travel_alike_share_their_scans(spark, small_field, tmp_path):
    small_field.write.parquet(str(tmp_path / "field"))
    stored = spark.read.parquet(str(tmp_path / "field"))
    ways = [("d1", None, "A"), ("d2", None, "S"), ("p1", "A * S", None), ("p2", "A + S", None), ("h1", "verticalsum(A) + S", None), ("h2", "verticalsum(A + S)", None), ("h3", "S * verticalsum(A)", None)]
    out, _ = native(spark, stored, [native_target(n, f, src, A="A", S="S") if f else native_target(n, source=src) for n, f, src in ways])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 3  # direct, plain formulas, helper sums
    assert {r["var"] for r in out.select("var").distinct().collect()} == {n for n, _, _ in ways}


def test_bad_targets_are_reported_and_variants_stay_apart(spark, small_field):
    lost = [pp.Target("no_map", "general", "A", {}, None, None, None, None), pp.Target("no_levels", "general", "A", {}, None, None, "plev19", "m"),
            pp.Target("no_ps", "general", "A", {}, None, None, "alevel", "m"), native_target("unbound", "A + QQ", A="A"), native_target("star", "A + * S", A="A", S="S")]
    good = [native_target("v", "A + S", region="n", A="A", S="S"), native_target("v", "A - S", region="s", A="A", S="S")]
    out, status = native(spark, small_field, lost + good)
    told = dict(status)
    assert told["no_map"] == "no weight map" and "plev19" in told["no_levels"] and "PS" in told["no_ps"]
    assert "QQ" in told["unbound"] and "readable" in told["star"] and told["v"] == "ok"
    assert {(r["region"], r["value"]) for r in out.filter("lev = 0").collect()} == {("n", 3.0), ("s", -1.0)}


def test_every_output_grid_is_planned(spark):
    both = entry("sos_x", "ocean", ["SO"], ["time", "latitude", "longitude"])
    both = (*both[:10], [["time", "latitude", "longitude"], ["time", "lat", "lon"]], *both[11:])
    planned = pp.plan_targets(spark.createDataFrame([both], CATALOG_SCHEMA), "cesm")
    assert {t.route for t in planned} == {"ocean_native", "general"} and {t.name for t in planned} == {"sos_x"}


def rows(df, name):
    return df.filter(F.col("var") == name).collect()


def test_status_of_every_target(setup):
    _, status = setup
    assert {n for n, s in status.items() if s == "ok"} == {"tas_x", "pr_x", "mrso_x", "ta_x", "tz_x", "siarea_x", "sos_x", "ua_x"}
    assert "NOPE" in status["lost_x"] and "incomplete" in status["both_x"] and "mystery" in status["odd_x"]


def test_direct_and_formula_targets_are_regridded(setup):
    out = setup[0]["general"]
    assert {r["cell"]: r["value"] for r in rows(out, "tas_x")} == {0: 5.0, 1: 25.0}
    # cell 0 divides by zero and is missing, so destination 0 rests on cell 1 alone
    assert {r["cell"]: r["value"] for r in rows(out, "pr_x")} == {0: 5.0, 1: pytest.approx((3.0 + 1 + 4 / 3) / 2)}
    # weighted by land fraction and divided back: the value over land
    assert {r["value"] for r in rows(out, "mrso_x")} == {2.5}


def test_pressure_targets(setup):
    out = setup[0]["general"]
    got = {(r["cell"], r["plev"]): r["value"] for r in rows(out, "ta_x")}
    assert got == {(c, p): pytest.approx(v) for c in (0, 1) for p, v in ((50000.0, 205.0), (100000.0, 220.0))}
    zonal = {(r["ilat"], r["plev"]): r["value"] for r in rows(setup[0]["zonal_pressure"], "tz_x")}
    assert zonal == {(0, 100000.0): pytest.approx(220.0), (1, 100000.0): pytest.approx(220.0)}


def test_hybrid_targets_carry_their_levels(setup):
    assert {(r["cell"], r["lev"]): r["value"] for r in setup[0]["hybrid"].collect()} == {(c, k): 200.0 + 10 * k for c in (0, 1) for k in range(LEVELS)}
    # Surface pressure once per time and cell, coefficients once per level.
    assert {(r["var"], r["cell"], r["lev"], r["value"]) for r in setup[0]["hybrid_ps"].collect()} == {("ps", c, None, 100000.0) for c in (0, 1)}
    assert {tuple(r) for r in setup[0]["hybrid_levels"].select("lev", "a", "b", "p0").collect()} == {(k, 0.0, (k + 1) / LEVELS, 100000.0) for k in range(LEVELS)}


def test_described_outputs_have_times_and_names(setup, spark):
    catalog = spark.createDataFrame([("tas_x", "K", "temperature", None), ("sftlf", "%", None, "land")], "name string, units string, long_name string, standard_name string")
    axis = spark.createDataFrame([(0, 15.0, 0.0, 30.0)], "time_idx int, time double, time_b0 double, time_b1 double")
    fx = spark.createDataFrame([(0, 50.0), (1, None)], "cell bigint, sftlf double")
    out = pp.described(setup[0], catalog, axis, fx)
    assert {(r["units"], r["long_name"], r["time"], r["time_b0"], r["time_b1"]) for r in rows(out["general"], "tas_x")} == {("K", "temperature", 15.0, 0.0, 30.0)}
    assert {(r["var"], r["cell"], r["value"], r["units"], r["standard_name"]) for r in out["fx"].collect()} == {("sftlf", 0, 50.0, "%", "land"), ("sftlf", 1, None, "%", "land")}
    late = axis.withColumn("time_idx", F.lit(7))
    with pytest.raises(Exception, match="no time bounds for time 0"):
        pp.described({"general": setup[0]["general"]}, catalog, late)["general"].collect()


def test_native_targets_stay_on_their_cells(setup):
    ice = {r["region"]: r["value"] for r in setup[0]["seaice_native"].collect()}
    assert ice == {"nh": 1000.0, "sh": 1000.0}
    assert {r["cell"] for r in rows(setup[0]["ocean_native"], "sos_x")} == set(range(CELLS))


def test_outputs_are_written(setup, spark, tmp_path):
    facets = dict(zip(("mip_era", "activity_id", "institution_id", "source_id", "experiment_id", "variant_label"), "eaisxv")) | {"frequency": "mon"}
    pp.write_outputs(setup[0], str(tmp_path / "tree"), facets)
    back = spark.read.parquet(str(tmp_path / "tree"))
    labels = {(r["variable_id"], r["grid_label"]) for r in back.select("variable_id", "grid_label").distinct().collect()}
    assert ("ps", "gr") in labels and spark.read.parquet(str(tmp_path / "tree_levels")).count() == LEVELS
    assert ("sos", "gn") in labels and ("tas", "gr") in labels and ("siarea", "gn") in labels
    assert {r["region"] for r in back.filter("variable_id = 'siarea'").collect()} == {"nh", "sh"}


def test_targets_follow_the_request(spark):
    rows = [(3, *entry("c_x", "atmos", ["C"], ["time"])), (1, *entry("a_x", "atmos", ["A"], ["time"])), (2, *entry("b_x", "atmos", ["B"], ["time"])),
            (4, *entry("h_x", "land", ["H"], ["time", "lev"])), (5, *entry("d_x", "atmos", [("D", None, "day")], ["time"]))]
    catalog = spark.createDataFrame(rows, "ord int, " + CATALOG_SCHEMA)
    request = spark.createDataFrame([("c_x", 1, "later"), ("c_x", 0, "first"), ("d_x", 2, "d"), ("z_x", 3, "z")], "name string, ord int, parameter string")
    planned = pp.plan_targets(catalog, "cesm", "mon", request=request)
    assert [(t.name, t.parameter, t.synthetic) for t in planned] == [("a_x", "a_x", True), ("b_x", "b_x", True), ("c_x", "first", False), ("h_x", "h_x", True)]
    assert [t.name for t in pp.plan_targets(catalog, "cesm", "mon", request=request, requested_only=True)] == ["c_x"]
    assert [(t.name, t.parameter) for t in pp.plan_targets(catalog, "cesm", "mon")] == [("a_x", None), ("b_x", None), ("c_x", None), ("h_x", None)]
    field = spark.createDataFrame([(n, 0, k, 0, 1.0) for n in "ABCH" for k in (0, 1)], "var string, time_idx int, lev int, cell bigint, value double")
    weights = spark.createDataFrame([], "map_id string, src_cell bigint, dst_cell bigint, w double")
    _, status = pp.prepare(spark, field, planned, weights=weights, static=field.select("cell").distinct())
    assert dict(status)["h_x"] == "hybrid sigma coordinates are only supported for atmosphere tables" and dict(status)["a_x"] == "no weight map"


def described_native(spark, levels, when="1851-03-01"):
    latlon = ["time", "latitude", "longitude"]
    rows = [entry("sos_x", "ocean", ["SO"], ["time", "olevel", *latlon[1:]]), entry("siconc_x", "seaIce", ["I"], latlon), entry("siarea_x", "seaIce", ["I"], ["time"])]
    catalog = spark.createDataFrame(rows, CATALOG_SCHEMA)
    schema = "var string, time_idx int, lev int, cell bigint, value double"
    ocean = spark.createDataFrame([("sos_x", 0, k, c, 1.0) for k in (0, 1) for c in (0, 1)] + [("other_x", 0, 7, 0, 1.0)], schema)
    ice = spark.createDataFrame([("siconc_x", 0, None, 0, 1.0), ("siconc_x", 0, None, 5, 1.0), ("siarea_x", 0, None, None, 2.0)], schema)
    grid = spark.createDataFrame([(0, 80.0, 10.0, [79.0, 81.0])], "cell bigint, TLAT double, TLON double, latt_bounds array<double>")
    axis = spark.createDataFrame([(0, when)], "time_idx int, d string").select("time_idx", *[F.to_date("d").alias(c) for c in ("time", "time_b0", "time_b1")])
    return pp.described({"ocean_native": ocean, "seaice_native": ice}, catalog, axis, ice_grid=grid, levels=levels)


def test_native_rows_have_grid_depth_and_dates(spark):
    depths = spark.createDataFrame([(0, 5.0, 0.0, 10.0), (1, 20.0, 10.0, 30.0)], "lev int, level double, level_b0 double, level_b1 double")
    out = described_native(spark, {"olevel": depths, "sdepth": depths.limit(0)})
    sea = {(r["var"], r["lev"], r["cell"]): (r["level_kind"], r["level"], r["level_b1"], r["time"]) for r in out["ocean_native"].collect()}
    year = 365.0 + 59  # no leap day before March
    assert sea == {("sos_x", k, c): ("olevel", v, b, year) for k, v, b in ((0, 5.0, 10.0), (1, 20.0, 30.0)) for c in (0, 1)} | {("other_x", 7, 0): (None, None, None, year)}
    ice = {(r["var"], r["cell"]): (r["TLAT"], r["TLON"], r["latt_bounds"], r["level"]) for r in out["seaice_native"].collect()}
    assert ice == {("siconc_x", 0): (80.0, 10.0, [79.0, 81.0], None), ("siconc_x", 5): (None, None, None, None), ("siarea_x", None): (None, None, None, None)}
    assert "TLAT" not in out["ocean_native"].columns
    with pytest.raises(Exception, match="no coordinate for level 1 of sos_x"):
        described_native(spark, {"olevel": depths.filter("lev = 0")})["ocean_native"].collect()


def test_sheet_to_outputs_with_index_sums(spark):
    """A sheet's index sums reduce the dimension their variable implies, all the way to field rows."""
    blank = {c: F.lit("") for c in ("formula", "units", "freq", "alias", "levels_name", "levels_units", "levels_axis", "levels_bounds")}
    sheet = spark.createDataFrame([("x_x", "seaIce", "FATES_A_PF(1:2) - PCT_LANDUNIT(3)", "time")], "name string, table string, source_expr string, dims string").withColumns(blank)
    catalog = ct.sheet_to_catalog(sheet)
    for column in ("positive", "cell_methods", "regrid_method", "long_name", "standard_name", "region"):
        catalog = catalog.withColumn(column, F.lit(None).cast("string"))
    catalog = catalog.withColumn("variants", F.lit(None).cast("array<struct<long_name:string,formula:string,region:string>>"))
    rows = [("FATES_A_PF", 0, None, p, None, c, 10.0 ** p) for p in range(3) for c in (0, 1)] + [("PCT_LANDUNIT", 0, None, None, t, c, float(t)) for t in range(4) for c in (0, 1)]
    rows += [("FATES_FRAC", 0, None, None, None, c, 0.5) for c in (0, 1)]
    field = spark.createDataFrame(rows, "var string, time_idx int, lev int, fates_levpft int, ltype int, cell bigint, value double")
    weights = spark.createDataFrame([], "map_id string, src_cell bigint, dst_cell bigint, w double")
    targets = pp.plan_targets(catalog, "cesm", "mon")
    dims = {"FATES_A_PF": ["fates_levpft"], "PCT_LANDUNIT": ["ltype"]}
    out, status = pp.prepare(spark, field, targets, weights=weights, static=field.select("cell").distinct(), dims=dims)
    assert status == [("x_x", "ok")]
    assert {(r["cell"], r["value"]) for r in out["seaice_native"].collect()} == {(c, (1.0 + 10.0 - 2.0) * 0.5) for c in (0, 1)}


def test_time_axis_is_read_without_the_field(spark):
    data = "/root/testdata/sf0.001"
    if not Path(data).is_dir():
        pytest.skip("test tables are not here")
    found = prepare_queries.months(spark, data)
    assert "l_suppkey" not in found._jdf.queryExecution().executedPlan().toString()
    want = bindings.native(spark, data).select("time_idx").distinct()
    assert sorted(r[0] for r in found.collect()) == sorted(r[0] for r in want.collect())
