import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.operators import regrid as rg


def field_of(spark, values, time=0):
    return spark.createDataFrame([("v", time, 0, c, v) for c, v in enumerate(values)], "var string, time_idx int, lev int, cell bigint, value double")


def weights_of(spark, entries):
    return spark.createDataFrame(entries, "src_cell bigint, dst_cell bigint, w double")


def by_cell(df):
    return {r["cell"]: r["value"] for r in df.collect()}


def test_missing_sources_are_left_out_of_the_mean(spark):
    entries = weights_of(spark, [(0, 0, 1.0), (1, 0, 3.0), (2, 1, 1.0), (0, 2, 0.5), (2, 2, 0.5)])
    got = by_cell(rg.regrid(field_of(spark, [4.0, 8.0, None]), entries))
    assert got == {0: 7.0, 1: None, 2: 4.0}


def test_tiny_valid_weight_counts_as_missing(spark):
    got = by_cell(rg.regrid(field_of(spark, [4.0, None]), weights_of(spark, [(0, 0, 1e-7), (1, 0, 1.0)])))
    assert got == {0: None}


def test_dense_grid_lists_every_cell_once(spark):
    out = rg.regrid(field_of(spark, [1.0, 2.0]), weights_of(spark, [(0, 1, 1.0), (1, 3, 1.0)]))
    assert by_cell(rg.regrid_dense(out, 5)) == {0: None, 1: 1.0, 2: None, 3: 2.0, 4: None}


def test_land_field_is_divided_back_and_ocean_is_not(spark):
    entries = weights_of(spark, [(0, 0, 1.0), (1, 0, 1.0), (2, 1, 1.0)])
    fraction = spark.createDataFrame([(0, 1.0), (1, None), (2, 0.0)], "cell bigint, fraction double")
    land = spark.createDataFrame([(0, 0.5), (1, 0.0)], "cell bigint, fraction double")
    values = field_of(spark, [6.0, 9.0, 5.0])
    assert by_cell(rg.regrid_masked(values, entries, fraction)) == {0: 3.0, 1: 0.0}
    assert by_cell(rg.regrid_masked(values, entries, fraction, destination_fraction=land)) == {0: 6.0, 1: None}


def test_land_and_sea_add_up(spark):
    static = spark.createDataFrame([(0, 0.25), (1, None), (2, 1.0)], "cell bigint, landfrac double")
    out = rg.fx_fractions(static, weights_of(spark, [(0, 0, 1.0), (1, 0, 1.0), (2, 1, 2.0)])).collect()
    assert {r["cell"]: (r["sftlf"], r["sftof"]) for r in out} == {0: (12.5, 87.5), 1: (100.0, 0.0)}


def test_fraction_names_and_scale(spark):
    percent = spark.createDataFrame([(0, 40.0), (1, 130.0)], "cell bigint, landmask double")
    assert by_cell(rg.land_percent(percent)) == {0: 40.0, 1: 100.0}
    ocean = spark.createDataFrame([(0, 0.5)], "cell bigint, ocnfrac double")
    assert by_cell(rg.sea_percent(ocean)) == {0: 0.5}  # only wet is tested for the scale
    wet = spark.createDataFrame([(0, 0.5)], "cell bigint, wet double")
    assert by_cell(rg.sea_percent(wet)) == {0: 50.0}
    with pytest.raises(KeyError):
        rg.land_percent(wet)


def test_area_of_the_whole_sphere(spark):
    lat = [(-90.0 + 30 * j, -60.0 + 30 * j) for j in range(6)]
    rows = [(j * 8 + i, *lat[j], 45.0 * i, 45.0 * (i + 1)) for j in range(6) for i in range(8)]
    grid = spark.createDataFrame(rows, "cell bigint, lat_b0 double, lat_b1 double, lon_b0 double, lon_b1 double")
    total = rg.cell_area(grid).agg(F.sum("areacella")).first()[0]
    assert total == pytest.approx(4 * 3.141592653589793 * 6371000.0**2)


def test_pick_map(spark):
    maps = spark.createDataFrame(
        [("m", "r", "conservative", "c"), ("m", "r", "bilinear", "b"), ("m", "q", "conservative", "c2")],
        "model string, resolution string, method string, map_id string",
    )
    entries = spark.createDataFrame([("tas_tavg-h2m-hxy-u", None), ("pr_tavg-u-hxy-u", None), ("ta", "conservative")], "name string, regrid_method string")
    names = lambda df: {r["name"].split("_")[0]: r["map_id"] for r in df.collect()}
    assert names(rg.pick_map(entries, maps, "m", "r")) == {"tas": "b", "pr": "c", "ta": "c"}
    assert names(rg.pick_map(entries, maps, "m", "r", "bilinear")) == {"tas": "b", "pr": "b", "ta": "b"}
    assert names(rg.pick_map(entries, maps, "m", "q"))["tas"] == "c2"
    for bad in (("x", "r", None), ("m", "q", "bilinear")):
        with pytest.raises(LookupError):
            rg.pick_map(entries, maps, *bad)
    with pytest.raises(ValueError):
        rg.pick_map(entries, maps, "m", "r", "nearest")


def test_time_bounds_must_match(spark):
    out = field_of(spark, [1.0], time=1).unionByName(field_of(spark, [1.0], time=2))
    axis = lambda *t: spark.createDataFrame([(x, x - 0.5, x + 0.5) for x in t], "time_idx int, time_b0 double, time_b1 double")
    good = rg.attach_time_bounds(out, axis(1, 2), out_times=out.select("time_idx")).collect()
    assert {(r["time_idx"], r["time_b0"], r["time_b1"]) for r in good} == {(1, 0.5, 1.5), (2, 1.5, 2.5)}
    with pytest.raises(ValueError):
        rg.attach_time_bounds(out, axis(1, 2, 3), out_times=out.select("time_idx"))
    with pytest.raises(Exception, match="no time bounds"):
        rg.attach_time_bounds(out, axis(1)).collect()


def test_attached_fields_do_not_replace_own_ones(spark):
    out = spark.createDataFrame([(0, 1.0), (1, None)], "cell bigint, sftlf double")
    fx = spark.createDataFrame([(0, 9.0, 5.0), (1, 8.0, 6.0)], "cell bigint, sftlf double, orog double")
    rows = {r["cell"]: (r["sftlf"], r["orog"]) for r in rg.attach_fixed_fields(out, fx, ("sftlf", "orog", "absent")).collect()}
    assert rows == {0: (1.0, 5.0), 1: (8.0, 6.0)}


def test_regular_grid_passes_or_fails(spark):
    regular = spark.createDataFrame([(0, 0, 1.0)], "lat int, lon int, value double")
    assert rg.pass_through_regular(regular) is regular
    with pytest.raises(KeyError):
        rg.pass_through_regular(field_of(spark, [1.0]))


def test_hot_cell_without_broadcast_gives_the_same(spark, monkeypatch):
    """A third of all rows on one cell, and weights past the broadcast limit."""
    rows = spark.range(30000).select(
        F.lit("v").alias("var"), F.col("id").cast("int").alias("time_idx"), F.lit(0).alias("lev"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("long").alias("cell"), F.col("id").cast("double").alias("value"),
    )
    entries = weights_of(spark, [(c, d, float(d + 1)) for c in range(50) for d in range(3)])
    hinted = sorted(map(tuple, rg.regrid(rows, entries).collect()))
    monkeypatch.setattr("gridloom.operators.regrid.small", lambda df: df.hint("merge"))
    assert sorted(map(tuple, rg.regrid(rows, entries).collect())) == hinted


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    value=st.floats(-1e6, 1e6),
    entries=st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.floats(0.01, 5.0)), min_size=1, max_size=15),
)
def test_constant_field_stays_constant(spark, value, entries):
    got = by_cell(rg.regrid(field_of(spark, [value] * 6), weights_of(spark, entries)))
    assert got and all(v == pytest.approx(value, rel=1e-9, abs=1e-6) for v in got.values())


def test_dense_grid_in_blocks(spark):
    rows = spark.createDataFrame([("a", 0, 0, 1, 5.0), ("a", 0, 0, 9, 7.0)], "var string, time_idx int, lev int, cell bigint, value double")
    for block in (2, 3, 100):
        out = {r["cell"]: r["value"] for r in rg.regrid_dense(rows, 11, block=block).collect()}
        assert out == {c: {1: 5.0, 9: 7.0}.get(c) for c in range(11)}
