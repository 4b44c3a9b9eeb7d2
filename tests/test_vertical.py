import numpy as np
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.operators import vertical as vt

FIELD = "var string, time_idx int, lev int, cell bigint, value double, hyam double, hybm double, ps double"


def column_of(spark, pressures, values, cell=0):
    """One column whose level pressures are given through the A coefficient."""
    rows = [("v", 0, k, cell, v, p / 100000.0, 0.0, 101325.0) for k, (p, v) in enumerate(zip(pressures, values))]
    return spark.createDataFrame(rows, FIELD)


def profile(df):
    return {r["plev"]: r["value"] for r in df.collect()}


def test_linear_between_levels_and_missing_outside(spark):
    got = profile(vt.to_pressure(column_of(spark, [10000.0, 50000.0, 90000.0], [1.0, 5.0, 7.0]), [5000.0, 10000.0, 30000.0, 70000.0, 90000.0, 95000.0]))
    assert got == {5000.0: None, 10000.0: 1.0, 30000.0: 3.0, 70000.0: 6.0, 90000.0: 7.0, 95000.0: None}


def test_missing_levels_make_their_segments_missing(spark):
    got = profile(vt.to_pressure(column_of(spark, [10000.0, 50000.0, 90000.0], [1.0, None, 7.0]), [10000.0, 30000.0, 50000.0, 70000.0, 90000.0]))
    assert got == {10000.0: 1.0, 30000.0: None, 50000.0: None, 70000.0: None, 90000.0: 7.0}


def test_every_column_has_every_level(spark):
    both = column_of(spark, [10000.0, 50000.0], [1.0, 2.0]).unionByName(column_of(spark, [20000.0], [4.0], cell=1))
    no_ps = column_of(spark, [10000.0, 50000.0], [1.0, 2.0], cell=2).withColumn("ps", F.lit(None).cast("double"))
    rows = vt.to_pressure(both.unionByName(no_ps), [20000.0, 60000.0]).collect()
    assert sorted((r["cell"], r["plev"], r["value"]) for r in rows if r["cell"] != 0) == [(1, 20000.0, 4.0), (1, 60000.0, None), (2, 20000.0, None), (2, 60000.0, None)]
    assert len(rows) == 6


def test_missing_inputs_are_named(spark):
    field = column_of(spark, [1.0], [1.0]).drop("hyam", "hybm", "ps")
    with pytest.raises(KeyError, match="ps"):
        vt.join_column_inputs(field, spark.createDataFrame([(0, 0)], "time_idx int, cell bigint"), spark.createDataFrame([(0, 0.1, 0.2)], "lev int, hyam double, hybm double"))


def test_log_method(spark):
    got = profile(vt.to_pressure(column_of(spark, [10000.0, 100000.0], [0.0, 1.0]), [31622.776601683792], method="log"))
    assert list(got.values())[0] == pytest.approx(0.5)
    with pytest.raises(ValueError):
        vt.to_pressure(column_of(spark, [1.0], [1.0]), [1.0], method="cubic")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(100, 100000), min_size=2, max_size=12, unique=True), st.randoms(use_true_random=False))
def test_agrees_with_numpy_inside_the_column(spark, pressures, rnd):
    pressures = sorted(float(p) for p in pressures)
    values = [rnd.uniform(-50, 50) for _ in pressures]
    targets = sorted({rnd.uniform(50, 110000) for _ in range(8)})
    got = profile(vt.to_pressure(column_of(spark, pressures, values), targets))
    exact = [p / 100000.0 * 100000.0 for p in pressures]
    for level in targets:
        if exact[0] <= level <= exact[-1]:
            assert got[level] == pytest.approx(np.interp(level, exact, values), abs=1e-9)
        else:
            assert got[level] is None


def layers(spark, interfaces, values):
    rows = [("v", 0, 0, k, a, b, v) for k, (a, b, v) in enumerate(zip(interfaces, interfaces[1:], values))]
    return spark.createDataFrame(rows, "var string, time_idx int, cell bigint, k int, z0 double, z1 double, value double")


def test_depth_bins(spark):
    rows = vt.remap_depth(layers(spark, [0.0, 10.0, 20.0, 20.0, 40.0], [1.0, 3.0, 99.0, 5.0]), [(0.0, 10.0), (5.0, 15.0), (15.0, 30.0), (50.0, 60.0)]).collect()
    got = {r["olevel"]: r["value"] for r in rows}
    assert got == {0: 1.0, 1: 2.0, 2: pytest.approx((0.5 * 3 + 0.5 * 5) / 1.0), 3: None}


def test_depth_bins_by_overlap_and_missing_layers(spark):
    data = layers(spark, [0.0, 10.0, 30.0], [1.0, 4.0])
    overlap = vt.remap_depth(data, [(0.0, 30.0)], weighting="overlap").first()["value"]
    assert overlap == pytest.approx((10 * 1 + 20 * 4) / 30)
    missing = vt.remap_depth(layers(spark, [0.0, 10.0, 20.0], [2.0, None]), [(0.0, 20.0)]).first()["value"]
    assert missing == 1.0  # the missing layer keeps its weight


def depth_rows(spark, bins, weighting="native", column=([0.0, 10.0, 20.0, 20.0, 40.0], [1.0, 3.0, 99.0, 5.0])):
    table = spark.createDataFrame([(0, i, *b) for i, b in enumerate(bins)] + [(77, 0, 0.0, 1.0)], "cell bigint, olevel int, b0 double, b1 double")
    data = layers(spark, *column)
    assert {r["cell"] for r in data.select("cell").distinct().collect()} == {0}
    return {r["olevel"]: r["value"] for r in vt.remap_depth_by_column(data, table, weighting=weighting).collect()}


def test_bins_of_a_column(spark):
    bins = [(-5.0, 0.0), (0.0, 10.0), (10.0, 10.0), (12.0, 30.0), (50.0, 60.0), (None, 3.0)]
    assert depth_rows(spark, bins) == {0: None, 1: 1.0, 2: None, 3: pytest.approx((0.8 * 3 + 0.5 * 5) / 1.3), 4: None, 5: None}
    assert depth_rows(spark, bins, "overlap")[3] == pytest.approx((8 * 3 + 10 * 5) / 18)
    assert depth_rows(spark, [(0.0, 20.0)], column=([0.0, 10.0, 20.0], [2.0, None])) == {0: 1.0}


def test_bins_of_a_column_equal_fixed_bins(spark):
    rng = random.Random(2)
    for _ in range(3):
        edges = sorted({rng.randrange(0, 400) / 4 for _ in range(12)})
        bins = list(zip(edges, edges[1:], strict=False))[:: rng.choice((1, 2))]
        faces = sorted({rng.randrange(0, 400) / 4 for _ in range(9)})
        column = (faces, [rng.choice((None, 1.0, 2.5, 8.0)) for _ in faces[1:]])
        want = {r["olevel"]: r["value"] for r in vt.remap_depth(layers(spark, *column), bins).collect()}
        assert depth_rows(spark, bins, column=column) == {k: v if v is None else pytest.approx(v) for k, v in want.items()}


def test_bins_that_meet_are_an_error(spark):
    with pytest.raises(Exception, match="bins of a column overlap"):
        depth_rows(spark, [(0.0, 10.0), (5.0, 15.0)])


def test_interfaces_to_layers(spark):
    faces = spark.createDataFrame([(0, 0, k, z) for k, z in enumerate([0.0, 5.0, 15.0])], "time_idx int, cell bigint, k int, z double")
    assert sorted((r["k"], r["z0"], r["z1"]) for r in vt.layers_from_interfaces(faces).collect()) == [(0, 0.0, 5.0), (1, 5.0, 15.0)]


def test_zonal_mean_skips_missing(spark):
    rows = [("v", 0, 100.0, c, v) for c, v in enumerate([1.0, None, 3.0, None, None, None])]
    out = vt.zonal_mean(spark.createDataFrame(rows, "var string, time_idx int, plev double, cell bigint, value double"), 3)
    assert {r["ilat"]: r["value"] for r in out.collect()} == {0: 2.0, 1: None}


def test_level_tables(spark):
    table = spark.createDataFrame([(0, 500.0)], "k int, lev double")
    assert vt.rescale_levels(table).first()["lev"] == 0.5
    faces = spark.createDataFrame([(0, 0.0), (1, 1.0)], "k int, ilev double")
    row = vt.attach_vertical_meta(table, faces, F.lit(1e5)).first()
    assert (row["b0"], row["b1"], row["P0"]) == (0.0, 1.0, 1e5)
    bounds = spark.createDataFrame([(k, float(k), k + 1.0) for k in range(20)], "k int, b0 double, b1 double")
    assert vt.truncate_bounds(table, bounds).count() == 1
