import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.operators import axes as ax


def axis_of(spark, values, axis_id=0, name="v"):
    return spark.createDataFrame([(axis_id, i, v) for i, v in enumerate(values)], f"axis_id int, i bigint, {name} double")


def bounds(df):
    return [(r["b0"], r["b1"]) for r in df.orderBy("i").collect()]


@pytest.mark.parametrize("block", [1, 2, 65536])
def test_latitude_bounds(spark, block):
    got = bounds(ax.bounds_from_centers(axis_of(spark, [10.0, 20.0, 30.0]), "lat", block=block))
    assert got == [(5.0, 15.0), (15.0, 25.0), (25.0, 35.0)]
    assert bounds(ax.bounds_from_centers(axis_of(spark, [-60.0, 0.0, 60.0]), "lat", block=block)) == [(-90.0, -30.0), (-30.0, 30.0), (30.0, 90.0)]


def test_latitude_limits_and_single_points(spark):
    poles = bounds(ax.bounds_from_centers(axis_of(spark, [-89.5, 0.0, 89.5]), "lat"))
    assert poles[0][0] == -90.0 and poles[-1][1] == 90.0
    assert bounds(ax.bounds_from_centers(axis_of(spark, [45.0]), "lat")) == [(44.5, 45.5)]


def test_longitudes_are_contiguous(spark):
    got = bounds(ax.bounds_from_centers(axis_of(spark, [1.25 + 2.5 * i for i in range(144)]), "lon", block=16))
    assert got[0][0] == 0.0 and got[-1][1] == 360.0
    assert all(a[1] == b[0] for a, b in zip(got, got[1:]))
    wrapped = bounds(ax.bounds_from_centers(axis_of(spark, [180.0, 270.0, 0.0]), "lon"))
    assert wrapped[-1][1] == 360.0


def test_pressure_bounds_end_at_50(spark):
    assert bounds(ax.bounds_from_centers(axis_of(spark, [1000.0, 100.0]), "plev"))[-1] == (550.0, 50.0)


@pytest.mark.parametrize("block", [2, 65536])
def test_roll(spark, block):
    axis = axis_of(spark, [180.0, 270.0, 0.0, 90.0])
    shifts = ax.roll_shift(axis, block=block)
    assert tuple(shifts.first()) == (0, 4, 2)
    assert [r["v"] for r in ax.roll_to_monotonic(axis, shifts).orderBy("i").collect()] == [0.0, 90.0, 180.0, 270.0]
    steady = axis_of(spark, [0.0, 90.0])
    assert ax.roll_shift(steady).first()["shift"] == 0


def test_dateline(spark):
    df = spark.createDataFrame([(0, 0, 2.0, 9.0), (0, 1, 10.0, 20.0), (0, 2, 20.0, 355.0), (1, 0, 5.0, 6.0)], "axis_id int, i bigint, b0 double, b1 double")
    got = {(r["axis_id"], r["i"]): (r["b0"], r["b1"]) for r in ax.dateline_fix(df).collect()}
    assert got == {(0, 0): (0.0, 10.0), (0, 1): (10.0, 20.0), (0, 2): (20.0, 360.0), (1, 0): (5.0, 6.0)}


def nudged(values, direction):
    """The stated rule, one point after the other."""
    out, sign = list(values), 1.0 if direction == "increasing" else -1.0
    for i in range(1, len(out)):
        before, here = out[i - 1], out[i]
        if before is not None and here is not None and not sign * here > sign * before:
            out[i] = before + sign * 1e-12
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.one_of(st.none(), st.integers(-3, 3).map(lambda x: x / 2)), min_size=1, max_size=25),
    st.sampled_from(["increasing", "decreasing"]),
    st.sampled_from([1, 3, 7, 65536]),
)
def test_monotone_by_blocks_matches_the_rule(spark, values, direction, block):
    got = [r["v"] for r in ax.make_strictly_monotonic(axis_of(spark, values), direction, block=block).orderBy("i").collect()]
    for a, b in zip(got, nudged(values, direction)):
        assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, abs=3e-12))
    for a, b in zip(got, got[1:]):
        assert a is None or b is None or (a < b if direction == "increasing" else a > b)


@pytest.mark.parametrize("values, expected", [([1, 2, 3], True), ([3, 2, 1], True), ([1, 2, 2, 3], False), ([3, 2, 2, 1], False), ([5], True), ([1, None, 3], False)])
def test_is_strictly_monotonic(spark, values, expected):
    axis = axis_of(spark, [None if v is None else float(v) for v in values])
    assert ax.is_strictly_monotonic(axis, block=2).first()["monotonic"] is expected


def sigma(spark, mid, faces, block=65536, check="raise"):
    level = spark.createDataFrame([(0, k, *[mid[c][k] for c in mid]) for k in range(len(next(iter(mid.values()))))], "axis_id int, k bigint, " + ", ".join(f"{c} double" for c in mid))
    edge = spark.createDataFrame(
        [(0, k, *[faces[c][k] for c in faces]) for k in range(len(next(iter(faces.values()))))] if faces else [],
        "axis_id int, k bigint" + "".join(f", {c} double" for c in faces),
    )
    return ax.sigma_axis(level, edge, block=block, check=check).orderBy("k").collect()


@pytest.mark.parametrize("block", [2, 65536])
def test_sigma_from_interfaces(spark, block):
    rows = sigma(spark, {"hybm": [0.1, 0.3, 0.6, 0.9]}, {"hybi": [0.0, 0.2, 0.4, 0.7, 1.0]}, block)
    assert [(r["sigma"], r["b0"], r["b1"]) for r in rows] == [(0.1, 0.0, 0.2), (0.3, 0.2, 0.4), (0.6, 0.4, 0.7), (0.9, 0.7, 1.0)]


def test_sigma_bounds_synthesised(spark):
    rows = sigma(spark, {"hybm": [0.2, 0.5, 0.8]}, {})
    assert (rows[0]["b0"], rows[-1]["b1"]) == (0.0, 1.0) and rows[1]["b0"] == pytest.approx(0.35)
    not_sigma = sigma(spark, {"hybm": [0.2, 0.5, 0.8]}, {"ilev": [0.0, 400.0, 600.0, 1000.0]})
    assert not_sigma[1]["b0"] == pytest.approx(0.35)
    from_ilev = sigma(spark, {"lev": [0.2, 0.5, 0.8]}, {"ilev": [0.0, 0.4, 0.6, 1.0]})
    assert [r["b1"] for r in from_ilev] == [0.4, 0.6, 1.0]


def test_sigma_made_monotone_and_checked(spark):
    rows = sigma(spark, {"hybm": [0.1, 0.3, 0.2, 0.9]}, {"hybi": [0.0, 0.2, 0.4, 0.7, 1.0]})
    values = [r["sigma"] for r in rows]
    assert values == sorted(values) and len(set(values)) == 4
    with pytest.raises(Exception, match="sigma axis"):
        sigma(spark, {"hybm": [0.1, 1.5]}, {"hybi": [0.0, 0.5, 1.0]})
    with pytest.raises(Exception, match="sigma axis"):
        sigma(spark, {"lev": [100.0, 500.0]}, {"hybi": [0.0, 0.5, 1.0]})
    assert not sigma(spark, {"hybm": [0.1, 0.5]}, {"hybi": [0.0, 0.5]}, check="flag")[0]["valid"]


def test_interfaces_and_corners(spark):
    faces = spark.createDataFrame([(0, k, z) for k, z in enumerate([0.0, 5.0, 15.0])], "axis_id int, k bigint, z double")
    assert sorted((r["b0"], r["b1"]) for r in ax.interface_bounds(faces, block=1).collect()) == [(0.0, 5.0), (5.0, 15.0)]
    corners = spark.createDataFrame([(0, j, i, float(3 * j + i)) for j in range(3) for i in range(3)], "axis_id int, j int, i int, v double")
    cells = {(r["j"], r["i"]): (r["b0"], r["b1"]) for r in ax.corner_bounds(corners).collect()}
    assert cells == {(0, 0): (0.0, 4.0), (0, 1): (1.0, 5.0), (1, 0): (3.0, 7.0), (1, 1): (4.0, 8.0)}
    holed = corners.withColumn("v", F.when(F.col("v") != 0, F.col("v")))
    assert ax.corner_bounds(holed).filter("j = 0 and i = 0").first()["b0"] == 1.0


def test_random_corners_match_numpy(spark):
    grid = np.random.default_rng(1).normal(size=(5, 5))
    corners = spark.createDataFrame([(0, j, i, float(grid[j, i])) for j in range(5) for i in range(5)], "axis_id int, j int, i int, v double")
    for r in ax.corner_bounds(corners).collect():
        box = grid[r["j"] : r["j"] + 2, r["i"] : r["i"] + 2]
        assert (r["b0"], r["b1"]) == (box.min(), box.max())


def test_supergrid(spark):
    grid = spark.createDataFrame([(j, i, -10.0 + i) for j in range(3) for i in range(3)], "j int, i int, lon double")
    rows = ax.supergrid_split(grid).collect()
    assert [(r["kind"], r["j"], r["i"], r["lon"]) for r in rows if r["kind"] == "center"] == [("center", 0, 0, 351.0)]
    assert len(rows) == 5


def test_index_axis_in_buckets(spark):
    points = spark.createDataFrame([(0, v) for v in [5, 3, 3, 90, 41, 7]], "axis_id int, v int")
    plain = sorted(map(tuple, ax.index_axis(points, "v").collect()))
    assert plain == sorted(map(tuple, ax.index_axis(points, "v", bucket=F.floor(F.col("v") / 10)).collect()))
    assert [i for _, _, i in plain] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("cast", ["double", "string", "date"])
def test_index_axis_by_sampled_bounds(spark, cast):
    """Two thirds of the points on one axis, repeats, NULL values and a NULL axis: the same numbers as one window gives."""
    n = F.col("id")
    values = {"double": (n * 37 % 1009) / 8.0, "string": (n * 37 % 1009).cast("string"), "date": F.date_add(F.lit("2000-01-01").cast("date"), (n * 37 % 1009).cast("int"))}
    points = spark.range(3000).select(F.when(n % 3 != 0, 0).when(n % 2 == 0, n % 5).alias("axis_id"), F.when(n % 97 != 0, values[cast]).alias("v"))
    order = lambda df: sorted(map(tuple, df.collect()), key=repr)
    plain = order(ax.index_axis(points, "v"))
    distinct = points.distinct()
    bounds = ax.value_bounds(distinct, "v", 100)
    assert len(bounds) > 5 and bounds == sorted(set(bounds)) and bounds == ax.value_bounds(distinct.repartition(3), "v", 100)
    assert order(ax.index_axis(points, "v", size=100)) == plain
    buckets = {r["b"]: r["count"] for r in distinct.withColumn("b", ax.bucket_of(F.col("v"), bounds)).groupBy("b").count().collect()}
    assert set(buckets) == set(range(len(bounds) + 1)) and max(buckets.values()) < 6 * 100


def test_buckets_are_found_by_halving(spark):
    for count in (1, 2, 3, 7, 8, 9):
        bounds = [10 * k for k in range(1, count + 1)]
        rows = spark.createDataFrame([(v,) for v in [None, *range(0, 10 * count + 15, 5)]], "v int").select("v", ax.bucket_of(F.col("v"), bounds).alias("b")).collect()
        assert all(r["b"] == (0 if r["v"] is None else sum(b <= r["v"] for b in bounds)) for r in rows)
