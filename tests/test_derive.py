import pytest
from pyspark.sql import functions as F

from gridloom.operators import derive as dv

FIELD = "var string, time_idx int, lev int, cell bigint, value double"


def field_of(spark, **values):
    rows = [(name, 0, lev, 0, v) for name, column in values.items() for lev, v in enumerate(column)]
    return spark.createDataFrame(rows, FIELD)


def by_lev(df):
    return {r["lev"]: r["value"] for r in df.collect()}


def test_formula_over_shared_points(spark):
    field = field_of(spark, A=[1.0, None, 3.0], B=[2.0, 2.0])
    got = by_lev(dv.realize_formula(field, "t", "A + B", {"A": "A", "B": "B"}))
    assert got == {0: 3.0, 1: None}  # level 2 exists in one of them only


def test_alias_picks_the_source(spark):
    field = field_of(spark, siconc=[50.0], siconc_d=[100.0])
    assert by_lev(dv.realize_formula(field, "t", "siconc / 100.", {"siconc": "siconc_d"})) == {0: 1.0}


def test_zero_divisor_and_missing_inputs(spark):
    field = field_of(spark, A=[1.0], B=[0.0])
    assert by_lev(dv.realize_formula(field, "t", "A/B", {"A": "A", "B": "B"})) == {0: None}
    with pytest.raises(KeyError, match="C"):
        dv.realize_formula(field, "t", "A + C", {"A": "A", "C": "C"}, available=("A", "B"))


def test_sums_over_levels(spark):
    field = field_of(spark, v=[1.0, None, 5.0])
    assert dv.vertical_sum(field).first()["value"] == 6.0
    assert dv.vertical_sum(field, cap=4).first()["value"] == 4.0
    assert dv.vertical_sum(field_of(spark, v=[None, None])).first()["value"] == 0.0
    assert dv.sum_over_index(field, [1, 3]).first()["value"] == 6.0
    assert dv.index_select(field, 2).first()["value"] == 5.0
    with pytest.raises(ValueError):
        dv.sum_over_index(field, [])
    with pytest.raises(ValueError):
        dv.sum_over_index(field, [1], dim="pft")


def test_lowered_formulas():
    low = dv.lower_formula("(X - sumoverpft(Y, pftlist=[1, 2], dimname='fates_levpft'))*F  #note")
    assert low.sql == "(X - _s0)*F" and low.steps[0].indices == (1, 2) and low.names() == {"X", "F", "Y"}
    low = dv.lower_formula("verticalsum(SOILICE + SOILLIQ, capped_at=5000)")
    assert low.sql == "_s0" and low.steps[0].cap == 5000.0 and low.steps[0].expr == "SOILICE + SOILLIQ"
    low = dv.lower_formula("1-P[:,0,:,:]-P[:,1,:,:]")
    assert low.sql == "1-_s0-_s1" and [s.indices for s in low.steps] == [(0,), (1,)]
    low = dv.lower_formula("(area.where(conc > 15., 0.0)).where(conc.coords['TLAT'] < 0).sum(dim=['nj', 'ni'])")
    assert low.region == "sh" and "CASE WHEN conc > 15. THEN area ELSE 0.0 END" in low.sql


def test_unreadable_formulas_are_named():
    problem = lambda f: dv.formula_problem(dv.lower_formula(f))
    assert problem("A + B") is None and problem("(A - B)/C") is None
    assert "helper" in problem("mystery(A)")
    assert problem("A + * B (") is not None


def test_steps(spark):
    field = field_of(spark, Y=[1.0, 2.0, 4.0], F=[0.5, 0.5, 0.5])
    low = dv.lower_formula("(sumoverpft(Y, pftlist=[1, 3], dimname='lev') + Y[:,1,:,:]) * F")
    assert dv.realize_steps(field, "t", low, ["Y", "F"]).first()["value"] == pytest.approx(3.5)


def test_steps_with_an_operand_without_levels(spark):
    rows = [("Y", 0, k, c, float(k)) for k in (1, 2, 3) for c in (0, 1)] + [("F", 0, None, 0, 0.5)]
    field = spark.createDataFrame(rows, FIELD)
    low = dv.lower_formula("sumoverpft(Y, pftlist=[1, 3], dimname='lev') * F")
    out = dv.realize_steps(field, "t", low, ["Y", "F"], first=1).collect()
    assert [(r["cell"], r["value"]) for r in out] == [(0, 2.0)]  # cell 1 has no fraction


def test_each_formula_needs_only_its_own_inputs(spark):
    field = field_of(spark, A=[1.0, 2.0], B=[3.0], C=[4.0, None])
    out = dv.realize_formulas(field, {"ab": "A + B", "ac": "A * C"}, ["A", "B", "C"])
    assert sorted(((r["var"], r["lev"], r["value"]) for r in out.collect()), key=str) == [("ab", 0, 4.0), ("ac", 0, 4.0), ("ac", 1, None)]


def sea_ice(spark):
    """4 x 4 grid with latitudes -30, -10, 10, 30, concentration 50 percent at two times."""
    static = spark.createDataFrame([(c, [-30.0, -10.0, 10.0, 30.0][c // 4], 1e10) for c in range(16)], "cell bigint, tlat double, tarea double")
    field = spark.createDataFrame([(t, c, 50.0) for t in range(2) for c in range(16)], "time_idx int, cell bigint, value double")
    return field, static


def test_hemispheres(spark):
    field, static = sea_ice(spark)
    regions = lambda df: {(r["time_idx"], r["region"]): r["value"] for r in df.collect()}
    assert set(regions(dv.hemisphere_area(field, static)).values()) == {4e10}
    assert set(regions(dv.hemisphere_extent(field, static)).values()) == {8e10}
    assert set(regions(dv.hemisphere_extent(field, static, threshold=60)).values()) == {0.0}
    assert set(regions(dv.hemisphere_total(field, static)).values()) == {8 * 50e10}
    south = static.filter("tlat < 0")
    assert regions(dv.hemisphere_area(field, south))[(0, "nh")] == 0.0


def test_regional_formula(spark):
    field, static = sea_ice(spark)
    low = dv.lower_formula("(siconc * tarea / 100.).where(siconc.coords['TLAT'] > 0).sum(dim=['nj', 'ni'])")
    named = field.withColumn("var", F.lit("siconc"))
    rows = dv.realize_regional(named, static, "siarea", low, ["siconc"]).collect()
    assert {(r["time_idx"], r["region"], r["value"]) for r in rows} == {(0, "nh", 4e10), (1, "nh", 4e10)}


def test_first_dataset_wins_whole_variables(spark):
    first, second = field_of(spark, a=[1.0], b=[2.0]), field_of(spark, b=[9.0, 9.0], c=[3.0])
    rows = sorted((r["var"], r["value"]) for r in dv.merge_first_wins([first, second]).collect())
    assert rows == [("a", 1.0), ("b", 2.0), ("c", 3.0)]


def test_attributes(spark):
    rows = spark.createDataFrame([("a", "x", None), ("z", "y", "own")], "var string, units string, long_name string")
    entries = spark.createDataFrame([("a", "K", "cat", "std")], "name string, units string, long_name string, standard_name string")
    got = {r["var"]: (r["units"], r["long_name"], r["standard_name"]) for r in dv.attach_attributes(rows, entries).collect()}
    assert got == {"a": ("K", "cat", "std"), "z": ("y", "own", None)}


def test_dimension_names(spark):
    df = spark.createDataFrame([(0, 1, 2)], "levsoi int, xh int, yh int")
    assert dv.rename_dimensions(df).columns == ["sdepth", "longitude", "latitude"]


def test_sums_over_levels_hold_no_partial_sums_ahead_of_the_exchange(spark):
    """Rows of a column lie in as many places as it has levels, so partial sums there are as many as the rows."""
    rows = [("T", 0, lev, cell, float(lev * 10 + cell)) for lev in range(1, 5) for cell in range(3)] + [("T", 0, 1, 9, None)]
    field = spark.createDataFrame(rows, "var string, time_idx int, lev int, cell long, value double")
    first_is = lambda df: df._jdf.queryExecution().executedPlan().toString()
    sums = dv.sums_over_indices(field, {"low": [1, 2], "high": [4]}, "lev", first=1)
    total = dv.vertical_sum(field, cap=101)
    for df in (sums, total):
        assert first_is(df).index("partial_sum") < first_is(df).index("Exchange")  # the partial sum is above the exchange
    assert {(r["cell"], r["low"], r["high"]) for r in sums.collect()} == {(0, 30.0, 40.0), (1, 32.0, 41.0), (2, 34.0, 42.0), (9, 0.0, 0.0)}
    assert {(r["cell"], r["value"]) for r in total.collect()} == {(0, 100.0), (1, 101.0), (2, 101.0), (9, 0.0)}
    # Sums over more than the dimension may meet one hot key, and keep their partial sums.
    wide = dv.vertical_sum(field, keys=("var", "time_idx"))
    assert first_is(wide).rindex("partial_sum") > first_is(wide).index("Exchange")
    assert wide.first()["value"] == 312.0
