"""Formulas over variables with dimensions of their own, against numpy arrays that broadcast by name."""

import numpy as np
import pytest

from gridloom.operators import derive as dv
from gridloom.operators import named_dims as nd
from gridloom.operators.catalog import CATALOG_SCHEMA
from gridloom.plans import prepare as pp

SCHEMA = "var string, time_idx int, cell bigint, soil int, pft int, value double"
SHAPES = {"S": ("soil",), "P": ("pft",), "X": ("soil", "pft"), "F": ()}
SIZES = {"soil": 3, "pft": 4}


@pytest.fixture(scope="module")
def arrays():
    rng = np.random.default_rng(1)
    made = {n: rng.integers(1, 9, (2, 2, *[SIZES[d] for d in shape])).astype(float) for n, shape in SHAPES.items()}
    made["X"][0, 0, 1, 2] = np.nan
    return made


def field_of(spark, arrays, leave=lambda name, point: False):
    rows = []
    for name, values in arrays.items():
        for at, v in np.ndenumerate(values):
            point = dict(zip(("t", "c", *SHAPES[name]), at, strict=True))
            if not leave(name, point):
                rows.append((name, point["t"], point["c"], point.get("soil"), point.get("pft"), None if np.isnan(v) else float(v)))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def run(field, **formulas):
    lowered = {t: dv.lower_formula(text) for t, text in formulas.items()}
    names = {t: sorted(low.names()) for t, low in lowered.items()}
    return {(r["var"], r["time_idx"], r["cell"], r["soil"], r["pft"]): r["value"] for r in nd.realize_named(field, lowered, names, SHAPES).collect()}


def test_each_helper_reduces_the_dimension_it_names(spark, arrays):
    s, p, f = arrays["S"], arrays["P"], arrays["F"]
    got = run(field_of(spark, arrays), a="verticalsum(S, capped_at=9, dim='soil') * F", b="sumoverpft(P, pftlist=[1, 4], dimname='pft') - verticalsum(S, dim='soil')", c="S[:,1,:,:] + F")
    for t, c in np.ndindex(2, 2):
        assert got["a", t, c, None, None] == min(9, s[t, c].sum()) * f[t, c]
        assert got["b", t, c, None, None] == p[t, c, [0, 3]].sum() - s[t, c].sum()
        assert got["c", t, c, None, None] == s[t, c, 1] + f[t, c]
    assert len(got) == 12


def test_the_other_dimension_is_kept_and_operands_hold_along_it(spark, arrays):
    s, p, x, f = (arrays[n] for n in "SPXF")
    got = run(field_of(spark, arrays), a="sumoverpft(X, pftlist=[2, 3], dimname='pft') * F + S", b="verticalsum(X * S, dim='soil')", c="sumoverpft(P, pftlist=[1], dimname='pft')")
    for t, c in np.ndindex(2, 2):
        for k in range(3):
            assert got["a", t, c, k, None] == np.nansum(x[t, c, k, 1:3]) * f[t, c] + s[t, c, k]
        for k in range(4):
            assert got["b", t, c, None, k] == np.nansum(x[t, c, :, k] * s[t, c])
        assert got["c", t, c, None, None] == p[t, c, 0]
    assert len(got) == 4 * (3 + 4 + 1)


def test_points_that_operands_do_not_share_are_left_out(spark, arrays):
    field = field_of(spark, arrays, lambda name, p: (name == "X" and p["soil"] == 2) or (name == "F" and p["t"] == 1))
    got = run(field, a="sumoverpft(X, pftlist=[1], dimname='pft') + S", b="verticalsum(S, dim='soil') * F")
    assert {k[3] for k in got if k[0] == "a"} == {0, 1} and {k[1] for k in got if k[0] == "b"} == {0}


def test_wrong_dimensions_are_errors(spark, arrays):
    field = field_of(spark, arrays)
    with pytest.raises(ValueError, match="dimension 'pft' not found in .*soil"):
        run(field, a="sumoverpft(S, pftlist=[1], dimname='pft')")
    with pytest.raises(ValueError, match="index list"):
        run(field, a="sumoverpft(P, pftlist=[], dimname='pft')")


def test_a_named_index_becomes_a_column(spark):
    rows = spark.createDataFrame([("P", 0, 0, "pft", 1, 2.0), ("S", 0, 0, "soil", 0, 3.0), ("F", 0, 0, None, None, 1.0)], "var string, time_idx int, cell bigint, dim string, idx int, value double")
    got = {r["var"]: (r["soil"], r["pft"]) for r in nd.named_columns(rows, ["soil", "pft"]).collect()}
    assert got == {"P": (None, 1), "S": (0, None), "F": (None, None)}
    with pytest.raises(Exception, match="unknown dimension soil"):
        nd.named_columns(rows, ["pft"]).collect()


def test_one_grouping_serves_all_targets_that_keep_nothing(spark, arrays):
    lowered = {"a": dv.lower_formula("verticalsum(S, dim='soil')"), "b": dv.lower_formula("sumoverpft(P, pftlist=[1], dimname='pft')")}
    made = nd.realize_named(field_of(spark, arrays), lowered, {"a": ["S"], "b": ["P"]}, SHAPES)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and "Window" not in plan and "Expand" not in plan  # the pivot and the sums


def test_a_catalog_with_named_dimensions_is_prepared(spark, arrays):
    def entry(name, formula, *sources):
        return (name, "land", "1", formula, None, None, None, None, None, None, [["time", "lat", "lon"]], [(s, None, None) for s in sources], None, None)

    catalog = spark.createDataFrame(
        [entry("mrso", "verticalsum(S, dim='soil')", "S"), entry("grass", "(sumoverpft(P, pftlist=[1, 2], dimname='pft'))*F", "P", "F"), entry("wrong", "sumoverpft(S, pftlist=[1], dimname='pft')", "S"), entry("deep", "sumoverpft(X, pftlist=[1], dimname='pft')", "X")],
        CATALOG_SCHEMA,
    )
    targets = [pp.Target(r["name"], "general", None, {n: n for n in dv.lower_formula(r["formula"]).names()}, r["formula"], None, None, "m") for r in catalog.select("name", "formula").collect()]
    field = field_of(spark, arrays).selectExpr("*", "CAST(NULL AS INT) AS lev")
    weights = spark.createDataFrame([("m", c, c, 1.0) for c in range(2)], "map_id string, src_cell bigint, dst_cell bigint, w double")
    static = spark.createDataFrame([(c, 1.0) for c in range(2)], "cell bigint, landfrac double")
    outputs, status = pp.prepare(spark, field, targets, weights=weights, static=static, available={n: False for n in SHAPES}, dims={n: s for n, s in SHAPES.items() if s})
    assert dict(status) == {"mrso": "ok", "grass": "ok", "deep": "ok", "wrong": "dimension 'pft' not found in ['soil'] of S"}
    got = {(r["var"], r["time_idx"], r["lev"], r["cell"]): r["value"] for r in outputs["general"].collect()}
    for t, c in np.ndindex(2, 2):
        assert got["mrso", t, None, c] == arrays["S"][t, c].sum()
        assert got["grass", t, None, c] == arrays["P"][t, c, :2].sum() * arrays["F"][t, c]
        assert [got["deep", t, k, c] for k in range(3)] == np.nan_to_num(arrays["X"])[t, c, :, 0].tolist()


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_one_exchange_serves_pivot_sets_and_windows(spark):
    """Sets of several dimensions, operands along those they lack and presence at a point: all within a time and cell."""
    rows = [("A", 0, 1, 0, None, 2.0), ("A", 0, 1, 1, None, 3.0), ("B", 0, 1, None, 0, 5.0), ("R", 0, 1, 0, 0, 7.0), ("R", 0, 1, 1, 0, 11.0), ("F", 0, 1, None, None, 0.5), ("A", 0, 2, 0, None, 1.0)]
    field = spark.createDataFrame(rows, "var string, time_idx int, cell long, levsoi int, levpft int, value double")
    texts = {"s": "sumoverpft(R, pftlist=[1], dimname='levpft') * F + A", "p": "verticalsum(R * A, dim='levsoi') - B", "z": "verticalsum(A, dim='levsoi') * F"}
    lowered = {t: dv.lower_formula(x) for t, x in texts.items()}
    shapes = {"A": ("levsoi",), "B": ("levpft",), "R": ("levsoi", "levpft"), "F": ()}
    made = nd.realize_named(field, lowered, {t: sorted(low.names()) for t, low in lowered.items()}, shapes)
    assert exchanges(made) == 1
    got = {(r["var"], r["cell"], r["levsoi"], r["levpft"], r["value"]) for r in made.collect()}
    assert got == {("s", 1, 0, None, 5.5), ("s", 1, 1, None, 8.5), ("p", 1, None, 0, 42.0), ("z", 1, None, None, 2.5)}
