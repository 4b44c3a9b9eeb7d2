"""Formulas, sums over dimensions, regional sums, units, fill values, attributes, merging."""

from functools import reduce

from pyspark.sql import functions as F

from gridloom.functions.calendar import month_index
from gridloom.functions.values import fill_missing, mask_where
from gridloom.operators import derive as dv
from gridloom.operators import named_dims as nd
from gridloom.plans.bindings import axes, field, native, read, static
from gridloom.plans.registry import query, view


@query("derive_direct", "SELECT 'hfls' AS var, time_idx, lev, cell, value FROM field WHERE var = 'QTY'", ["field"])
def derive_direct(spark, d):
    return dv.realize_direct(field(spark, d), "QTY", "hfls")


@query(
    "derive_formula",
    "SELECT 'pr' AS var, time_idx, lev, cell, (PRICE - DISC * 10) / nullif(TAX, 0) + QTY / 100 AS value FROM native",
    ["native"],
)
def derive_formula(spark, d):
    aliases = {"precip": "PRICE", "DISC": "DISC", "t": "TAX", "QTY": "QTY"}
    return dv.realize_formula(field(spark, d), "pr", "(precip - DISC*10) /t + QTY / 100.", aliases, available=("PRICE", "QTY", "DISC", "TAX"))


@query(
    "derive_many_formulas",
    """SELECT 'a' AS var, time_idx, lev, cell, PRICE / nullif(QTY, 0) AS value FROM native
       UNION ALL SELECT 'b', time_idx, lev, cell, DISC + TAX FROM native
       UNION ALL SELECT 'c', time_idx, lev, cell, QTY - TAX FROM native""",
    ["native"],
)
def derive_many_formulas(spark, d):
    return dv.realize_formulas(field(spark, d), {"a": "PRICE/QTY", "b": "DISC + TAX", "c": "QTY-TAX"}, ("PRICE", "QTY", "DISC", "TAX"))


@query(
    "derive_with_static",
    "SELECT time_idx, lev, cell, QTY * landfrac AS value FROM native JOIN static USING (cell)",
    ["native", "static"],
)
def derive_with_static(spark, d):
    wide = dv.widen(field(spark, d, "QTY"), ["QTY"])
    both = dv.with_static(wide, static(spark, d), ["landfrac"])
    return both.select("time_idx", "lev", "cell", F.expr("QTY * landfrac").alias("value"))


@query("derive_mask", "SELECT time_idx, lev, cell, CASE WHEN PRICE > 5000000 THEN QTY ELSE 0 END AS value FROM native", ["native"])
def derive_mask(spark, d):
    return native(spark, d).select("time_idx", "lev", "cell", mask_where(F.col("QTY"), F.col("PRICE") > 5000000, 0.0).alias("value"))


@query("convert_units_scale", "SELECT var, time_idx, lev, cell, value * 0.5e0 + 273.15e0 AS value FROM price", ["price"])
def convert_units_scale(spark, d):
    return dv.convert_units(field(spark, d, "PRICE"), {"scale": 0.5, "offset": 273.15})


@query("convert_units_expression", "SELECT var, time_idx, lev, cell, value * 1000e0 AS value FROM price", ["price"])
def convert_units_expression(spark, d):
    return dv.convert_units(field(spark, d, "PRICE"), "x * 1000.0")


@query(
    "fill_missing",
    "SELECT var, time_idx, lev, cell, coalesce(value / 4, 1e20)::FLOAT::DOUBLE AS value FROM price",
    ["price"],
)
def fill_missing_values(spark, d):
    quarter = field(spark, d, "PRICE").withColumn("value", F.coalesce(F.col("value") / 4, F.lit(float("nan"))))
    # Shown as double because a 4-byte float prints differently in the two engines.
    return quarter.withColumn("value", fill_missing(F.col("value")).cast("double"))


@query(
    "vertical_sum_capped",
    "SELECT var, time_idx, cell, least(30000000e0, coalesce(sum(value), 0e0)) AS value FROM price GROUP BY 1, 2, 3",
    ["price"],
)
def vertical_sum_capped(spark, d):
    return dv.vertical_sum(field(spark, d, "PRICE"), cap=30000000)


@query(
    "sum_over_index",
    "SELECT var, time_idx, cell, coalesce(sum(value), 0e0) AS value FROM price WHERE lev IN (1, 2, 4) GROUP BY 1, 2, 3",
    ["price"],
)
def sum_over_index(spark, d):
    return dv.sum_over_index(field(spark, d, "PRICE"), [1, 2, 4], "lev", first=1)


@query(
    "sums_over_indices",
    """SELECT var, time_idx, cell, coalesce(sum(CASE WHEN lev IN (1, 2, 3) THEN value END), 0e0) AS low,
       coalesce(sum(CASE WHEN lev IN (5, 6, 7) THEN value END), 0e0) AS high
       FROM field WHERE lev IN (1, 2, 3, 5, 6, 7) GROUP BY 1, 2, 3""",
    ["field"],
)
def sums_over_indices(spark, d):
    return dv.sums_over_indices(field(spark, d), {"low": [1, 2, 3], "high": [5, 6, 7]}, "lev", first=1)


@query("index_select", "SELECT var, time_idx, cell, value FROM price WHERE lev = 2", ["price"])
def index_select(spark, d):
    return dv.index_select(field(spark, d, "PRICE"), 1, first=1)


@query(
    "formula_steps",
    """SELECT 'mrso' AS var, time_idx, cell, lev,
       (least(900e0, coalesce(sum(QTY + TAX) OVER w, 0)) + coalesce(sum(CASE WHEN lev IN (1, 3) THEN DISC END) OVER w, 0e0)
        - max(CASE WHEN lev = 2 THEN TAX END) OVER w) * TAX AS value FROM native WINDOW w AS (PARTITION BY time_idx, cell)""",
    ["native"],
)
def formula_steps(spark, d):
    text = "(verticalsum(QTY + TAX, capped_at=900) + sumoverpft(DISC, pftlist=[1, 3], dimname='lev') - TAX[:,1,:,:]) * TAX  #note"
    return dv.realize_steps(field(spark, d), "mrso", dv.lower_formula(text), ("QTY", "TAX", "DISC"), "lev", first=1, levelled=("TAX",))


@query(
    "formula_steps_reduced",
    """SELECT 'mrso' AS var, time_idx, cell, least(900e0, coalesce(sum(QTY + TAX), 0)) + coalesce(sum(CASE WHEN lev IN (1, 3) THEN DISC END), 0e0)
       - max(CASE WHEN lev = 2 THEN TAX END) AS value FROM native GROUP BY 2, 3""",
    ["native"],
)
def formula_steps_reduced(spark, d):
    text = "verticalsum(QTY + TAX, capped_at=900) + sumoverpft(DISC, pftlist=[1, 3], dimname='lev') - TAX[:,1,:,:]"
    return dv.realize_steps(field(spark, d), "mrso", dv.lower_formula(text), ("QTY", "TAX", "DISC"), "lev", first=1)


# One field with soil levels and plant types: QTY, TAX by level; GPP, NPP by type; ROOT by both; FRAC by neither.
view(
    "land",
    """SELECT (year(l_shipdate) * 12 + month(l_shipdate) - 1)::INTEGER AS time_idx, l_suppkey AS cell, (l_linenumber - 1)::INTEGER AS soil,
       (l_orderkey % 14)::INTEGER AS pft, l_quantity AS q, round(l_tax * 100) AS t FROM lineitem""",
)
LAND = {
    "mrso": "verticalsum(QTY + TAX, capped_at=900)",
    "grass": "(sumoverpft(GPP, pftlist=[12, 13, 14], dimname='levpft') - sumoverpft(NPP, pftlist=[12, 13, 14], dimname='levpft'))*FRAC",
    "top": "QTY[:,0,:,:] + sumoverpft(GPP, pftlist=[1], dimname='levpft')",
    "rootsoil": "sumoverpft(ROOT, pftlist=[1, 2, 3], dimname='levpft') * FRAC + QTY",
    "rootpft": "verticalsum(ROOT * QTY, dim='levsoi') - GPP",
}
LAND_DIMS = {"QTY": ("levsoi",), "TAX": ("levsoi",), "GPP": ("levpft",), "NPP": ("levpft",), "ROOT": ("levsoi", "levpft"), "FRAC": ()}


def land(spark, d):
    rows = read(spark, d, "lineitem").select(
        month_index(F.col("l_shipdate")).alias("time_idx"), F.col("l_suppkey").alias("cell"), (F.col("l_linenumber") - 1).alias("levsoi"),
        (F.col("l_orderkey") % 14).cast("int").alias("levpft"), F.col("l_quantity").alias("q"), F.rint(F.col("l_tax") * 100).alias("t"),
    )
    none = F.lit(None).cast("int")

    def part(**amounts):
        """Variables of the same dimensions, from one sum."""
        own = LAND_DIMS[next(iter(amounts))]
        summed = rows.groupBy("time_idx", "cell", *own).agg(*[F.sum(amount).alias(name) for name, amount in amounts.items()])
        long = summed.unpivot(["time_idx", "cell", *own], list(amounts), "var", "value")
        return long.select("var", "time_idx", "cell", *[F.col(k) if k in own else none.alias(k) for k in ("levsoi", "levpft")], "value")

    parts = [part(QTY="q", TAX="t"), part(GPP="q", NPP="t"), part(ROOT="q"), part(FRAC="t")]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "named_dimensions",
    """SELECT 'mrso' AS var, time_idx, cell, NULL::INTEGER AS levsoi, NULL::INTEGER AS levpft, least(900e0, sum(q + t)) AS value FROM land GROUP BY 2, 3
       UNION ALL SELECT 'grass', time_idx, cell, NULL, NULL, (coalesce(sum(q) FILTER (WHERE pft >= 11), 0) - coalesce(sum(t) FILTER (WHERE pft >= 11), 0)) * sum(t) FROM land GROUP BY 2, 3
       UNION ALL SELECT 'top', time_idx, cell, NULL, NULL, sum(q) FILTER (WHERE soil = 0) + coalesce(sum(q) FILTER (WHERE pft = 0), 0) FROM land GROUP BY 2, 3
       UNION ALL SELECT 'rootsoil', time_idx, cell, soil, NULL, coalesce(sum(q) FILTER (WHERE pft <= 2), 0) * (SELECT sum(t) FROM land m WHERE m.time_idx = l.time_idx AND m.cell = l.cell) + sum(q)
                 FROM land l GROUP BY 2, 3, 4
       UNION ALL SELECT 'rootpft', time_idx, cell, NULL, pft, sum(r * s) - sum(r) FROM (SELECT time_idx, cell, soil, pft, sum(q) AS r, any_value(s) AS s FROM land
                 JOIN (SELECT time_idx, cell, soil, sum(q) AS s FROM land GROUP BY 1, 2, 3) USING (time_idx, cell, soil) GROUP BY 1, 2, 3, 4) GROUP BY 2, 3, 5""",
    ["land"],
)
def named_dimensions(spark, d):
    lowered = {t: dv.lower_formula(text) for t, text in LAND.items()}
    names = {t: sorted(low.names()) for t, low in lowered.items()}
    made = nd.realize_named(land(spark, d), lowered, names, LAND_DIMS)
    return made.select("var", "time_idx", "cell", "levsoi", "levpft", "value")


view("conc", "SELECT time_idx, cell, sum(QTY)::BIGINT % 101 AS value FROM native GROUP BY 1, 2", ("native",))


def concentration(spark, d):
    summed = native(spark, d).groupBy("time_idx", "cell").agg(F.sum("QTY").alias("q"))
    return summed.select("time_idx", "cell", (F.col("q").cast("long") % 101).cast("double").alias("value"))


def hemispheres(amount: str) -> str:
    return f"""SELECT time_idx, r AS region, coalesce(sum(CASE WHEN (r = 'nh' AND tlat > 0) OR (r = 'sh' AND tlat < 0) THEN {amount} END), 0e0)::DOUBLE AS value
               FROM conc JOIN static USING (cell), (VALUES ('nh'), ('sh')) g(r) GROUP BY 1, 2"""


@query("hemisphere_area", hemispheres("value * tarea / 100e0"), ["conc", "static"])
def hemisphere_area(spark, d):
    return dv.hemisphere_area(concentration(spark, d), static(spark, d))


@query("hemisphere_extent", hemispheres("CASE WHEN value > 15 THEN tarea ELSE 0 END"), ["conc", "static"])
def hemisphere_extent(spark, d):
    return dv.hemisphere_extent(concentration(spark, d), static(spark, d))


@query("hemisphere_total", hemispheres("value * tarea"), ["conc", "static"])
def hemisphere_total(spark, d):
    return dv.hemisphere_total(concentration(spark, d), static(spark, d))


@query(
    "merge_first_wins",
    """SELECT var, time_idx, lev, cell, value FROM field WHERE var IN ('PRICE', 'QTY')
       UNION ALL SELECT var, time_idx, lev, cell, value FROM field WHERE var = 'TAX'""",
    ["field"],
)
def merge_first_wins(spark, d):
    first = field(spark, d, "PRICE", "QTY")
    second = field(spark, d, "QTY", "TAX").withColumn("value", F.col("value") + F.when(F.col("var") == "QTY", 1000.0).otherwise(0.0))
    return dv.merge_first_wins([first, second], [("PRICE", "QTY"), ("QTY", "TAX")])


@query(
    "attach_attributes",
    """SELECT o_orderkey AS id, 'v' || (o_custkey % 3000) AS var, CASE WHEN p.p_partkey IS NULL THEN 'old' ELSE p_type END AS units,
       coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, p_name) AS long_name, p_brand AS standard_name
       FROM orders LEFT JOIN part p ON p_partkey = o_custkey % 3000""",
)
def attach_attributes(spark, d):
    key = F.col("o_custkey") % 3000
    rows = read(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("v"), key).alias("var"),
        F.lit("old").alias("units"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("long_name"),
    )
    entries = read(spark, d, "part").select(
        F.concat(F.lit("v"), "p_partkey").alias("name"), F.col("p_type").alias("units"), F.col("p_name").alias("long_name"), F.col("p_brand").alias("standard_name")
    )
    return dv.attach_attributes(rows, entries)


@query(
    "rename_dimensions",
    "SELECT axis_id AS latitude, i AS sdepth, s AS longitude, i * 0.5e0 AS depth FROM axes",
    ["axes"],
)
def rename_dimensions(spark, d):
    rows = axes(spark, d).select(F.col("axis_id").alias("yh"), F.col("i").alias("levgrnd"), F.col("s").alias("xh"))
    depths = spark.range(48).select(F.col("id").alias("sdepth"), (F.col("id") * 0.5).cast("double").alias("depth"))
    return dv.rename_dimensions(rows, depths)
