"""Regridding of long field tables with a precomputed sparse weight table.

A field has one row per (variable, time, level, source cell); a missing value is a NULL in its row. The weight table
has ``map_id, src_cell, dst_cell, w``. Regridding is one join on the source cell and one sum per destination cell:
the weights are broadcast when they measure small, so the field itself is never shuffled on its cell, and partial
sums shrink every task's output before the only shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import fixed_values as fixed
from gridloom.functions.sizing import small
from gridloom.functions.values import first_present, to_percent, wrap_longitude

KEYS = ("var", "time_idx", "lev")


def weights_of(weights: DataFrame, map_id: str) -> DataFrame:
    """Entries of one map."""
    return weights.filter(F.col("map_id") == map_id).select("src_cell", "dst_cell", "w")


def _apply(
    field: DataFrame, weights: DataFrame, keys: Sequence[str], source: Column, valid: Column, *, require_all: bool
) -> DataFrame:
    joined = field.withColumnRenamed("cell", "src_cell").join(small(weights), "src_cell")
    summed = joined.groupBy(*keys, F.col("dst_cell").alias("cell")).agg(
        F.sum(F.col("w") * source).alias("_num"), F.sum(F.when(valid, F.col("w"))).alias("_den")
    )
    enough = F.col("_den") >= (0.0 if require_all else fixed.VALID_WEIGHT_TOLERANCE)
    value = F.when(enough, F.try_divide(F.col("_num").cast("double"), F.col("_den").cast("double")))
    return summed.select(*keys, "cell", value.alias("value"))


def regrid(field: DataFrame, weights: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Weighted mean over the source cells that have a value; NULL when none of them has one."""
    value = F.col("value")
    return _apply(field, weights, keys, value, value.isNotNull(), require_all=False)


def regrid_by_map(field: DataFrame, weights: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Regrid rows that name their own map (``map_id``): many variables and maps in one pass."""
    joined = field.withColumnRenamed("cell", "src_cell").join(small(weights), ["map_id", "src_cell"])
    summed = joined.groupBy(*keys, F.col("dst_cell").alias("cell")).agg(
        F.sum(F.col("w") * F.col("value")).alias("_num"), F.sum(F.when(F.col("value").isNotNull(), F.col("w"))).alias("_den")
    )
    value = F.when(F.col("_den") >= fixed.VALID_WEIGHT_TOLERANCE, F.try_divide(F.col("_num"), F.col("_den").cast("double")))
    return summed.select(*keys, "cell", value.alias("value"))


def regrid_masked(
    field: DataFrame,
    weights: DataFrame,
    fraction: DataFrame,
    keys: Sequence[str] = KEYS,
    destination_fraction: DataFrame | None = None,
) -> DataFrame:
    """Regrid a land or sea field weighted by the source fraction (0..1), missing counted as 0.

    ``fraction`` is (cell, fraction). It depends on the source cell only, so it joins the weight table, not the field.
    With ``destination_fraction`` the result is divided by it where it is above 0 and missing elsewhere (land fields);
    without it the result stays weighted (ocean fields).
    """
    shares = fraction.select(F.col("cell").alias("src_cell"), F.coalesce("fraction", F.lit(0.0)).alias("_f"))
    weighted = weights.join(shares, "src_cell")
    value = F.coalesce(F.col("value"), F.lit(0.0)) * F.col("_f")
    out = _apply(field, weighted, keys, value, F.lit(True), require_all=True)
    if destination_fraction is None:
        return out
    divisor = destination_fraction.select("cell", F.col("fraction").alias("_d"))
    divided = F.when(F.col("_d") > 0, F.try_divide(F.col("value"), F.col("_d")))
    return out.join(small(divisor), "cell", "left").select(*keys, "cell", divided.alias("value"))


def regrid_dense(regridded: DataFrame, cells: int, keys: Sequence[str] = KEYS, block: int = 65536) -> DataFrame:
    """One row per destination cell 0..cells-1 for every slice present, NULL where nothing was regridded.

    A slice gathers its cells in blocks of numbers, so no list is longer than ``block``, and each block adds the
    numbers it lacks. Blocks without any cell come from the list of slices; grids of one block have none.
    """
    number = F.floor(F.col("cell") / F.lit(block)).cast("long")
    present = regridded.groupBy(*keys, number.alias("_b")).agg(F.collect_list(F.struct("cell", "value")).alias("_have"))
    last = (cells - 1) // block
    if last > 0:
        nothing = F.array().cast(present.schema["_have"].dataType)
        blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long")))
        every = regridded.select(*keys).distinct().select(*keys, blocks.alias("_b"), nothing.alias("_have"))
        present = present.unionByName(every).groupBy(*keys, "_b").agg(F.flatten(F.collect_list("_have")).alias("_have"))
    start = F.col("_b") * block
    wanted = F.sequence(start, F.least(start + (block - 1), F.lit(cells - 1).cast("long")))
    absent = F.array_except(wanted, F.transform("_have", lambda e: e["cell"]))
    filled = F.transform(absent, lambda c: F.struct(c.alias("cell"), F.lit(None).cast("double").alias("value")))
    return present.select(*keys, F.inline(F.concat("_have", filled)))


def pass_through_regular(field: DataFrame) -> DataFrame:
    """A field that is on lat/lon already stays as it is; anything else is an error."""
    if not {"lat", "lon"} <= set(field.columns):
        raise KeyError("regular grid is requested but the field has no lat and lon")
    return field


def pick_map(catalog: DataFrame, maps: DataFrame, model: str, resolution: str, method: str | None = None) -> DataFrame:
    """Weight map per variable: forced method, the entry's own, or bilinear for intensive variables.

    The intensive list holds short names, so a branded name is matched by its part before the first ``_``. Where the
    chosen method has no map the conservative one is used, unless the method was forced.
    """
    if method not in (None, "conservative", "bilinear"):
        raise ValueError("method must be 'conservative' or 'bilinear'")
    mine = maps.filter((F.col("model") == model) & (F.col("resolution") == resolution))
    one = mine.agg(
        F.max(F.when(F.col("method") == "conservative", F.col("map_id"))).alias("_cons"),
        F.max(F.when(F.col("method") == "bilinear", F.col("map_id"))).alias("_bilin"),
    ).first()
    if one["_cons"] is None and one["_bilin"] is None:
        raise LookupError(f"no weight map for model {model!r} and resolution {resolution!r}")
    if method and one["_cons" if method == "conservative" else "_bilin"] is None:
        raise LookupError(f"no {method} map for model {model!r} and resolution {resolution!r}")
    short = F.substring_index("name", "_", 1)
    own = F.col("regrid_method") if "regrid_method" in catalog.columns else F.lit(None)
    wanted = F.lit(method) if method else F.coalesce(
        own, F.when(short.isin(*fixed.INTENSIVE_VARIABLES), "bilinear").otherwise("conservative")
    )
    use_bilinear = (wanted == "bilinear") & F.lit(one["_bilin"] is not None)
    return catalog.withColumn("method", F.when(use_bilinear, "bilinear").otherwise("conservative")).withColumn(
        "map_id", F.when(use_bilinear, F.lit(one["_bilin"])).otherwise(F.lit(one["_cons"]))
    )


# --- fixed fields ------------------------------------------------------------------------------------------------


def fraction_to_percent(static: DataFrame, names: Sequence[str], scaled_names: Sequence[str] | None = None) -> DataFrame:
    """(cell, value) in percent from the first of ``names`` that ``static`` has.

    ``scaled_names`` limits which of them are tested for the 0..1 scale; by default all are.
    """
    name = first_present(names, static.columns)
    if name is None:
        raise KeyError(f"none of {list(names)} is present")
    test = scaled_names is None or name in scaled_names
    largest = static.agg(F.max(name).alias("m")).first()["m"] if test else None
    value = to_percent(F.col(name).cast("double"), largest if largest is not None else 0.0, test_scale=test)
    return static.select("cell", value.alias("value"))


def land_percent(static: DataFrame) -> DataFrame:
    return fraction_to_percent(static, fixed.LAND_FRACTION_NAMES)


def sea_percent(static: DataFrame) -> DataFrame:
    """Only ``wet`` may come as 0..1; the other names are percent by definition."""
    return fraction_to_percent(static, fixed.SEA_FRACTION_NAMES, scaled_names=("wet",))


def fx_fractions(static: DataFrame, weights: DataFrame) -> DataFrame:
    """(cell, sftlf, sftof) on the destination grid: land percent regridded conservatively, sea as the rest."""
    land = land_percent(static).select("cell", F.coalesce("value", F.lit(0.0)).alias("value"))
    out = regrid(land, weights, keys=())
    sea = F.greatest(F.lit(0.0), F.least(F.lit(100.0), (F.lit(1.0) - F.col("value") / 100.0) * 100.0))
    return out.select("cell", F.col("value").alias("sftlf"), F.when(F.col("value").isNotNull(), sea).alias("sftof"))


def fx_missing(wanted: DataFrame, stored: DataFrame, keys: Sequence[str] = ("map_id", "source_id")) -> DataFrame:
    """Keys of fixed-field tables that still have to be computed."""
    return wanted.select(*keys).distinct().join(stored.select(*keys).distinct(), list(keys), "left_anti")


def fx_table(static: DataFrame, weights: DataFrame, keys: Sequence[str] = ("map_id",)) -> DataFrame:
    """Fixed fields of all maps in one pass; ``static`` may carry further keys such as its source."""
    land = land_percent(static).select("cell", F.coalesce("value", F.lit(0.0)).alias("value"))
    joined = land.withColumnRenamed("cell", "src_cell").join(weights, "src_cell")
    summed = joined.groupBy(*keys, F.col("dst_cell").alias("cell")).agg(
        F.sum(F.col("w") * F.col("value")).alias("_num"), F.sum("w").alias("_den")
    )
    land_value = F.when(
        F.col("_den") >= fixed.VALID_WEIGHT_TOLERANCE, F.try_divide(F.col("_num"), F.col("_den").cast("double"))
    )
    out = summed.select(*keys, "cell", land_value.alias("sftlf"))
    sea = F.greatest(F.lit(0.0), F.least(F.lit(100.0), (F.lit(1.0) - F.col("sftlf") / 100.0) * 100.0))
    return out.withColumn("sftof", F.when(F.col("sftlf").isNotNull(), sea))


def cell_area(grid: DataFrame, radius: float = fixed.EARTH_RADIUS_M) -> DataFrame:
    """Cell area in m2 and cell centres from ``lat_b0, lat_b1, lon_b0, lon_b1``; other columns are kept."""
    width = F.abs(F.radians("lon_b1") - F.radians("lon_b0"))
    height = F.abs(F.sin(F.radians("lat_b1")) - F.sin(F.radians("lat_b0")))
    return (
        grid.withColumn("lat", (F.col("lat_b0") + F.col("lat_b1")) * 0.5)
        .withColumn("lon", (F.col("lon_b0") + F.col("lon_b1")) * 0.5)
        .withColumn("areacella", F.lit(radius * radius) * width * height)
    )


def source_land_area(static: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Land area of the source grid in m2 from ``landfrac`` and ``area`` in km2."""
    area = F.col("landfrac") * F.col("area") * F.lit(1.0e6)
    return static.groupBy(*keys).agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("land_area"))


def grid_extent(static: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Smallest and largest latitude and longitude, longitudes taken in [0, 360)."""
    lon = wrap_longitude(F.col("lon"))
    return static.groupBy(*keys).agg(
        F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"), F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max")
    )


def attach_missing(field: DataFrame, static: DataFrame, names: Sequence[str], on: Sequence[str] = ("cell",)) -> DataFrame:
    """Carry the named static columns that ``static`` has and ``field`` has not."""
    take = [n for n in names if n in static.columns and n not in field.columns]
    return field.join(small(static.select(*on, *take)), list(on), "left") if take else field


def attach_fixed_fields(out: DataFrame, fx: DataFrame, names: Sequence[str], on: Sequence[str] = ("cell",)) -> DataFrame:
    """Add fixed fields; where the output has a value already, that one stays."""
    take = [n for n in names if n in fx.columns]
    renamed = fx.select(*on, *[F.col(n).alias(f"_fx_{n}") for n in take])
    joined = out.join(small(renamed), list(on), "left")
    for n in take:
        value = F.coalesce(F.col(n), F.col(f"_fx_{n}")) if n in out.columns else F.col(f"_fx_{n}")
        joined = joined.withColumn(n, value)
    return joined.drop(*[f"_fx_{n}" for n in take])


def attach_time_bounds(
    out: DataFrame, time_axis: DataFrame, bounds: Sequence[str] = ("time_b0", "time_b1"), out_times: DataFrame | None = None
) -> DataFrame:
    """Add time bounds from the source's time axis; axes that differ are an error.

    A row whose time has no bounds fails when it is read, so the output is not computed twice; a row without a time
    (a fixed field) has no bounds either. The time dimension of
    the output (``out_times``, one row per time) also finds bounds without a time, before any field row is read.
    """
    if out_times is not None:
        sides = time_axis.select("time_idx").distinct().withColumn("_s", F.lit(1))
        sides = sides.unionByName(out_times.select("time_idx").distinct().withColumn("_s", F.lit(2)))
        if not sides.groupBy("time_idx").agg(F.sum("_s").alias("_t")).filter(F.col("_t") != 3).isEmpty():
            raise ValueError("time bounds and time axis differ in length")
    axis = time_axis.select("time_idx", *bounds, F.lit(True).alias("_known"))
    wrong = F.raise_error(F.concat(F.lit("no time bounds for time "), F.col("time_idx").cast("string")))
    timeless = F.col("time_idx").isNull()
    checked = {b: F.when(F.col("_known").isNotNull() | timeless, F.col(b)).otherwise(wrong.cast("double")) for b in bounds}
    return out.join(small(axis), "time_idx", "left").withColumns(checked).drop("_known")
