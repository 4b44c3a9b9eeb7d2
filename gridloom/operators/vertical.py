"""Vertical coordinates: hybrid levels to pressure, layers to depth bins, level tables.

A column (one variable, time and cell) has as many rows as the model has levels, so a window over it stays small
however large the field is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import fixed_values as fixed
from gridloom.functions.sizing import small
from gridloom.functions.values import reference_pressure

COLUMN_KEYS = ("var", "time_idx", "cell")


def join_column_inputs(
    field: DataFrame, surface: DataFrame, coefficients: DataFrame, surface_keys: Sequence[str] = ("time_idx", "cell")
) -> DataFrame:
    """Surface pressure (``ps``) by column and hybrid coefficients by level onto the field; absent names are an error.

    Surface pressure that changes in time is as long as the field is over its levels, so it joins by shuffle on
    (time, cell), a partitioning that the interpolation then reuses. Only a static one is tried for broadcasting.
    A stored reference pressure (``P0`` beside the coefficients) comes along.
    """
    missing = [n for n in ("ps",) if n not in surface.columns]
    missing += [n for n in ("hyam", "hybm") if n not in coefficients.columns]
    if missing:
        raise KeyError(f"missing variables {missing}")
    stored = [c for c in ("P0",) if c in coefficients.columns]
    levels = field.join(small(coefficients.select("lev", "hyam", "hybm", *stored)), "lev")
    columns = surface.select(*surface_keys, "ps")
    return levels.join(columns if "time_idx" in surface_keys else small(columns), list(surface_keys), "left")


def stored_p0(table: DataFrame, attribute: float | None = None) -> Column:
    """Reference pressure for rows of ``table``: its ``P0`` where stored, else the attribute, else 100000 Pa."""
    return reference_pressure(F.col("P0") if "P0" in table.columns else None, None if attribute is None else F.lit(float(attribute)))


def level_pressure(p0: float | Column = fixed.REFERENCE_PRESSURE_PA) -> Column:
    """Pressure of a hybrid level from ``hyam, hybm, ps``."""
    reference = p0 if isinstance(p0, Column) else F.lit(float(p0))
    return F.col("hyam") * reference + F.col("hybm") * F.col("ps")


def to_pressure(
    field: DataFrame,
    levels: Sequence[float],
    p0: float | Column = fixed.REFERENCE_PRESSURE_PA,
    keys: Sequence[str] = COLUMN_KEYS,
    method: str = "linear",
) -> DataFrame:
    """Interpolate every column to the pressure ``levels``; NULL outside the column, no extrapolation.

    ``field`` has ``hyam, hybm, ps`` joined on (see :func:`join_column_inputs`). Each level row emits the targets
    between itself and the next level; the first and last row also emit the targets above and below the column. So
    every column gives exactly one row per target from one window, with no join on pressure.
    """
    if method not in ("linear", "log"):
        raise ValueError("method must be 'linear' or 'log'")
    order = Window.partitionBy(*keys).orderBy("lev")
    rows = (
        field.withColumn("_p", level_pressure(p0))
        .withColumn("_p1", F.lead("_p").over(order))
        .withColumn("_v1", F.lead("value").over(order))
        .withColumn("_last", F.lead(F.lit(1)).over(order).isNull())
        .withColumn("_ends_next", F.lead(F.lit(1), 2).over(order).isNull() & ~F.col("_last"))
        .withColumn("_first", F.lag(F.lit(1)).over(order).isNull())
    )
    targets = F.array(*[F.lit(float(x)) for x in levels])
    p, p1, v, v1 = F.col("_p"), F.col("_p1"), F.col("value"), F.col("_v1")
    scale = F.log if method == "log" else (lambda c: c)

    def inside(level: Column) -> Column:
        # The last segment is closed; a column of one level matches only exactly.
        upper = (level < p1) | (F.col("_ends_next") & (level == p1))
        alone = F.col("_first") & F.col("_last") & (level == p)
        return F.coalesce((p <= level) & upper, F.lit(False)) | F.coalesce(alone, F.lit(False))

    def outside(level: Column) -> Column:
        above = F.col("_first") & ~F.coalesce(p <= level, F.lit(False))
        below = F.col("_last") & F.coalesce(p < level, F.lit(False))
        return above | below

    def value_at(level: Column) -> Column:
        slope = F.try_divide((v1 - v) * (scale(level) - scale(p)), scale(p1) - scale(p))
        return F.when(outside(level), None).when(level == p, v).when(level == p1, v1).otherwise(v + slope)

    hits = F.filter(targets, lambda level: inside(level) | outside(level))
    emitted = F.transform(hits, lambda level: F.struct(level.alias("plev"), value_at(level).alias("value")))
    return rows.select(*keys, F.explode(emitted).alias("_e")).select(*keys, "_e.plev", "_e.value")


def layers_from_interfaces(interfaces: DataFrame, keys: Sequence[str] = ("time_idx", "cell")) -> DataFrame:
    """(z0, z1) of each layer from n+1 interface depths ``z`` numbered by ``k``; the last interface closes the column."""
    order = Window.partitionBy(*keys).orderBy("k")
    closed = interfaces.withColumn("z1", F.lead("z").over(order)).withColumn("_has_next", F.lead("k").over(order).isNotNull())
    return closed.filter("_has_next").drop("_has_next").withColumnRenamed("z", "z0")


def remap_depth(
    layers: DataFrame,
    bins: Sequence[tuple[float, float]],
    keys: Sequence[str] = COLUMN_KEYS,
    weighting: str = "native",
) -> DataFrame:
    """Weighted mean of the layers that overlap each depth bin, NULL for bins without overlap.

    ``layers`` has ``z0, z1, value``. A layer weighs overlap / layer thickness (``native``) or just the overlap
    (``overlap``). As published for this remap, a missing layer adds nothing to the sum but keeps its weight.
    """
    if weighting not in ("native", "overlap"):
        raise ValueError("weighting must be 'native' or 'overlap'")
    targets = F.array(
        *[
            F.struct(F.lit(i).alias("olevel"), F.lit(float(b0)).alias("b0"), F.lit(float(b1)).alias("b1"))
            for i, (b0, b1) in enumerate(bins)
        ]
    )
    z0, z1 = F.col("z0"), F.col("z1")
    overlap = lambda t: F.least(z1, t["b1"]) - F.greatest(z0, t["b0"])
    # Every layer names only the bins it touches; one extra unweighted row per bin keeps empty bins in the result.
    touched = F.filter(targets, lambda t: (overlap(t) > 0) | (F.col("k") == 0))
    rows = layers.withColumn("_t", F.explode(touched)).withColumn("_o", F.greatest(overlap(F.col("_t")), F.lit(0.0)))
    thickness = z1 - z0
    weight = F.col("_o") if weighting == "overlap" else F.try_divide(F.col("_o"), F.when(thickness > 0, thickness))
    summed = (
        rows.withColumn("_w", weight)
        .groupBy(*keys, F.col("_t.olevel").alias("olevel"))
        .agg(F.sum(F.col("_w") * F.col("value")).alias("_num"), F.sum("_w").alias("_den"))
    )
    mean = F.when(F.col("_den") > 0, F.try_divide(F.coalesce("_num", F.lit(0.0)), F.col("_den")))
    return summed.select(*keys, "olevel", mean.alias("value"))


def remap_depth_by_column(
    layers: DataFrame,
    bins: DataFrame,
    bin_keys: Sequence[str] = ("cell",),
    keys: Sequence[str] = COLUMN_KEYS,
    weighting: str = "native",
) -> DataFrame:
    """As ``remap_depth``, for bins held in a table (``bin_keys, olevel, b0, b1``) that differ from column to column.

    A merge sweep: where layers and bins of a column begin is put in one order of depth; a window knows at each of these
    places which layer and which bin it lies in and how far it is to the next one, which is their overlap. A column costs
    its layers plus its bins, not their product, in one exchange by column. Bins reach the columns by their first layer
    (``k`` 0), so only one row a column is joined. Layers of a column must not overlap each other, nor its bins: both are
    errors. Layers without thickness or with a missing bound weigh nothing, such bins are NULL; a column without bins has
    no rows.
    """
    if weighting not in ("native", "overlap"):
        raise ValueError("weighting must be 'native' or 'overlap'")
    layer, bin_ = F.struct("z0", "z1", F.col("value").cast("double").alias("value")), F.struct("olevel", "b0", "b1")
    kind = lambda made: F.lit(None).cast(made)
    begun = layers.filter("z1 > z0").select(*keys, F.col("z0").cast("double").alias("_z"), layer.alias("_layer"))
    heads = layers.filter("k = 0").select(*keys).join(small(bins.select(*bin_keys, "olevel", F.col("b0").cast("double").alias("b0"), F.col("b1").cast("double").alias("b1"))), list(bin_keys))
    # A bin without extent stands before all others and is never the one in force.
    real = F.col("b1") > F.col("b0")
    listed = heads.select(*keys, F.when(real, F.col("b0")).alias("_z"), F.when(real, bin_).alias("_bin"), F.col("olevel").alias("_own"))
    fields = {f.name: f.dataType for f in [*begun.schema, *listed.schema]}
    events = begun.withColumns({c: kind(fields[c]) for c in ("_bin", "_own")}).unionByName(listed.withColumn("_layer", kind(fields["_layer"])))
    order = Window.partitionBy(*keys).orderBy("_z")
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = events.select(
        *keys, "_z", "_own", F.lead("_z").over(order).alias("_next"), F.last("_layer", True).over(until).alias("_l"), F.last("_bin", True).over(until).alias("_b"),
        (F.col("_bin").isNotNull() & (F.last("_bin", True).over(before)["b1"] > F.col("_z"))).alias("_bins_meet"),
        (F.col("_layer").isNotNull() & (F.last("_layer", True).over(before)["z1"] > F.col("_z"))).alias("_layers_meet"),
    )
    wrong = F.when(F.col("_bins_meet"), F.raise_error(F.lit("depth bins of a column overlap")).cast("double")).when(
        F.col("_layers_meet"), F.raise_error(F.lit("layers of a column overlap")).cast("double")
    )
    reach = F.when(F.col("_l").isNotNull() & F.col("_b").isNotNull(), F.least("_next", "_l.z1", "_b.b1") - F.col("_z"))
    overlap = F.coalesce(wrong, F.greatest(reach, F.lit(0.0)), F.lit(0.0))
    weighed = placed.select(
        *keys, F.coalesce("_b.olevel", "_own").alias("olevel"), F.col("_l.value").alias("_v"),
        (overlap if weighting == "overlap" else F.coalesce(F.try_divide(overlap, F.col("_l.z1") - F.col("_l.z0")), overlap)).alias("_w"),
    ).filter("olevel IS NOT NULL")
    own = weighed.groupBy(*keys, "olevel").agg(F.sum(F.when(F.col("_w") > 0, F.col("_w") * F.col("_v"))).alias("_num"), F.sum("_w").alias("_den"))
    return own.select(*keys, "olevel", F.when(F.col("_den") > 0, F.coalesce("_num", F.lit(0.0)) / F.col("_den")).alias("value"))


def zonal_mean(field: DataFrame, lon_cells: int, keys: Sequence[str] = ("var", "time_idx", "plev")) -> DataFrame:
    """Mean over longitude, missing skipped, on a regular grid numbered ``cell = ilat * lon_cells + ilon``."""
    row = F.floor(F.col("cell") / F.lit(lon_cells)).cast("int").alias("ilat")
    return field.groupBy(*keys, row).agg(F.avg("value").alias("value"))


def rescale_levels(levels: DataFrame, names: Sequence[str] = ("lev", "ilev")) -> DataFrame:
    """Hybrid level coordinates from hPa-like numbers to 0..1 (divided by 1000)."""
    return levels.withColumns({n: F.col(n) / F.lit(1000.0) for n in names if n in levels.columns})


def attach_vertical_meta(levels: DataFrame, interfaces: DataFrame, p0: Column | None = None) -> DataFrame:
    """Level table with coefficients and P0, and the interfaces on both sides as bounds (``b0, b1``).

    ``interfaces`` holds ``k`` and ``ilev`` plus interface coefficients; level ``k`` lies between ``k`` and ``k+1``.
    """
    carried = [c for c in interfaces.columns if c not in ("k", "ilev")]
    lower = interfaces.select("k", F.col("ilev").alias("b0"), *carried)
    upper = interfaces.select((F.col("k") - 1).alias("k"), F.col("ilev").alias("b1"))
    joined = levels.join(small(lower), "k").join(small(upper), "k")
    return joined if p0 is None else joined.withColumn("P0", p0)


def hybrid_levels(coefficients: DataFrame, interfaces: DataFrame | None = None, p0: float | None = None) -> DataFrame:
    """What hybrid levels mean, one row per ``lev``: ``a, b, p0``, and as bounds the interface values on both sides.

    ``interfaces`` (``lev, hyai, hybi``) has one row more than there are levels: level n lies between n and n+1. A level
    that lacks an interface has NULL on that side.
    """
    table = coefficients.select("lev", F.col("hyam").alias("a"), F.col("hybm").alias("b"), stored_p0(coefficients, p0).alias("p0"))
    if interfaces is None:
        return table
    side = lambda lev, n: interfaces.select(lev.alias("lev"), F.col("hyai").alias(f"a_b{n}"), F.col("hybi").alias(f"b_b{n}"))
    return table.join(side(F.col("lev"), 0), "lev", "left").join(side(F.col("lev") - 1, 1), "lev", "left")


def hybrid_output(
    field: DataFrame, surface: DataFrame, coefficients: DataFrame, p0: float | None = None, surface_keys: Sequence[str] = ("time_idx", "cell")
) -> DataFrame:
    """For readers: a field on hybrid levels beside its surface pressure ``ps``, coefficients ``a, b`` and ``p0``.

    Stored outputs keep the three apart, as surface pressure repeats on every level and coefficients in every cell.
    """
    with_ps = field.join(surface.select(*surface_keys, "ps"), list(surface_keys))
    return with_ps.join(small(hybrid_levels(coefficients, None, p0)), "lev")


def truncate_bounds(levels: DataFrame, bounds: DataFrame, on: str = "k") -> DataFrame:
    """Reference bounds for the levels that exist, cut to their number."""
    return levels.join(small(bounds), on)
