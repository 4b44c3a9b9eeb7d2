"""Axis tables: bounds, monotone order, rolling, index axes, corner bounds.

An axis has one row per point: ``axis_id``, a consecutive position ``i`` from 0, and values. Points only need their
direct neighbours, so an axis is cut into blocks of positions and each block also receives the one point on either
side. A window then never holds more than a block, however long one axis is or how many rows it holds.

Joins between axis-sized tables carry no broadcast hint: adaptive execution picks the join from the sizes it sees at
run time and splits an axis that holds too many rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import fixed_values as fixed
from gridloom.functions.sizing import small
from gridloom.functions.values import is_finite

BLOCK = 65536
AXIS = ("axis_id",)


def _block(index: str, block: int) -> Column:
    return F.floor(F.col(index) / F.lit(block)).cast("long")


def with_neighbours(
    axis: DataFrame, columns: Sequence[str], keys: Sequence[str] = AXIS, index: str = "i", block: int = BLOCK
) -> DataFrame:
    """Add ``<column>_before`` and ``<column>_after`` from positions i-1 and i+1."""
    own, offset = _block(index, block), F.pmod(F.col(index), F.lit(block))
    # The first point of a block is also the right edge of the one before, the last point the left edge of the next.
    copies = F.array(own, F.when(offset == 0, own - 1), F.when(offset == block - 1, own + 1))
    spread = axis.withColumn("_blk", F.explode(F.array_compact(copies)))
    order = Window.partitionBy(*keys, "_blk").orderBy(index)
    around = {f"{c}_before": F.lag(c).over(order) for c in columns} | {f"{c}_after": F.lead(c).over(order) for c in columns}
    return spread.withColumns(around).filter(F.col("_blk") == own).drop("_blk")


def bounds_from_centers(
    axis: DataFrame, kind: str, keys: Sequence[str] = AXIS, index: str = "i", value: str = "v", block: int = BLOCK
) -> DataFrame:
    """Cell bounds ``b0, b1``: midpoints inside, half a step beyond both ends, half a unit around a single point.

    ``lat`` limits to the poles; ``lon`` closes the last cell at 360 when its upper bound falls below the lower and
    rounds to 8 places; ``plev`` sets a negative last upper bound to 50. Other kinds have no extra rule.
    """
    near = with_neighbours(axis, [value], keys, index, block)
    v, before, after = F.col(value), F.col(f"{value}_before"), F.col(f"{value}_after")
    lower = F.when(before.isNotNull(), (v + before) * 0.5).when(after.isNotNull(), v - (after - v) * 0.5).otherwise(v - 0.5)
    upper = F.when(after.isNotNull(), (after + v) * 0.5).when(before.isNotNull(), v + (v - before) * 0.5).otherwise(v + 0.5)
    last = after.isNull()
    if kind == "lat":
        lower, upper = F.greatest(lower, F.lit(-90.0)), F.least(upper, F.lit(90.0))
    elif kind == "lon":
        upper = F.when(last & (upper < lower), F.lit(360.0)).otherwise(upper)
        lower, upper = F.round(lower, 8), F.round(upper, 8)
    elif kind == "plev":
        upper = F.when(last & (upper < 0), F.lit(50.0)).otherwise(upper)
    return near.withColumns({"b0": lower, "b1": upper}).drop(f"{value}_before", f"{value}_after")


def roll_shift(axis: DataFrame, keys: Sequence[str] = AXIS, index: str = "i", value: str = "v", block: int = BLOCK) -> DataFrame:
    """Per axis its number of points ``n`` and the position after its first descent as ``shift`` (0 without one)."""
    near = with_neighbours(axis.select(*keys, index, value), [value], keys, index, block)
    descent = F.min(F.when(F.col(value) < F.col(f"{value}_before"), F.col(index)))
    return near.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.coalesce(descent, F.lit(0)).cast("long").alias("shift"))


def roll_to_monotonic(df: DataFrame, shifts: DataFrame, keys: Sequence[str] = AXIS, index: str = "i") -> DataFrame:
    """Move positions so that the axis rises from its first descent on; works for the axis and for data on it."""
    moved = F.pmod(F.col(index) - F.col("shift"), F.col("n"))
    return df.join(small(shifts), list(keys)).withColumn(index, moved.cast("long")).drop("n")


def dateline_fix(bounds: DataFrame, keys: Sequence[str] = AXIS, index: str = "i", block: int = BLOCK) -> DataFrame:
    """When the first cell starts above 0 it starts at 0 and the last ends at 360; the first ends where the second starts.

    Only axes of two points or more are changed.
    """
    near = with_neighbours(bounds, ["b0"], keys, index, block)
    many = F.col("b0_before").isNotNull() | F.col("b0_after").isNotNull()
    first, last = F.col("b0_before").isNull(), F.col("b0_after").isNull()
    starts = bounds.filter(F.col(index) == 0).select(*keys, (F.col("b0") > 0).alias("_open"))
    joined = near.join(starts, list(keys))
    lower = F.when(many & first & F.col("_open"), F.lit(0.0)).otherwise(F.col("b0"))
    upper = (
        F.when(many & first, F.col("b0_after"))
        .when(many & last & F.col("_open"), F.lit(360.0))
        .otherwise(F.col("b1"))
    )
    return joined.withColumns({"_b0": lower, "_b1": upper}).drop("b0", "b1", "b0_before", "b0_after", "_open").withColumnsRenamed(
        {"_b0": "b0", "_b1": "b1"}
    )


def make_strictly_monotonic(
    axis: DataFrame,
    direction: str = "increasing",
    keys: Sequence[str] = AXIS,
    index: str = "i",
    value: str | Sequence[str] = "v",
    block: int = BLOCK,
) -> DataFrame:
    """Nudge points by the smallest step so that the axis strictly rises or falls; missing points split it.

    With step e a nudged point is ``max over earlier points j of (v_j - j*e) + i*e``. That maximum is taken within
    blocks first and then carried over the much shorter table of block maxima. Several columns go in one pass.
    """
    names = [value] if isinstance(value, str) else list(value)
    sign = 1.0 if direction.lower().startswith("inc") else -1.0
    step = fixed.MONOTONE_STEP
    slanted = {f"_t_{n}": F.when(is_finite(F.col(n)), F.col(n) * sign - F.col(index) * step) for n in names}
    rows = axis.withColumn("_blk", _block(index, block)).withColumns(slanted)
    within = Window.partitionBy(*keys, "_blk").orderBy(index).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"_seg_{n}": F.sum(F.col(f"_t_{n}").isNull().cast("long")).over(within) for n in names})
    for n in names:
        earlier = Window.partitionBy(*keys, "_blk", f"_seg_{n}").orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn(f"_prev_{n}", F.max(f"_t_{n}").over(earlier))

    # The open end of each block: the largest point after its last gap, as one struct maximum per block.
    ends = rows.groupBy(*keys, "_blk").agg(*[F.max(F.struct(f"_seg_{n}", f"_t_{n}")).alias(f"_end_{n}") for n in names])
    order = Window.partitionBy(*keys).orderBy("_blk")
    for n in names:
        gaps = F.sum((F.col(f"_end_{n}._seg_{n}") > 0).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
        so_far = Window.partitionBy(*keys, f"_run_{n}").orderBy("_blk").rowsBetween(Window.unboundedPreceding, 0)
        ends = ends.withColumn(f"_run_{n}", gaps).withColumn(f"_open_{n}", F.max(f"_end_{n}._t_{n}").over(so_far))
    carried = ends.select(*keys, "_blk", *[F.lag(f"_open_{n}").over(order).alias(f"_carry_{n}") for n in names])

    def corrected(n: str) -> Column:
        limit = F.greatest(F.col(f"_prev_{n}"), F.when(F.col(f"_seg_{n}") == 0, F.col(f"_carry_{n}")))
        return F.coalesce(F.when(F.col(f"_t_{n}") <= limit - step * 0.5, (limit + F.col(index) * step) * sign), F.col(n))

    joined = rows.join(carried, [*keys, "_blk"])
    return joined.withColumns({n: corrected(n) for n in names}).select(*axis.columns)


def is_strictly_monotonic(axis: DataFrame, keys: Sequence[str] = AXIS, index: str = "i", value: str = "v", block: int = BLOCK) -> DataFrame:
    """Per axis whether every step rises, or every step falls; a missing value breaks both."""
    near = with_neighbours(axis.withColumn("_row", F.lit(1)), [value, "_row"], keys, index, block)
    has_before = F.col("_row_before").isNotNull()
    rises = F.coalesce(F.col(value) > F.col(f"{value}_before"), F.lit(False)) | ~has_before
    falls = F.coalesce(F.col(value) < F.col(f"{value}_before"), F.lit(False)) | ~has_before
    return near.groupBy(*keys).agg((F.bool_and(rises) | F.bool_and(falls)).alias("monotonic"))


def interface_bounds(interfaces: DataFrame, keys: Sequence[str] = AXIS, index: str = "k", value: str = "z", block: int = BLOCK) -> DataFrame:
    """n+1 interfaces to n pairs ``b0, b1``."""
    near = with_neighbours(interfaces.withColumn("_row", F.lit(1)), [value, "_row"], keys, index, block)
    pairs = near.filter(F.col("_row_after").isNotNull())
    return pairs.select(*keys, index, F.col(value).alias("b0"), F.col(f"{value}_after").alias("b1"))


def sigma_axis(mid: DataFrame, interfaces: DataFrame, keys: Sequence[str] = AXIS, block: int = BLOCK, check: str = "raise") -> DataFrame:
    """Hybrid sigma axis (``sigma, b0, b1``) per ``axis_id`` and level ``k``.

    Midpoints: ``hybm`` made strictly increasing, else ``lev`` when all of it lies in 0..1. Bounds: ``hybi`` made
    strictly increasing, else ``ilev`` when all of it lies in 0..1, else 0, the midpoints between levels, 1. Columns
    may be absent or NULL for a whole axis. Values outside 0..1 or not strictly monotone are an error; with
    ``check="flag"`` they set the column ``valid`` to false instead.

    Levels and interfaces share one table by ``k``, every choice is judged per axis in one grouping, and the choice is
    then made per row.
    """
    double = lambda df, c: F.col(c).cast("double") if c in df.columns else F.lit(None).cast("double")
    none = F.lit(None).cast("double")
    levels = mid.select(*keys, "k", F.lit(True).alias("_mid"), double(mid, "hybm").alias("hybm"), double(mid, "lev").alias("lev"), none.alias("hybi"), none.alias("ilev"))
    faces = interfaces.select(*keys, "k", F.lit(False).alias("_mid"), none.alias("hybm"), none.alias("lev"), double(interfaces, "hybi").alias("hybi"), double(interfaces, "ilev").alias("ilev"))
    both = levels.unionByName(faces).groupBy(*keys, "k").agg(F.max("_mid").alias("_mid"), *[F.max(c).alias(c) for c in ("hybm", "lev", "hybi", "ilev")])
    rising = make_strictly_monotonic(both, "increasing", keys, "k", ("hybm", "hybi"), block)
    near = with_neighbours(rising, ["hybm", "lev", "hybi", "ilev", "_mid"], keys, "k", block)

    def synthetic(name: str) -> tuple[Column, Column]:
        return F.coalesce((F.col(f"{name}_before") + F.col(name)) * 0.5, F.lit(0.0)), F.coalesce((F.col(name) + F.col(f"{name}_after")) * 0.5, F.lit(1.0))

    pairs = {"hybi": (F.col("hybi"), F.col("hybi_after")), "ilev": (F.col("ilev"), F.col("ilev_after"))}
    made = {"hybm": synthetic("hybm"), "lev": synthetic("lev")}
    sure = lambda c: F.coalesce(c, F.lit(False))
    is_mid = F.col("_mid")
    every = lambda condition: F.bool_and(~is_mid | condition)

    def mid_ok(name: str) -> Column:
        up, down = F.col(name) > F.col(f"{name}_before"), F.col(name) < F.col(f"{name}_before")
        first = F.coalesce(~F.col("_mid_before"), F.lit(True))
        return every(sure(F.col(name).between(0.0, 1.0))) & (every(first | sure(up)) | every(first | sure(down)))

    def pair_ok(b0: Column, b1: Column) -> Column:
        return every(sure((b0 < b1) & (b0 >= 0.0) & (b1 <= 1.0)))

    unit = lambda c: sure((F.min(c) >= 0) & (F.max(c) <= 1))
    facts = near.groupBy(*keys).agg(
        F.sum(is_mid.cast("long")).alias("_n"),
        *[F.count(c).alias(f"_n_{c}") for c in ("hybm", "hybi", "ilev")],
        unit("lev").alias("_lev_unit"),
        unit("ilev").alias("_ilev_unit"),
        mid_ok("hybm").alias("_ok_hybm"),
        mid_ok("lev").alias("_ok_lev"),
        *[pair_ok(*pairs[c]).alias(f"_ok_{c}") for c in pairs],
        *[pair_ok(*made[c]).alias(f"_ok_from_{c}") for c in made],
    )
    def choose(way: tuple[Column, Column, Column], of_pair: Callable[[str], Column], of_made: Callable[[str], Column]) -> Column:
        by_hybm, by_hybi, by_ilev = way
        from_mid = F.when(by_hybm, of_made("hybm")).otherwise(of_made("lev"))
        return F.when(by_hybi, of_pair("hybi")).when(by_ilev, of_pair("ilev")).otherwise(from_mid)

    counted = (F.col("_n_hybm") > 0, F.col("_n_hybi") > 0, F.col("_ilev_unit") & (F.col("_n_ilev") == F.col("_n") + 1))
    mids_valid = F.when(counted[0], F.col("_ok_hybm")).otherwise(F.col("_lev_unit") & F.col("_ok_lev"))
    bounds_valid = choose(counted, lambda c: F.col(f"_ok_{c}"), lambda c: F.col(f"_ok_from_{c}"))
    size_valid = ~counted[1] | (F.col("_n_hybi") == F.col("_n") + 1)
    judged = facts.select(
        *keys, *[c.alias(n) for n, c in zip(("_hybm", "_hybi", "_ilev"), counted)], (mids_valid & bounds_valid & size_valid).alias("valid")
    )
    way = (F.col("_hybm"), F.col("_hybi"), F.col("_ilev"))
    sigma = F.when(way[0], F.col("hybm")).otherwise(F.col("lev"))
    lower = choose(way, lambda c: pairs[c][0], lambda c: made[c][0])
    upper = choose(way, lambda c: pairs[c][1], lambda c: made[c][1])
    joined = near.filter(is_mid).join(judged, list(keys))
    out = joined.select(*keys, "k", sigma.alias("sigma"), lower.alias("b0"), upper.alias("b1"), "valid")
    if check == "flag":
        return out
    wrong = F.raise_error(F.concat(F.lit("sigma axis is not strictly monotone within 0..1: "), F.col(keys[0]).cast("string")))
    return out.withColumn("sigma", F.when(F.col("valid"), F.col("sigma")).otherwise(wrong.cast("double"))).drop("valid")


def corner_bounds(corners: DataFrame, keys: Sequence[str] = ("axis_id",)) -> DataFrame:
    """Per cell (j, i) the smallest and largest of its four corner values, missing skipped.

    Every corner reports to the up to four cells it touches, so only a sum per cell is needed and no ordering.
    """
    touched = F.array(
        *[F.struct((F.col("j") - dj).alias("j"), (F.col("i") - di).alias("i")) for dj in (0, 1) for di in (0, 1)]
    )
    reports = corners.select(*keys, "v", F.explode(touched).alias("_c"))
    cells = reports.groupBy(*keys, F.col("_c.j").alias("j"), F.col("_c.i").alias("i")).agg(
        F.min("v").alias("b0"), F.max("v").alias("b1"), F.count(F.lit(1)).alias("_n")
    )
    return cells.filter(F.col("_n") == 4).drop("_n")


def supergrid_split(supergrid: DataFrame) -> DataFrame:
    """Centres (odd j and i) and corners (even j and i) of a supergrid, longitudes in [0, 360)."""
    odd = (F.pmod(F.col("j"), F.lit(2)) == 1) & (F.pmod(F.col("i"), F.lit(2)) == 1)
    even = (F.pmod(F.col("j"), F.lit(2)) == 0) & (F.pmod(F.col("i"), F.lit(2)) == 0)
    half = {"j": F.floor(F.col("j") / 2).cast("long"), "i": F.floor(F.col("i") / 2).cast("long")}
    kind = F.when(odd, F.lit("center")).when(even, F.lit("corner"))
    return supergrid.withColumn("kind", kind).filter(F.col("kind").isNotNull()).withColumns(half | {"lon": F.pmod(F.col("lon"), F.lit(360.0))})


BUCKET = 1_000_000  # points that one window numbers
MOST_BUCKETS = 1024  # beyond as many, buckets grow
PER_BUCKET = 16  # points sampled for each bound


def value_bounds(points: DataFrame, order: str, size: int = BUCKET) -> list:
    """Values that cut the points into buckets of about ``size`` by ``order``: at most 1,023, read off a sample.

    The sample goes by the hash of the whole point, so a point is in it or not whenever and wherever it is looked at. Some 16
    points a bucket come to the driver, however many points there are. Equal values are never cut apart.
    """
    total = points.count()
    buckets = min(-(-total // size), MOST_BUCKETS)
    if buckets < 2:
        return []
    drawn = points.filter(F.pmod(F.xxhash64(*points.columns), F.lit(1 << 30)) < F.lit(min(1 << 30, (buckets * PER_BUCKET << 30) // total + 1)))
    values = [r[0] for r in drawn.filter(F.col(order).isNotNull()).select(order).orderBy(order).collect()]
    cuts = [values[len(values) * k // buckets] for k in range(1, buckets)] if values else []
    return list(dict.fromkeys(cuts))


def bucket_of(value: Column, bounds: Sequence) -> Column:
    """How many of the sorted ``bounds`` are not above the value, found by halving; 0 for NULL."""
    table = F.array(*[F.lit(b) for b in bounds])
    width = 1 << (len(bounds).bit_length() - 1)
    steps = F.array(*[F.lit(width >> k) for k in range(width.bit_length())])
    reached = lambda at: (at <= len(bounds)) & F.coalesce(F.get(table, at - 1) <= value, F.lit(False))
    return F.aggregate(steps, F.lit(0), lambda done, step: F.when(reached(done + step), done + step).otherwise(done))


def index_axis(axis: DataFrame, order: str, keys: Sequence[str] = AXIS, bucket: Column | None = None, size: int = BUCKET) -> DataFrame:
    """0-based consecutive position ``i`` of the distinct coordinate values of each axis; NULL comes first.

    Points are cut into buckets by value. Each bucket is numbered on its own and starts after the counted size of the buckets
    before it, so no window holds a long axis, and an axis that holds most points gets most buckets. Bounds are sampled
    (:func:`value_bounds`), or ``bucket`` is an expression that never falls as ``order`` rises (a year of a date, a value range).
    """
    points = axis.select(*keys, order).distinct()
    if bucket is None:
        bounds = value_bounds(points, order, size)
        if not bounds:
            return points.withColumn("i", (F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1).cast("long"))
        bucket = bucket_of(F.col(order), bounds)
    points = points.withColumn("_b", bucket)
    sizes = points.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(k).alias(f"_{n}") for n, k in enumerate(keys)], F.col("_b").alias("_bucket"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    local = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(order)) - 1
    same = F.col("_b").eqNullSafe(F.col("_bucket"))
    for n, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_{n}"))
    numbered = points.withColumn("_local", local).join(starts, same)
    return numbered.select(*keys, order, (F.col("_local") + F.col("_start")).cast("long").alias("i"))
