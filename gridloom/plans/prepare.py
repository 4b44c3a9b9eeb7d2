"""From native fields and a catalog to output fields: derive, interpolate, regrid, all targets of a kind in one plan.

The catalog is read first and decides what is built. Targets that travel alike (route, levels, surface, map) are derived
together: direct ones are a lookup, plain formulas share one pivot, those with helper sums one grouping. A target that
cannot be made is reported and stops no other.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import fixed_values as fixed
from gridloom.functions.calendar import encode_time
from gridloom.functions.sizing import small
from gridloom.functions.text import canonical_realm
from gridloom.operators import catalog as ct
from gridloom.operators import derive as dv
from gridloom.operators import named_dims as nd
from gridloom.operators import packed as pk
from gridloom.operators import regrid as rg
from gridloom.operators import vertical as vt
from gridloom.sources.sinks import prepare_output, with_facets, write_tree

FIELD = ("var", "time_idx", "lev", "cell", "value")


@dataclass(frozen=True)
class Target:
    """One output variable: what it is made of and how it travels."""

    name: str
    route: str
    source: str | None
    aliases: Mapping[str, str]
    formula: str | None
    region: str | None
    level: str | None
    map_id: str | None
    surface: str = "all"  # land and ocean fields are weighted by the fraction of their surface
    kind: str | None = None  # vertical axis family
    parameter: str | None = None  # what the request calls it
    synthetic: bool = False  # in the catalog, not in the request

    @property
    def key(self) -> str:
        """Name of its rows while they travel: variants of one name differ by region."""
        return self.name if self.region is None else f"{self.name}@{self.region}"


TARGET_COLUMNS = ("name", "route", "source", "aliases", "formula", "region", "level", "map_id", "surface", "kind", "parameter", "synthetic")


def target_rows(
    catalog: DataFrame,
    model: str,
    freq: str | None = None,
    maps: DataFrame | None = None,
    resolution: str | None = None,
    request: DataFrame | None = None,
    requested_only: bool = False,
) -> DataFrame:
    """Targets of a catalog as rows, one per variant and way: :func:`plan_targets` tells what they mean."""
    numbered = catalog if "ord" in catalog.columns else catalog.withColumn("ord", F.monotonically_increasing_id())
    if request is None:
        usable = numbered.filter(ct.supports_freq(F.col("sources"), freq))
        usable = usable.withColumns({"parameter": F.lit(None).cast("string"), "is_synthetic": F.lit(False)})
    else:
        usable = ct.assemble_targets(numbered, request, freq)
        usable = usable.filter(~F.col("is_synthetic")) if requested_only else usable
    spread = ct.split_targets(ct.normalize_catalog(ct.expand_variants(usable), freq))
    routed = spread.withColumn("route", ct.route(F.col("dims"), F.col("table"), model, F.col("levels.name")))
    mapped = routed.withColumn("map_id", F.lit(None).cast("string")) if maps is None else rg.pick_map(routed, maps, model, resolution)
    realm = canonical_realm(F.col("table"))
    surface = F.when(realm.isin("land", "landIce"), "land").when(realm.isin("ocean", "seaIce"), "ocean").otherwise("all")
    told = {
        "aliases": F.array_sort(F.map_entries("source_aliases")),
        "formula": F.nullif(F.col("formula"), F.lit("")),
        "level": F.col("levels.name"),
        "surface": surface,
        "kind": ct.level_kind(F.col("dims"), F.col("levels.name"), F.col("table"), misplaced=F.lit("misplaced")),
        "synthetic": F.col("is_synthetic"),
    }
    return mapped.withColumns(told).groupBy(*TARGET_COLUMNS).agg(F.min("ord").alias("ord"), F.min("variant").alias("variant"))


def plan_targets(
    catalog: DataFrame,
    model: str,
    freq: str | None = None,
    maps: DataFrame | None = None,
    resolution: str | None = None,
    request: DataFrame | None = None,
    requested_only: bool = False,
) -> list[Target]:
    """Targets of a catalog, one per variant and output grid. A catalog has some thousand entries, so the list is short.

    Output grids that go the same way (they differ in the names of dimensions only) are one target. They stand in catalog
    order (``ord`` if it has one). With a ``request`` (``name, ord, parameter``) each has the parameter of the first request
    row of its name; entries without one are synthetic, named by themselves, and left out if ``requested_only``.
    """
    rows = target_rows(catalog, model, freq, maps, resolution, request, requested_only)
    listed = sorted(rows.collect(), key=lambda r: (r["ord"], r["variant"], r["route"]))
    own = [c for c in TARGET_COLUMNS if c != "aliases"]
    return [Target(aliases={e["key"]: e["value"] for e in r["aliases"] or ()}, **{c: r[c] for c in own}) for r in listed]


def plain_sql(formula: str, aliases: Mapping[str, str]) -> str:
    """Formula with aliases replaced by the native names behind them."""
    return re.sub(r"\b[A-Za-z_]\w*\b", lambda m: aliases.get(m.group(0), m.group(0)), formula)


def realize_targets(
    spark: SparkSession,
    field: DataFrame,
    targets: Sequence[Target],
    static: DataFrame | None = None,
    available: Mapping[str, bool] | Sequence[str] | None = None,
    dim_first: int = 0,
    dims: Mapping[str, Sequence[str]] | None = None,
) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """Field rows of all targets by their keys, and (name, status) of each; what cannot be made is reported.

    ``available`` tells of each variable of the field whether it has levels; otherwise this is measured, in one pass.
    ``dims`` names the dimensions of variables that have positions in columns of their own (soil levels, plant types): a helper call
    of a formula over such variables reduces the one it names; a dimension that is left over becomes the level.
    """
    dims = dims or {}
    columns = sorted({d for own in dims.values() for d in own})
    named: dict[str, dv.Lowered] = {}
    named_names: dict[str, list[str]] = {}
    named_static: set[str] = set()
    native_field, field = field, field.drop(*columns)
    shapes = available if isinstance(available, Mapping) else dv.shapes_of(field)
    static_columns = set(static.columns) - {"cell"} if static is not None else set()
    status: list[tuple[str, str]] = []
    direct: list[tuple[str, str]] = []
    formulas: dict[str, str] = {}
    from_static: dict[str, str] = {}
    summed: dict[str, dv.Lowered] = {}
    summed_names: dict[str, list[str]] = {}
    pieces: list[DataFrame] = []
    inputs: set[str] = set()
    plain_static: set[str] = set()
    summed_static: set[str] = set()
    for target in targets:
        needed = {target.source} if target.source else set(target.aliases.values())
        missing = sorted(needed - set(shapes) - static_columns)
        if missing:
            status.append((target.name, f"missing inputs: {', '.join(missing)}"))
            continue
        if target.source:
            if target.source in shapes:
                direct.append((target.source, target.key))
            else:
                from_static[target.key] = f"`{target.source}`"
        elif not target.formula:
            status.append((target.name, "incomplete mapping: several sources without a formula"))
            continue
        else:
            lowered = dv.lower_formula(plain_sql(target.formula, target.aliases))
            problem = dv.formula_problem(lowered, sorted(needed))
            if problem is None and lowered.region and "tlat" not in static_columns:
                problem = "missing inputs: tlat"
            if problem:
                status.append((target.name, problem))
                continue
            used = sorted(needed & set(shapes) & lowered.names())
            by_cell = sorted((needed & lowered.names()) - set(shapes))
            levelled = [n for n in used if shapes[n]]
            if not used and not lowered.region and not lowered.steps:
                from_static[target.key] = lowered.sql
            elif lowered.steps and any(n in dims for n in used):
                try:
                    left = nd.result_dims(lowered, used, dims)
                except ValueError as error:
                    status.append((target.name, str(error)))
                    continue
                if len(left) > 1:
                    status.append((target.name, f"result keeps several dimensions: {', '.join(left)}"))
                    continue
                named[target.key], named_names[target.key] = lowered, used
                named_static |= set(by_cell)
            elif lowered.region:
                pieces.append(dv.realize_regional(field, static, target.key, lowered, used))
            elif lowered.steps and set(levelled) & set(re.findall(r"\w+", lowered.sql)):
                pieces.append(dv.realize_steps(field, target.key, lowered, used, "lev", dim_first, levelled=levelled, static=static, static_names=by_cell))
            elif lowered.steps:
                summed[target.key], summed_names[target.key] = lowered, used
                summed_static |= set(by_cell)
            else:
                formulas[target.key] = lowered.sql
                inputs |= set(used)
                plain_static |= set(by_cell)
        status.append((target.name, "ok"))
    if direct:
        names = spark.createDataFrame(direct, "var string, target string")  # as long as the catalog
        native = field.filter(F.col("var").isin(sorted({source for source, _ in direct})))
        pieces.append(native.join(F.broadcast(names), "var").withColumn("var", F.col("target")).drop("target"))
    if formulas:
        free = [n for n in sorted(inputs) if not shapes[n]]
        pieces.append(dv.realize_formulas(field, formulas, sorted(inputs), level_free=free, static=static, static_names=sorted(plain_static)))
    if summed:
        pieces.append(dv.realize_step_targets(field, summed, summed_names, "lev", dim_first, static=static, static_names=sorted(summed_static)))
    if named:
        made = nd.realize_named(native_field, named, named_names, dims, dict.fromkeys(columns, dim_first), static=static, static_names=sorted(named_static))
        left = sorted({d for names in named_names.values() for n in names for d in dims.get(n, ())})
        pieces.append(made.select("var", "time_idx", F.coalesce(*left, F.lit(None).cast("int")).alias("lev"), "cell", "value"))
    if from_static:
        pieces.append(dv.realize_static(static, from_static))
    if not all("block" in p.columns for p in pieces):  # derived rows have no layout, and none may fall out of a join by block
        pieces = [p.drop("block") for p in pieces]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces) if pieces else None
    return rows, status


NATIVE_ROUTES = ("ocean_native", "seaice_native")


def _on_hybrid(target: Target) -> bool:
    return (target.level or "").lower() in fixed.SIGMA_LEVELS


def _has_levels(target: Target, shapes: Mapping[str, bool]) -> bool:
    """Whether the result of a target has levels; unknown names and formulas are judged elsewhere."""
    if target.source or not target.formula:
        return shapes.get(target.source, True)
    lowered = dv.lower_formula(plain_sql(target.formula, target.aliases))
    words = set(re.findall(r"[A-Za-z_]\w*", lowered.sql))
    return lowered.region is None and (any(shapes.get(w, False) for w in words) or not words & set(shapes))


def _problem(target: Target, shapes: Mapping[str, bool], coefficients: DataFrame | None, levels: Mapping[str, Sequence[float]]) -> str | None:
    """What the way of a target lacks, beside its own inputs."""
    if target.kind == "misplaced":
        return ct.HYBRID_MISPLACED
    if target.route in NATIVE_ROUTES:
        return None
    if target.map_id is None:
        return "no weight map"
    level = "plev39" if target.route == "zonal_pressure" else target.level
    on_pressure = (level or "").lower().startswith("plev")
    if on_pressure and level not in levels:
        return f"no levels given for {level}"
    if on_pressure or level in levels or _on_hybrid(target):
        if not _has_levels(target, shapes):
            return "levels are asked of variables without levels"
        lacking = [] if "PS" in shapes else ["PS"]
        lacking += [n for n in ("hyam", "hybm") if coefficients is None or n not in coefficients.columns]
        return f"missing inputs: {', '.join(lacking)}" if lacking else None
    if target.formula and dv.lower_formula(target.formula).region:
        return "a regional sum has no cells to regrid"
    return None


def _named_apart(rows: DataFrame, targets: Sequence[Target]) -> DataFrame:
    """Keys back to names, and the region of each variant where there are any."""
    if all(t.region is None for t in targets):
        return rows
    region = F.nullif(F.regexp_extract("var", "@(.*)$", 1), F.lit(""))
    known = F.coalesce(F.col("region"), region) if "region" in rows.columns else region
    return rows.withColumn("region", known).withColumn("var", F.substring_index("var", "@", 1))


def prepare(
    spark: SparkSession,
    field: DataFrame,
    targets: Sequence[Target],
    *,
    weights: DataFrame,
    static: DataFrame,
    coefficients: DataFrame | None = None,
    levels: Mapping[str, Sequence[float]] | None = None,
    lon_cells: int = 360,
    available: Mapping[str, bool] | Sequence[str] | None = None,
    dim_first: int = 0,
    surface_map: str | None = None,
    p0: float | None = None,
    interfaces: DataFrame | None = None,
    dims: Mapping[str, Sequence[str]] | None = None,
    packed: DataFrame | None = None,
) -> tuple[dict[str, DataFrame], list[tuple[str, str]]]:
    """Output fields by route, and the status of every target.

    Native routes keep their cells. General targets go to pressure first when they ask for it and are then regridded,
    land and ocean ones weighted by their surface. Targets on hybrid levels (output ``hybrid``) come with surface
    pressure once per time and cell (``hybrid_ps``) and coefficients once per level (``hybrid_levels``, with bounds if
    ``interfaces`` are given). Zonal ones are regridded level by level with ``PS``, interpolated and averaged.
    ``surface_map`` is the map for ``PS``, by default that of the first target. The reference pressure is the ``P0``
    stored beside the coefficients, else ``p0``, else 100000 Pa.
    A target without map, levels, coefficients or ``PS`` that it needs is reported and left out. ``dims`` names the dimensions
    that variables have in columns of their own. ``packed`` are the weights packed by cell: general and hybrid targets are then joined with them,
    without an exchange of the field where both are stored by block (plain ones) and the weights are too large to broadcast.
    """
    levels = levels or {}
    in_use = sorted({t.map_id for t in targets if t.map_id} | ({surface_map} if surface_map else set()))
    weights = weights.filter(F.col("map_id").isin(in_use))  # so that only these are measured and sent
    shapes = available if isinstance(available, Mapping) else dv.shapes_of(field)
    status: list[tuple[str, str]] = []
    groups: dict[tuple, list[Target]] = {}
    for target in targets:
        problem = _problem(target, shapes, coefficients, levels)
        if problem:
            status.append((target.name, problem))
            continue
        route = "hybrid" if target.route == "general" and _on_hybrid(target) else target.route
        level = (target.level or "") if route == "general" and target.level in levels else ""
        alike = (target.surface, "" if target.surface == "all" else target.map_id) if route == "general" else ("", "")
        groups.setdefault((route, level, *alike), []).append(target)
    made: dict[str, list[DataFrame]] = {}
    for (route, level, surface, map_id), chosen in sorted(groups.items()):
        rows, report = realize_targets(spark, field, chosen, static, shapes, dim_first, dims)
        status += report
        if rows is None:
            continue
        if route == "zonal_pressure":
            rows = _zonal(spark, rows, field, weights, chosen, coefficients, levels["plev39"], lon_cells, surface_map, p0)
        elif route == "hybrid":
            rows = _by_map(spark, rows, weights, chosen, packed=packed)
            made["hybrid_ps"] = [_surface_rows(field, rg.weights_of(weights, surface_map or chosen[0].map_id))]
            made["hybrid_levels"] = [vt.hybrid_levels(coefficients, interfaces, p0)]
        elif route == "general":
            if level:
                inputs = vt.join_column_inputs(rows, _surface(field), coefficients)
                rows = vt.to_pressure(inputs, levels[level], vt.stored_p0(inputs, p0))
            keys = [c for c in ("var", "time_idx", "lev", "plev") if c in rows.columns]
            if surface == "all":
                rows = _by_map(spark, rows, weights, chosen, keys, packed)
            else:
                rows = _masked(rows, rg.weights_of(weights, map_id), static, surface, keys)
        made.setdefault(route, []).append(_named_apart(rows, chosen))
    stacked = lambda parts: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return {route: stacked(parts) for route, parts in made.items()}, status


def _surface(field: DataFrame) -> DataFrame:
    return field.filter("var = 'PS'").select("time_idx", "cell", F.col("value").alias("ps"))


def _by_map(spark: SparkSession, rows: DataFrame, weights: DataFrame, targets: Sequence[Target], keys: Sequence[str] = rg.KEYS, packed: DataFrame | None = None) -> DataFrame:
    maps = spark.createDataFrame(sorted({(t.key, t.map_id) for t in targets}), "var string, map_id string")
    if packed is not None:
        return pk.regrid_packed(rows.join(F.broadcast(maps), "var"), packed, keys)  # one row per target
    return rg.regrid_by_map(rows.join(F.broadcast(maps), "var"), weights, keys)  # one row per target


def _surface_rows(field: DataFrame, entries: DataFrame) -> DataFrame:
    """Surface pressure on the destination grid as the variable ``ps``, which has no levels."""
    surface = field.filter("var = 'PS'").select("time_idx", "cell", "value")
    flat = rg.regrid(surface, entries, ("time_idx",))
    return flat.select(F.lit("ps").alias("var"), "time_idx", F.lit(None).cast("int").alias("lev"), "cell", "value")


def _masked(rows: DataFrame, entries: DataFrame, static: DataFrame, surface: str, keys: Sequence[str]) -> DataFrame:
    """Land fields by land fraction and divided back; ocean fields by sea fraction where the grid has one."""
    if surface == "land":
        land = rg.land_percent(static).select("cell", (F.col("value") / 100.0).alias("fraction"))
        on_target = rg.fx_fractions(static, entries).select("cell", (F.col("sftlf") / 100.0).alias("fraction"))
        return rg.regrid_masked(rows, entries, land, keys, on_target)
    if not set(fixed.SEA_FRACTION_NAMES) & set(static.columns):
        return rg.regrid(rows, entries, keys)
    sea = rg.sea_percent(static).select("cell", (F.col("value") / 100.0).alias("fraction"))
    return rg.regrid_masked(rows, entries, sea, keys)


def _with_surface(spark, rows, field, weights, targets, surface_map) -> DataFrame:
    """Targets and ``PS`` on the destination grid, from one pass over the weights."""
    names = [(t.key, t.map_id) for t in targets] + [("PS", surface_map or targets[0].map_id)]
    maps = spark.createDataFrame(sorted(set(names)), "var string, map_id string")
    both = rows.select(*FIELD).unionByName(field.filter("var = 'PS'").select(*FIELD))
    return rg.regrid_by_map(both.join(F.broadcast(maps), "var"), weights)  # one row per target


def _zonal(spark, rows, field, weights, targets, coefficients, levels, lon_cells, surface_map, p0) -> DataFrame:
    on_grid = _with_surface(spark, rows, field, weights, targets, surface_map)
    inputs = vt.join_column_inputs(on_grid.filter("var != 'PS'"), _surface(on_grid), coefficients)
    return vt.zonal_mean(vt.to_pressure(inputs, levels, vt.stored_p0(inputs, p0)), lon_cells)


def described(
    outputs: Mapping[str, DataFrame],
    catalog: DataFrame,
    time_axis: DataFrame,
    fx: DataFrame | None = None,
    *,
    ice_grid: DataFrame | None = None,
    levels: Mapping[str, DataFrame] | None = None,
    units: str = "days since 1850-01-01",
    calendar: str = "noleap",
) -> dict[str, DataFrame]:
    """Outputs as they are stored, with what their numbers mean.

    Every field row has units and names from the catalog (``name, units, long_name, standard_name``), and its time with
    bounds from ``time_axis`` (``time_idx, time, time_b0, time_b1``, as numbers or as dates, which are counted in ``units``
    of ``calendar``); a time without an entry fails, rows without a time have none. Rows of a native ice grid have its centres and
    vertices from ``ice_grid`` (``cell`` and those of ``TLAT, TLON, latt_bounds, lont_bounds`` it has); hemisphere sums have no cell
    and none. ``levels`` gives the coordinate tables of vertical axis families (``sdepth``, ``olevel``, as :func:`level_kind`
    reads them off the catalog's ``dims``, ``levels`` and ``table``): see :func:`with_levels`. Fixed fields (``fx``, one row per
    cell) become an output of their own, once per cell instead of beside every row.
    """
    dated = {c: encode_time(dict(time_axis.dtypes)[c], F.col(c), units, calendar) for c in ("time", "time_b0", "time_b1")}
    time_axis = time_axis.withColumns(dated)
    out = {}
    for route, rows in outputs.items():
        if route != "hybrid_levels":
            rows = rg.attach_time_bounds(dv.attach_attributes(rows, catalog), time_axis, ("time", "time_b0", "time_b1"))
            rows = with_levels(rows, catalog, levels) if levels and "lev" in rows.columns else rows
            rows = rg.attach_missing(rows, ice_grid, fixed.ICE_GRID_CARRIED) if ice_grid is not None and route == "seaice_native" else rows
            rows = dv.rename_dimensions(rows)
        out[route] = rows
    if fx is not None:
        names = [n for n in ("sftlf", "sftof", "areacella", "orog") if n in fx.columns]
        long = fx.select("cell", *[F.col(n).cast("double").alias(n) for n in names]).unpivot("cell", names, "var", "value")
        out["fx"] = dv.attach_attributes(long, catalog)
    return out


def with_levels(rows: DataFrame, catalog: DataFrame, levels: Mapping[str, DataFrame]) -> DataFrame:
    """Rows with the family of their vertical axis (``level_kind``) and coordinates from that family's table in ``levels``.

    A table has ``lev, level`` and, where there are bounds, ``level_b0, level_b1``. Families without a table, and rows without a
    level, have no coordinate; a level that the table of its family lacks fails when it is read. An entry with several output grids
    has the family of all its dimensions.
    """
    part = catalog.select("name", F.flatten("dims").alias("_dims"), F.col("levels.name").alias("_level"), "table")
    kind = ct.level_kind(F.col("_dims"), F.col("_level"), F.col("table"), misplaced=F.lit("misplaced"))
    kinds = part.groupBy(F.col("name").alias("var")).agg(F.coalesce(F.max(F.when(kind != "none", kind)), F.lit("none")).alias("level_kind"))
    coordinates = ("level", "level_b0", "level_b1")
    tables = [t.select(F.lit(k).alias("level_kind"), "lev", *[c for c in coordinates if c in t.columns], F.lit(True).alias("_known")) for k, t in levels.items()]
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    joined = rows.join(small(kinds), "var", "left").join(small(table), ["level_kind", "lev"], "left")
    open_level = F.col("level_kind").isin(*levels) & F.col("lev").isNotNull() & F.col("_known").isNull()
    wrong = F.raise_error(F.concat(F.lit("no coordinate for level "), F.col("lev").cast("string"), F.lit(" of "), F.col("var")))
    checked = joined.withColumn("level", F.when(open_level, wrong.cast("double")).otherwise(F.col("level")))
    return checked.select(*rows.columns, "level_kind", *[c for c in coordinates if c in table.columns])


def write_outputs(outputs: Mapping[str, DataFrame], root: str, facets: Mapping[str, str]) -> None:
    """Every route into the output tree, missing values filled, grid label by whether it was regridded.

    Hybrid coefficients are no field: they go beside the tree, into ``<root>_levels``.
    """
    for route, rows in outputs.items():
        if route == "hybrid_levels":
            rows.write.mode("overwrite").parquet(f"{root.rstrip('/')}_levels")
            continue
        regridded = route not in NATIVE_ROUTES
        write_tree(with_facets(prepare_output(rows), facets, regridded), root)
