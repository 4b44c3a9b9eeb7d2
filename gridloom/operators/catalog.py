"""Catalog operators: one row per target variable, worked on as columns.

Columns: ``name, table, units, formula, positive, cell_methods, regrid_method, long_name, standard_name, region,
dims ARRAY<ARRAY<STRING>>, sources ARRAY<STRUCT<model_var, alias, freq>>, levels STRUCT<name, units, src_axis_name,
src_axis_bnds>, variants ARRAY<STRUCT<long_name, formula, region>>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import fixed_values as fixed
from gridloom.functions import text as tx
from gridloom.functions.sizing import small

CATALOG_SCHEMA = (
    "name string, table string, units string, formula string, positive string, cell_methods string, "
    "regrid_method string, long_name string, standard_name string, region string, dims array<array<string>>, "
    "sources array<struct<model_var:string,alias:string,freq:string>>, "
    "levels struct<name:string,units:string,src_axis_name:string,src_axis_bnds:string>, "
    "variants array<struct<long_name:string,formula:string,region:string>>"
)


def strings(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


# --- sources --------------------------------------------------------------------------------------------------------


def sources_for_freq(sources: Column, freq: str | None) -> Column:
    """Sources that apply at a frequency.

    Without tags or without a frequency all apply. Else the matching ones followed by the untagged ones; without a
    match the untagged ones, and without those all.
    """
    if freq is None:
        return sources
    matched = F.filter(sources, lambda s: s["freq"] == freq)
    untagged = F.filter(sources, lambda s: s["freq"].isNull())
    return (
        F.when(F.size(untagged) == F.size(sources), sources)
        .when(F.size(matched) > 0, F.concat(matched, untagged))
        .when(F.size(untagged) > 0, untagged)
        .otherwise(sources)
    )


def supports_freq(sources: Column, freq: str | None) -> Column:
    """Whether any source is untagged or tagged with the frequency; entries without sources always qualify."""
    if freq is None:
        return F.lit(True)
    fits = F.exists(sources, lambda s: s["freq"].isNull() | (s["freq"] == freq))
    return F.coalesce(fits | (F.size(sources) == 0), F.lit(True))


def expand_variants(catalog: DataFrame) -> DataFrame:
    """One row per variant with its own texts over the entry's; entries without variants stay one row.

    ``variant`` numbers them from 0, and the bare name means variant 0.
    """
    spread = catalog.select("*", F.posexplode_outer("variants").alias("_pos", "_variant")).drop("variants")
    own = {n: F.coalesce(F.col(f"_variant.{n}"), F.col(n)) for n in ("long_name", "formula", "region")}
    return spread.withColumns(own).withColumn("variant", F.coalesce("_pos", F.lit(0))).drop("_pos", "_variant")


def alias_binding(sources: Column) -> Column:
    """Map from formula token to native variable; a later source of the same token replaces an earlier one."""
    pairs = F.transform(sources, lambda s: F.struct(F.coalesce(s["alias"], s["model_var"]).alias("k"), s["model_var"].alias("v")))
    tokens = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    last = F.transform(tokens, lambda t: F.element_at(F.filter(pairs, lambda p: p["k"] == t), -1)["v"])
    return F.map_from_arrays(tokens, last)


def normalize_catalog(catalog: DataFrame, freq: str | None = None) -> DataFrame:
    """Plain table names; a single source without formula becomes ``source``, anything else ``raw_variables``.

    Adds ``source``, ``raw_variables`` and ``source_aliases`` for the frequency. Entries without any source are an error.
    """
    active = sources_for_freq(F.col("sources"), freq)
    checked = F.when(F.coalesce(F.size(active), F.lit(0)) > 0, active).otherwise(
        F.raise_error(F.concat(F.lit("no sources for "), F.col("name")))
    )
    names = F.transform(F.col("_active"), lambda s: s["model_var"])
    direct = (F.size("_active") == 1) & (F.coalesce("formula", F.lit("")) == "")
    return (
        catalog.withColumn("_active", checked)
        .withColumn("table", F.regexp_replace("table", "^CMIP7_", ""))
        .withColumn("source", F.when(direct, names[0]))
        .withColumn("raw_variables", F.when(~direct, names))
        .withColumn("source_aliases", F.when(~direct, alias_binding(F.col("_active"))))
        .drop("_active")
    )


def required_inputs(catalog: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """(name, var): every native variable a target needs; names without an entry drop out."""
    chosen = catalog if targets is None else catalog.join(targets.select("name").distinct(), "name", "left_semi")
    level = F.lower(F.coalesce(F.col("levels.name"), F.lit("")))
    needed = F.concat(
        F.coalesce(F.transform("sources", lambda s: s["model_var"]), strings([])),
        F.when(F.contains(level, F.lit("plev")), strings(fixed.PRESSURE_INPUTS))
        .when(level == "standard_hybrid_sigma", strings(fixed.HYBRID_INPUTS))
        .otherwise(F.array().cast("array<string>")),
        strings(fixed.STATIC_INPUTS),
    )
    return chosen.select("name", F.explode(F.array_distinct(needed)).alias("var"))


def required_variables(catalog: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """Distinct native variables of all targets, sorted."""
    return required_inputs(catalog, targets).select("var").distinct().orderBy("var")


def select_files(files: DataFrame, variables: DataFrame, pattern: str | None = None) -> DataFrame:
    """Files (``path``) whose name holds ``.VAR.`` for one of the variables and, if given, the pattern.

    The name is split at its dots and each inner part joins the variable list by equality.
    """
    name = tx.file_name(F.col("path"))
    kept = files if pattern is None else files.filter(F.contains(name, F.lit(pattern)))
    parts = F.split(name, r"\.")
    inner = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0)))
    tokens = kept.withColumn("var", F.explode(F.array_distinct(inner)))
    return tokens.join(small(variables.select("var").distinct()), "var", "left_semi").drop("var").distinct()


def drop_targets_without_inputs(catalog: DataFrame, available: DataFrame) -> DataFrame:
    """Targets whose every explicit source is among the available variables (``var``)."""
    needs = catalog.select("name", F.explode(F.transform("sources", lambda s: s["model_var"])).alias("var"))
    lacking = needs.join(available.select("var").distinct(), "var", "left_anti").select("name").distinct()
    return catalog.join(lacking, "name", "left_anti")


# --- targets --------------------------------------------------------------------------------------------------------


def request_filter(
    request: DataFrame, realm: str, frequency: str, experiment: str | None = None, skipped: Sequence[str] = (fixed.SKIPPED_REGION,)
) -> DataFrame:
    """Request rows of a realm, frequency and experiment, without the ``skipped`` regions, which are not produced."""
    wanted = (F.col("realm") == realm) & (F.col("frequency") == frequency)
    wanted = wanted if experiment is None else wanted & (F.col("experiment") == experiment)
    return request.filter(wanted & ~F.coalesce("region", F.lit("")).isin(*skipped))


def first_by_name(rows: DataFrame, order: str = "ord", name: str = "name") -> DataFrame:
    """First row of each name in request order; a grouped minimum, so repeated names shrink before the shuffle."""
    others = [c for c in rows.columns if c != name]
    best = rows.groupBy(name).agg(F.min_by(F.struct(*others), F.col(order)).alias("_r"))
    return best.select(name, "_r.*")


def restrict_to_names(request: DataFrame, names: Sequence[str], order: str = "ord") -> DataFrame:
    """Request rows with one of the names, each name once, in request order."""
    return first_by_name(request.filter(F.col("name").isin(list(names))), order).orderBy(order)


def assemble_targets(catalog: DataFrame, request: DataFrame, freq: str | None = None) -> DataFrame:
    """Catalog entries that support the frequency, with the first request row of the name or a synthetic one.

    ``catalog`` has ``ord``; the result is in that order with ``parameter`` and ``is_synthetic``.
    """
    usable = catalog.filter(supports_freq(F.col("sources"), freq))
    known = first_by_name(request.select("name", "ord", "parameter").withColumnRenamed("ord", "_ord"), "_ord")
    joined = usable.join(known, "name", "left")
    return (
        joined.withColumn("is_synthetic", F.col("_ord").isNull())
        .withColumn("parameter", F.coalesce("parameter", "name"))
        .drop("_ord")
    )


def split_targets(catalog: DataFrame) -> DataFrame:
    """One row per output grid of a target: each inner list of ``dims``."""
    return catalog.withColumn("dims", F.explode("dims"))


def route(dims: Column, realm: Column, model: str, level_name: Column) -> Column:
    """Way a target is derived: native ocean, native sea ice, zonal on pressure, or general.

    Longitude/latitude dims mean the native ocean grid only in ocean realms.
    """
    native_dims = F.array_contains(dims, "latitude") & F.array_contains(dims, "longitude")
    ocean = tx.canonical_realm(realm) == "ocean"
    ice_native = (realm == "seaIce") & (F.lit(model != "cesm") | (F.size(dims) == 1))
    return (
        F.when(F.lit(model == "cesm") & ocean & native_dims, F.lit("ocean_native"))
        .when(ice_native, F.lit("seaice_native"))
        .when(F.coalesce(level_name, F.lit("")) == "plev39", F.lit("zonal_pressure"))
        .otherwise(F.lit("general"))
    )


HYBRID_MISPLACED = "hybrid sigma coordinates are only supported for atmosphere tables"


def level_kind(dims: Column, level_name: Column, realm: Column, misplaced: Column | None = None) -> Column:
    """Vertical axis family of a target; hybrid levels outside the atmosphere realms are an error, or ``misplaced``."""
    name = F.lower(F.coalesce(level_name, F.lit("")))
    hybrid = name.isin(*fixed.SIGMA_LEVELS) | F.array_contains(dims, "lev")
    allowed = F.lower(realm).isin(*[r.lower() for r in fixed.HYBRID_REALMS])
    wrong = F.raise_error(F.lit(HYBRID_MISPLACED)).cast("string") if misplaced is None else misplaced
    chain = F.when(hybrid, F.when(allowed, F.lit("hybrid")).otherwise(wrong)).when(
        F.array_contains(dims, "plev"), F.when(F.startswith(name, F.lit("plev")), name).otherwise(F.lit("plev"))
    )
    chain = chain.when(F.array_contains(dims, "sdepth"), F.lit("sdepth")).when(F.array_contains(dims, "z_l"), F.lit("z_l"))
    chain = chain.when(F.array_contains(dims, "zl") | F.array_contains(dims, "olevel"), F.lit("olevel"))
    return (
        chain.when(F.array_contains(dims, "fates_levpft"), F.lit("pft"))
        .when(F.array_contains(dims, "fates_levfuel"), F.lit("fuelclass"))
        .otherwise(F.lit("none"))
    )


# --- sheets ---------------------------------------------------------------------------------------------------------


def sheet_to_catalog(sheet: DataFrame, *, rename_dimensions: bool = False) -> DataFrame:
    """Catalog rows from cleaned sheet columns.

    Reads ``name, table, source_expr, formula, dims, units, freq, alias`` and the four level columns; a given formula
    column decides, else an expression in ``source_expr`` is the formula, its index sums written as helper calls.
    """
    text = F.trim("source_expr")
    listed = tx.identifier_list(text)
    plain = listed.isNotNull() & ~F.contains(text, F.lit("FATES"))
    names = F.when(plain, listed).when(tx.is_expression(text), tx.expression_variables(text)).otherwise(F.array(text))
    count = F.size("_names")
    blank = lambda c: F.nullif(c, F.lit(""))
    with_names = sheet.withColumn("_names", names)
    zipped = F.arrays_zip(
        F.col("_names").alias("m"),
        tx.positional_split(F.col("alias"), count).alias("a"),
        tx.positional_split(F.col("freq"), count).alias("f"),
    )
    sources = F.transform(
        zipped, lambda s: F.struct(s["m"].alias("model_var"), blank(s["a"]).alias("alias"), blank(s["f"]).alias("freq"))
    )
    from_source = F.when(~plain & tx.is_expression(text), fates_fraction(tx.write_index_sums(text)))
    dims = tx.parse_dimensions(F.col("dims"), rename_dimensions=rename_dimensions)
    nested = F.from_json("dims", "array<array<string>>")
    is_nested = F.regexp_like(F.col("dims"), F.lit(r"^\s*\[\s*\["))
    levels = tx.infer_levels(
        raw_dimensions(F.col("dims"), rename_dimensions),
        *[F.col(c) if c in sheet.columns else None for c in ("levels_name", "levels_units", "levels_axis", "levels_bounds")],
    )
    formula = F.coalesce(blank(F.col("formula")), from_source) if "formula" in sheet.columns else from_source
    return (
        with_names.withColumn("sources", sources)
        .withColumn("formula", formula)
        .withColumn("levels", levels)
        .withColumn("units", tx.plain_number(F.col("units")))
        .withColumn("dims", F.when(is_nested, nested).otherwise(F.array(dims)))
        .drop("_names", "source_expr", "freq", "alias", "levels_name", "levels_units", "levels_axis", "levels_bounds")
    )


def raw_dimensions(dims: Column, rename_dimensions: bool) -> Column:
    """Dimension names while the pressure axis still has its number."""
    listed = F.split(F.regexp_replace(dims, r"[\[\]\"]", ""), ",")
    return F.transform(listed, lambda d: tx.clean_cell(d, rename_dimensions=rename_dimensions))


def fates_fraction(formula: Column) -> Column:
    """FATES amounts are per vegetated fraction, so the formula is multiplied by it unless it names it."""
    add = F.contains(formula, F.lit("FATES")) & ~F.contains(formula, F.lit("FATES_FRAC"))
    return F.when(add, F.concat(F.lit("("), formula, F.lit(")*FATES_FRAC"))).otherwise(formula)


def group_catalog_rows(rows: DataFrame, order: str = "ord") -> DataFrame:
    """Rows of the same name as one entry: variants in row order for sea ice, the first row otherwise.

    Only names whose first row is sea ice gather a list (one item per region); other duplicates reduce to a minimum.
    """
    first = first_by_name(rows, order)
    ice = rows.join(first.filter(F.col("table") == "seaIce").select("name"), "name", "left_semi")
    item = F.struct(F.col(order).alias("_o"), "long_name", "formula", "region")
    listed = ice.groupBy("name").agg(F.array_sort(F.collect_list(item)).alias("_all")).filter(F.size("_all") > 1)
    whole = first.join(listed, "name", "left").withColumn("variants", F.transform("_all", lambda v: v.dropFields("_o")))
    own = {c: F.when(F.col("variants").isNull(), F.col(c)) for c in ("long_name", "formula", "region")}
    return whole.withColumns(own).drop("_all", order)


def catalog_to_rows(catalog: DataFrame) -> DataFrame:
    """One flat sheet row per variant; lists joined by comma, dims as JSON.

    Rows of entries with variants carry only the variant's formula and region; plain entries have no region.
    """
    spread = catalog.select("*", F.posexplode_outer("variants").alias("_pos", "_v"))
    is_variant = F.col("_pos").isNotNull()
    text = lambda c: F.coalesce(c, F.lit(""))

    def joined(field: str) -> Column:
        values = F.transform("sources", lambda s: F.coalesce(s[field], F.lit("")))
        return F.when(F.exists(values, lambda v: v != ""), F.array_join(values, ", ")).otherwise(F.lit(""))

    flat_dims = F.when(F.size("dims") == 1, F.to_json(F.element_at("dims", 1))).otherwise(F.to_json("dims"))
    return spread.select(
        "name",
        text(F.col("table")).alias("table"),
        F.when(is_variant, F.coalesce("_v.long_name", "long_name", F.lit(""))).otherwise(text(F.col("long_name"))).alias("long_name"),
        text(F.col("standard_name")).alias("standard_name"),
        text(F.col("units")).alias("units"),
        text(flat_dims).alias("dims"),
        F.array_join(F.filter(F.transform("sources", lambda s: s["model_var"]), lambda n: n != ""), ", ").alias("source_expr"),
        F.when(is_variant, text(F.col("_v.formula"))).otherwise(text(F.col("formula"))).alias("formula"),
        joined("freq").alias("freq"),
        joined("alias").alias("alias"),
        text(F.col("cell_methods")).alias("cell_methods"),
        text(F.col("regrid_method")).alias("regrid_method"),
        F.when(is_variant, text(F.col("_v.region"))).otherwise(F.lit("")).alias("region"),
        text(F.col("positive")).alias("positive"),
        text(F.col("levels.name")).alias("levels_name"),
        text(F.col("levels.units")).alias("levels_units"),
        text(F.col("levels.src_axis_name")).alias("levels_axis"),
        text(F.col("levels.src_axis_bnds")).alias("levels_bounds"),
        F.coalesce("_pos", F.lit(0)).alias("variant"),
    )


# --- request against catalog ----------------------------------------------------------------------------------------


def catalog_gap(request: DataFrame, tables: DataFrame, catalog: DataFrame) -> DataFrame:
    """(name, table, kind): requested names without an entry, as ``stub`` if a table defines them else ``not_in_tables``.

    ``tables`` has ``name`` and ``table``.
    """
    open_names = request.select("name").distinct().join(catalog.select("name"), "name", "left_anti")
    defined = tables.groupBy("name").agg(F.max("table").alias("table"))
    joined = open_names.join(defined, "name", "left")
    return joined.withColumn("kind", F.when(F.col("table").isNotNull(), "stub").otherwise("not_in_tables"))


def request_rollup(request: DataFrame) -> DataFrame:
    """Per name its sorted experiments, joined over all opportunities, and its priority.

    Duplicate pairs vanish before the shuffle; the list is as long as there are experiments.
    """
    return request.groupBy("name").agg(
        F.array_sort(F.collect_set("experiment")).alias("experiments"), F.min("priority").alias("priority")
    )


def merge_catalog_rows(existing: DataFrame, stubs: DataFrame, meta: DataFrame) -> DataFrame:
    """Existing rows with the request's parameter, priority and experiments, followed by the stub rows with theirs."""
    facts = meta.select("name", "parameter", "priority", "experiments")
    rows = existing.withColumn("is_stub", F.lit(False)).unionByName(
        stubs.withColumn("is_stub", F.lit(True)), allowMissingColumns=True
    )
    return rows.join(facts, "name", "left")


def stub_levels(dims: Column) -> Column:
    """Level block a dimension list implies: plev19 and plev39 by name, model levels as hybrid."""
    listed = F.filter(dims, lambda d: d.isin("plev19", "plev39", "alevel"))
    first = F.get(listed, F.lit(0))
    return F.when(first == "alevel", F.lit("standard_hybrid_sigma")).otherwise(first)


def table_realm(realm: Column, table: Column) -> Column:
    """First word of the realm text, else the table's own id."""
    words = F.split(F.trim(F.coalesce(realm, F.lit(""))), r"\s+")
    return F.coalesce(F.nullif(words[0], F.lit("")), table)
