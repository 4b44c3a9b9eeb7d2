"""Deriving target variables from native ones: renames, formulas, sums over dimensions, regional sums."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field as dataclass_field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions import fixed_values as fixed
from gridloom.functions.sizing import small
from gridloom.functions.values import scale_offset

POINT = ("time_idx", "lev", "cell")


def realize_direct(field: DataFrame, source: str, target: str) -> DataFrame:
    """Rows of one native variable under the target's name."""
    return field.filter(F.col("var") == source).withColumn("var", F.lit(target))


def require_variables(available: Sequence[str], needed: Sequence[str], context: str) -> None:
    missing = sorted(set(needed) - set(available))
    if missing:
        raise KeyError(f"{context}: missing variables {missing}")


def pivot(field: DataFrame, label: Mapping[str, str], keys: Sequence[str]) -> DataFrame:
    """One column per variable under its label, and ``_has_<label>`` where the variable has a row at the point."""
    columns = []
    for native, name in label.items():
        columns.append(F.max(F.when(F.col("var") == native, F.col("value"))).alias(name))
        columns.append(F.max(F.col("var") == native).alias(f"_has_{name}"))
    return field.filter(F.col("var").isin(*label)).groupBy(*keys).agg(*columns)


def all_present(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"_has_{n}") for n in names], F.lit(True))


def used_names(text: str, names: Sequence[str]) -> list[str]:
    return [n for n in names if re.search(rf"\b{re.escape(n)}\b", text)]


def widen(field: DataFrame, names: Sequence[str], keys: Sequence[str] = POINT, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """One column per variable, one row per point that all of them share.

    Points missing from one of the variables are dropped, as labelled arrays are aligned on common coordinates; a
    point that is present with a NULL value stays.
    """
    label = {n: n for n in names} if aliases is None else {native: alias for alias, native in aliases.items()}
    return pivot(field, label, keys).filter(all_present(list(label.values()))).select(*keys, *label.values())


def _closing(text: str, start: int) -> int:
    """Position behind the parenthesis that closes the one at ``start``, or the end of an unbalanced text."""
    depth = 0
    for at in range(start, len(text)):
        depth += {"(": 1, ")": -1}.get(text[at], 0)
        if depth == 0:
            return at + 1
    return len(text)


def guard_division(formula: str) -> str:
    """A zero divisor (a name, a call or a parenthesis) gives NULL, which the output stage fills, instead of an error."""
    head, slash, rest = formula.partition("/")
    if not slash:
        return formula
    found = re.match(r"\s*([A-Za-z_]\w*\b(?!\s*[(.])|(?:[A-Za-z_]\w*\s*)?\()", rest)
    if not found:
        return f"{head}/{guard_division(rest)}"
    end = _closing(rest, found.end() - 1) if found.group(1).endswith("(") else found.end()
    return f"{head}/ nullif({guard_division(rest[found.start(1) : end])}, 0){guard_division(rest[end:])}"


def realize_formula(
    field: DataFrame,
    target: str,
    formula: str,
    aliases: Mapping[str, str],
    keys: Sequence[str] = POINT,
    available: Sequence[str] | None = None,
) -> DataFrame:
    """Evaluate an SQL expression over aliased native variables at every shared point."""
    if available is not None:
        require_variables(available, list(aliases.values()), f"formula of {target}")
    wide = widen(field, list(aliases.values()), keys, aliases)
    return wide.select(F.lit(target).alias("var"), *keys, F.expr(guard_division(formula)).cast("double").alias("value"))


def emit(rows: DataFrame, keys: Sequence[str], outputs: Sequence[tuple[Column, str, Column]]) -> DataFrame:
    """From one row per point, one row for each (condition, target, value) whose condition holds."""
    structs = [F.struct(here.alias("here"), F.lit(target).alias("var"), value.cast("double").alias("value")) for here, target, value in outputs]
    emitted = F.filter(F.array(*structs), lambda o: o["here"])
    return rows.select(*keys, F.explode(emitted).alias("_o")).select("_o.var", *keys, "_o.value")


def realize_formulas(
    field: DataFrame,
    formulas: Mapping[str, str],
    names: Sequence[str],
    keys: Sequence[str] = POINT,
    level_free: Sequence[str] = (),
    static: DataFrame | None = None,
    static_names: Sequence[str] = (),
) -> DataFrame:
    """Many targets from one pass over the field: one pivot, then each point emits the formulas whose inputs it has.

    Variables in ``level_free`` have one value per column. Beside operands with levels that value holds on every
    level; formulas of such variables alone stay level-free. ``static_names`` are columns of ``static``, by cell.
    """
    used = {target: used_names(text, names) for target, text in formulas.items()}
    mixed = {t for t, own in used.items() if set(own) & set(level_free) and set(own) - set(level_free)}
    spread = sorted({n for t in mixed for n in used[t] if n in level_free})
    column = [k for k in keys if k != "lev"]
    # One exchange by column serves the pivot and the window over it.
    wide = pivot(field.repartition(*column) if spread else field, {n: n for n in names}, keys)
    over = Window.partitionBy(*column)
    wide = wide.withColumns({f"_all_{n}": F.max(n).over(over) for n in spread} | {f"_has__all_{n}": F.max(f"_has_{n}").over(over) for n in spread})
    if static_names:
        wide = with_static(wide, static, static_names)
    outputs = []
    for target, text in formulas.items():
        own = used[target]
        if target in mixed:
            text = re.sub(rf"\b({'|'.join(map(re.escape, spread))})\b", r"_all_\1", text)
            own = [f"_all_{n}" if n in spread else n for n in own]
        outputs.append((all_present(own), target, F.expr(guard_division(text))))
    return emit(wide, keys, outputs)


def realize_static(static: DataFrame, formulas: Mapping[str, str]) -> DataFrame:
    """Targets made of static columns only: one value per cell, without time and level."""
    rows = emit(static, ["cell"], [(F.lit(True), target, F.expr(guard_division(text))) for target, text in formulas.items()])
    none = F.lit(None).cast("int")
    return rows.select("var", none.alias("time_idx"), none.alias("lev"), "cell", "value")


def with_static(field: DataFrame, static: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns of a static table onto every point of their cell, for formulas with operands of both grains."""
    return field.join(small(static.select("cell", *names)), "cell")


def convert_units(df: DataFrame, rule: str | Mapping[str, float], column: str = "value") -> DataFrame:
    """Apply ``{"scale": a, "offset": b}``, or an SQL expression on ``x``, to one column."""
    if isinstance(rule, str):
        return df.withColumn("x", F.col(column)).withColumn(column, F.expr(guard_division(rule))).drop("x")
    if isinstance(rule, Mapping):
        return df.withColumn(column, scale_offset(F.col(column), **rule))
    raise TypeError("a unit rule is an expression on x or a mapping with scale and offset")


# --- sums over a dimension ---------------------------------------------------------------------------------------


def missing_as_zero(total: Column) -> Column:
    """A sum of missing values only is 0, as array sums that skip missing values give."""
    return F.coalesce(total, F.lit(0.0))


def _grouped_once(field: DataFrame, dim: str, keys: Sequence[str]) -> DataFrame:
    """``field`` by ``keys`` before a sum over ``dim``, where nothing but that is summed: a group is then as small as the dimension, and
    partial sums ahead of the exchange would hold nearly every row and save none of them."""
    return field.repartition(*keys) if set(field.columns) <= {*keys, dim, "value"} else field


def vertical_sum(field: DataFrame, cap: float | None = None, keys: Sequence[str] = ("var", "time_idx", "cell")) -> DataFrame:
    """Sum over the level dimension, missing skipped; totals above ``cap`` become ``cap``."""
    total = missing_as_zero(F.sum("value"))
    limited = total if cap is None else F.least(F.lit(float(cap)), total)
    return _grouped_once(field, "lev", keys).groupBy(*keys).agg(limited.alias("value"))


def sum_over_index(
    field: DataFrame, indices: Sequence[int], dim: str = "lev", first: int = 0, keys: Sequence[str] = ("var", "time_idx", "cell")
) -> DataFrame:
    """Sum over the listed 1-based positions of ``dim``, whose own numbering starts at ``first``."""
    return sums_over_indices(field, {"value": indices}, dim, first, keys)


def sums_over_indices(
    field: DataFrame, lists: Mapping[str, Sequence[int]], dim: str = "lev", first: int = 0, keys: Sequence[str] = ("var", "time_idx", "cell")
) -> DataFrame:
    """Several index sums in one pass, one output column each."""
    if dim not in field.columns:
        raise ValueError(f"dimension {dim!r} not found in {field.columns}")
    for name, indices in lists.items():
        if not indices:
            raise ValueError(f"index list of {name!r} is empty")
    wanted = sorted({i - 1 + first for indices in lists.values() for i in indices})
    sums = [
        missing_as_zero(F.sum(F.when(F.col(dim).isin([i - 1 + first for i in indices]), F.col("value")))).alias(name)
        for name, indices in lists.items()
    ]
    return _grouped_once(field.filter(F.col(dim).isin(wanted)), dim, keys).groupBy(*keys).agg(*sums)


def index_select(field: DataFrame, index: int, dim: str = "lev", first: int = 0) -> DataFrame:
    """The slice at a 0-based position of ``dim``."""
    return field.filter(F.col(dim) == index + first).drop(dim)


# --- helper steps of a formula ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Step:
    """One reduction a formula needs before its arithmetic: ``op`` of ``expr`` over ``dim``, stored as ``name``."""

    name: str
    op: str  # vertical_sum, index_sum or index_select
    expr: str
    indices: tuple[int, ...] = ()
    dim: str = "lev"
    cap: float | None = None


@dataclass(frozen=True)
class Lowered:
    """A formula as SQL arithmetic over plain names, the steps behind some of these names, and a regional sum."""

    sql: str
    steps: tuple[Step, ...] = dataclass_field(default_factory=tuple)
    region: str | None = None  # nh or sh when the arithmetic is summed over that hemisphere

    def names(self) -> set[str]:
        """Plain names the arithmetic and the steps refer to."""
        texts = [self.sql, *[s.expr for s in self.steps]]
        return {n for t in texts for n in re.findall(r"\b[A-Za-z_]\w*", t)} - {s.name for s in self.steps}


_VERTICAL = re.compile(r"verticalsum\(\s*([^(),]+?)\s*(?:,\s*capped_at\s*=\s*([\d.]+))?\s*(?:,\s*dim\s*=\s*['\"](\w+)['\"])?\s*\)")
_INDEX_SUM = re.compile(r"sumoverpft\(\s*(\w+)\s*,\s*(?:pftlist\s*=\s*)?\[([\d,\s]*)\]\s*,\s*(?:dimname\s*=\s*)?['\"](\w+)['\"]\s*\)")
_REGION = re.compile(r"^\((.+)\)\.where\(\w+\.coords\[['\"]TLAT['\"]\]\s*([<>])\s*0\)\.sum\(dim=\[[^\]]*\]\)$")
_WHERE = re.compile(r"(\w+)\.where\(([^(),]+),\s*([\d.]+)\)")
_SLICE = re.compile(r"(\w+)\[:,\s*(\d+)\s*,:,:\]")


def lower_formula(formula: str) -> Lowered:
    """Take the helper calls out of a catalog formula; what is left is arithmetic that Spark parses itself.

    The catalog writes its few helpers in one fixed way each, so plain pattern replacement finds them.
    """
    steps: list[Step] = []

    def put(step: Step) -> str:
        steps.append(step)
        return step.name

    def vertical(m: re.Match) -> str:
        cap = float(m.group(2)) if m.group(2) else None
        return put(Step(f"_s{len(steps)}", "vertical_sum", m.group(1), (), m.group(3) or "levsoi", cap))

    def index_sum(m: re.Match) -> str:
        listed = tuple(int(x) for x in m.group(2).split(",") if x.strip())
        return put(Step(f"_s{len(steps)}", "index_sum", m.group(1), listed, m.group(3)))

    def one(m: re.Match) -> str:
        return put(Step(f"_s{len(steps)}", "index_select", m.group(1), (int(m.group(2)),)))

    text = formula.split("#")[0].strip()
    regional = _REGION.match(text)
    if regional:
        text = regional.group(1)
    text = _WHERE.sub(r"(CASE WHEN \2 THEN \1 ELSE \3 END)", text)
    text = _VERTICAL.sub(vertical, text)
    text = _INDEX_SUM.sub(index_sum, text)
    text = _SLICE.sub(one, text)
    return Lowered(text, tuple(steps), {">": "nh", "<": "sh"}[regional.group(2)] if regional else None)


_SQL_WORDS = ("CASE", "WHEN", "THEN", "ELSE", "END", "AND", "OR", "NOT", "IS", "NULL")


def formula_problem(lowered: Lowered, bound: Sequence[str] | None = None) -> str | None:
    """Why Spark cannot evaluate a formula, or None: unreadable text, an unknown helper, or a name not ``bound``.

    Each text is analysed on an empty table that has its names, which starts no job.
    """
    steps = [s.name for s in lowered.steps]
    operands = SparkSession.active().range(0).select(*[F.lit(0.0).alias(n) for n in sorted({*lowered.names(), *steps} - set(_SQL_WORDS))])
    for text in (lowered.sql, *[s.expr for s in lowered.steps]):
        calls = [c for c in re.findall(r"\b([A-Za-z_]\w*)\s*\(", text) if c not in _SQL_WORDS]
        if calls:
            return f"formula calls unknown helper {calls[0]}"
        try:
            operands.select(F.expr(guard_division(text)).cast("double"))
        except AnalysisException:  # parse errors are among them
            return "formula is not readable"
    if any(s.op == "index_sum" and not s.indices for s in lowered.steps):
        return "formula has an empty index list"
    unbound = [] if bound is None else sorted(lowered.names() - set(bound) - set(_SQL_WORDS))
    return f"formula names what no source gives: {', '.join(unbound)}" if unbound else None


def _reduced(step: Step, target: str, dim: str, first: int, over: Window | None = None) -> Column:
    """The reduction of a step, per group or over a window."""
    value = F.expr(guard_division(step.expr))
    put = (lambda c: c) if over is None else (lambda c: c.over(over))
    if step.op == "vertical_sum":
        total = missing_as_zero(put(F.sum(value)))
        return total if step.cap is None else F.least(F.lit(step.cap), total)
    if step.op == "index_sum":
        if not step.indices:
            raise ValueError(f"index list in the formula of {target} is empty")
        return missing_as_zero(put(F.sum(F.when(F.col(dim).isin([i - 1 + first for i in step.indices]), value))))
    return put(F.max(F.when(F.col(dim) == step.indices[0] + first, value)))


def realize_steps(
    field: DataFrame,
    target: str,
    lowered: Lowered,
    names: Sequence[str],
    dim: str = "lev",
    first: int = 0,
    keys: Sequence[str] = ("time_idx", "cell"),
    levelled: Sequence[str] = (),
    static: DataFrame | None = None,
    static_names: Sequence[str] = (),
) -> DataFrame:
    """Evaluate a formula with helper steps: widen once, reduce all steps in one grouping, then the arithmetic.

    ``names`` are the native variables. Those without a level dimension (fractions, areas) have one row per point,
    with any or no position in ``dim``, and enter the arithmetic by that value. A plain operand in ``levelled`` keeps
    its levels: the sums then stand beside each of them, and the result has ``dim``.
    """
    kept = used_names(lowered.sql, [n for n in names if n in levelled])
    if not kept:
        return realize_step_targets(field, {target: lowered}, {target: names}, dim, first, keys, static, static_names)
    over = Window.partitionBy(*keys)
    wide = pivot(field.repartition(*keys), {n: n for n in names}, (*keys, dim))
    if static_names:
        wide = with_static(wide, static, static_names)
    sums = {s.name: _reduced(s, target, dim, first, over) for s in lowered.steps}
    present = {f"_has_{n}": F.max(f"_has_{n}").over(over) for n in names if n not in kept}
    free = {n: F.max(n).over(over) for n in used_names(lowered.sql, names) if n not in kept}
    located = wide.select(*keys, dim, *kept, *static_names, *[F.col(f"_has_{n}") for n in kept], *[c.alias(n) for n, c in (sums | present | free).items()])
    rows = located.filter(all_present(names))
    return rows.select(F.lit(target).alias("var"), *keys, dim, F.expr(guard_division(lowered.sql)).cast("double").alias("value"))


def realize_step_targets(
    field: DataFrame,
    lowered: Mapping[str, Lowered],
    names: Mapping[str, Sequence[str]],
    dim: str = "lev",
    first: int = 0,
    keys: Sequence[str] = ("time_idx", "cell"),
    static: DataFrame | None = None,
    static_names: Sequence[str] = (),
) -> DataFrame:
    """All formulas with helper steps that keep no levels: one pivot and one grouping, however many they are."""
    every = sorted({n for own in names.values() for n in own})
    wide = pivot(field, {n: n for n in every}, (*keys, dim))
    if static_names:
        wide = with_static(wide, static, static_names)
    sums, outputs, plain = [], [], set()
    for number, (target, low) in enumerate(lowered.items()):
        sql = low.sql
        for step in low.steps:
            label = f"_t{number}{step.name}"
            sums.append(_reduced(step, target, dim, first).alias(label))
            sql = re.sub(rf"\b{step.name}\b", label, sql)
        plain |= set(used_names(low.sql, [*names[target], *static_names]))
        outputs.append((all_present(names[target]), target, F.expr(guard_division(sql))))
    carried = [F.max(n).alias(n) for n in sorted(plain)]
    present = [F.max(f"_has_{n}").alias(f"_has_{n}") for n in every]
    return emit(wide.groupBy(*keys).agg(*sums, *carried, *present), keys, outputs)


def realize_regional(
    field: DataFrame, static: DataFrame, target: str, lowered: Lowered, names: Sequence[str], keys: Sequence[str] = ("time_idx",)
) -> DataFrame:
    """Sum the arithmetic of a formula over one hemisphere; ``static`` gives ``tlat`` and the static operands."""
    wide = widen(field, names, (*keys, "cell"))
    operands = [c for c in static.columns if c not in ("cell", *names)]
    located = with_static(wide, static, operands)
    inside = F.col("tlat") > 0 if lowered.region == "nh" else F.col("tlat") < 0
    amount = F.expr(guard_division(lowered.sql)).cast("double")
    total = missing_as_zero(F.sum(F.when(inside, amount)))
    return located.groupBy(*keys).agg(total.alias("value")).select(F.lit(target).alias("var"), *keys, F.lit(lowered.region).alias("region"), "value")


# --- regional sums -----------------------------------------------------------------------------------------------


def _by_hemisphere(field: DataFrame, static: DataFrame, amount: Column, keys: Sequence[str]) -> DataFrame:
    located = with_static(field, static, ["tlat", "tarea"])
    # Both regions in one pass, so a time without any northern cell still gets its 0.
    sums = located.groupBy(*keys).agg(
        missing_as_zero(F.sum(F.when(F.col("tlat") > 0, amount))).alias("nh"),
        missing_as_zero(F.sum(F.when(F.col("tlat") < 0, amount))).alias("sh"),
    )
    return sums.unpivot(list(keys), ["nh", "sh"], "region", "value")


def hemisphere_area(field: DataFrame, static: DataFrame, keys: Sequence[str] = ("time_idx",)) -> DataFrame:
    """Sum of concentration (percent) times cell area, north and south of the equator; the equator is in neither."""
    return _by_hemisphere(field, static, F.col("value") * F.col("tarea") / F.lit(100.0), keys)


def hemisphere_extent(field: DataFrame, static: DataFrame, threshold: float = 15.0, keys: Sequence[str] = ("time_idx",)) -> DataFrame:
    """Area of the cells with a concentration above the threshold."""
    return _by_hemisphere(field, static, F.when(F.col("value") > threshold, F.col("tarea")).otherwise(0.0), keys)


def hemisphere_total(field: DataFrame, static: DataFrame, keys: Sequence[str] = ("time_idx",)) -> DataFrame:
    """Sum of value times cell area: mass or volume from amounts per area."""
    return _by_hemisphere(field, static, F.col("value") * F.col("tarea"), keys)


# --- merging and attributes ----------------------------------------------------------------------------------------


def variables_of(field: DataFrame) -> list[str]:
    """Names of the variables a field holds; as many as a catalog has, so a short list. Reads the name column only."""
    return sorted(row["var"] for row in field.select("var").distinct().collect())


def shapes_of(field: DataFrame) -> dict[str, bool]:
    """Variables of a field, and whether they have levels: one grouped minimum and maximum, as short as a catalog."""
    ends = field.groupBy("var").agg((F.min("lev") < F.max("lev")).alias("levelled"))
    return {row["var"]: bool(row["levelled"]) for row in ends.collect()}


def merge_first_wins(datasets: Sequence[DataFrame], variables: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """One field table from several: a variable held by more than one is taken whole from the first that has it.

    With the variables of each dataset known (from its folder names or the catalog) this is a filter and a union; no
    row moves, and stored fields skip the folders of variables they lose.
    """
    taken: set[str] = set()
    merged = None
    for dataset, names in zip(datasets, variables or [variables_of(d) for d in datasets], strict=True):
        won = [n for n in names if n not in taken]
        taken.update(won)
        part = dataset.filter(F.col("var").isin(won))
        merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    return merged


def attach_attributes(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Units always from the catalog; long and standard name only where the field has none."""
    names = ("units", "long_name", "standard_name")
    own = catalog.select(F.col("name").alias("var"), *[F.col(n).alias(f"_{n}") for n in names])
    joined = df.join(small(own), "var", "left")
    for n in names:
        current = F.col(n) if n in df.columns else F.lit(None).cast("string")
        first = (F.col(f"_{n}"), current) if n == "units" else (current, F.col(f"_{n}"))
        joined = joined.withColumn(n, F.coalesce(*first))
    return joined.drop(*[f"_{n}" for n in names])


def rename_dimensions(df: DataFrame, levels: DataFrame | None = None) -> DataFrame:
    """Dimension columns by their archive names; soil and ocean levels take their coordinate from ``levels``."""
    renamed = df.withColumnsRenamed({k: v for k, v in fixed.DIMENSION_NAMES.items() if k in df.columns})
    return renamed if levels is None else renamed.join(small(levels), [c for c in ("sdepth", "olevel") if c in renamed.columns], "left")
