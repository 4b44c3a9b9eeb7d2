"""Formulas over variables with dimensions of their own: soil levels, plant types, land-use classes.

A field may have, beside time and cell, one column of positions for each named dimension; a variable's rows have a position in
the dimensions it has and NULL in the others. A helper call of a formula reduces the dimension it names, and no other. What is left
of the dimensions is kept, and operands with fewer dimensions hold their value along those they lack, as labelled arrays do.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.derive import Lowered, Step, all_present, emit, guard_division, missing_as_zero, pivot, used_names, with_static

Dims = tuple[str, ...]


def named_columns(field: DataFrame, dims: Sequence[str], dim: str = "dim", idx: str = "idx") -> DataFrame:
    """A field with (dim, idx), the name of a variable's one categorical dimension and the position in it, as one with a column for
    each name. Rows of other dimensions than ``dims`` are an error."""
    known = F.col(dim).isNull() | F.col(dim).isin(list(dims))
    checked = F.when(known, F.col(idx)).otherwise(F.raise_error(F.concat(F.lit("unknown dimension "), F.col(dim))).cast("int"))
    return field.withColumns({d: F.when(~known | (F.col(dim) == d), checked) for d in dims}).drop(dim, idx)


def _union(shapes: Sequence[Dims]) -> Dims:
    return tuple(sorted({d for s in shapes for d in s}))


def step_shape(step: Step, names: Sequence[str], shapes: Mapping[str, Dims]) -> tuple[Dims, str]:
    """Dimensions of what a step reduces, and the one it reduces: its name must be among them. A position picked without a name is one of the
    only dimension there is."""
    own = _union([shapes.get(n, ()) for n in used_names(step.expr, names)])
    if step.op == "index_select" and len(own) == 1:
        return own, own[0]
    if step.dim not in own:
        raise ValueError(f"dimension {step.dim!r} not found in {list(own)} of {step.expr}")
    return own, step.dim


def result_dims(lowered: Lowered, names: Sequence[str], shapes: Mapping[str, Dims]) -> Dims:
    """The named dimensions that a formula's result keeps."""
    plain = [shapes.get(n, ()) for n in used_names(lowered.sql, names)]
    left = [tuple(d for d in own if d != gone) for own, gone in (step_shape(s, names, shapes) for s in lowered.steps)]
    return _union([*plain, *left])


def realize_named(
    field: DataFrame,
    lowered: Mapping[str, Lowered],
    names: Mapping[str, Sequence[str]],
    shapes: Mapping[str, Sequence[str]],
    firsts: Mapping[str, int] | None = None,
    keys: Sequence[str] = ("time_idx", "cell"),
    static: DataFrame | None = None,
    static_names: Sequence[str] = (),
) -> DataFrame:
    """Rows (var, keys, named dimensions, value) of all targets: one exchange by ``keys``, which serves the pivot, the grouping by every
    set of dimensions that is kept, and all windows.

    ``names`` are each target's native variables, ``shapes`` the named dimensions of every variable, ``firsts`` the
    number of a dimension's first position (0 if it is not given). Targets that keep nothing need a plain grouping by ``keys``; the others
    get a row for every set and position in it, as few as results, and windows over them.
    """
    firsts = firsts or {}
    shapes = {n: tuple(sorted(s)) for n, s in shapes.items()}
    every = sorted({n for own in names.values() for n in own})
    dims = _union([shapes.get(n, ()) for n in every])
    has = lambda shape: reduce(lambda a, b: a & b, [F.col(d).isNotNull() if d in shape else F.col(d).isNull() for d in dims], F.lit(True))
    wide = pivot(field.repartition(*keys), {n: n for n in every}, (*keys, *dims))
    if static_names:
        wide = with_static(wide, static, static_names)

    # Operands of a step that have fewer dimensions than the rest of it, along those they lack.
    along: dict[str, Column] = {}
    sums: dict[str, tuple[Column, Dims]] = {}
    there: dict[str, Column] = {}
    texts: dict[str, str] = {}
    for number, (target, low) in enumerate(lowered.items()):
        text = low.sql
        for step in low.steps:
            own, gone = step_shape(step, names[target], shapes)
            expr = step.expr
            for n in used_names(expr, names[target]):
                if shapes.get(n, ()) != own:
                    along[f"_along_{n}"] = F.max(F.when(has(shapes.get(n, ())), F.col(n))).over(Window.partitionBy(*keys, *shapes.get(n, ())))
                    expr = re.sub(rf"\b{re.escape(n)}\b", f"_along_{n}", expr)
            kept = tuple(d for d in own if d != gone)
            label = f"_t{number}{step.name}"
            there[label] = F.max(has(own))
            sums[label] = (_reduced(step, F.expr(guard_division(expr)), has(own), gone, firsts.get(gone, 0), target), kept)
            text = re.sub(rf"\b{re.escape(step.name)}\b", label, text)
        texts[target] = text
    if along:
        wide = wide.withColumns(along)
    wanted = {t: result_dims(low, names[t], shapes) for t, low in lowered.items()}
    operands = {t: [*used_names(low.sql, names[t]), *[f"_t{i}{s.name}" for s in low.steps]] for i, (t, low) in enumerate(lowered.items())}
    for n in sorted({n for own in operands.values() for n in own} & set(every)):
        sums[n] = (F.max(F.when(has(shapes.get(n, ())), F.col(n))), shapes.get(n, ()))
    aggregates = [c.alias(n) for n, (c, _) in sums.items()] + [F.max(n).alias(n) for n in static_names] + [F.max(f"_has_{n}").alias(f"_has_{n}") for n in every]
    aggregates += [c.alias(f"_has_{n}") for n, c in there.items() if sums[n][1]]
    kept_sets = sorted({*wanted.values(), *[s for n, (_, s) in sums.items() if n.startswith("_t")], *[shapes.get(n, ()) for t, low in lowered.items() if wanted[t] for n in used_names(low.sql, names[t])]})
    none = [F.lit(None).cast("int").alias(d) for d in dims]
    if kept_sets == [()]:
        rows = emit(wide.groupBy(*keys).agg(*aggregates), keys, [(all_present(names[t]), t, F.expr(guard_division(text))) for t, text in texts.items()])
        return rows.select("var", *keys, *none, "value")
    # Grouping sets as an explode, which unlike Spark's own keeps the rows where they are.
    number_of = lambda s: sum(1 << i for i, d in enumerate(reversed(dims)) if d not in s)
    member = lambda s: F.struct(F.lit(number_of(s)).alias("_set"), *[(F.col(d) if d in s else F.lit(None).cast("int")).alias(f"_in_{d}") for d in dims])
    # A row counts in a set if it has a position in each of the set's dimensions.
    inside = lambda s: reduce(lambda a, b: a & b, [F.col(d).isNotNull() for d in s], F.lit(True))
    sets = F.array(*[F.when(inside(s), member(s)) for s in ((), *[s for s in kept_sets if s])])
    exploded = wide.select("*", F.explode(sets).alias("_g")).filter("_g IS NOT NULL")
    grouped = exploded.groupBy(*keys, F.col("_g._set").alias("_set"), *[F.col(f"_g._in_{d}").alias(f"_in_{d}") for d in dims]).agg(*aggregates)
    grouped = grouped.withColumnsRenamed({f"_in_{d}": d for d in dims})
    # A point exists for a target if each of its variables has rows at its time and cell.
    present = {f"_has_{n}": F.max(F.when(F.col("_set") == number_of(()), F.col(f"_has_{n}"))).over(Window.partitionBy(*keys)) for n in every}
    # An operand with the dimensions of the result stands in the result's row; only others are brought there.
    away = {n for t, own in operands.items() for n in own if sums[n][1] != wanted[t]}
    spread = {n: F.max(F.when(F.col("_set") == number_of(sums[n][1]), F.col(n))).over(Window.partitionBy(*keys, *sums[n][1])) for n in sorted(away)}
    located = grouped.withColumns(present | spread)
    outputs = []
    for i, (target, text) in enumerate(texts.items()):
        here = (F.col("_set") == number_of(wanted[target])) & reduce(lambda a, b: a & b, [F.col(d).isNotNull() for d in wanted[target]], F.lit(True))
        # An operand that has the result's dimensions must have a row there, as arrays are aligned on what they share.
        own = [F.col(n).isNotNull() | F.lit(shapes.get(n, ()) != wanted[target]) for n in used_names(lowered[target].sql, names[target])]
        own += [F.col(f"_has__t{i}{s.name}") for s in lowered[target].steps if sums[f"_t{i}{s.name}"][1] == wanted[target] != ()]
        outputs.append((here & all_present(names[target]) & reduce(lambda a, b: a & b, own, F.lit(True)), target, F.expr(guard_division(text))))
    return emit(located, (*keys, *dims), outputs)


def _reduced(step: Step, value: Column, rows: Column, dim: str, first: int, target: str) -> Column:
    if step.op == "vertical_sum":
        total = missing_as_zero(F.sum(F.when(rows, value)))
        return total if step.cap is None else F.least(F.lit(step.cap), total)
    if step.op == "index_sum":
        if not step.indices:
            raise ValueError(f"index list in the formula of {target} is empty")
        return missing_as_zero(F.sum(F.when(rows & F.col(dim).isin([i - 1 + first for i in step.indices]), value)))
    return F.max(F.when(rows & (F.col(dim) == step.indices[0] + first), value))
