"""Access to nested values by a path such as ``/a/b[2]``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Step = str | int


def split_path(path: str) -> list[Step]:
    """Steps of a path: names after ``/``, list indexes in brackets."""
    steps: list[Step] = []
    for name, index in re.findall(r"/([^/\[\]]+)|\[(\d+)\]", path):
        steps.append(name if name else int(index))
    return steps


def _child_type(dtype: T.DataType, step: Step) -> T.DataType | None:
    if isinstance(step, int):
        return dtype.elementType if isinstance(dtype, T.ArrayType) else None
    if isinstance(dtype, T.StructType):
        return dtype[step].dataType if step in dtype.names else None
    return dtype.valueType if isinstance(dtype, T.MapType) else None


def _child(value: Column, dtype: T.DataType, step: Step) -> Column:
    if isinstance(step, int):
        return F.get(value, F.lit(step))
    return value.getField(step) if isinstance(dtype, T.StructType) else value[step]


def _walk(value: Column, dtype: T.DataType, steps: list[Step]) -> tuple[Column, T.DataType] | None:
    for step in steps:
        child = _child_type(dtype, step)
        if child is None:
            return None
        value, dtype = _child(value, dtype, step), child
    return value, dtype


def get_path(df: DataFrame, column: str, path: str) -> Column:
    """Value at ``path``, null where it cannot be reached; a top-level key equal to the whole path wins."""
    dtype, value = df.schema[column].dataType, F.col(column)
    if isinstance(dtype, T.VariantType):
        json_path = "$" + "".join(f"[{s}]" if isinstance(s, int) else f"['{s}']" for s in split_path(path))
        return F.try_variant_get(value, json_path, "string")
    if isinstance(dtype, T.StructType) and path in dtype.names:
        return value.getField(path)
    found = _walk(value, dtype, split_path(path))
    reached = found[0] if found else F.lit(None)
    if isinstance(dtype, T.MapType) and split_path(path):
        return F.when(F.map_contains_key(value, path), value[path]).otherwise(reached)
    return reached


def has_path(df: DataFrame, column: str, path: str) -> Column:
    """True where every step exists, also when the value found there is null."""
    dtype, steps = df.schema[column].dataType, split_path(path)
    if not steps:
        return F.col(column).isNotNull()
    found = _walk(F.col(column), dtype, steps[:-1])
    if found is None or _child_type(found[1], steps[-1]) is None:
        return F.lit(False)
    parent, kind = found
    if isinstance(kind, T.MapType):
        there = F.map_contains_key(parent, steps[-1])
    elif isinstance(kind, T.ArrayType):
        there = F.size(parent) > steps[-1]
    else:
        there = parent.isNotNull()
    return F.coalesce(there, F.lit(False))


def _unreachable(path: str, dtype: T.DataType) -> Column:
    return F.raise_error(F.lit(f"path {path!r} not reachable")).cast(dtype)


def _edit(value: Column, dtype: T.DataType, steps: list[Step], leaf, path: str) -> Column:
    """Rebuild the containers along ``steps``; ``leaf`` changes the last one."""
    if len(steps) == 1:
        return leaf(value, dtype, steps[0])
    step = steps[0]
    child_type = _child_type(dtype, step)
    if child_type is None:
        raise ValueError(f"path {path!r} not reachable in {dtype.simpleString()}")
    child = _edit(_child(value, dtype, step), child_type, steps[1:], leaf, path)
    return _put(value, dtype, step, child, path, may_add=False)


def _put(value: Column, dtype: T.DataType, step: Step, child: Column, path: str, may_add: bool) -> Column:
    if isinstance(dtype, T.StructType):
        return value.withField(step, child)
    if isinstance(dtype, T.MapType):
        rest = F.map_filter(value, lambda k, _: k != step)
        put = F.map_concat(rest, F.create_map(F.lit(step), child.cast(dtype.valueType)))
        return put if may_add else F.when(F.map_contains_key(value, step), put).otherwise(_unreachable(path, dtype))
    item = child.cast(dtype.elementType)
    replaced = F.transform(value, lambda x, i: F.when(i == step, item).otherwise(x))
    result = F.when(F.size(value) > step, replaced)
    if may_add:
        result = result.when(F.size(value) == step, F.concat(value, F.array(item)))
    return result.otherwise(_unreachable(path, dtype))


def set_path(df: DataFrame, column: str, path: str, value: Column) -> Column:
    """Column with ``path`` set: the last step may be new, a missing parent is an error."""
    dtype, steps = df.schema[column].dataType, split_path(path)
    if not steps:
        return value
    return _edit(
        F.col(column), dtype, steps, lambda v, t, s: _put(v, t, s, value, path, may_add=True), path
    )


def delete_path(df: DataFrame, column: str, path: str) -> Column:
    """Column without the value at ``path``; the empty path clears it, an absent one changes nothing."""
    dtype, steps = df.schema[column].dataType, split_path(path)
    if not steps:
        return F.lit(None).cast(dtype)
    found = _walk(F.col(column), dtype, steps[:-1])
    if found is None or _child_type(found[1], steps[-1]) is None:
        return F.col(column)

    def drop(v: Column, t: T.DataType, s: Step) -> Column:
        if isinstance(t, T.StructType):
            return v.dropFields(s)
        if isinstance(t, T.MapType):
            return F.map_filter(v, lambda k, _: k != s)
        return F.filter(v, lambda _, i: i != s)

    if any(not isinstance(_walk(F.col(column), dtype, steps[:n])[1], T.StructType) for n in range(len(steps) - 1)):
        return F.when(has_path(df, column, path), _edit(F.col(column), dtype, steps, drop, path)).otherwise(
            F.col(column)
        )
    return _edit(F.col(column), dtype, steps, drop, path)


def _escaped(name: Column) -> Column:
    for mark in "/[]":
        name = F.replace(name, F.lit(mark), F.lit(mark * 2))
    return name


def _paths_below(base: Column, value: Column, dtype: T.DataType) -> Column | None:
    """Array of the paths under a container, depth first; None for plain values."""

    def with_children(path: Column, child: Column, child_type: T.DataType) -> Column:
        below = _paths_below(path, child, child_type)
        return F.array(path) if below is None else F.concat(F.array(path), below)

    none = F.array().cast("array<string>")
    if isinstance(dtype, T.StructType):
        parts = [
            with_children(F.concat(base, F.lit("/"), _escaped(F.lit(f.name))), value.getField(f.name), f.dataType)
            for f in dtype.fields
        ]
        return F.when(value.isNotNull(), F.concat(*parts)).otherwise(none)
    if isinstance(dtype, T.MapType):
        return F.coalesce(
            F.flatten(
                F.transform(
                    F.map_entries(value),
                    lambda e: with_children(
                        F.concat(base, F.lit("/"), _escaped(e["key"].cast("string"))), e["value"], dtype.valueType
                    ),
                )
            ),
            none,
        )
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(
            F.flatten(
                F.transform(
                    value,
                    lambda x, i: with_children(
                        F.concat(base, F.lit("["), i.cast("string"), F.lit("]")), x, dtype.elementType
                    ),
                )
            ),
            none,
        )
    return None


def list_paths(df: DataFrame, column: str) -> Column:
    """All paths of a value, root (the empty path) first."""
    value = F.col(column)
    below = _paths_below(F.lit(""), value, df.schema[column].dataType)
    paths = F.array(F.lit("")) if below is None else F.concat(F.array(F.lit("")), below)
    return F.when(value.isNotNull(), paths).otherwise(F.array().cast("array<string>"))
