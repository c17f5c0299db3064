"""Flattening of nested documents (JSN-1..7).

All are projections and generators over a parsed struct column: nested
fields by path, array-of-struct fields by ``transform``, one row per entry
by ``explode`` (``explode_outer`` keeps entries whose list is empty).  No
document is ever gathered; each row is flattened where it lies.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pluck(arr, field: str) -> Column:
    """JSN-1: list of one field out of an array of structs."""
    col = F.col(arr) if isinstance(arr, str) else arr
    return F.transform(col, lambda s: s[field])


def entries(df: DataFrame, doc: str, array_path: str, keep: Sequence[str] = (),
            alias: str = "entry", outer: bool = False) -> DataFrame:
    """JSN-2/3: one row per element of ``doc.array_path``; ``keep`` columns
    (e.g. request parameters) are repeated on every row."""
    gen = F.explode_outer if outer else F.explode
    return df.select(*keep, gen(F.col(f"{doc}.{array_path}")).alias(alias))


def explode_two(df: DataFrame, outer_arr: str, inner_field: str, keep: Sequence[str] = (),
                outer_alias: str = "entry", inner_alias: str = "item") -> DataFrame:
    """JSN-4: entry -> nested list -> row; entries with an empty nested list
    are kept with a NULL item (``explode_outer``)."""
    e = df.select(*keep, F.explode(outer_arr).alias(outer_alias))
    return e.select(*keep, outer_alias, F.explode_outer(F.col(f"{outer_alias}.{inner_field}")).alias(inner_alias))


def flatten_paths(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """JSN-5: wide flatten from an output-name -> column-path map."""
    return df.select(*[F.col(p).alias(n) for n, p in paths.items()])


def leaf_paths(schema, prefix: str = "") -> list[str]:
    """All leaf field paths of a struct schema (arrays are leaves)."""
    from pyspark.sql.types import StructType
    out = []
    for f in schema.fields:
        p = f"{prefix}{f.name}"
        if isinstance(f.dataType, StructType):
            out += leaf_paths(f.dataType, p + ".")
        else:
            out.append(p)
    return out
