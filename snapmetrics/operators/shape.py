"""Shaping nested payloads into flat frames (survey A9, B1–B5).

All of these are projections: they change the schema, never the row count
(except ``explode_child``), and Catalyst prunes every nested field that a
later projection does not use down to the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _leaves(schema: StructType, prefix: tuple[str, ...], sep: str) -> list[Column]:
    cols: list[Column] = []
    for field in schema.fields:
        path = prefix + (field.name,)
        if isinstance(field.dataType, StructType):
            cols.extend(_leaves(field.dataType, path, sep))
        else:
            ref = F.col(".".join(f"`{p}`" for p in path))
            cols.append(ref.alias(sep.join(path)))
    return cols


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """B1: every struct path ``a.b.c`` becomes column ``a_b_c``.

    Lists stay lists; a null parent gives null leaves; the row count is
    unchanged.
    """
    return df.select(*_leaves(df.schema, (), sep))


def explode_child(df: DataFrame, column: str, sep: str = "_") -> DataFrame:
    """One row per element of the list ``column``, then flatten.

    ``explode_outer`` keeps a row with a null element for an empty or null
    list, as the source's explode does.
    """
    others = [c for c in df.columns if c != column]
    exploded = df.select(*others, F.explode_outer(column).alias(column))
    return flatten(exploded, sep)


def rename_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names that are not columns are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Append snapshots by column name; missing columns become null and
    duplicates are kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def root_select(df: DataFrame, root: str, keep: Iterable[str] = ("block",)) -> DataFrame:
    """Keep one top-level field of the payload (plus the snapshot key)."""
    return df.select(*keep, f"{root}.*")


def parse_json_field(text: str | Column, field: str, ddl_type: str = "bigint") -> Column:
    """A9 on JSON text: the value of one top-level field of a JSON object."""
    c = F.col(text) if isinstance(text, str) else text
    return F.from_json(c, f"`{field}` {ddl_type}").getField(field)
