"""Columns by name, cast to a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed(df: DataFrame, schema: T.StructType, path: str, keep_others: bool = False) -> DataFrame:
    """The columns of ``schema`` with its types, cast where the file has
    others; with ``keep_others`` every column, in the file's order.  A
    missing column raises.  A cast fails on a value that does not fit."""
    wanted = {f.name: f.dataType for f in schema.fields}
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    names = df.columns if keep_others else list(wanted)
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(c: str):
        same = c not in wanted or have[c] == wanted[c]
        return F.col(f"`{c}`") if same else F.col(f"`{c}`").cast(wanted[c]).alias(c)

    return df.select(*[column(c) for c in names])
