"""Record-level operators: process fan-out (D13), regrouped sums
and attribute overrides (D18)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberledger.functions.semantics import na_sum, sum_or_zero
from emberledger.operators.relational import fan_out, when_groups


def fan_out_activities(
    records: DataFrame, suffixes: Sequence[str], column: str = "activity"
) -> DataFrame:
    """One record per process, e.g. ``_enteric_fermentation`` and
    ``_manure``, or direct (``""``) and ``_indirect`` (D13)."""
    return fan_out(records, column, suffixes)


def regroup_sum(
    records: DataFrame,
    groups: Mapping[str, Sequence[str]],
    member: str,
    value: str,
    by: Sequence[str] = ("input_year",),
    out_group: str = "activity",
    out_value: str = "amount",
    na_rm: bool = False,
) -> DataFrame:
    """Roll members into named groups and sum them.

    One ``groupBy`` on a group label computed by a ``case_when`` replaces a
    filtered aggregate per group; members in no group are dropped.  The sum
    is NA-propagating unless ``na_rm``.  Aggregation is partial, so a hot
    group is combined map-side before the shuffle.
    """
    label = when_groups(member, groups)
    agg = sum_or_zero(value) if na_rm else na_sum(value)
    return (
        records.where(F.col(member).isin([m for ms in groups.values() for m in ms]))
        .groupBy(*by, label.alias(out_group))
        .agg(agg.alias(out_value))
    )


def override_attributes(
    records: DataFrame,
    target: str,
    rules: Sequence[tuple[str, Sequence[object], object]],
) -> DataFrame:
    """Reassign ``target`` by rules, else keep it.

    ``rules`` is ``[(column, values, new_value), ...]``; the first rule
    whose ``column`` is in ``values`` wins.
    """
    out = None
    for column, values, new_value in rules:
        cond = F.col(column).isin(list(values))
        out = F.when(cond, F.lit(new_value)) if out is None else out.when(cond, F.lit(new_value))
    if out is None:
        return records
    return records.withColumn(target, out.otherwise(F.col(target)))
