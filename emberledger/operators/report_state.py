"""Reports from stored partial aggregates.

A report needs of the ledger only the sum, whether a value was missing, and the
number of records per year, sector and entity. ``ledger_state`` keeps these in a form
that merges: sums as integers (``semantics.sum_limbs``), which add up exactly,
so totals of merged states have the same digits as totals of the records. A
state is stored by year; re-running a year replaces that year's rows and reads no
other year's records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberledger.functions.semantics import LIMBS, any_null, limbs_value, safe_div, sum_limbs, sum_outside
from emberledger.operators import report
from emberledger.sources.io import write_table

STATE_KEYS = ("input_year", "fiscal_year", "supercategory", "entity")
_SUMS = [*(f"limb_{i}" for i in range(LIMBS)), "outside"]


def ledger_state(ledger: DataFrame, keys: Sequence[str] = STATE_KEYS, value: str = "total_mtco2e") -> DataFrame:
    """Per ``keys``: the parts of the sum of ``value``, ``has_null`` and ``n``
    (records)."""
    sums = [*sum_limbs(value), sum_outside(value)]
    return ledger.groupBy(*keys).agg(
        *[c.alias(n) for c, n in zip(sums, _SUMS)], any_null(value).alias("has_null"), F.count(F.lit(1)).alias("n")
    )


def merge(*states: DataFrame, by: Sequence[str]) -> DataFrame:
    """States as one, per ``by``: parts are summed, null flags joined."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    return both.groupBy(*by).agg(
        *[F.sum(n).alias(n) for n in _SUMS], F.coalesce(F.bool_or("has_null"), F.lit(False)).alias("has_null"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")
    )


def known_total() -> Column:
    """The total of a state, missing values ignored."""
    return F.coalesce(limbs_value([F.col(n) for n in _SUMS[:-1]], F.col(_SUMS[-1])), F.lit(0.0))


def strict_total() -> Column:
    """The total of a state, missing if any value was."""
    return F.when(~F.col("has_null"), known_total())


def store_state(state: DataFrame, path: str) -> None:
    """Write a state by year; the years it holds replace those stored before,
    other years stay."""
    write_table(state, path, "parquet", partition_by=["input_year"], replace_partitions=True)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# -- reports, as those of ``operators.report`` on the ledger ---------------


def annual_totals(state: DataFrame, by: Sequence[str] = ("input_year",), na_rm: bool = True, out: str = "total") -> DataFrame:
    total = known_total() if na_rm else strict_total()
    return report.ordered(merge(state, by=by).select(*by, total.alias(out)), *by)


def baseline_vs_current(state: DataFrame, baseline_year: int, current_year: int, year: str = "input_year") -> DataFrame:
    of = [merge(state.where(F.col(year) == y), by=[]).select(t.alias(n))
          for y, t, n in ((baseline_year, strict_total(), "baseline"), (current_year, known_total(), "current"))]
    both = of[0].select("baseline", of[1].scalar().alias("current"))  # one row each
    return both.withColumn("change", safe_div(F.col("current") - F.col("baseline"), F.col("baseline")))


def change_vs_baseline(
    state: DataFrame, by: Sequence[str] = (), period: str = "fiscal_year", labels: bool = True, decimals: int | None = 1
) -> DataFrame:
    totals = merge(state, by=[*by, period]).select(*by, period, known_total().alias("total"))
    return report.change_of_totals(totals, by, period, labels, decimals)


def sector_share(
    state: DataFrame, period: str = "fiscal_year", sector: str = "supercategory", value: str = "total_mtco2e", decimals: int = 1
) -> DataFrame:
    sectors = merge(state, by=[period, sector]).select(period, sector, strict_total().alias(value))
    return report.share_of_totals(sectors, period, sector, value, decimals)
