"""Reporting over a stored ledger: annual totals (A6), baseline vs current
(D20), change vs first period (D21), sector share (D22) and fuel mix (D23).

Every report aggregates the ledger first (partial aggregation, so a hot
key is combined map-side) and only then applies windows or scalar
subqueries to the small aggregated result -- never a window over facts.
Totals are exact sums (``semantics.exact_sum``): a report has the same digits
however the ledger is partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberledger.functions.semantics import (
    fitted_percent_text,
    half_even,
    label_text,
    na_sum,
    number_text,
    percent_text,
    safe_div,
    sum_or_zero,
    whole_partition,
)


def ordered(df: DataFrame, period: str, *then: str) -> DataFrame:
    """Display order (O2): by the numeric year in a period such as
    ``FY 2016`` or ``2016``, then by the other keys."""
    text = F.col(period).cast("string")
    return df.orderBy(F.regexp_extract(text, r"(\d+)", 1).try_cast("int"), text, *then)


def annual_totals(
    ledger: DataFrame,
    by: Sequence[str] = ("input_year",),
    value: str = "total_mtco2e",
    na_rm: bool = True,
    out: str = "total",
) -> DataFrame:
    """Totals per ``by`` (A6); NA-ignoring by default like the report."""
    agg = sum_or_zero(value, exact=True) if na_rm else na_sum(value, exact=True)
    return ordered(ledger.groupBy(*by).agg(agg.alias(out)), *by)


def baseline_vs_current(
    ledger: DataFrame,
    baseline_year: int,
    current_year: int,
    value: str = "total_mtco2e",
    year: str = "input_year",
) -> DataFrame:
    """One row: baseline total (NA-propagating), current total
    (NA-ignoring) and the relative change (D20), from a single scan."""
    v, y = F.col(value), F.col(year)
    is_base, is_cur = y == F.lit(baseline_year), y == F.lit(current_year)
    base_has_null = F.coalesce(F.bool_or(is_base & v.isNull()), F.lit(False))
    base = F.when(~base_has_null, sum_or_zero(F.when(is_base, v), exact=True))
    cur = sum_or_zero(F.when(is_cur, v), exact=True)
    totals = ledger.where(y.isin(baseline_year, current_year)).agg(
        base.cast("double").alias("baseline"), cur.cast("double").alias("current")
    )
    return totals.withColumn(
        "change", safe_div(F.col("current") - F.col("baseline"), F.col("baseline"))
    )


def change_vs_baseline(
    ledger: DataFrame,
    by: Sequence[str] = (),
    period: str = "fiscal_year",
    value: str = "total_mtco2e",
    labels: bool = True,
    decimals: int | None = 1,
) -> DataFrame:
    """Totals per period (NA-ignoring) and the change relative to the first
    period of each ``by`` group (D21).

    Periods sort as their labels; ``FY <year>`` labels sort like years.
    With no ``by`` the baseline is a scalar subquery over the per-period
    totals; with ``by`` it is a window over those totals. The percent labels
    have ``decimals`` decimals, or, with None, as many as each group's column
    needs (X12).
    """
    totals = ledger.groupBy(*by, period).agg(sum_or_zero(value, exact=True).alias("total"))
    return change_of_totals(totals, by, period, labels, decimals)


def change_of_totals(
    totals: DataFrame, by: Sequence[str] = (), period: str = "fiscal_year", labels: bool = True, decimals: int | None = 1
) -> DataFrame:
    """``change_vs_baseline`` from finished totals (``total``)."""
    if by:
        first = F.min_by("total", period).over(Window.partitionBy(*by))
    else:
        first = totals.agg(F.min_by("total", period)).scalar()
    out = totals.withColumn("baseline_total", first)
    out = out.withColumn(
        "percent_change",
        safe_div(F.col("total") - F.col("baseline_total"), F.col("baseline_total")),
    ).drop("baseline_total")
    if labels:
        out = out.withColumns(
            {
                "percent_change_label": percent_text("percent_change", decimals)
                if decimals is not None
                else fitted_percent_text("percent_change", *by),
                "total_label": F.format_number(F.col("total"), 0),
            }
        )
    return ordered(out, period, *by)


def sector_share(
    ledger: DataFrame,
    period: str = "fiscal_year",
    sector: str = "supercategory",
    value: str = "total_mtco2e",
    decimals: int = 1,
) -> DataFrame:
    """Emissions, percent of the period total and a label (null prints as
    ``NA``) per (period, sector) (D22).

    Sector totals and the period total are NA-propagating, as in the
    report; the period total is a window over the aggregated rows.
    """
    sectors = ledger.groupBy(period, sector).agg(na_sum(value, exact=True).alias(value))
    return share_of_totals(sectors, period, sector, value, decimals)


def share_of_totals(
    sectors: DataFrame, period: str = "fiscal_year", sector: str = "supercategory", value: str = "total_mtco2e", decimals: int = 1
) -> DataFrame:
    """``sector_share`` from finished totals (``value``)."""
    year_total = na_sum(value, over=whole_partition(period), exact=True)
    out = sectors.withColumn("year_total", year_total)
    out = out.withColumn("pct", safe_div(F.col(value), F.col("year_total")) * F.lit(100.0))
    text = F.concat(
        F.lit("Sector: "), label_text(sector),
        F.lit("<br>Emissions: "), number_text(value, decimals), F.lit(" MTCO2e<br>Share: "),
        number_text("pct", decimals), F.lit("%"),
    )
    out = out.withColumns({"pct_rounded": half_even("pct", decimals), "text": text})
    return ordered(out, period, sector)


def fuel_mix(
    meter_ledger: DataFrame,
    period: str = "fiscal_year",
    fuel: str = "account_fuel",
    value: str = "total_mtco2e",
    out: str = "total_emissions",
) -> DataFrame:
    """Emissions per (period, fuel), share of the period on a 0-1 scale
    (the normalization of a 100 %-stacked bar, W4) and in percent, and a
    tooltip label where nulls print as ``NA`` (D23)."""
    fuels = meter_ledger.groupBy(period, fuel).agg(na_sum(value, exact=True).alias(out))
    period_total = na_sum(out, over=whole_partition(period), exact=True)
    fuels = fuels.withColumn("share", safe_div(F.col(out), period_total))  # 0-1, stacked bars
    fuels = fuels.withColumn("percentage", F.col("share") * F.lit(100.0))
    text = F.concat(
        F.lit("Fuel: "), label_text(fuel),
        F.lit("\nEmissions: "), number_text(out, 2),
        F.lit(" MTCO2e\nShare: "), number_text("percentage", 1), F.lit("%"),
    )
    return ordered(fuels.withColumn("tooltip_text", text), period, fuel)
