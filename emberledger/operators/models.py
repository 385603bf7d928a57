"""Consumption models that derive activity amounts: household fuel (D5),
transit fuel (D6), residual allocation (D8), concentration load (D11),
downscaling (D12) and fertilizer application (D14).

All are column arithmetic plus grouped aggregates, so they run as
whole-stage-codegen projections with partial aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberledger import constants as K
from emberledger.functions.semantics import na_mean, na_sum, safe_div, sum_or_zero, whole_partition
from emberledger.operators.factors import KEEP, apply_factors
from emberledger.operators.records import fan_out_activities
from emberledger.operators.relational import lookup_join
from emberledger.sources.schemas import SECTOR_COLUMNS


def sector_columns(df: DataFrame) -> DataFrame:
    """Keep the sector-ledger columns ``df`` has, in ledger order."""
    return df.select(*[c for c in SECTOR_COLUMNS if c in df.columns])


def with_labels(df: DataFrame, labels: Mapping[str, object]) -> DataFrame:
    """Constant label columns in one projection."""
    return df.withColumns({k: F.lit(v) for k, v in labels.items()})


def household_fuel_model(
    inputs: DataFrame,
    households: str = "total_households",
    share: str = "pct_using_heating_oil",
    use_per_household: str = "total_avg_household_heat_oil_use_gal_year",
    labels: Mapping[str, object] = K.HOUSEHOLD_FUEL_LABELS,
) -> DataFrame:
    """households x share x use per household, one ledger row per input
    row (D5)."""
    heating = F.col(households) * F.col(share)
    out = inputs.withColumn("amount", heating * F.col(use_per_household))
    out = with_labels(out, labels)
    return sector_columns(out)


def transit_fuel(
    miles: Column,
    weekday_trips: Column,
    sat_trips: Column,
    sun_trips: Column,
    efficiency: Column,
    season_months: float = K.SCHOOL_YEAR_MONTHS,
    months: float = K.MONTHS_PER_YEAR,
    off_season_share: float = K.OFF_SEASON_SHARE,
    weekdays: int = K.WEEKDAYS_PER_YEAR,
    saturdays: int = K.SATURDAYS_PER_YEAR,
    sundays: int = K.SUNDAYS_PER_YEAR,
) -> Column:
    """Yearly fuel of one route: in-season trips plus a share of the
    off-season schedule, divided by fuel efficiency (zero -> null, N11)."""
    regular = season_months / months
    irregular = (months - season_months) / months

    def days(factor: float) -> Column:
        return (
            F.lit(factor) * F.lit(weekdays) * weekday_trips
            + F.lit(factor) * F.lit(saturdays) * sat_trips
            + F.lit(factor) * F.lit(sundays) * sun_trips
        )

    trips = days(regular) + F.lit(off_season_share) * days(irregular)
    return safe_div(miles * trips, efficiency)


def transit_fuel_model(
    routes: DataFrame,
    by: Sequence[str] = ("input_year",),
    na_rm: bool = False,
    labels: Mapping[str, object] = K.TRANSIT_FUEL_LABELS,
    **constants: float,
) -> DataFrame:
    """Per-route fuel summed by year, as ledger rows.

    The sum is NA-propagating like the model's, unless ``na_rm``, and exact:
    the same in any partitioning.
    """
    fuel = transit_fuel(
        F.col("miles_per_route"), F.col("avg_weekday_trips"), F.col("avg_sat_trips"),
        F.col("avg_sun_trips"), F.col("avg_fuel_efficiency"), **constants,
    )
    agg = sum_or_zero(fuel, exact=True) if na_rm else na_sum(fuel, exact=True)
    out = with_labels(routes.groupBy(*by).agg(agg.alias("amount")), labels)
    return sector_columns(out)


def residual_allocation(
    totals: DataFrame,
    parts: Sequence[str],
    residual: str,
    population: str = "population",
    rate: str = "per_capita_rate_daily_lbs",
    lbs_per_tonne: str = "lbs_per_tonne",
    days: int = K.DAYS_PER_YEAR,
    total: str = "total_annual_tonnes",
) -> DataFrame:
    """total = population x daily rate x days / lbs per tonne; the residual
    is the total minus the named parts, null if any part is null (D8).

    The residual sees the freshly computed total (sequential ``mutate``,
    N13); a zero divisor gives null instead of an error.
    """
    out = totals.withColumn(
        total, safe_div(F.col(population) * F.col(rate) * F.lit(days), F.col(lbs_per_tonne))
    )
    rest = F.col(total)
    for p in parts:
        rest = rest - F.col(p)
    return out.withColumn(residual, rest)


def downscale(
    counts: DataFrame,
    scaling: DataFrame,
    local: str = "local_acreage",
    regional: str = "regional_acreage",
    count: str = "headcount",
    out: str = "local_headcount",
    on: Sequence[str] = ("input_year",),
) -> DataFrame:
    """local = regional count x local/regional ratio of the same year.

    Unmatched years keep a null factor; a zero regional size gives null.
    """
    ratio = scaling.select(*on, safe_div(local, regional).alias("scaling_factor"))
    joined = lookup_join(counts, ratio, list(on), "left", null_safe=True)
    return joined.withColumn(out, F.col(count) * F.col("scaling_factor"))


def concentration_load(
    flows: DataFrame,
    chemistry: DataFrame,
    factors: DataFrame,
    flow: str = "wastewater_gallons",
    influent: str = "influent_bod_mg_l",
    effluent: str = "effluent_bod_mg_l",
    by: Sequence[str] = ("input_year", "entity"),
    year: str = "input_year",
    liters_per_gallon: float = K.LITERS_PER_GALLON,
    mg_per_kg: float = K.MG_PER_KG,
    labels: Mapping[str, object] = K.WASTEWATER_LABELS,
) -> DataFrame:
    """Yearly mean concentration x summed flow x unit constant.

    Flows are aggregated per (year, entity) and chemistry per year before
    they meet, so the join is between two small aggregates.  The effluent
    mean drives the load; the influent mean is reported alongside.
    """
    means = chemistry.groupBy(year).agg(
        na_mean(influent).alias("avg_influent_bod"),
        na_mean(effluent).alias("avg_effluent_bod"),
    )
    volume = flows.groupBy(*by).agg(na_sum(flow).alias(flow))
    joined = lookup_join(volume, means, [year], "left", null_safe=True)
    return load_rows(joined, factors, flow, liters_per_gallon, mg_per_kg, labels)


def load_rows(
    volume: DataFrame,
    factors: DataFrame,
    flow: str = "wastewater_gallons",
    liters_per_gallon: float = K.LITERS_PER_GALLON,
    mg_per_kg: float = K.MG_PER_KG,
    labels: Mapping[str, object] = K.WASTEWATER_LABELS,
) -> DataFrame:
    """Ledger rows of summed flows that carry ``avg_effluent_bod``."""
    load = (
        F.col(flow) * F.lit(liters_per_gallon) * F.col("avg_effluent_bod") / F.lit(mg_per_kg)
    )
    out = with_labels(volume.withColumn("amount", load), labels)
    return sector_columns(apply_factors(out, factors, KEEP))


def concentration_load_of(
    records: DataFrame,
    factors: DataFrame,
    flow: str = "wastewater_gallons",
    influent: str = "influent_bod_mg_l",
    effluent: str = "effluent_bod_mg_l",
    entity: str = "entity",
    year: str = "input_year",
) -> DataFrame:
    """D11 where flows and concentrations are columns of the same records:
    one aggregation to (year, entity) with sums and counts, from which the
    yearly means follow, so the records are read once."""
    total = [F.sum(c).alias(f"__sum_{c}") for c in (influent, effluent)]
    known = [F.count(c).alias(f"__n_{c}") for c in (influent, effluent)]
    rows = F.count(F.lit(1)).alias("__rows")
    flows = records.groupBy(year, entity).agg(na_sum(flow).alias(flow), *total, *known, rows)
    whole = whole_partition(year)

    def mean(c: str) -> Column:
        n = F.sum("__rows").over(whole)
        full = F.sum(f"__n_{c}").over(whole) == n
        return F.when(full, F.sum(f"__sum_{c}").over(whole) / n)

    means = {"avg_influent_bod": mean(influent), "avg_effluent_bod": mean(effluent)}
    return load_rows(flows.withColumns(means), factors, flow)


def application_model(
    area: DataFrame,
    practice: DataFrame,
    factors: DataFrame,
    acreage: str = "local_acreage",
    share: str = "pct_fertilized",
    rate: str = "application_rate_lb_N_acre",
    year: str = "input_year",
    lb_per_kg: float = K.LB_PER_KG,
    labels: Mapping[str, object] = K.FERTILIZATION_LABELS,
    suffixes: Sequence[str] = K.DIRECT_AND_INDIRECT,
) -> DataFrame:
    """area x mean fertilized share x mean rate x unit constant, as a
    direct and an indirect row per year, with factors applied (D14)."""
    means = practice.groupBy(year).agg(
        na_mean(share).alias("fertilization_pct"),
        na_mean(rate).alias("application_rate"),
    )
    joined = lookup_join(area.select(year, acreage), means, [year], "left", null_safe=True)
    return application_rows(joined, factors, acreage, lb_per_kg, labels, suffixes)


def application_rows(
    yearly: DataFrame,
    factors: DataFrame,
    acreage: str = "local_acreage",
    lb_per_kg: float = K.LB_PER_KG,
    labels: Mapping[str, object] = K.FERTILIZATION_LABELS,
    suffixes: Sequence[str] = K.DIRECT_AND_INDIRECT,
) -> DataFrame:
    """Ledger rows of yearly areas that carry the mean share
    (``fertilization_pct``) and rate (``application_rate``)."""
    amount = (
        F.col(acreage) * F.col("fertilization_pct") * F.col("application_rate") * F.lit(lb_per_kg)
    )
    out = with_labels(yearly.withColumn("amount", amount), labels)
    out = fan_out_activities(out, suffixes)
    out = apply_factors(out, factors, KEEP)
    return sector_columns(out)
