"""Account-level meter readings: normalization (D16) and emissions with
transmission/distribution losses (D17)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberledger import constants as K
from emberledger.operators.factors import KEEP, apply_factors, with_losses
from emberledger.operators.relational import when_map

FACTOR_KEYS = {"activity": "activity", "year": "input_year"}


def _year_range(column: str, dtype: T.DataType, years: Sequence[int]):
    """A pushable range predicate implied by ``year(column) IN years``."""
    lo, hi = f"{min(years):04d}-01-01", f"{max(years) + 1:04d}-01-01"
    return (F.col(column) >= F.lit(lo).cast(dtype)) & (F.col(column) < F.lit(hi).cast(dtype))


def normalize_meter_readings(
    export: DataFrame,
    fuel_map: Mapping[str, str] = K.METER_FUEL_MAP,
    years: Sequence[int] | None = K.METER_YEARS,
    scaled_fuel: str = K.METER_SCALED_FUEL,
    divisor: float = K.METER_SCALE_DIVISOR,
    scaled_units: str = K.METER_SCALED_UNITS,
    date: str = "usage_end",
    fuel: str = "account_fuel",
    use: str = "use",
    default_units: str = "default_units",
) -> DataFrame:
    """Year of the usage end, fuel -> activity (unmapped -> null), one fuel
    rescaled with its own units, other units kept, year whitelist (D16).

    Besides ``year(date) IN years`` a plain range predicate on ``date`` is
    added, which the Parquet scan can use to skip row groups.
    """
    out = export
    dtype = export.schema[date].dataType
    if years is not None and isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        out = out.where(_year_range(date, dtype, years))
    is_scaled = F.col(fuel) == F.lit(scaled_fuel)
    out = out.withColumns(
        {
            "year": F.year(date).cast("int"),
            "activity": when_map(fuel, fuel_map),
            use: F.when(is_scaled, F.col(use) / F.lit(divisor)).otherwise(F.col(use)),
            "units": F.when(is_scaled, F.lit(scaled_units)).otherwise(F.col(default_units)),
        }
    )
    if years is not None:
        out = out.where(F.col("year").isin(list(years)))
    return out


def meter_emissions(
    readings: DataFrame,
    loss_factors: DataFrame,
    factors: DataFrame,
    use: str = "use",
) -> DataFrame:
    """Direct readings plus loss readings, each with factors.

    Unmatched factors stay null.  Loss readings keep every account column,
    with ``use`` scaled by the loss factor and activity ``<fuel>_<type>``.
    The readings are read once: each reading explodes into itself and its
    loss readings, then one broadcast join applies the factors.
    """
    both = with_losses(readings, loss_factors, fuel="activity", year="year", amount=use)
    return apply_factors(both, factors, KEEP, amount=use, on=FACTOR_KEYS)
