"""Explicit schemas for every input table and the one ledger schema.

Nothing is inferred at read time: spreadsheets and CSV exports are landed
as Parquet/CSV tables and read with these ``StructType``s.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, I, TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# -- factor and mapping dimensions -------------------------------------------
ACTIVITY_MAP = _schema(("activity", S), ("activity_recoded", S))
ACTIVITY_EMISSIONS_KEY = _schema(("activity", S), ("input_year", I), ("emissions_factor", S))
EMISSIONS_FACTORS = _schema(("emissions_factor", S), ("total_co2e_ef", D))
TRANSMISSION_LOSS_FACTORS = _schema(
    ("fuel_type", S), ("type", S), ("loss_factor", D), ("input_year", I)
)

# -- activity records -------------------------------------------------------
ACTIVITY_INPUTS = _schema(
    ("supercategory", S), ("subcategory", S), ("gpc_ref", S), ("scope", I),
    ("activity", S), ("entity", S), ("amount", D), ("units", S), ("input_year", I),
)
METER_EXPORT = _schema(
    ("usage_end", TS), ("account_fuel", S), ("use", D), ("default_units", S),
    ("facility", S), ("department", S),
)

# -- model inputs -------------------------------------------------------------
HOUSEHOLD_FUEL_INPUTS = _schema(
    ("input_year", I), ("total_households", D), ("pct_using_heating_oil", D),
    ("avg_household_space_heating_gal_year", D), ("avg_household_water_heating_gal_year", D),
    ("total_avg_household_heat_oil_use_gal_year", D),
)
TRANSIT_MODEL_INPUTS = _schema(
    ("input_year", I), ("miles_per_route", D), ("avg_weekday_trips", D),
    ("avg_sat_trips", D), ("avg_sun_trips", D), ("avg_fuel_efficiency", D),
)
ACREAGE_SCALING = _schema(("input_year", I), ("local_acreage", D), ("regional_acreage", D))
REGIONAL_LIVESTOCK = _schema(("input_year", I), ("animal", S), ("headcount", D))
FERTILIZATION_PCTS = _schema(
    ("input_year", I), ("pct_fertilized", D), ("application_rate_lb_N_acre", D)
)
SOLID_WASTE_COMPOSITION = _schema(
    ("input_year", I), ("entity", S), ("waste_type", S), ("total_waste_pct", D)
)
ORGANIC_WASTE_COMPOSITION = _schema(
    ("input_year", I), ("entity", S), ("organic_waste_subtype", S), ("organic_waste_pct", D)
)
WASTE_METHOD_COMPOSITION = _schema(
    ("input_year", I), ("entity", S), ("disposal_method", S), ("disposal_method_pct", D)
)
RECYCLING_COMPOSITION = _schema(
    ("input_year", I), ("entity", S), ("waste_type", S), ("total_recycling_pct", D)
)
SUPPLIED_DISPOSAL_METHODS = _schema(
    ("input_year", I), ("entity", S), ("waste_type", S), ("disposal_method", S),
    ("percentage", D),
)
WASTEWATER_INPUTS = _schema(("input_year", I), ("entity", S), ("wastewater_gallons", D))
WASTEWATER_CHEMICALS = _schema(
    ("input_year", I), ("influent_bod_mg_l", D), ("effluent_bod_mg_l", D)
)

# -- outputs ------------------------------------------------------------------
LEDGER = _schema(
    ("supercategory", S), ("subcategory", S), ("gpc_ref", S), ("scope", I),
    ("activity", S), ("entity", S), ("amount", D), ("units", S), ("input_year", I),
    ("total_co2e_ef", D), ("total_mtco2e", D), ("fiscal_year", S),
)
METER_LEDGER = T.StructType(
    METER_EXPORT.fields
    + _schema(
        ("year", I), ("activity", S), ("units", S), ("total_co2e_ef", D), ("total_mtco2e", D),
        ("fiscal_year", S),
    ).fields
)
LEDGER_COLUMNS = [f.name for f in LEDGER.fields]
SECTOR_COLUMNS = LEDGER_COLUMNS[:-1]  # a sector ledger has no fiscal-year label yet

# Named schemas, so a table directory can be loaded by name.
TABLES: dict[str, T.StructType] = {
    "activity_map": ACTIVITY_MAP,
    "activity_emissions_key": ACTIVITY_EMISSIONS_KEY,
    "emissions_factors": EMISSIONS_FACTORS,
    "transmission_loss_factors": TRANSMISSION_LOSS_FACTORS,
    "stationary_inputs": ACTIVITY_INPUTS,
    "transportation_inputs": ACTIVITY_INPUTS,
    "res_heat_oil_model_inputs": HOUSEHOLD_FUEL_INPUTS,
    "transit_model_inputs": TRANSIT_MODEL_INPUTS,
    "acreage_scaling": ACREAGE_SCALING,
    "regional_livestock": REGIONAL_LIVESTOCK,
    "fertilization_pcts": FERTILIZATION_PCTS,
    "solid_waste_composition": SOLID_WASTE_COMPOSITION,
    "organic_waste_composition": ORGANIC_WASTE_COMPOSITION,
    "waste_method_composition": WASTE_METHOD_COMPOSITION,
    "recycling_composition": RECYCLING_COMPOSITION,
    "supplied_disposal_methods": SUPPLIED_DISPOSAL_METHODS,
    "wastewater_inputs": WASTEWATER_INPUTS,
    "wastewater_chemicals": WASTEWATER_CHEMICALS,
    "meter_export": METER_EXPORT,
    "ledger": LEDGER,
    "meter_ledger": METER_LEDGER,
}


def conform(df: DataFrame, schema: T.StructType = LEDGER) -> DataFrame:
    """Select ``schema``'s columns in order, cast to its types.

    Missing columns become typed nulls (``bind_rows`` fills NA, N14), and
    extra columns are dropped.
    """
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
