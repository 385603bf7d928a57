"""Fixed values of the inventory model.

These must equal the model's published values for results to match:
labels written into the ledger, unit constants, calendar constants,
lookup rules and reporting years.  Operators take them as default
arguments so a caller can replace any of them.
"""

# ---- fixed values: ledger labels -------------------------------------------
SUPERCATEGORY_STATIONARY = "stationary_energy"
SUPERCATEGORY_TRANSPORTATION = "transportation"
SUPERCATEGORY_WASTE = "waste"
SUPERCATEGORY_AFOLU = "agriculture_forestry_other_land_use"

# Display names given to two of the four supercategories by the inventory.
PRETTY_SUPERCATEGORIES = {
    "stationary_energy": "Stationary Energy",
    "transportation": "Transportation",
}
FISCAL_YEAR_PREFIX = "FY "

# Loss records: activity -> replacement gpc_ref and scope.
LOSS_LABELS = {
    "electricity": {"gpc_ref": "I.2.3", "scope": 3},
    "natural_gas": {"gpc_ref": "I.8.1", "scope": 1},
}

# Residential heating-oil model output row.
HOUSEHOLD_FUEL_LABELS = {
    "supercategory": "stationary_energy",
    "subcategory": "residential_buildings",
    "gpc_ref": "I.1.1",
    "scope": 1,
    "activity": "dist_oil",
    "entity": "community",
    "units": "gal(US)/year",
}

# Transit fuel model output row.
TRANSIT_FUEL_LABELS = {
    "supercategory": "transportation",
    "subcategory": "on_road_transportation",
    "gpc_ref": "II.1.2",
    "scope": 2,
    "activity": "transit_bus",
    "entity": "community",
    "units": "gallons/year",
}

# Solid waste: disposal method -> subcategory and gpc_ref (recycling has none).
METHOD_LABELS = {
    "landfill": {"subcategory": "solid_waste_disposal", "gpc_ref": "III.1.2"},
    "compost": {"subcategory": "biological_treatment_of_waste", "gpc_ref": "III.2.2"},
    "incineration": {"subcategory": "incineration_and_open_burning", "gpc_ref": "III.3.2"},
}
SOLID_WASTE_UNITS = "tonnes"

# Solid waste allocation grid: value domains and which composition feeds a
# method.  Entities are the caller's (no default).
WASTE_YEARS = [2016, 2022]
WASTE_TYPES = [
    "paper", "plastic", "food_waste", "yard_waste", "metal", "glass",
    "construction_demo", "haz_waste", "electronics", "other_waste",
]
DISPOSAL_METHODS = ["recycle", "open_dump", "landfill", "compost", "incineration", "open_burning"]
METHOD_SOURCES = {
    "recycle": "recycling",
    "landfill": "total",
    "incineration": "total",
    "compost": "organic",
}
ENTITY_TONNES_SUFFIX = "_tonnes"

# Wastewater output row.
WASTEWATER_LABELS = {
    "supercategory": "waste",
    "subcategory": "wastewater_treatment_and_discharge",
    "gpc_ref": "III.4.1",
    "scope": 1,
    "activity": "wastewater_bod",
    "units": "kg",
}

# Livestock, fertilization and dung output rows.
LIVESTOCK_LABELS = {
    "supercategory": "agriculture_forestry_other_land_use",
    "subcategory": "livestock",
    "gpc_ref": "V.1",
    "scope": 1,
    "entity": "community",
    "units": "animals",
}
LIVESTOCK_PROCESS_SUFFIXES = ["_enteric_fermentation", "_manure"]
FERTILIZATION_LABELS = {
    "supercategory": "agriculture_forestry_other_land_use",
    "subcategory": "aggregate_sources",
    "gpc_ref": "V.3",
    "scope": 1,
    "activity": "fertilization",
    "entity": "community",
    "units": "kg",
}
DUNG_LABELS = {
    "supercategory": "agriculture_forestry_other_land_use",
    "subcategory": "aggregate_sources",
    "gpc_ref": "V.3",
    "scope": 1,
    "entity": "community",
    "units": "animals",
}
DUNG_GROUPS = {
    "cattle_dung": ["dairy_cattle", "other_cattle"],
    "other_dung": ["sheep", "goats"],
}
DIRECT_AND_INDIRECT = ["", "_indirect"]

# Meter export: account fuel -> activity; electricity is scaled kWh -> MWh.
METER_FUEL_MAP = {
    "Electric": "electricity",
    "Oil": "dist_oil",
    "Gas": "natural_gas",
    "Diesel": "diesel",
    "Gasoline": "gasoline",
    "Propane": "lpg",
}
METER_SCALED_FUEL = "Electric"
METER_SCALE_DIVISOR = 1000.0
METER_SCALED_UNITS = "MWh"
METER_YEARS = [2016, 2022, 2025]

# ---- fixed values: model constants -----------------------------------------
SCHOOL_YEAR_MONTHS = 8.5
MONTHS_PER_YEAR = 12.0
OFF_SEASON_SHARE = 0.4
WEEKDAYS_PER_YEAR = 261
SATURDAYS_PER_YEAR = 52
SUNDAYS_PER_YEAR = 52
LITERS_PER_GALLON = 3.79
MG_PER_KG = 1_000_000.0
LB_PER_KG = 0.4536
DAYS_PER_YEAR = 365

# ---- fixed values: reporting years -------------------------------------------
BASELINE_YEAR = 2016
CURRENT_YEAR = 2025
