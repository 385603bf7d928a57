"""Lookup tables that bind the operators to the driver's TPC-H-style tables.

Activity records come from ``lineitem`` joined to ``orders``, ``customer``
and ``part``: activity = ``p_type``, entity = ``c_mktsegment``,
supercategory = ``l_returnflag``, input year = year of ``l_shipdate``,
amount = ``l_quantity``.  The lookups below are small literal tables built
from rules.  ``SMALL`` and the year 2001 deliberately have no factors, one
key points at an unknown factor id and one at a null id, so every
unmatched-row path runs.  Factor values are dyadic (k/8), so products and
sums of integer-valued quantities are exact in any summation order.
"""

from __future__ import annotations

BASE_ACTIVITIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "STANDARD"]  # no SMALL
ALL_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
FACTOR_YEARS = list(range(1995, 2001))  # no 2001
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

# factor id -> value (PRO-B is referenced but unknown; STA-B is a zero factor)
FACTOR_VALUES = {
    "ECO-A": 0.5, "ECO-B": 0.75, "LAR-A": 1.25, "LAR-B": 1.5, "MED-A": 0.25,
    "MED-B": 2.0, "PRO-A": 0.125, "STA-A": 1.0, "STA-B": 0.0,
    "LOSS-T": 0.5, "LOSS-D": 0.25, "ENT": 0.5, "MAN": 0.25, "DUNG": 1.5, "DUNG-I": 0.5,
    "BOD": 2.0, "FERT": 0.75, "FERT-I": 0.125, "M-N": 0.375, "M-R": 0.625,
    "ELEC": 0.5, "GAS": 0.25, "DIESEL": 1.0, "ELEC-T": 0.5, "GAS-D": 0.25, "GAS-L": 0.75,
    "UNUSED": 9.5,
}
METER_YEAR = 2024


def _base_key() -> list[tuple]:
    rows = []
    for a in BASE_ACTIVITIES:
        for y in FACTOR_YEARS:
            fid = None if (a, y) == ("MEDIUM", 1999) else f"{a[:3]}-{'A' if y % 2 else 'B'}"
            rows.append((a, y, fid))
    return rows


def _derived_key() -> list[tuple]:
    rows = []
    for y in FACTOR_YEARS:
        rows += [("ECONOMY_transmission", y, "LOSS-T"), ("ECONOMY_distribution", y, "LOSS-D"),
                 ("LARGE_transmission", y, "LOSS-T")]
        for a in ["ECONOMY", "LARGE", "PROMO"]:
            rows += [(f"{a}_enteric_fermentation", y, "ENT"), (f"{a}_manure", y, "MAN")]
        rows += [("big_dung", y, "DUNG"), ("big_dung_indirect", y, "DUNG-I"),
                 ("other_dung", y, "DUNG")]
        rows += [("wastewater_bod", y, "BOD"), ("fertilization", y, "FERT"),
                 ("fertilization_indirect", y, "FERT-I"), ("N", y, "M-N"), ("R", y, "M-R")]
    rows += [("electricity", METER_YEAR, "ELEC"), ("natural_gas", METER_YEAR, "GAS"),
             ("diesel", METER_YEAR, "DIESEL"), ("electricity_transmission", METER_YEAR, "ELEC-T"),
             ("natural_gas_distribution", METER_YEAR, "GAS-D"),
             ("natural_gas_leak", METER_YEAR, "GAS-L")]
    return rows


KEY_ROWS = _base_key() + _derived_key()
FACTOR_ROWS = sorted(FACTOR_VALUES.items())
KEY_SCHEMA = "activity string, input_year int, emissions_factor string"
FACTOR_SCHEMA = "emissions_factor string, total_co2e_ef double"

# Loss lookup: two loss types for ECONOMY; LARGE has no 1998 row.
LOSS_ROWS = (
    [("ECONOMY", "transmission", 0.0625, y) for y in FACTOR_YEARS]
    + [("ECONOMY", "distribution", 0.03125, y) for y in FACTOR_YEARS]
    + [("LARGE", "transmission", 0.125, y) for y in FACTOR_YEARS if y != 1998]
    + [("electricity", "transmission", 0.5, METER_YEAR),
       ("natural_gas", "distribution", 0.25, METER_YEAR),
       ("natural_gas", "leak", 0.5, METER_YEAR)]
)
LOSS_SCHEMA = "fuel_type string, type string, loss_factor double, input_year int"
LOSS_LABELS = {"ECONOMY": {"gpc_ref": "L.2.3", "scope": 3}, "LARGE": {"gpc_ref": "L.8.1", "scope": 1}}

# Recode map without SMALL (D1); the null-safe variant maps a null name.
RECODE_ROWS = [(a, a.lower()) for a in BASE_ACTIVITIES]
RECODE_NULL_ROWS = RECODE_ROWS + [(None, "unlabelled")]
RECODE_SCHEMA = "activity string, activity_recoded string"

# Literal domain for q03: region -> zone; MIDDLE EAST left out.
ZONE_ROWS = [("AFRICA", "south"), ("AMERICA", "west"), ("ASIA", "east"), ("EUROPE", "north")]
ZONE_SCHEMA = "r_name string, zone string"

# Allocation (q12/q22): methods are return flags; each draws on one composition.
ORGANIC_TYPES = ["PROMO", "SMALL"]
# Method -> whose amounts its type composition is made of (None: all), and which types it has.
METHOD_COMPOSITIONS = {
    "A": {"of": "A", "types": ORGANIC_TYPES},
    "N": {"of": None, "types": None},
    "R": {"of": "R", "types": None},
}
GRID_YEARS = FACTOR_YEARS
GRID_ENTITIES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]  # HOUSEHOLD is supplied
GRID_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]
GRID_METHODS = ["A", "N", "R", "X"]
SUPPLIED_ENTITY = "HOUSEHOLD"
METHOD_LABELS = {
    "N": {"subcategory": "normal_lines", "gpc_ref": "T.1.2"},
    "R": {"subcategory": "returned_lines", "gpc_ref": "T.3.1"},
}

# q13/q14: per-year segment totals as <segment>_tonnes columns; SPACE never occurs.
WIDE_SEGMENTS = SEGMENTS + ["SPACE"]
RESIDUAL_PARTS = ["AUTOMOBILE_tonnes", "BUILDING_tonnes", "late_MACHINERY_tonnes"]
LATE_FROM_YEAR = 1998

# q21/q29: events as meter readings.
EVENT_FUEL_MAP = {"click": "electricity", "view": "natural_gas", "purchase": "diesel",
                  "signup": "gasoline"}
EVENT_SCALED_FUEL = "click"
EVENT_YEARS = [2023, 2024]

# q23: groups of activities, others dropped.
DUNG_GROUPS = {"big_dung": ["ECONOMY", "LARGE"], "other_dung": ["PROMO", "SMALL"]}

# q19: label ladders and override rules.
PRIORITY_GROUPS = {"high": ["1-URGENT", "2-HIGH"], "medium": ["3-MEDIUM"]}
DEPARTMENT_RULES = [("o_orderstatus", ["P"], "pending_desk"),
                    ("o_orderpriority", ["5-LOW"], "low_desk")]

# q24: returnflag -> sector, and which sectors drop unmatched rows.
SECTOR_OF_FLAG = {"A": "stationary_energy", "N": "transportation", "R": "waste"}
ORDERS_SECTOR = "agriculture_forestry_other_land_use"
