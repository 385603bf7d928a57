"""DuckDB SQL for every acceptance query (the independent oracle).

The SQL states each computation directly -- e.g. the allocation matrix as
the literal product of value domains left-joined to compositions -- and
shares only the literal lookup rows with the Spark side.  Views ``lineitem
orders customer part nation region events`` are registered by the caller.
"""

from __future__ import annotations

from emberledger import constants as K
from emberledger.plans import bindings as B


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return f"{v!r}::DOUBLE"
    return str(v)


def values(rows, cols: list[str]) -> str:
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({', '.join(cols)}))"


def _in(vals) -> str:
    return "(" + ", ".join(_lit(v) for v in vals) + ")"


def _case_map(col: str, mapping: dict, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {col} = {_lit(k)} THEN {_lit(v)}" for k, v in mapping.items())
    return f"CASE {whens}{' ELSE ' + default if default else ''} END"


def _exact(expr: str, over: str = "") -> str:
    """Sum of doubles whose digits do not depend on the order: in 24-bit
    integers, put together from the lowest."""
    limbs = [f"sum(CAST(trunc(fmod(({expr}) * power(2.0, {144 - 24 * i}), 16777216.0)) AS BIGINT)){over}" for i in range(10)]
    out = f"{limbs[0]} * power(2.0, -144)"
    for i, limb in enumerate(limbs[1:], 1):
        out = f"({out} + {limb} * power(2.0, {24 * i - 144}))"
    return out


def _exact_na_sum(expr: str, over: str = "") -> str:
    return f"CASE WHEN bool_or({expr} IS NULL){over} THEN NULL ELSE coalesce({_exact(expr, over)}, 0.0) END"


def _na_sum(expr: str, over: str = "") -> str:
    return f"CASE WHEN bool_or({expr} IS NULL){over} THEN NULL ELSE coalesce(sum({expr}){over}, 0.0) END"


def _stored(expr: str, decimals: int) -> str:
    """The nearer of the two numbers with that many decimals; of a tie the even one."""
    p = f"1{'0' * decimals}.0::DOUBLE"
    lo, hi = f"(floor(({expr}) * {p}) / {p})", f"(ceil(({expr}) * {p}) / {p})"
    return (f"CASE WHEN ({expr}) - {lo} < {hi} - ({expr}) THEN {lo} WHEN ({expr}) - {lo} > {hi} - ({expr}) THEN {hi} "
            f"WHEN CAST(floor(({expr}) * {p}) AS HUGEINT) % 2 = 0 THEN {lo} ELSE {hi} END")


def _number_text(expr: str, decimals: int) -> str:
    """Rounded, without trailing zeros; NA for null."""
    fixed = f"printf('%.{decimals}f', {_stored(expr, decimals)} + 0.0)"
    return f"CASE WHEN {expr} IS NULL THEN 'NA' ELSE regexp_replace({fixed}, '\\.0+$|(\\.\\d*?[1-9])0+$', '\\1') END"


KEYS = values(B.KEY_ROWS, ["activity", "input_year", "emissions_factor"])
FACTORS = values(B.FACTOR_ROWS, ["emissions_factor", "total_co2e_ef"])
LOSS = values(B.LOSS_ROWS, ["fuel_type", "type", "loss_factor", "input_year"])

BASE = f"""
act AS (
  SELECT p.p_type AS activity, c.c_mktsegment AS entity, l.l_returnflag AS supercategory,
         CAST(year(l.l_shipdate) AS INTEGER) AS input_year, l.l_quantity AS amount,
         l.l_linestatus, l.l_discount, l.l_tax, l.l_linenumber, l.l_orderkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey),
keyt AS {KEYS},
eft AS {FACTORS},
loss AS {LOSS},
resolved AS (
  SELECT k.activity, k.input_year, e.total_co2e_ef
  FROM keyt k LEFT JOIN eft e ON k.emissions_factor IS NOT DISTINCT FROM e.emissions_factor)
"""

MATCH = "{a}.activity IS NOT DISTINCT FROM r.activity AND {a}.input_year IS NOT DISTINCT FROM r.input_year"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([BASE.strip()] + [c.strip() for c in ctes]) + "\n"


def _totals(src: str, keys: str) -> str:
    return f"""
SELECT {keys}, count(*) AS n_records, coalesce(sum(amount), 0.0) AS total_amount,
       coalesce(sum(amount * r.total_co2e_ef), 0.0) AS total_mtco2e
FROM {src} s LEFT JOIN resolved r ON {MATCH.format(a='s')}
GROUP BY {keys}"""


def _shares_sql(name: str, keys: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT {keys}, sum(amount) / sum(sum(amount)) OVER (PARTITION BY input_year, entity) AS pct
  FROM act WHERE {where} GROUP BY {keys})"""


ALLOCATION_CTES = [
    _shares_sql("c_total", "input_year, entity, activity"),
    _shares_sql("c_recycling", "input_year, entity, activity", "supercategory = 'R'"),
    _shares_sql("c_organic", "input_year, entity, activity",
                f"supercategory = 'A' AND activity IN {_in(B.ORGANIC_TYPES)}"),
    _shares_sql("c_method", "input_year, entity, supercategory"),
    f"""c_supplied AS (
  SELECT input_year, entity, activity AS waste_type, supercategory AS disposal_method,
         sum(amount) / sum(sum(amount)) OVER (PARTITION BY input_year, entity) AS percentage
  FROM act WHERE entity = {_lit(B.SUPPLIED_ENTITY)} AND input_year IN {_in(B.GRID_YEARS)}
  GROUP BY input_year, entity, activity, supercategory)""",
    f"""grid AS (
  SELECT y.input_year, e.entity, t.waste_type, m.disposal_method
  FROM {values([(y,) for y in B.GRID_YEARS], ['input_year'])} y
  CROSS JOIN {values([(e,) for e in B.GRID_ENTITIES], ['entity'])} e
  CROSS JOIN {values([(t,) for t in B.GRID_TYPES], ['waste_type'])} t
  CROSS JOIN {values([(m,) for m in B.GRID_METHODS], ['disposal_method'])} m)""",
    """matrix AS (
  SELECT * FROM (
    SELECT g.input_year, g.entity, g.waste_type, g.disposal_method,
      CASE WHEN g.disposal_method = 'R' THEN rc.pct * mt.pct
           WHEN g.disposal_method = 'N' THEN tt.pct * mt.pct
           WHEN g.disposal_method = 'A' THEN og.pct * mt.pct END AS percentage
    FROM grid g
    LEFT JOIN c_total tt ON g.input_year = tt.input_year AND g.entity = tt.entity AND g.waste_type = tt.activity
    LEFT JOIN c_organic og ON g.input_year = og.input_year AND g.entity = og.entity AND g.waste_type = og.activity
    LEFT JOIN c_method mt ON g.input_year = mt.input_year AND g.entity = mt.entity AND g.disposal_method = mt.supercategory
    LEFT JOIN c_recycling rc ON g.input_year = rc.input_year AND g.entity = rc.entity AND g.waste_type = rc.activity
  ) WHERE percentage IS NOT NULL
  UNION ALL SELECT * FROM c_supplied)""",
]

_wide_cols = ",\n    ".join(
    f"sum(CASE WHEN entity = {_lit(s)} THEN amount END) AS \"{s}_tonnes\"" for s in B.WIDE_SEGMENTS
)
WIDE_CTE = f"""wide AS (
  SELECT input_year,
    {_wide_cols},
    sum(CASE WHEN entity = 'MACHINERY' AND input_year >= {B.LATE_FROM_YEAR} THEN amount END) AS "late_MACHINERY_tonnes",
    CAST(count(*) AS DOUBLE) AS population
  FROM act GROUP BY input_year)"""
LONG_CTE = "long13 AS (" + " UNION ALL ".join(
    f"SELECT input_year, {_lit(s)} AS entity, \"{s}_tonnes\" AS total_tonnes FROM wide" for s in B.WIDE_SEGMENTS
) + ")"

_fuel_case = _case_map("account_fuel", B.EVENT_FUEL_MAP)
METER_CTES = [
    f"""rd AS (
  SELECT event_id, ts AS usage_end, event_type AS account_fuel, 'count' AS default_units,
    CAST(year(ts) AS INTEGER) AS year,
    {_case_map('event_type', B.EVENT_FUEL_MAP)} AS activity,
    CASE WHEN event_type = {_lit(B.EVENT_SCALED_FUEL)} THEN value / 1000.0::DOUBLE ELSE value END AS use,
    CASE WHEN event_type = {_lit(B.EVENT_SCALED_FUEL)} THEN 'MWh' ELSE 'count' END AS units
  FROM events WHERE year(ts) IN {_in(B.EVENT_YEARS)})""",
    f"""meter AS (
  SELECT d.*, r.total_co2e_ef, d.use * r.total_co2e_ef AS total_mtco2e
  FROM rd d LEFT JOIN resolved r ON d.activity IS NOT DISTINCT FROM r.activity AND d.year IS NOT DISTINCT FROM r.input_year
  UNION ALL
  SELECT x.*, r.total_co2e_ef, x.use * r.total_co2e_ef AS total_mtco2e FROM (
    SELECT d.event_id, d.usage_end, d.account_fuel, d.default_units, d.year,
           d.activity || '_' || l.type AS activity, d.use * l.loss_factor AS use, d.units
    FROM rd d JOIN loss l ON d.activity = l.fuel_type AND d.year = l.input_year) x
  LEFT JOIN resolved r ON x.activity IS NOT DISTINCT FROM r.activity AND x.year IS NOT DISTINCT FROM r.input_year)""",
]

_sector_case = _case_map("supercategory", B.SECTOR_OF_FLAG)
_pretty_case = _case_map("supercategory", K.PRETTY_SUPERCATEGORIES, default="supercategory")
LEDGER_CTES = [
    f"""led_act AS (
  SELECT l.*, r.total_co2e_ef, l.amount * r.total_co2e_ef AS total_mtco2e FROM (
    SELECT {_sector_case} AS supercategory, l_linestatus AS subcategory, 'S.' || supercategory AS gpc_ref,
      CASE WHEN supercategory = 'A' THEN 1 WHEN supercategory = 'N' THEN 2 ELSE 3 END AS scope,
      activity, entity, amount, 'units' AS units, input_year FROM act) l
  LEFT JOIN resolved r ON {MATCH.format(a='l')})""",
    f"""led_orders AS (
  SELECT l.*, r.total_co2e_ef, l.amount * r.total_co2e_ef AS total_mtco2e FROM (
    SELECT {_lit(B.ORDERS_SECTOR)} AS supercategory, 'orders' AS subcategory, 'V.9' AS gpc_ref,
      CAST(NULL AS INTEGER) AS scope, o_orderpriority AS activity, o_orderstatus AS entity,
      o_totalprice AS amount, 'usd' AS units, CAST(year(o_orderdate) AS INTEGER) AS input_year
    FROM orders) l
  LEFT JOIN resolved r ON {MATCH.format(a='l')})""",
    f"""ledger AS (
  SELECT {_pretty_case} AS supercategory, subcategory, gpc_ref, scope, activity, entity, amount,
         units, input_year, total_co2e_ef, total_mtco2e, 'FY ' || CAST(input_year AS VARCHAR) AS fiscal_year
  FROM (SELECT * FROM led_act WHERE total_mtco2e IS NOT NULL OR supercategory <> 'stationary_energy'
        UNION ALL SELECT * FROM led_orders))""",
]


def _transit_fuel_sql() -> str:
    reg = K.SCHOOL_YEAR_MONTHS / K.MONTHS_PER_YEAR
    irr = (K.MONTHS_PER_YEAR - K.SCHOOL_YEAR_MONTHS) / K.MONTHS_PER_YEAR

    def days(f: float) -> str:
        return (f"({f!r}::DOUBLE * {K.WEEKDAYS_PER_YEAR} * wd + {f!r}::DOUBLE * {K.SATURDAYS_PER_YEAR} * sat"
                f" + {f!r}::DOUBLE * {K.SUNDAYS_PER_YEAR} * sun)")

    trips = f"({days(reg)} + {K.OFF_SEASON_SHARE!r}::DOUBLE * {days(irr)})"
    return f"(miles * {trips}) / nullif(eff, 0)"


def _labels_select(labels: dict) -> str:
    return ", ".join(f"{_lit(v)} AS {k}" for k, v in labels.items())


CHANGE_COLUMNS = f"""fiscal_year, total, percent_change,
  CASE WHEN percent_change IS NULL THEN 'NA'
       ELSE printf('%.1f%%', {_stored('percent_change * 100.0', 1)} + 0.0) END AS percent_change_label,
  format('{{:,.0f}}', total) AS total_label"""


def _baseline_sql(where: str) -> str:
    return _with(*LEDGER_CTES) + f"""
SELECT baseline, current, (current - baseline) / nullif(baseline, 0) AS change FROM (
  SELECT CASE WHEN bool_or(input_year = 1995 AND total_mtco2e IS NULL) THEN NULL
              ELSE coalesce(sum(CASE WHEN input_year = 1995 THEN total_mtco2e END), 0.0) END AS baseline,
         coalesce(sum(CASE WHEN input_year = 2000 THEN total_mtco2e END), 0.0) AS current
  FROM ledger WHERE {where} AND input_year IN (1995, 2000))"""


def _share_sql(where: str) -> str:
    return _with(
        *LEDGER_CTES,
        f"""s AS (SELECT fiscal_year, supercategory, {_na_sum('total_mtco2e')} AS total_mtco2e
  FROM ledger WHERE {where} GROUP BY 1, 2)""",
        f"""y AS (SELECT *, {_na_sum('total_mtco2e', over=' OVER (PARTITION BY fiscal_year)')} AS year_total FROM s)""",
        "p AS (SELECT *, total_mtco2e / nullif(year_total, 0) * 100.0 AS pct FROM y)",
    ) + f"""
SELECT fiscal_year, supercategory, total_mtco2e, year_total, pct, {_stored('pct', 1)} AS pct_rounded,
  'Sector: ' || coalesce(supercategory, 'NA') || '<br>Emissions: ' || {_number_text('total_mtco2e', 1)} ||
  ' MTCO2e<br>Share: ' || {_number_text('pct', 1)} || '%' AS text
FROM p"""


def _mix_sql(where: str) -> str:
    return _with(
        *METER_CTES,
        f"""f AS (
  SELECT CAST(CAST(usage_end AS DATE) AS VARCHAR) AS day, account_fuel, {_exact_na_sum('total_mtco2e')} AS total_emissions
  FROM meter WHERE {where} GROUP BY 1, 2)""",
        f"""p AS (
  SELECT *, total_emissions / nullif({_exact_na_sum('total_emissions', over=' OVER (PARTITION BY day)')}, 0) AS share FROM f)""",
    ) + f"""
SELECT day, account_fuel, total_emissions, share, share * 100.0 AS percentage,
  'Fuel: ' || coalesce(account_fuel, 'NA') || chr(10) || 'Emissions: ' || {_number_text('total_emissions', 2)} ||
  ' MTCO2e' || chr(10) || 'Share: ' || {_number_text('(share * 100.0)', 1)} || '%' AS tooltip_text
FROM p"""


SQL: dict[str, str] = {
    "q01_resolve_factors": _with() + f"""
SELECT p.activity, p.input_year, p.n_records, r.total_co2e_ef
FROM (SELECT activity, input_year, count(*) AS n_records FROM act GROUP BY activity, input_year) p
LEFT JOIN resolved r ON {MATCH.format(a='p')}""",

    "q01_workbook_sheets": """
SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority, o_totalprice, o_orderdate,
       o_totalprice > 1000 AS large
FROM orders""",

    "q02_csv_roundtrip": """
SELECT n_nationkey, n_name, n_regionkey, nullif(r_name, 'ASIA') AS r_name
FROM nation JOIN region ON n_regionkey = r_regionkey""",

    "q02_reject_channel": """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END AS o_totalprice,
  CASE WHEN o_custkey % 5 > 0 THEN CAST(o_orderdate AS DATE) END AS o_orderdate,
  nullif(concat_ws('; ', CASE WHEN o_orderkey % 7 = 0 THEN 'o_totalprice: ''n/k'' is no double' END,
                   CASE WHEN o_custkey % 5 = 0 THEN 'o_orderdate: missing' END), '') AS reason
FROM orders""",

    "q02_published": _with() + """
SELECT v.version, coalesce(o.input_year, t.input_year) AS input_year, o.n_orders, t.n_records
FROM (SELECT 'first' AS version, 1996 AS last UNION ALL SELECT 'second', 1998) v
JOIN (SELECT coalesce(o.input_year, t.input_year) AS y, o.*, t.* FROM
        (SELECT CAST(year(o_orderdate) AS INTEGER) AS input_year, count(*) AS n_orders FROM orders GROUP BY 1) o
        FULL JOIN (SELECT input_year, count(*) AS n_records FROM act GROUP BY 1) t ON o.input_year = t.input_year) x
  ON x.y <= v.last
LEFT JOIN (SELECT CAST(year(o_orderdate) AS INTEGER) AS input_year, count(*) AS n_orders FROM orders GROUP BY 1) o ON o.input_year = x.y
LEFT JOIN (SELECT input_year, count(*) AS n_records FROM act GROUP BY 1) t ON t.input_year = x.y""",

    "q08_hot_keys": """
SELECT p_type AS activity, count(*) AS n_records, sum(l_quantity) AS total_amount, count(l.part) AS n_known
FROM (SELECT CASE WHEN l_linenumber > 2 THEN l_partkey WHEN l_quantity > 3 THEN 1 END AS part, l_quantity FROM lineitem) l
LEFT JOIN part ON l.part = p_partkey GROUP BY p_type""",

    "q03_literal_domain": f"""
SELECT c.r_name, c.n_nations, z.zone
FROM (SELECT r_name, count(*) AS n_nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name) c
LEFT JOIN {values(B.ZONE_ROWS, ['r_name', 'zone'])} z ON c.r_name = z.r_name""",

    "q04_projection": """
SELECT o_orderkey, o_custkey AS customer_key, o_totalprice AS amount, o_orderpriority FROM orders""",

    "q05_household_model": f"""
SELECT {_labels_select(K.HOUSEHOLD_FUEL_LABELS)},
       (CAST(p_size AS DOUBLE) * 0.25::DOUBLE) * p_retailprice AS amount,
       CAST(p_partkey AS INTEGER) AS input_year
FROM part""",

    "q06_filters": """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem
WHERE l_returnflag = 'R' AND l_linestatus IN ('F', 'O') AND l_tax > 0.04::DOUBLE AND l_discount > 0""",

    "q06_membership": """
SELECT l_orderkey, l_linenumber, flag, coalesce(flag IN ('A', 'R'), FALSE) AS is_in,
       NOT coalesce(flag IN ('A', 'R'), FALSE) AS is_out
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_tax > 0.04::DOUBLE THEN l_returnflag END AS flag FROM lineitem)""",

    "q07_recode": _with() + f"""
SELECT m.activity_recoded AS activity, a.input_year, count(*) AS n_records, sum(a.amount) AS total_amount
FROM act a LEFT JOIN {values(B.RECODE_ROWS, ['activity', 'activity_recoded'])} m
  ON a.activity IS NOT DISTINCT FROM m.activity
GROUP BY m.activity_recoded, a.input_year""",

    "q08_emissions": _with() + f"""
SELECT a.activity, a.input_year, count(*) AS n_records,
       count(*) FILTER (WHERE a.amount * r.total_co2e_ef IS NULL) AS n_unmatched,
       coalesce(sum(a.amount), 0.0) AS total_amount,
       coalesce(sum(a.amount * r.total_co2e_ef), 0.0) AS total_mtco2e
FROM act a LEFT JOIN resolved r ON {MATCH.format(a='a')}
GROUP BY a.activity, a.input_year""",

    "q08_matched_only": _with() + f"""
SELECT a.activity, a.input_year, count(*) AS n_records, coalesce(sum(a.amount), 0.0) AS total_amount,
       coalesce(sum(a.amount * r.total_co2e_ef), 0.0) AS total_mtco2e
FROM act a JOIN resolved r ON {MATCH.format(a='a')}
WHERE a.amount * r.total_co2e_ef IS NOT NULL
GROUP BY a.activity, a.input_year""",

    "q09_loss_records": _with(
        f"""led AS (
  SELECT a.activity || '_' || l.type AS activity, a.input_year, a.amount * l.loss_factor AS amount,
    {_case_map('a.activity', {k: v['gpc_ref'] for k, v in B.LOSS_LABELS.items()})} AS gpc_ref,
    {_case_map('a.activity', {k: v['scope'] for k, v in B.LOSS_LABELS.items()})} AS scope
  FROM act a JOIN loss l ON a.activity = l.fuel_type AND a.input_year = l.input_year)"""
    ) + _totals("led", "s.activity, s.input_year, s.gpc_ref, s.scope").replace(
        "SELECT s.activity, s.input_year, s.gpc_ref, s.scope",
        "SELECT s.activity AS activity, s.input_year AS input_year, s.gpc_ref AS gpc_ref, s.scope AS scope"),

    "q09_losses": _with(
        f"""led AS (
  SELECT activity, input_year, amount, CAST(NULL AS VARCHAR) AS gpc_ref, CAST(NULL AS INTEGER) AS scope FROM act
  UNION ALL
  SELECT a.activity || '_' || l.type, a.input_year, a.amount * l.loss_factor,
    {_case_map('a.activity', {k: v['gpc_ref'] for k, v in B.LOSS_LABELS.items()})},
    {_case_map('a.activity', {k: v['scope'] for k, v in B.LOSS_LABELS.items()})}
  FROM act a JOIN loss l ON a.activity = l.fuel_type AND a.input_year = l.input_year)"""
    ) + _totals("led", "s.activity, s.input_year, s.gpc_ref, s.scope").replace(
        "SELECT s.activity, s.input_year, s.gpc_ref, s.scope",
        "SELECT s.activity AS activity, s.input_year AS input_year, s.gpc_ref AS gpc_ref, s.scope AS scope"),

    "q09_loss_gaps": _with() + """
SELECT a.activity, a.input_year, count(*) AS n_records, sum(a.amount) AS total_amount
FROM act a
WHERE a.activity IN (SELECT fuel_type FROM loss)
  AND NOT EXISTS (SELECT 1 FROM loss l WHERE l.fuel_type = a.activity AND l.input_year = a.input_year)
GROUP BY a.activity, a.input_year""",

    "q10_null_safe": _with() + f"""
SELECT m.activity_recoded AS activity, count(*) AS n_records, sum(a.amount) AS total_amount
FROM (SELECT nullif(activity, 'SMALL') AS activity, amount FROM act) a
LEFT JOIN {values(B.RECODE_NULL_ROWS, ['activity', 'activity_recoded'])} m
  ON a.activity IS NOT DISTINCT FROM m.activity
GROUP BY m.activity_recoded""",

    "q11_na_totals": _with("e AS (SELECT a.entity, a.input_year, a.amount * r.total_co2e_ef AS t "
                           f"FROM act a LEFT JOIN resolved r ON {MATCH.format(a='a')})") + f"""
SELECT entity, input_year, {_na_sum('t')} AS total_na, coalesce(sum(t), 0.0) AS total_ignore_na
FROM e GROUP BY entity, input_year""",

    "q12_allocation_matrix": _with(*ALLOCATION_CTES) + """
SELECT * FROM matrix WHERE percentage > 0""",

    "q13_entity_totals": _with(WIDE_CTE, LONG_CTE) + "SELECT * FROM long13",

    "q14_residual": _with(WIDE_CTE) + """
SELECT input_year, (population * 2.0::DOUBLE * 365) / 2000.0::DOUBLE AS total_annual_tonnes,
       (population * 2.0::DOUBLE * 365) / 2000.0::DOUBLE - "AUTOMOBILE_tonnes" - "BUILDING_tonnes"
         - "late_MACHINERY_tonnes" AS residual_tonnes
FROM wide""",

    "q15_fan_out": _with(
        "fan AS (SELECT activity || '_enteric_fermentation' AS activity, input_year, amount FROM act "
        "UNION ALL SELECT activity || '_manure' AS activity, input_year, amount FROM act)"
    ) + _totals("fan", "s.activity, s.input_year").replace(
        "SELECT s.activity, s.input_year", "SELECT s.activity AS activity, s.input_year AS input_year"),

    "q16_downscale": _with(
        """counts AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS input_year, n_name, CAST(count(*) AS DOUBLE) AS headcount
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)""",
        """scaling AS (
  SELECT input_year, sum(CASE WHEN entity = 'BUILDING' THEN amount END) / nullif(sum(amount), 0) AS scaling_factor
  FROM act GROUP BY input_year)""",
    ) + """
SELECT c.input_year, c.n_name, c.headcount, s.scaling_factor, c.headcount * s.scaling_factor AS local_headcount
FROM counts c LEFT JOIN scaling s ON c.input_year IS NOT DISTINCT FROM s.input_year""",

    "q17_concentration_load": _with(
        """means AS (SELECT input_year, sum(amount) / count(amount) AS avg_effluent_bod FROM act GROUP BY input_year)""",
        """vol AS (SELECT input_year, entity, sum(amount) AS gallons FROM act GROUP BY input_year, entity)""",
        """j AS (
  SELECT v.input_year, v.entity,
         v.gallons * 3.79::DOUBLE * m.avg_effluent_bod / 1000000.0::DOUBLE AS amount
  FROM vol v LEFT JOIN means m ON v.input_year IS NOT DISTINCT FROM m.input_year)""",
    ) + f"""
SELECT {_labels_select(K.WASTEWATER_LABELS)}, j.entity, j.amount, j.input_year, r.total_co2e_ef,
       j.amount * r.total_co2e_ef AS total_mtco2e
FROM j LEFT JOIN resolved r ON r.activity = 'wastewater_bod' AND j.input_year IS NOT DISTINCT FROM r.input_year""",

    "q17_application_model": _with(
        """area AS (SELECT input_year, sum(CASE WHEN entity = 'BUILDING' THEN amount END) AS acreage
  FROM act GROUP BY input_year)""",
        """means AS (SELECT input_year, sum(l_linenumber / 8.0::DOUBLE) / count(*) AS pct,
  sum(amount) / count(amount) AS rate FROM act GROUP BY input_year)""",
        """base AS (SELECT a.input_year, a.acreage * m.pct * m.rate * 0.4536::DOUBLE AS amount
  FROM area a LEFT JOIN means m ON a.input_year IS NOT DISTINCT FROM m.input_year)""",
        """fan AS (SELECT 'fertilization_indirect' AS activity, input_year, amount FROM base
  UNION ALL SELECT 'fertilization' AS activity, input_year, amount FROM base)""",
    ) + f"""
SELECT {_labels_select({k: v for k, v in K.FERTILIZATION_LABELS.items() if k != 'activity'})},
       f.activity, f.amount, f.input_year, r.total_co2e_ef, f.amount * r.total_co2e_ef AS total_mtco2e
FROM fan f LEFT JOIN resolved r ON {MATCH.format(a='f')}""",

    "q18_transit_model": _with(
        f"""routes AS (
  SELECT input_year, {_transit_fuel_sql()} AS fuel FROM (
    SELECT input_year, amount AS miles, CAST(l_linenumber AS DOUBLE) AS wd, l_linenumber / 2.0::DOUBLE AS sat,
           1.0::DOUBLE AS sun, l_tax AS eff FROM act))"""
    ) + f"""
SELECT {_labels_select(K.TRANSIT_FUEL_LABELS)},
       coalesce({_exact('fuel')}, 0.0) AS amount, input_year
FROM routes GROUP BY input_year""",

    "q18_transit_strict": _with(
        f"""routes AS (
  SELECT input_year, eff, {_transit_fuel_sql()} AS fuel FROM (
    SELECT input_year, amount AS miles, CAST(l_linenumber AS DOUBLE) AS wd, l_linenumber / 2.0::DOUBLE AS sat,
           1.0::DOUBLE AS sun, l_tax AS eff FROM act))""",
        f"""sums AS (
  SELECT input_year, {_exact_na_sum('fuel')} AS amount FROM routes GROUP BY input_year
  UNION ALL SELECT input_year, {_exact_na_sum('fuel')} AS amount FROM routes WHERE eff > 0 GROUP BY input_year)""",
    ) + f"""
SELECT {_labels_select(K.TRANSIT_FUEL_LABELS)}, amount, input_year FROM sums""",

    "q19_labels": f"""
SELECT o_orderkey,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high'
       WHEN o_orderpriority IN ('3-MEDIUM') THEN 'medium' END AS priority_label,
  CASE WHEN o_orderstatus = 'F' THEN 'filled' ELSE o_orderstatus END AS status_label,
  CASE WHEN o_orderstatus IN ('P') THEN 'pending_desk'
       WHEN o_orderpriority IN ('5-LOW') THEN 'low_desk' ELSE o_orderpriority END AS department
FROM orders""",

    "q20_strings": r"""
SELECT p_partkey,
  p_type || '_' || (CASE WHEN p_size > 25 THEN p_name END) AS type_name,
  regexp_replace(p_brand, 'Brand#', '') AS brand_code,
  regexp_replace(p_name, 'o', '') AS name_stub,
  TRY_CAST(nullif(regexp_extract(p_brand, '\d$'), '') AS INTEGER) AS brand_digit,
  TRY_CAST(nullif(regexp_extract(p_name, '\d$'), '') AS INTEGER) AS name_digit,
  CAST(p_size AS VARCHAR) AS size_text
FROM part""",

    "q21_meter_emissions": _with(*METER_CTES) + """
SELECT event_id, year, activity, use, units, total_co2e_ef, total_mtco2e FROM meter""",

    "q22_allocate_and_emit": _with(*ALLOCATION_CTES, WIDE_CTE, LONG_CTE,
        f"""m AS (
  SELECT g.input_year, g.entity, g.disposal_method,
    {_exact_na_sum('g.percentage * t.total_tonnes')} AS amount
  FROM matrix g LEFT JOIN long13 t ON g.input_year IS NOT DISTINCT FROM t.input_year
    AND g.entity IS NOT DISTINCT FROM t.entity
  WHERE g.percentage > 0
  GROUP BY g.input_year, g.entity, g.disposal_method)""",
        f"""lab AS (
  SELECT *, {_case_map('disposal_method', {k: v['subcategory'] for k, v in B.METHOD_LABELS.items()})} AS subcategory,
    {_case_map('disposal_method', {k: v['gpc_ref'] for k, v in B.METHOD_LABELS.items()})} AS gpc_ref
  FROM m)""",
    ) + r"""
SELECT 'waste' AS supercategory, l.subcategory, l.gpc_ref,
  TRY_CAST(nullif(regexp_extract(l.gpc_ref, '\d$'), '') AS INTEGER) AS scope,
  l.disposal_method AS activity, l.entity, l.amount, 'tonnes' AS units, l.input_year,
  r.total_co2e_ef, l.amount * r.total_co2e_ef AS total_mtco2e
FROM lab l LEFT JOIN resolved r ON l.disposal_method IS NOT DISTINCT FROM r.activity
  AND l.input_year IS NOT DISTINCT FROM r.input_year""",

    "q23_regroup": _with(
        f"""g AS (
  SELECT input_year,
    CASE WHEN activity IN {_in(B.DUNG_GROUPS['big_dung'])} THEN 'big_dung'
         WHEN activity IN {_in(B.DUNG_GROUPS['other_dung'])} THEN 'other_dung' END AS activity,
    {_na_sum('amount')} AS amount
  FROM act WHERE activity IN {_in(B.DUNG_GROUPS['big_dung'] + B.DUNG_GROUPS['other_dung'])}
  GROUP BY 1, 2)""",
        """fan AS (SELECT input_year, activity || '_indirect' AS activity, amount FROM g
  UNION ALL SELECT input_year, activity, amount FROM g)""",
    ) + f"""
SELECT f.input_year, f.activity, f.amount, r.total_co2e_ef, f.amount * r.total_co2e_ef AS total_mtco2e
FROM fan f LEFT JOIN resolved r ON {MATCH.format(a='f')}""",

    "q24_inventory": _with(*LEDGER_CTES) + "SELECT * FROM ledger",

    "q25_annual_totals": _with(*LEDGER_CTES) + """
SELECT input_year, coalesce(sum(total_mtco2e), 0.0) AS total_mtco2e FROM ledger
WHERE entity = 'BUILDING' AND supercategory = 'Stationary Energy' GROUP BY input_year""",

    "q24_four_sectors": _with(
        f"""s4 AS (
  SELECT 'stationary_energy' AS supercategory, l_linestatus AS subcategory, 'I.1' AS gpc_ref, 1 AS scope,
         activity, entity, amount, 'units' AS units, input_year FROM act WHERE supercategory = 'A'
  UNION ALL SELECT 'transportation', 'orders', 'II.1', NULL, o_orderpriority, o_orderstatus, o_totalprice, 'usd',
         CAST(year(o_orderdate) AS INTEGER) FROM orders
  UNION ALL SELECT 'waste', NULL, 'III.1', 3, p_type, p_brand, p_retailprice, NULL,
         CAST(1995 + p_size % 6 AS INTEGER) FROM part
  UNION ALL SELECT {_lit(B.ORDERS_SECTOR)}, 'events', NULL, 1, event_type, NULL, value, 'count',
         CAST(year(ts) AS INTEGER) FROM events)""",
        f"""l4 AS (
  SELECT s.*, r.total_co2e_ef, s.amount * r.total_co2e_ef AS total_mtco2e
  FROM s4 s LEFT JOIN resolved r ON {MATCH.format(a='s')})""",
    ) + f"""
SELECT {_pretty_case} AS supercategory, subcategory, gpc_ref, scope, activity, entity, units, input_year,
       total_co2e_ef, 'FY ' || CAST(input_year AS VARCHAR) AS fiscal_year, count(*) AS n_records,
       CAST(sum(CAST(amount AS DECIMAL(38,4))) AS DOUBLE) AS amount,
       count(*) FILTER (WHERE total_mtco2e IS NULL) AS n_unmatched
FROM l4 WHERE supercategory <> 'stationary_energy' OR total_mtco2e IS NOT NULL
GROUP BY ALL""",

    "q26_baseline_vs_current": _baseline_sql("entity = 'BUILDING'"),

    "q26_baseline_known": _baseline_sql("entity = 'BUILDING' AND supercategory = 'Stationary Energy'"),

    "q27_change_vs_baseline": _with(
        *LEDGER_CTES,
        "t AS (SELECT entity, fiscal_year, coalesce(sum(total_mtco2e), 0.0) AS total FROM ledger GROUP BY 1, 2)",
        "b AS (SELECT entity, arg_min(total, fiscal_year) AS base FROM t GROUP BY entity)",
        "c AS (SELECT t.entity, t.fiscal_year, t.total, (t.total - b.base) / nullif(b.base, 0) AS percent_change "
        "FROM t JOIN b ON t.entity IS NOT DISTINCT FROM b.entity)",
    ) + f"""
SELECT entity, {CHANGE_COLUMNS} FROM c""",

    "q27_change_overall": _with(
        *LEDGER_CTES,
        "t AS (SELECT fiscal_year, coalesce(sum(total_mtco2e), 0.0) AS total FROM ledger WHERE entity = 'BUILDING' GROUP BY 1)",
        "c AS (SELECT fiscal_year, total, (total - (SELECT arg_min(total, fiscal_year) FROM t)) "
        "/ nullif((SELECT arg_min(total, fiscal_year) FROM t), 0) AS percent_change FROM t)",
    ) + f"""
SELECT {CHANGE_COLUMNS} FROM c""",

    "q28_sector_share": _share_sql("TRUE"),

    "q28_sector_share_known": _share_sql("total_mtco2e IS NOT NULL"),

    "q29_fuel_mix": _mix_sql("TRUE"),

    "q29_fuel_mix_known": _mix_sql("total_mtco2e IS NOT NULL"),
}

# The streaming form of q21 must give exactly the batch rows.
SQL["q12_crossing"] = _with(ALLOCATION_CTES[-2]) + """
SELECT g.input_year, g.entity, g.waste_type AS activity, g.disposal_method AS supercategory, count(a.amount) AS n_lines
FROM grid g LEFT JOIN act a ON a.input_year = g.input_year AND a.entity = g.entity
  AND a.activity = g.waste_type AND a.supercategory = g.disposal_method
GROUP BY ALL"""
# The same results from stored partial aggregates as from the ledger.
SQL["q27_change_from_state"] = SQL["q27_change_vs_baseline"]
SQL["q28_share_from_state"] = SQL["q28_sector_share"]
# The same results from tables as from records.
SQL["q12_allocation_tables"] = SQL["q12_allocation_matrix"]
SQL["q17_load_tables"] = SQL["q17_concentration_load"]
SQL["q17_application_tables"] = SQL["q17_application_model"]

# Labels of a column with the decimals that tell its values apart.
SQL["q27_change_fitted"] = _with(
    *LEDGER_CTES,
    "t AS (SELECT entity, fiscal_year, coalesce(sum(total_mtco2e), 0.0) AS total FROM ledger GROUP BY 1, 2)",
    "b AS (SELECT entity, arg_min(total, fiscal_year) AS base FROM t GROUP BY entity)",
    "c AS (SELECT t.entity, t.fiscal_year, t.total, (t.total - b.base) / nullif(b.base, 0) AS change, "
    "change * 100.0::DOUBLE AS v FROM t JOIN b ON t.entity IS NOT DISTINCT FROM b.entity)",
    """g AS (SELECT x.entity, min(y.v - x.v) AS least FROM c x JOIN c y ON x.entity IS NOT DISTINCT FROM y.entity AND y.v > x.v
  GROUP BY x.entity)""",
    "u AS (SELECT c.*, least, pow(10.0, floor(log10(least)) - 1) AS unit FROM c LEFT JOIN g ON c.entity IS NOT DISTINCT FROM g.entity)",
    """f AS (SELECT *, CASE WHEN least >= pow(2.0, -26) THEN
    least(CASE WHEN bool_and(round_even(v / unit, 0) % 10 = 0) OVER (PARTITION BY entity) THEN unit * 10 ELSE unit END, 1.0) ELSE 1.0 END AS acc
  FROM u)""",
) + """
SELECT entity, fiscal_year, total, change AS percent_change,
  CASE WHEN v IS NULL THEN 'NA' ELSE printf('%.' || CAST(CAST(greatest(-floor(log10(acc)), 0) AS INTEGER) AS VARCHAR) || 'f', round_even(v / acc, 0) * acc + 0.0) || '%' END AS percent_change_label,
  format('{:,.0f}', total) AS total_label
FROM f"""

SQL["q21_meter_stream"] = SQL["q21_meter_emissions"]
