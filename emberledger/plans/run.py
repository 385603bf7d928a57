"""Full run: load landed tables once, build the inventory and the meter
ledger, write both ledgers.

    python -m emberledger.plans.run --tables DIR --meter-export PATH --out DIR \\
        --waste-entities town campus --waste-named-parts campus --waste-residual town

Each input table is ``DIR/<name>.parquet`` (or ``.csv`` with ``--format
csv``), or with ``--format xlsx`` the sheet ``<name>`` of the workbook DIR, named as in ``sources.schemas.TABLES``; ``solid_waste_inputs`` has
one ``<entity>_tonnes`` column per named part.  Outputs are CSV with the
``NA`` null token (or Parquet), partitioned by year.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from emberledger import constants as K
from emberledger.plans import sectors
from emberledger.sources.io import load_tables, read_export, read_table, write_table
from emberledger.sources.schemas import METER_EXPORT, TABLES
from emberledger.sources.workbook import sheet_names

INPUTS = [n for n in TABLES if n not in ("ledger", "meter_ledger", "meter_export", "supplied_disposal_methods")]
OPTIONAL = ["supplied_disposal_methods"]


def run_inventory(
    spark: SparkSession,
    tables_dir: str,
    out_dir: str,
    waste_entities: Sequence[str],
    waste_named_parts: Sequence[str],
    waste_residual: str,
    meter_export: str | None = None,
    department_rules: Sequence[tuple[str, Sequence[object], object]] = (),
    fmt: str = "parquet",
    out_fmt: str = "csv",
    waste_years: Sequence[int] | None = K.WASTE_YEARS,
    meter_years: Sequence[int] | None = K.METER_YEARS,
    transit: Mapping[str, object] | None = None,
) -> dict[str, str]:
    """Write ``<out_dir>/inventory`` and, with a meter export,
    ``<out_dir>/meters``; return their paths.  ``transit`` are arguments of
    ``models.transit_fuel_model``.  Years of None mean all years."""
    t = load_tables(spark, tables_dir, INPUTS, fmt=fmt)
    # the wide waste table has entity-specific columns: read it without a fixed schema
    t["solid_waste_inputs"] = read_table(spark, tables_dir, "solid_waste_inputs", fmt=fmt)
    for name in OPTIONAL:
        if fmt == "xlsx" and name not in sheet_names(spark, tables_dir):
            continue
        try:
            t[name] = read_table(spark, tables_dir, name, fmt=fmt)
        except AnalysisException:  # table not landed: no supplied shares
            pass
    ef = sectors.resolved_factors(t)
    ledger = sectors.inventory(t, waste_entities, waste_named_parts, waste_residual, waste_years, ef, transit)
    out = {"inventory": f"{out_dir.rstrip('/')}/inventory"}
    write_table(ledger, out["inventory"], out_fmt, partition_by=["input_year"])
    if meter_export:
        export = read_export(spark, meter_export, METER_EXPORT)
        meters = sectors.meter_ledger(export, t, department_rules, ef, years=meter_years)
        out["meters"] = f"{out_dir.rstrip('/')}/meters"
        write_table(meters, out["meters"], out_fmt, partition_by=["year"])
    return out


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--tables", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--meter-export")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv", "xlsx"])
    p.add_argument("--out-format", default="csv", choices=["parquet", "csv"])
    p.add_argument("--waste-entities", nargs="+", required=True)
    p.add_argument("--waste-named-parts", nargs="*", default=[])
    p.add_argument("--waste-residual", required=True)
    p.add_argument("--waste-years", nargs="*", type=int, default=K.WASTE_YEARS, help="without values: all")
    p.add_argument("--meter-years", nargs="*", type=int, default=K.METER_YEARS, help="without values: all")
    p.add_argument("--transit-activity", default=K.TRANSIT_FUEL_LABELS["activity"],
                   help="activity name of the transit rows in the factor key table")
    p.add_argument("--transit-skip-missing", action="store_true",
                   help="sum the routes whose fuel is known instead of giving a missing total")
    p.add_argument("--department-rule", nargs=3, action="append", default=[],
                   metavar=("COLUMN", "VALUE", "DEPARTMENT"),
                   help="reassign department where COLUMN equals VALUE (repeatable, first match wins)")
    a = p.parse_args(argv)
    from emberledger.session import get_session

    spark = get_session()
    paths = run_inventory(
        spark, a.tables, a.out, a.waste_entities, a.waste_named_parts, a.waste_residual,
        meter_export=a.meter_export, fmt=a.format, out_fmt=a.out_format,
        waste_years=a.waste_years or None, meter_years=a.meter_years or None,
        transit={"labels": {**K.TRANSIT_FUEL_LABELS, "activity": a.transit_activity}, "na_rm": a.transit_skip_missing},
        department_rules=[(col, [value], dept) for col, value, dept in a.department_rule],
    )
    for k, v in paths.items():
        print(k, v)


if __name__ == "__main__":
    main()
