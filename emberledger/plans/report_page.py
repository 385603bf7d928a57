"""Report tables from stored ledgers: baseline vs current, change by year,
sector share by year, and fuel mix by year (the data behind the overview
page's figures; rendering is not part of this package).

    python -m emberledger.plans.report_page --ledger DIR --out DIR \\
        [--meters DIR] [--entity municipal] [--baseline 2016] [--current 2025]

Ledgers are read as written by ``plans.run`` (CSV with ``NA`` nulls, or
Parquet); each report is a small aggregate written as one CSV table.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberledger import constants as K
from emberledger.operators import report
from emberledger.sources.io import read_csv_table, write_table
from emberledger.sources.schemas import LEDGER, METER_LEDGER


def read_ledger(spark: SparkSession, path: str, fmt: str = "csv", schema=LEDGER) -> DataFrame:
    """A stored ledger, read with its fixed schema (no inference pass)."""
    if fmt == "csv":
        return read_csv_table(spark, path, schema)
    return spark.read.schema(schema).parquet(path)


def report_tables(
    ledger: DataFrame,
    entity: str | None = None,
    baseline_year: int = K.BASELINE_YEAR,
    current_year: int = K.CURRENT_YEAR,
    meters: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The report's tables for one entity (or all rows)."""
    scoped = ledger if entity is None else ledger.where(F.col("entity") == F.lit(entity))
    out = {
        "baseline_vs_current": report.baseline_vs_current(scoped, baseline_year, current_year),
        "change_by_year": report.change_vs_baseline(scoped),
        "sector_share": report.sector_share(scoped),
    }
    if meters is not None:
        out["fuel_mix"] = report.fuel_mix(meters)
    return out


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--ledger", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--meters")
    p.add_argument("--format", default="csv", choices=["csv", "parquet"])
    p.add_argument("--entity")
    p.add_argument("--baseline", type=int, default=K.BASELINE_YEAR)
    p.add_argument("--current", type=int, default=K.CURRENT_YEAR)
    a = p.parse_args(argv)
    from emberledger.session import get_session

    spark = get_session()
    ledger = read_ledger(spark, a.ledger, a.format)
    meters = read_ledger(spark, a.meters, a.format, METER_LEDGER) if a.meters else None
    for name, df in report_tables(ledger, a.entity, a.baseline, a.current, meters).items():
        write_table(df, f"{a.out.rstrip('/')}/{name}", "csv")
        print(name, f"{a.out.rstrip('/')}/{name}")


if __name__ == "__main__":
    main()
