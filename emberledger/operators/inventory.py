"""Inventory assembly (D19): sector ledgers under one schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberledger import constants as K
from emberledger.operators.relational import bind, when_map
from emberledger.sources.schemas import LEDGER, SECTOR_COLUMNS, conform
from pyspark.sql import types as T


def fiscal_year_label(year: str | Column = "input_year", prefix: str = K.FISCAL_YEAR_PREFIX) -> Column:
    """``"FY <year>"``; null year gives a null label (N7).  Sort on the
    numeric year, not the label, for display order (O2)."""
    y = F.col(year) if isinstance(year, str) else year
    return F.concat(F.lit(prefix), y.cast("string"))


def assemble_inventory(
    *sectors: DataFrame,
    pretty: Mapping[str, str] = K.PRETTY_SUPERCATEGORIES,
) -> DataFrame:
    """Union sector ledgers by name (missing columns null), add the fiscal
    year label and display names for some supercategories."""
    sector_schema = T.StructType([f for f in LEDGER.fields if f.name in SECTOR_COLUMNS])
    ledger = bind(*[conform(s, sector_schema) for s in sectors])
    ledger = ledger.withColumns(
        {
            "fiscal_year": fiscal_year_label("input_year"),
            "supercategory": when_map("supercategory", pretty, default=F.col("supercategory")),
        }
    )
    return conform(ledger, LEDGER)
