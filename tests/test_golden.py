"""
inventory ledger CSV by the report operators.

The published file is opt-in: set EMBERLEDGER_GOLDEN_LEDGER to the ledger
CSV (header, ``NA`` for missing values, the 12 ledger columns). The same
reports always run on a small ledger made by hand.
"""

import os

import pytest
from pyspark.sql import functions as F

from emberledger.operators import report
from emberledger.sources.io import read_csv_table
from emberledger.sources.schemas import LEDGER

PATH = os.environ.get("EMBERLEDGER_GOLDEN_LEDGER")
published = pytest.mark.skipif(not PATH, reason="EMBERLEDGER_GOLDEN_LEDGER not set")

# A small ledger in the published shape; its figures below are worked out by hand.
SMALL = [
    ("Stationary Energy", "municipal", 2016, 60.0), ("Stationary Energy", "municipal", 2016, 20.0),
    ("Transportation", "municipal", 2016, 40.0), ("waste", "community", 2016, None),
    ("Stationary Energy", "municipal", 2022, 75.0), ("Transportation", "municipal", 2022, 25.0),
    ("Stationary Energy", "municipal", 2025, 60.0), ("Transportation", "municipal", 2025, 24.125),
    ("Transportation", "municipal", 2030, None), ("Stationary Energy", "municipal", 2030, 12.25),
]


@pytest.fixture(scope="module")
def small(spark):
    df = spark.createDataFrame(SMALL, "supercategory string, entity string, input_year int, total_mtco2e double")
    return df.withColumn("fiscal_year", F.concat(F.lit("FY "), F.col("input_year").cast("string")))


def test_small_ledger_totals_and_order(small):
    got = [tuple(r) for r in report.annual_totals(small, ["fiscal_year"]).collect()]
    assert got == [("FY 2016", 120.0), ("FY 2022", 100.0), ("FY 2025", 84.125), ("FY 2030", 12.25)]
    strict = dict(report.annual_totals(small, ["fiscal_year"], na_rm=False).collect())
    assert strict == {"FY 2016": None, "FY 2022": 100.0, "FY 2025": 84.125, "FY 2030": None}


def test_small_ledger_change(small):
    town = small.where(F.col("entity") == "municipal")
    bc = report.baseline_vs_current(town, 2016, 2025).collect()[0]
    assert (bc["baseline"], bc["current"]) == (120.0, 84.125)
    assert bc["change"] == pytest.approx(-0.298958, abs=1e-6)
    assert report.baseline_vs_current(small, 2016, 2025).collect()[0]["baseline"] is None
    ch = [(r["fiscal_year"], r["percent_change_label"], r["total_label"]) for r in report.change_vs_baseline(town).collect()]
    assert ch == [("FY 2016", "0.0%", "120"), ("FY 2022", "-16.7%", "100"), ("FY 2025", "-29.9%", "84"), ("FY 2030", "-89.8%", "12")]


def test_small_ledger_shares_and_labels(small):
    town = small.where(F.col("entity") == "municipal")
    got = {(r["fiscal_year"], r["supercategory"]): r["text"] for r in report.sector_share(town).collect()}
    assert got[("FY 2022", "Stationary Energy")] == "Sector: Stationary Energy<br>Emissions: 75 MTCO2e<br>Share: 75%"
    assert got[("FY 2016", "Transportation")] == "Sector: Transportation<br>Emissions: 40 MTCO2e<br>Share: 33.3%"
    # ties go to the even digit; a missing total makes the whole year's shares missing
    assert got[("FY 2025", "Transportation")] == "Sector: Transportation<br>Emissions: 24.1 MTCO2e<br>Share: 28.7%"
    assert got[("FY 2030", "Stationary Energy")] == "Sector: Stationary Energy<br>Emissions: 12.2 MTCO2e<br>Share: NA%"
    assert got[("FY 2030", "Transportation")] == "Sector: Transportation<br>Emissions: NA MTCO2e<br>Share: NA%"


@pytest.fixture(scope="module")
def ledger(spark):
    return read_csv_table(spark, PATH, LEDGER)


@published
def test_totals_by_year_and_sector(ledger):
    fy = dict(report.annual_totals(ledger, ["fiscal_year"]).collect())
    assert fy["FY 2016"] == pytest.approx(290035.15974, abs=1e-4)
    assert fy["FY 2022"] == pytest.approx(258677.87698, abs=1e-4)
    assert fy["FY 2025"] == pytest.approx(3342.47279, abs=1e-4)
    sec = dict(report.annual_totals(ledger, ["supercategory"]).collect())
    assert sec["Stationary Energy"] == pytest.approx(411741.66412, abs=1e-4)
    assert sec["Transportation"] == pytest.approx(127651.05184, abs=1e-4)


@published
def test_entity_baseline_change_and_shares(ledger):
    ent = ledger.where(F.col("entity") == "municipal")
    bc = report.baseline_vs_current(ent, 2016, 2025).collect()[0]
    assert bc["baseline"] == pytest.approx(4764.73420, abs=1e-4)
    assert bc["current"] == pytest.approx(3342.47279, abs=1e-4)
    ch = {r["fiscal_year"]: r for r in report.change_vs_baseline(ent).collect()}
    assert ch["FY 2022"]["percent_change"] == pytest.approx(-0.130617, abs=1e-6)
    assert ch["FY 2025"]["percent_change_label"] == "-29.8%"
    share = {(r["fiscal_year"], r["supercategory"]): r["pct"] for r in report.sector_share(ent).collect()}
    assert share[("FY 2016", "Stationary Energy")] == pytest.approx(68.0172, abs=1e-4)
    assert share[("FY 2022", "Stationary Energy")] == pytest.approx(66.0954, abs=1e-4)
    assert share[("FY 2025", "Stationary Energy")] == pytest.approx(79.6075, abs=1e-4)


@published
def test_row_and_na_counts_per_year(ledger):
    got = {
        r["fiscal_year"]: (r["n"], r["n_na"])
        for r in ledger.groupBy("fiscal_year").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("total_mtco2e").isNull()).alias("n_na")
        ).collect()
    }
    assert got == {"FY 2016": (90, 3), "FY 2022": (95, 4), "FY 2025": (9, 3)}
    na = report.annual_totals(ledger, ["fiscal_year"], na_rm=False).collect()
    assert all(r["total"] is None for r in na)  # every year has an NA row
