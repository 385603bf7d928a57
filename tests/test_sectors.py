"""Sector ledgers on small hand-made tables in the input shapes of
FIXTURES.md (invented rows), with invariants checked by hand arithmetic."""

import datetime as dt

import pytest

from checks import rows
from emberledger.operators import report
from emberledger.plans import sectors
from emberledger.sources import schemas as S


@pytest.fixture(scope="module")
def tables(spark):
    def t(name, data):
        return spark.createDataFrame(data, S.TABLES[name])

    return {
        "activity_map": t("activity_map", [
            ("Electric", "electricity"), ("Gas", "natural_gas"), ("Oil #2", "dist_oil"),
            ("Diesel fuel", "diesel"), ("Bus", "transit_bus")]),
        "activity_emissions_key": t("activity_emissions_key", [
            ("electricity", 2020, "E20"), ("natural_gas", 2020, "G20"), ("dist_oil", 2020, "O20"),
            ("electricity_transmission", 2020, "T20"), ("natural_gas_distribution", 2020, "D20"),
            ("natural_gas_leak", 2020, "D20"), ("diesel", 2020, "MISSING"), ("transit_bus", 2020, None),
            ("landfill", 2020, "LF"), ("compost", 2020, "CP"), ("wastewater_bod", 2020, "BOD"),
            ("cow_enteric_fermentation", 2020, "EF"), ("cow_manure", 2020, "MN"),
            ("fertilization", 2020, "FZ"), ("cattle_dung", 2020, "DG"), ("cattle_dung_indirect", 2020, "DGI"),
            ("electricity", 2021, "E21")]),
        "emissions_factors": t("emissions_factors", [
            ("E20", 0.5), ("G20", 0.25), ("O20", 1.0), ("T20", 0.5), ("D20", 0.25), ("LF", 2.0),
            ("CP", 0.0), ("BOD", 4.0), ("EF", 1.5), ("MN", 0.5), ("FZ", 0.125), ("DG", 1.0),
            ("DGI", 0.25), ("E21", 0.75)]),
        "transmission_loss_factors": t("transmission_loss_factors", [
            ("electricity", "transmission", 0.125, 2020), ("natural_gas", "distribution", 0.25, 2020),
            ("natural_gas", "leak", 0.5, 2020)]),
        "stationary_inputs": t("stationary_inputs", [
            ("stationary_energy", "buildings", "I.2.2", 2, "Electric", "town", 100.0, "MWh", 2020),
            ("stationary_energy", "buildings", "I.2.1", 1, "Gas", "town", 40.0, "therm", 2020),
            ("stationary_energy", "buildings", "I.2.1", 1, "Unknown", "town", 7.0, "x", 2020),
            ("stationary_energy", "buildings", "I.2.2", 2, "Electric", "town", 8.0, "MWh", 2021)]),
        "res_heat_oil_model_inputs": t("res_heat_oil_model_inputs", [(2020, 1000.0, 0.25, 1.0, 1.0, 4.0)]),
        "transportation_inputs": t("transportation_inputs", [
            ("transportation", "on_road", "II.1.1", 1, "Diesel fuel", "town", 10.0, "gal", 2020)]),
        "transit_model_inputs": t("transit_model_inputs", [
            (2020, 12.0, 10.0, 4.0, 2.0, 4.0), (2020, 6.0, 5.0, 0.0, 0.0, 3.0)]),
        "solid_waste_inputs": spark.createDataFrame(
            [(2020, 1000.0, 4.0, 2000.0, 100.0)],
            "input_year int, population double, per_capita_rate_daily_lbs double, lbs_per_tonne double, "
            "campus_tonnes double"),
        "solid_waste_composition": t("solid_waste_composition", [
            (2020, "town", "paper", 0.5), (2020, "town", "food_waste", 0.5),
            (2020, "campus", "paper", 1.0)]),
        "organic_waste_composition": t("organic_waste_composition", [(2020, "town", "food_waste", 0.5)]),
        "waste_method_composition": t("waste_method_composition", [
            (2020, "town", "landfill", 0.75), (2020, "town", "compost", 0.25),
            (2020, "town", "open_dump", 0.5), (2020, "campus", "landfill", 1.0)]),
        "recycling_composition": t("recycling_composition", [(2020, "town", "paper", 0.0)]),
        "supplied_disposal_methods": t("supplied_disposal_methods", [
            (2020, "college", "paper", "landfill", 0.5), (2020, "college", "glass", "landfill", 0.0)]),
        "wastewater_inputs": t("wastewater_inputs", [(2020, "town", 1e6), (2020, "town", 1e6)]),
        "wastewater_chemicals": t("wastewater_chemicals", [(2020, 200.0, 10.0), (2020, 100.0, 30.0)]),
        "regional_livestock": t("regional_livestock", [
            (2020, "cow", 100.0), (2020, "dairy_cattle", 40.0), (2020, "other_cattle", 20.0)]),
        "acreage_scaling": t("acreage_scaling", [(2020, 50.0, 200.0)]),
        "fertilization_pcts": t("fertilization_pcts", [(2020, 0.5, 100.0), (2020, 0.25, 50.0)]),
    }


def test_stationary_drops_unmatched_and_derives_losses(spark, tables):
    led = sectors.stationary_ledger(tables)
    got = rows(led, "activity", "input_year", "amount", "total_mtco2e", "gpc_ref", "scope")
    assert got == [
        ("dist_oil", 2020, 1000.0, 1000.0, "I.1.1", 1),           # household model 1000*0.25*4
        ("electricity", 2020, 100.0, 50.0, "I.2.2", 2),
        ("electricity", 2021, 8.0, 6.0, "I.2.2", 2),
        ("electricity_transmission", 2020, 12.5, 6.25, "I.2.3", 3),
        ("natural_gas", 2020, 40.0, 10.0, "I.2.1", 1),
        ("natural_gas_distribution", 2020, 10.0, 2.5, "I.8.1", 1),
        ("natural_gas_leak", 2020, 20.0, 5.0, "I.8.1", 1),
    ]  # "Unknown" maps to null and has no factor: dropped; 2021 has no loss row


def test_invariant_total_is_amount_times_factor(spark, tables):
    for r in sectors.stationary_ledger(tables).collect():
        assert r["total_mtco2e"] == r["amount"] * r["total_co2e_ef"]


def test_transportation_keeps_unmatched(spark, tables):
    led = sectors.transportation_ledger(tables)
    got = rows(led, "activity", "amount", "total_co2e_ef", "total_mtco2e")
    reg, irr = 8.5 / 12, 3.5 / 12
    fuel1 = 12.0 * (reg * 261 * 10 + reg * 52 * 4 + reg * 52 * 2 + 0.4 * (irr * 261 * 10 + irr * 52 * 4 + irr * 52 * 2)) / 4.0
    fuel2 = 6.0 * (reg * 261 * 5 + 0.4 * (irr * 261 * 5)) / 3.0
    assert got[0][:1] == ("diesel",) and got[0][2:] == (None, None)  # id has no factor: kept
    assert got[1][0] == "transit_bus" and got[1][1] == pytest.approx(fuel1 + fuel2)
    assert got[1][2:] == (None, None)  # null factor id


def test_waste_allocation_conserves_totals(spark, tables):
    led = sectors.waste_ledger(tables, entities=["town", "campus"], named_parts=["campus"],
                               residual_entity="town", years=[2020])
    got = {(r["entity"], r["activity"]): r for r in led.collect()}
    total = 1000.0 * 4.0 * 365 / 2000.0          # 730 tonnes
    town = total - 100.0                            # residual
    # landfill: (0.5 + 0.5) * 0.75 of town; compost: food 0.5 * 0.25; open_dump has no source
    assert got[("town", "landfill")]["amount"] == pytest.approx(town * 0.75)
    assert got[("town", "compost")]["amount"] == pytest.approx(town * 0.125)
    assert got[("town", "compost")]["total_mtco2e"] == 0.0  # zero factor
    assert got[("campus", "landfill")]["amount"] == pytest.approx(100.0)
    assert got[("campus", "landfill")]["scope"] == 2 and got[("town", "landfill")]["gpc_ref"] == "III.1.2"
    # supplied college rows have no tonnage column: amount is null; zero share dropped
    assert got[("college", "landfill")]["amount"] is None
    assert ("town", "open_dump") not in got and ("town", "recycle") not in got
    bod = got[("town", "wastewater_bod")]
    assert bod["amount"] == pytest.approx(2e6 * 3.79 * 20.0 / 1e6)
    assert bod["total_mtco2e"] == pytest.approx(bod["amount"] * 4.0)


def test_agriculture_downscale_fan_out_and_groups(spark, tables):
    led = sectors.agriculture_ledger(tables)
    got = {r["activity"]: r for r in led.collect()}
    assert got["cow_enteric_fermentation"]["amount"] == 25.0     # 100 * 50/200
    assert got["cow_manure"]["total_mtco2e"] == 12.5
    assert got["cattle_dung"]["amount"] == 15.0                  # (40 + 20) * 0.25
    assert got["cattle_dung_indirect"]["total_mtco2e"] == 3.75
    assert got["fertilization"]["amount"] == pytest.approx(50.0 * 0.375 * 75.0 * 0.4536)
    assert got["fertilization_indirect"]["total_co2e_ef"] is None
    assert got["dairy_cattle_manure"]["total_mtco2e"] is None    # kept, unmatched
    assert "sheep_goats" not in got and "other_dung" not in got


def test_inventory_schema_and_labels(spark, tables):
    led = sectors.inventory(tables, ["town", "campus"], ["campus"], "town", [2020])
    assert led.schema == S.LEDGER
    sup = {r["supercategory"] for r in led.collect()}
    assert sup == {"Stationary Energy", "Transportation", "waste", "agriculture_forestry_other_land_use"}
    assert {r["fiscal_year"] for r in led.collect()} == {"FY 2020", "FY 2021"}


def test_meter_ledger(spark, tables):
    export = spark.createDataFrame([
        (dt.datetime(2020, 3, 1), "Electric", 5000.0, "kWh", "Parking", "Public Works"),
        (dt.datetime(2020, 3, 1), "Gas", 10.0, "therm", "Hall", "Admin"),
        (dt.datetime(2019, 3, 1), "Gas", 10.0, "therm", "Hall", "Admin"),
        (dt.datetime(2020, 3, 1), "Steam", 1.0, "lb", "Hall", "Admin"),
    ], S.METER_EXPORT)
    led = sectors.meter_ledger(export, tables, [("facility", ["Parking"], "Parking")],
                               years=[2020], fuel_map={"Electric": "electricity", "Gas": "natural_gas"})
    got = rows(led, "activity", "use", "units", "total_mtco2e", "department", "fiscal_year")
    assert got == [
        ("electricity", 5.0, "MWh", 2.5, "Parking", "FY 2020"),
        ("electricity_transmission", 0.625, "MWh", 0.3125, "Parking", "FY 2020"),
        ("natural_gas", 10.0, "therm", 2.5, "Admin", "FY 2020"),
        ("natural_gas_distribution", 2.5, "therm", 0.625, "Admin", "FY 2020"),
        ("natural_gas_leak", 5.0, "therm", 1.25, "Admin", "FY 2020"),
        (None, 1.0, "lb", None, "Admin", "FY 2020"),
    ]


def test_reports(spark):
    led = spark.createDataFrame([
        ("A", "e1", 2016, 10.0, "FY 2016"), ("B", "e1", 2016, 30.0, "FY 2016"),
        ("A", "e1", 2025, 5.0, "FY 2025"), ("B", "e1", 2025, None, "FY 2025"),
        ("A", "e2", 2016, 4.0, "FY 2016"), ("A", "e2", 2025, 6.0, "FY 2025"),
    ], "supercategory string, entity string, input_year int, total_mtco2e double, fiscal_year string")
    bc = report.baseline_vs_current(led.where("entity = 'e1'"), 2016, 2025).collect()[0]
    assert (bc["baseline"], bc["current"], bc["change"]) == (40.0, 5.0, -0.875)
    bc2 = report.baseline_vs_current(led.where("entity = 'e1'"), 2025, 2016).collect()[0]
    assert bc2["baseline"] is None  # NA-propagating baseline
    ch = {(r["entity"], r["fiscal_year"]): r for r in report.change_vs_baseline(led, by=["entity"]).collect()}
    assert ch[("e1", "FY 2025")]["percent_change"] == -0.875
    assert ch[("e2", "FY 2025")]["percent_change_label"] == "50.0%"
    glob = {r["fiscal_year"]: r["percent_change"] for r in report.change_vs_baseline(led).collect()}
    assert glob == {"FY 2016": 0.0, "FY 2025": (11.0 - 44.0) / 44.0}
    share = {(r["fiscal_year"], r["supercategory"]): r for r in report.sector_share(led).collect()}
    assert share[("FY 2016", "A")]["pct"] == pytest.approx(14 / 44 * 100)
    assert share[("FY 2025", "A")]["pct"] is None  # a null in the year propagates
    s16 = [r["pct"] for (fy, _), r in share.items() if fy == "FY 2016"]
    assert sum(s16) == pytest.approx(100.0)


def test_full_run_writes_both_ledgers(spark, tables):
    from emberledger.plans.run import run_inventory
    from emberledger.sources.io import read_csv_table, scratch_dir

    base = scratch_dir(spark, "run-test")
    for name, df in tables.items():
        df.write.parquet(f"{base}/in/{name}.parquet")
    export = spark.createDataFrame([
        (dt.datetime(2020, 3, 1), "Electric", 5000.0, "kWh", "Parking", "Works")], S.METER_EXPORT)
    export.write.parquet(f"{base}/export")
    out = run_inventory(spark, f"{base}/in", f"{base}/out", ["town", "campus"], ["campus"], "town",
                        meter_export=f"{base}/export", department_rules=[("facility", ["Parking"], "Parking")],
                        waste_years=[2020], meter_years=[2020])
    led = read_csv_table(spark, out["inventory"], S.LEDGER)
    direct = sectors.inventory(tables, ["town", "campus"], ["campus"], "town", [2020])
    cols = ["supercategory", "activity", "entity", "input_year", "amount", "total_mtco2e", "fiscal_year"]
    assert rows(led, *cols) == rows(direct, *cols)
    assert led.where("total_mtco2e IS NULL").count() > 0  # NA token read back as null
    m = read_csv_table(spark, out["meters"], S.METER_LEDGER)
    assert m.count() == 2 and {r["department"] for r in m.collect()} == {"Parking"}
    assert {r["year"] for r in m.collect()} == {2020}

    from emberledger.plans.report_page import main as report_main

    report_main(["--ledger", out["inventory"], "--meters", out["meters"], "--out", f"{base}/report",
                 "--entity", "town", "--baseline", "2020", "--current", "2021"])
    bc = spark.read.option("header", True).option("inferSchema", True).csv(f"{base}/report/baseline_vs_current")
    r = bc.collect()[0]
    assert r["current"] == 6.0  # town 2021: electricity 8 MWh x 0.75
    fm = spark.read.option("header", True).option("multiLine", True).csv(f"{base}/report/fuel_mix").collect()
    assert len(fm) == 1 and fm[0]["account_fuel"] == "Electric"
    assert fm[0]["tooltip_text"].startswith("Fuel: Electric\nEmissions: ") and fm[0]["tooltip_text"].endswith(" MTCO2e\nShare: 100%")


def test_run_cli(spark, tables, capsys):
    from emberledger.plans.run import main
    from emberledger.sources.io import scratch_dir

    base = scratch_dir(spark, "cli-test")
    for name, df in tables.items():
        df.write.parquet(f"{base}/in/{name}.parquet")
    spark.createDataFrame([(dt.datetime(2020, 3, 1), "Electric", 5000.0, "kWh", "Parking", "Works")],
                          S.METER_EXPORT).write.parquet(f"{base}/export")
    main(["--tables", f"{base}/in", "--out", f"{base}/out", "--waste-entities", "town", "campus",
          "--waste-named-parts", "campus", "--waste-residual", "town", "--waste-years", "2020",
          "--out-format", "parquet", "--meter-export", f"{base}/export", "--meter-years", "2020",
          "--department-rule", "facility", "Parking", "Lots"])
    assert "inventory" in capsys.readouterr().out
    assert {r["department"] for r in spark.read.parquet(f"{base}/out/meters").collect()} == {"Lots"}
    assert spark.read.parquet(f"{base}/out/inventory").count() == sectors.inventory(
        tables, ["town", "campus"], ["campus"], "town", [2020]).count()


def test_full_run_from_csv_tables(spark, tables):
    from emberledger.plans.run import run_inventory
    from emberledger.sources.io import scratch_dir, write_table

    base = scratch_dir(spark, "csv-run")
    for name, df in tables.items():
        write_table(df, f"{base}/in/{name}.csv", "csv")
    out = run_inventory(spark, f"{base}/in", f"{base}/out", ["town", "campus"], ["campus"], "town",
                        fmt="csv", out_fmt="parquet", waste_years=[2020])
    got = spark.read.parquet(out["inventory"])
    direct = sectors.inventory(tables, ["town", "campus"], ["campus"], "town", [2020])
    cols = ["supercategory", "activity", "entity", "input_year", "amount", "total_mtco2e"]
    assert rows(got, *cols) == rows(direct, *cols)


def test_transit_activity_of_another_key_table(spark, tables):
    """A key table that names the transit rows otherwise is matched by a
    parameter of the run."""
    from emberledger import constants as K

    args = (["town", "campus"], ["campus"], "town", [2020])
    key = tables["activity_emissions_key"]
    year = tables["transit_model_inputs"].select("input_year").first()[0]
    fid = key.where("emissions_factor IS NOT NULL").join(tables["emissions_factors"], "emissions_factor").first()["emissions_factor"]
    t = {**tables, "activity_emissions_key": key.where(key.activity != "transit_bus").unionByName(
        spark.createDataFrame([("city_bus", year, fid)], "activity string, input_year int, emissions_factor string"))}
    transit = {"labels": {**K.TRANSIT_FUEL_LABELS, "activity": "city_bus"}, "na_rm": True}
    rows_ = sectors.inventory(t, *args, transit=transit).where("activity = 'city_bus'").collect()
    assert any(r["input_year"] == year and r["total_mtco2e"] is not None for r in rows_)
    old = sectors.inventory(t, *args).where("activity = 'transit_bus'").collect()
    assert old and all(r["total_mtco2e"] is None for r in old)
