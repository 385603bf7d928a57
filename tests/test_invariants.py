"""Invariants from the test strategy: keep policy conserves rows, lookups
are unique on their keys, allocation conserves totals, losses are 1 -> N."""

from pyspark.sql import functions as F

from checks import rows
from emberledger.operators import allocation, factors
from emberledger.plans import acceptance as A
from emberledger.plans import bindings as B

SF = "/root/testdata/sf0.001"


def test_binding_lookups_are_unique(spark):
    assert factors.duplicate_keys(A.key_table(spark), ["activity", "input_year"]).count() == 0
    assert factors.duplicate_keys(A.factor_table(spark), ["emissions_factor"]).count() == 0
    assert factors.duplicate_keys(A.loss_table(spark), ["fuel_type", "type", "input_year"]).count() == 0


def test_duplicate_keys_found(spark):
    dim = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, y int")
    assert rows(factors.duplicate_keys(dim, ["k", "y"])) == [("a", 1, 2)]


def test_keep_policy_conserves_rows_and_amount(spark):
    a = A.act(spark, SF).select("activity", "input_year", "amount")
    e = factors.apply_factors(a, A.resolved(spark), factors.KEEP)
    before = a.agg(F.count(F.lit(1)), F.sum("amount")).collect()[0]
    after = e.agg(F.count(F.lit(1)), F.sum("amount")).collect()[0]
    assert tuple(before) == tuple(after)
    dropped = factors.apply_factors(a, A.resolved(spark), factors.DROP)
    assert dropped.count() == e.where(F.col("total_mtco2e").isNotNull()).count()


def test_losses_one_to_many(spark):
    a = A.act(spark, SF).select("activity", "input_year", "amount")
    losses = factors.derive_losses(a, A.loss_table(spark), B.LOSS_LABELS)
    n_econ = a.where("activity = 'ECONOMY' AND input_year <= 2000").count()
    n_large = a.where("activity = 'LARGE' AND input_year <= 2000 AND input_year <> 1998").count()
    assert losses.count() == 2 * n_econ + n_large  # two loss types for ECONOMY


def test_allocation_conserves_totals(spark):
    # compositions summing to 1 per (year, entity), every method with a source
    method = spark.createDataFrame(
        [(2020, "e", "landfill", 0.25), (2020, "e", "incineration", 0.25), (2020, "e", "recycle", 0.5)],
        "input_year int, entity string, disposal_method string, disposal_method_pct double")
    total = spark.createDataFrame([(2020, "e", "paper", 0.5), (2020, "e", "glass", 0.5)],
                                  "input_year int, entity string, waste_type string, total_waste_pct double")
    recyc = spark.createDataFrame([(2020, "e", "paper", 0.75), (2020, "e", "glass", 0.25)],
                                  "input_year int, entity string, waste_type string, total_recycling_pct double")
    m = allocation.allocation_matrix(method, {"total": total, "recycling": recyc}, years=None,
                                     entities=None, types=None, methods=None)
    assert abs(m.agg(F.sum("percentage")).collect()[0][0] - 1.0) < 1e-12
    totals = spark.createDataFrame([(2020, "e", 800.0)], "input_year int, entity string, total_tonnes double")
    ef = spark.createDataFrame([("landfill", 2020, 1.0)], "activity string, input_year int, total_co2e_ef double")
    out = allocation.allocate_and_emit(m, totals, ef)
    assert out.agg(F.sum("amount")).collect()[0][0] == 800.0
    assert rows(out, "activity", "amount", "total_mtco2e") == [
        ("incineration", 200.0, None), ("landfill", 200.0, 200.0), ("recycle", 400.0, None)]


def test_with_losses_equals_union_form(spark):
    recs = spark.createDataFrame([
        ("electricity", 2020, 10.0, "I.2.2", 2), ("electricity", 2021, 4.0, "I.2.2", 2),
        ("natural_gas", 2020, 8.0, None, 1), (None, 2020, 1.0, "x", 1), ("electricity", None, 2.0, "y", 3),
        ("oil", 2020, 5.0, "I.1", 1)],
        "activity string, input_year int, amount double, gpc_ref string, scope int")
    loss = spark.createDataFrame([
        ("electricity", "transmission", 0.5, 2020), ("natural_gas", "distribution", 0.25, 2020),
        ("natural_gas", "leak", 0.125, 2020), ("oil", None, 0.5, 2020)],
        "fuel_type string, type string, loss_factor double, input_year int")
    labels = {"electricity": {"gpc_ref": "I.2.3", "scope": 3}, "natural_gas": {"gpc_ref": "I.8.1"}}
    one_pass = factors.with_losses(recs, loss, labels)
    union = recs.unionByName(factors.derive_losses(recs, loss, labels), allowMissingColumns=True)
    cols = ["activity", "input_year", "amount", "gpc_ref", "scope"]
    assert rows(one_pass, *cols) == rows(union, *cols)
    assert one_pass.count() == 6 + 4  # the oil loss row has a null type -> null activity (N7)


def test_meter_normalization_with_date_column(spark):
    import datetime as dt

    from emberledger.operators import meters

    export = spark.createDataFrame([
        (dt.date(2022, 12, 31), "Electric", 2000.0, "kWh"), (dt.date(2023, 1, 1), "Electric", 1.0, "kWh"),
        (dt.date(2016, 1, 1), "Oil", 3.0, "gal"), (None, "Gas", 4.0, "therm")],
        "usage_end date, account_fuel string, use double, default_units string")
    out = meters.normalize_meter_readings(export, years=[2016, 2022])
    assert rows(out, "year", "activity", "use", "units") == [
        (2016, "dist_oil", 3.0, "gal"), (2022, "electricity", 2.0, "MWh")]
