"""The incremental meter ledger equals the batch ledger on the same files."""

import datetime as dt

from checks import rows
from emberledger.operators import meters
from emberledger.sources.io import scratch_dir
from emberledger.sources.schemas import METER_EXPORT
from emberledger.streaming.meters import meter_ledger_stream, read_meter_stream, start_meter_ledger


def test_stream_matches_batch(spark):
    base = scratch_dir(spark, "stream-test")
    export = spark.createDataFrame([
        (dt.datetime(2020, 3, 1), "Electric", 5000.0, "kWh", "Parking", "Works"),
        (dt.datetime(2020, 4, 1), "Gas", 10.0, "therm", "Hall", "Admin"),
        (dt.datetime(2019, 4, 1), "Gas", 3.0, "therm", "Hall", "Admin"),
    ], METER_EXPORT)
    export.write.option("header", True).csv(f"{base}/in")
    factors = spark.createDataFrame(
        [("electricity", 2020, 0.5), ("natural_gas", 2020, 0.25), ("electricity_transmission", 2020, 1.0)],
        "activity string, input_year int, total_co2e_ef double")
    loss = spark.createDataFrame([("electricity", "transmission", 0.125, 2020)],
                                 "fuel_type string, type string, loss_factor double, input_year int")
    rules = [("facility", ["Parking"], "Parking")]
    stream = meter_ledger_stream(read_meter_stream(spark, f"{base}/in"), loss, factors, rules, years=[2020])
    q = start_meter_ledger(stream, f"{base}/out", f"{base}/chk", available_now=True)
    q.awaitTermination(120)
    got = spark.read.parquet(f"{base}/out")
    batch = meters.meter_emissions(meters.normalize_meter_readings(export, years=[2020]), loss, factors)
    cols = ["activity", "use", "units", "total_mtco2e", "year"]
    assert rows(got, *cols) == rows(batch, *cols)
    assert rows(got, "activity", "department") == [
        ("electricity", "Parking"), ("electricity_transmission", "Parking"), ("natural_gas", "Admin")]


def test_restart_from_checkpoint_processes_each_file_once(spark):
    base = scratch_dir(spark, "stream-restart")
    factors = spark.createDataFrame([("natural_gas", 2020, 0.5)],
                                    "activity string, input_year int, total_co2e_ef double")
    loss = spark.createDataFrame([], "fuel_type string, type string, loss_factor double, input_year int")

    def land(name, n):
        rows_ = [(dt.datetime(2020, 1, 1 + i), "Gas", float(i + 1), "therm", f"F{name}", "A") for i in range(n)]
        spark.createDataFrame(rows_, METER_EXPORT).write.option("header", True).csv(f"{base}/in/{name}")

    def run_once():
        stream = meter_ledger_stream(read_meter_stream(spark, f"{base}/in/*"), loss, factors, years=[2020])
        q = start_meter_ledger(stream, f"{base}/out", f"{base}/chk", available_now=True)
        q.awaitTermination(120)

    land("a", 3)
    run_once()
    land("b", 2)
    run_once()  # restarts from the checkpoint: only the new file is read
    got = spark.read.parquet(f"{base}/out")
    assert got.count() == 5
    assert sorted(r["use"] for r in got.collect()) == [1.0, 1.0, 2.0, 2.0, 3.0]
    assert {r["facility"] for r in got.collect()} == {"Fa", "Fb"}
