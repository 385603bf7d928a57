"""Sources and sinks: CSV with the NA token, partitioned writes, table
reuse, scratch folders under the checkpoint directory, literal domains."""

import pytest

from checks import rows
from emberledger.operators import allocation
from emberledger.operators.relational import MAX_ROWS_CONF, crossing
from emberledger.sources import io
from emberledger.sources.schemas import LEDGER, conform


def test_scratch_dir_under_checkpoint_dir(spark):
    a, b = io.scratch_dir(spark, "x"), io.scratch_dir(spark, "x")
    base = spark.sparkContext.getCheckpointDir()
    assert a.startswith(base.rstrip("/")) and a != b


def test_csv_roundtrip_with_na_token(spark):
    df = conform(spark.createDataFrame(
        [("waste", None, 3, "landfill", 2.5, 2020), ("waste", "s", None, None, None, 2021)],
        "supercategory string, subcategory string, scope int, activity string, amount double, input_year int"))
    path = io.scratch_dir(spark, "csv")
    io.write_table(df, path, "csv", partition_by=["input_year"])
    raw = spark.read.text(f"{path}/input_year=2021").collect()
    assert any(",NA," in r.value or r.value.endswith(",NA") for r in raw)
    back = io.read_csv_table(spark, path, LEDGER)
    assert rows(back, "activity", "scope", "amount", "input_year") == rows(df, "activity", "scope", "amount", "input_year")


def test_read_table_sees_new_files(spark):
    root = io.scratch_dir(spark, "reuse")
    spark.range(5).write.parquet(f"{root}/t.parquet")
    assert io.read_table(spark, root, "t", reuse=True).count() == 5
    spark.range(5).write.mode("append").parquet(f"{root}/t.parquet")
    assert io.read_table(spark, root, "t", reuse=True).count() == 10


def test_parquet_without_a_column_raises(spark):
    root = io.scratch_dir(spark, "columns")
    spark.createDataFrame([(2020, 1.0, 2.0)], "input_year int, town double, region double").write.parquet(f"{root}/acreage_scaling.parquet")
    with pytest.raises(ValueError, match="local_acreage"):
        io.read_table(spark, root, "acreage_scaling")


def test_export_keeps_every_column(spark):
    from emberledger.sources.schemas import METER_EXPORT

    for fmt in ("csv", "parquet"):
        path = io.scratch_dir(spark, "export") + f"/e.{fmt}"
        row = "'2022-01-05 00:00:00' AS usage_end, 'Gas' AS account_fuel, '2.5' AS use, 'therm' AS default_units, 'a' AS facility, 'b' AS department, '77' AS account_number"
        getattr(spark.sql(f"SELECT {row}").write.option("header", True) if fmt == "csv" else spark.sql(f"SELECT {row}").write, fmt)(path)
        got = io.read_export(spark, path, METER_EXPORT)
        assert "account_number" in got.columns
        assert [(r.use, r.account_number) for r in got.collect()] == [(2.5, "77")]


def test_crossing_is_sorted_distinct_and_unbounded(spark):
    g = crossing(spark, "y int, m string", y=[2022, 2016, 2016], m=["b", "a"])
    assert [tuple(r) for r in g.collect()] == [(2016, "a"), (2016, "b"), (2022, "a"), (2022, "b")]
    spark.conf.set(MAX_ROWS_CONF, "3")
    try:
        assert crossing(spark, "y int, m int", y=range(20), m=range(30)).count() == 600
        assert crossing(spark, "y int, m int", y=[], m=[1]).count() == 0
    finally:
        spark.conf.unset(MAX_ROWS_CONF)


def test_cluster_needs_a_checkpoint_folder():
    from emberledger.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda k, d=None: d)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_supplied_shares_without_type_column(spark):
    method = spark.createDataFrame([(2020, "e", "landfill", 1.0)],
                                   "input_year int, entity string, disposal_method string, disposal_method_pct double")
    total = spark.createDataFrame([(2020, "e", "paper", 1.0)],
                                  "input_year int, entity string, waste_type string, total_waste_pct double")
    supplied = spark.createDataFrame([(2020, "u", "landfill", 0.5)],
                                     "input_year int, entity string, disposal_method string, percentage double")
    m = allocation.allocation_matrix(method, {"total": total}, years=None, types=None, methods=None,
                                     supplied=supplied)
    assert rows(m) == [(2020, "e", "paper", "landfill", 1.0), (2020, "u", None, "landfill", 0.5)]


def test_replace_partitions_keeps_other_years(spark):
    path = io.scratch_dir(spark, "dyn")
    first = spark.createDataFrame([(2020, 1.0), (2021, 2.0)], "input_year int, amount double")
    io.write_table(first, path, "parquet", partition_by=["input_year"])
    again = spark.createDataFrame([(2021, 5.0)], "input_year int, amount double")
    io.write_table(again, path, "parquet", partition_by=["input_year"], replace_partitions=True)
    assert rows(spark.read.parquet(path), "input_year", "amount") == [(2020, 1.0), (2021, 5.0)]


def test_csv_columns_by_header_name(spark):
    from pyspark.errors import AnalysisException  # noqa: F401

    path = io.scratch_dir(spark, "csv-order")
    spark.createDataFrame([("x", "5", "2020"), ("NA", "7", "2021")], "extra string, amount string, input_year string") \
        .write.option("header", True).csv(path)
    got = io.read_csv_table(spark, path, "input_year int, amount double")
    assert got.columns == ["input_year", "amount"] and rows(got) == [(2020, 5.0), (2021, 7.0)]
    with pytest.raises(ValueError):
        io.read_csv_table(spark, path, "input_year int, missing double")
