"""Versions of ledgers: failed runs, readers during a run, retention."""

import pytest
from pyspark.sql import functions as F

from checks import rows
from emberledger.sources.io import scratch_dir
from emberledger.sources.publish import MANIFEST, Published, Root, publish, retire


def ledgers(spark, n, fail=False):
    inventory = spark.range(n).select(F.col("id").cast("int").alias("input_year"), (F.col("id") / 4).alias("total_mtco2e"))
    meters = spark.range(2 * n, numPartitions=4).select("id")
    if fail:  # the second ledger breaks after some of its files are written
        meters = meters.select(F.when(F.col("id") > 5, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    return {"inventory": (inventory, ["input_year"]), "meters": (meters, [])}


def test_a_failed_run_leaves_the_old_version(spark):
    root = scratch_dir(spark, "publish")
    with pytest.raises(FileNotFoundError):
        Published(spark, root)
    first = publish(spark, root, ledgers(spark, 3))
    with pytest.raises(Exception, match="lost"):
        publish(spark, root, ledgers(spark, 5, fail=True))
    now = Published(spark, root)
    assert now.version == first and Root(spark, root).folders("versions") == [first]
    assert now.read("inventory").count() == 3 and now.read("meters").count() == 6


def test_a_run_killed_before_the_switch(spark, monkeypatch):
    """The ledgers are written but the manifest is not: readers see the old
    version, and the next run publishes beside what was left."""
    root = scratch_dir(spark, "publish")
    first = publish(spark, root, ledgers(spark, 2))

    class Killed(BaseException):
        pass

    def kill(*_):
        raise Killed

    with monkeypatch.context() as m, pytest.raises(Killed):
        m.setattr(Root, "replace", kill)
        publish(spark, root, ledgers(spark, 9))
    assert Published(spark, root).version == first and len(Root(spark, root).folders("versions")) == 2
    publish(spark, root, ledgers(spark, 4))
    assert Published(spark, root).read("meters").count() == 8


def test_an_open_reader_keeps_its_version(spark):
    root = scratch_dir(spark, "publish")
    publish(spark, root, ledgers(spark, 2))
    reader = Published(spark, root)
    publish(spark, root, ledgers(spark, 7))
    assert reader.read("inventory").count() == 2 and reader.read("meters").count() == 4
    assert Published(spark, root).read("inventory").count() == 7
    assert rows(reader.read("inventory", spark.createDataFrame([], "total_mtco2e double, input_year int").schema)) == [(0.0, 0), (0.25, 1)]


def test_csv_and_retention(spark):
    root = scratch_dir(spark, "publish")
    versions = [publish(spark, root, ledgers(spark, n), fmt="csv") for n in (1, 2, 3, 4)]
    old = Published(spark, root, versions[1])
    assert old.read("inventory", spark.createDataFrame([], "input_year int, total_mtco2e double").schema).count() == 2
    assert retire(spark, root, keep=1) == versions[:2]
    assert Root(spark, root).folders("versions") == versions[2:]
    assert Published(spark, root).read("meters", spark.createDataFrame([], "id long").schema).count() == 8
    assert retire(spark, scratch_dir(spark, "none")) == []
    names = Root(spark, root).folders("")
    assert [n for n in names if not n.endswith(".crc")] == [MANIFEST, "versions"]
