"""CSV tables with malformed records: every other record is read."""

import datetime as dt
import os
import tempfile

import pytest

from checks import rows
from emberledger.sources.rejects import read_csv_with_rejects

SCHEMA = "use double, usage_end date, facility string, meter int"


def folder(**files):
    base = tempfile.mkdtemp(prefix="rejects-")
    for name, text in files.items():
        with open(os.path.join(base, f"{name}.csv"), "w") as f:
            f.write(text)
    return base


def test_rows_and_rejects(spark):
    path = folder(
        a="facility,use,usage_end,meter,note\n"
        "Hall,1.5,2020-01-31,7,ok\n"
        "Hall,lots,2020-02-29,7,x\n"
        "NA,,,,\n"
        "Hall,2,2020-13-01,7.5,x\n"
        "Hall,3\n"
        '"Hall, old",4,2020-03-31,8,"a ""quoted"" note",extra\n'
        "Pool,5e1,2020-04-30,9,\n",
        b="facility,use,usage_end,meter,note\nHall,?,NA,1,\n",
    )
    good, bad = read_csv_with_rejects(spark, path, SCHEMA)
    assert rows(good) == sorted([
        (1.5, dt.date(2020, 1, 31), "Hall", 7), (None, None, None, None), (50.0, dt.date(2020, 4, 30), "Pool", 9)], key=repr)
    got = sorted((os.path.basename(r.file), r.row, r.reason) for r in bad.collect())
    assert got == [
        ("a.csv", 2, "use: 'lots' is no double"),
        ("a.csv", 4, "usage_end: '2020-13-01' is no date; meter: '7.5' is no int"),
        ("a.csv", 5, "wrong number of cells"),
        ("a.csv", 6, "wrong number of cells"),
        ("b.csv", 1, "use: '?' is no double"),
    ]
    records = {r.row: (r.record, r.cells) for r in bad.where("file LIKE '%a.csv'").collect()}
    assert records[5][0] == "Hall,3" and records[2][0] is None and records[2][1]["use"] == "lots"


def test_rows_of_split_files(spark):
    """Row numbers count over the splits that a file is read in."""
    lines = [f"{i},{'bad' if i % 97 == 0 else i}" for i in range(1, 4001)]
    path = folder(big="id,v\n" + "\n".join(lines) + "\n")
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in old:
            spark.conf.set(k, "1500")
        good, bad = read_csv_with_rejects(spark, path, "id int, v double")
        assert good.rdd.getNumPartitions() > 8
        assert good.count() == 4000 - 4000 // 97
        assert sorted((r.row, r.cells["id"]) for r in bad.collect()) == [(i, str(i)) for i in range(97, 4001, 97)]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_required_and_missing_columns(spark):
    path = folder(a="id,v\n1,\n2,3\n")
    good, bad = read_csv_with_rejects(spark, path, "id int, v int", required=["v"])
    assert rows(good) == [(2, 3)] and [(r.row, r.reason) for r in bad.collect()] == [(1, "v: missing")]
    with pytest.raises(ValueError, match="lacks columns"):
        read_csv_with_rejects(spark, path, "id int, w int")
    good, bad = read_csv_with_rejects(spark, folder(a="id,v\n"), "v int")
    assert good.collect() == [] and bad.collect() == []
