"""Incremental meter ledger.

Meter exports land as files over time.  The same normalization and
emission operators run on ``readStream`` input: factor, loss and mapping
lookups are static DataFrames joined to the stream (stream-static joins,
broadcast when bounded), and each micro-batch appends its ledger rows.
No operator keeps state, so no watermark is needed; the checkpoint under
the session's ``spark.checkpoint.dir`` makes the job restartable after a
lost executor or driver.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from emberledger.functions.semantics import NA_TOKEN
from emberledger.operators import meters, records
from emberledger.operators.inventory import fiscal_year_label
from emberledger.sources.io import scratch_dir
from emberledger.sources.schemas import METER_EXPORT


def read_meter_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    max_files_per_trigger: int | None = None,
    schema: StructType = METER_EXPORT,
) -> DataFrame:
    """Stream of landed files with a fixed schema (the meter export's by
    default).  ``path`` is a directory that receives files; a single local
    file is streamed through its directory with a name filter."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("nullValue", NA_TOKEN)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    local = path.removeprefix("file:")
    if "://" not in local and os.path.isfile(local):
        reader = reader.option("pathGlobFilter", os.path.basename(local))
        path = os.path.dirname(local)
    return reader.load(path)


def meter_ledger_stream(
    readings: DataFrame,
    loss_factors: DataFrame,
    factors: DataFrame,
    department_rules: Sequence[tuple[str, Sequence[object], object]] = (),
    **normalize,
) -> DataFrame:
    """The meter ledger (D16, D17, D18) as a streaming DataFrame."""
    norm = meters.normalize_meter_readings(readings, **normalize)
    out = meters.meter_emissions(norm, loss_factors, factors)
    out = out.withColumn("fiscal_year", fiscal_year_label("year"))
    return records.override_attributes(out, "department", department_rules)


def start_meter_ledger(
    ledger: DataFrame,
    out_path: str,
    checkpoint: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append ledger rows as Parquet partitioned by year."""
    spark = ledger.sparkSession
    checkpoint = checkpoint or scratch_dir(spark, "meter-ledger-checkpoint")
    writer = (
        ledger.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("year")
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(out_path)
