"""CSV tables with a reject channel.

``read_csv_table`` fails on the first value that does not fit its type. Where a
large export must be read all the same, ``read_csv_with_rejects`` gives two
DataFrames: the typed rows of every record that fits, and a row for every
record that does not, saying where it stands and why.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberledger.functions.semantics import NA_TOKEN

REJECT_SCHEMA = "file string, row long, reason string, cells map<string,string>, record string"


def read_csv_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType | str, required: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Typed rows and rejects of headed CSV files.

    Columns are taken by header name, empty cells and ``NA`` are null, as in
    ``read_csv_table``. A record is rejected if a cell does not cast to its
    column's type, if it has more or fewer cells than the header, or if a
    ``required`` cell is null. Rejects hold the ``file``, the ``row`` (records
    of the file counted from 1 after the header), the ``reason``, the declared
    cells as text, and for a wrong number of cells the ``record`` itself.

    Files are still split: a record's row is its place in its split and the
    sum over the splits before, so only a number per split is gathered. Rejects
    are found in the tasks that read them; reading only the rows costs no count.
    """
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    base = spark.read.option("header", True).option("nullValue", NA_TOKEN).option("emptyValue", None)
    header = base.csv(path).schema
    lacks = [f.name for f in schema.fields if f.name not in header.names]
    if lacks:
        raise ValueError(f"{path} lacks columns {lacks}")
    broken = "_broken"
    while broken in header.names:
        broken += "_"
    # partition columns of the path are not in the files
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in header.fields] + [T.StructField(broken, T.StringType())])
    raw = (
        base.schema(text)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", broken)
        .option("enforceSchema", False)
        .option("columnPruning", False)  # a pruned parser does not count the cells
        .csv(path)
    )
    cell = {f.name: F.col(f"`{f.name}`") for f in schema.fields}
    bad = {
        f.name: cell[f.name].isNotNull() & cell[f.name].try_cast(f.dataType).isNull()
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    }
    missing = {n: cell[n].isNull() for n in required or []}
    reason = F.concat_ws(
        "; ",
        F.when(F.col(f"`{broken}`").isNotNull(), F.lit("wrong number of cells")),
        *[F.when(b, F.concat(F.lit(f"{n}: '"), cell[n], F.lit(f"' is no {schema[n].dataType.simpleString()}"))) for n, b in bad.items()],
        *[F.when(m, F.lit(f"{n}: missing")) for n, m in missing.items()],
    )
    typed = [cell[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields]
    rows = raw.withColumn("__reason", reason).where("__reason = ''").select(*typed)

    placed = raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__split"),
        F.monotonically_increasing_id().alias("__n"), reason.alias("reason"),
        F.create_map(*[x for n, c in cell.items() for x in (F.lit(n), c)]).alias("cells"), F.col(f"`{broken}`").alias("record"),
    )
    splits = placed.groupBy("file", "__split").agg(F.min("__n").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(Window.partitionBy("file").orderBy("__split").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.withColumn("__before", F.coalesce(before, F.lit(0))).drop("__rows")
    rejects = placed.where("reason <> ''").join(splits, ["file", "__split"])
    row = F.col("__before") + F.col("__n") - F.col("__first") + 1
    return rows, rejects.select("file", row.alias("row"), "reason", "cells", "record")
