"""Sources and sinks: named tables (S1), CSV with the ``NA`` token (S2),
literal tables (S3) and ledger writers (K1).

Scratch output goes under the session's ``spark.checkpoint.dir`` -- the
shared folder a cluster names for this -- never a machine-local temp dir.
"""

from __future__ import annotations

import uuid
import weakref
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from emberledger.functions.semantics import NA_TOKEN
from emberledger.operators.relational import mark_bounded
from emberledger.session import ensure_checkpoint_dir
from emberledger.sources import schemas
from emberledger.sources.typing import typed
from emberledger.sources.workbook import read_sheet


_schemas: "weakref.WeakKeyDictionary[SparkSession, dict[str, T.StructType]]" = weakref.WeakKeyDictionary()


def read_table(
    spark: SparkSession,
    root: str,
    name: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    reuse: bool = False,
) -> DataFrame:
    """Load one named table ``<root>/<name>.<fmt>`` (S1), or, as ``xlsx``,
    the sheet ``name`` of the workbook (or workbooks) at ``root``.

    With a schema every column of it must be in the file (by name; others
    are ignored) and has its type, else the read raises.  ``reuse`` keeps the
    schema that a path had in this session, so that its footers are read
    once; files are listed anew on every read.
    """
    schema = schema if schema is not None else schemas.TABLES.get(name)
    path = f"{root.rstrip('/')}/{name}.{fmt}"
    if fmt == "csv":
        return read_csv_table(spark, path, schema)
    if fmt == "xlsx":
        return read_sheet(spark, root, name, schema)
    known = _schemas.setdefault(spark, {}) if reuse else {}
    if path in known:
        return spark.read.schema(known[path]).format(fmt).load(path)
    df = spark.read.format(fmt).load(path)
    if schema is not None:
        df = typed(df, schema, path)
    else:
        known[path] = df.schema
    return df


def load_tables(
    spark: SparkSession, root: str, names: Iterable[str], fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Load every named table once; sectors share the same DataFrames."""
    return {n: read_table(spark, root, n, fmt=fmt) for n in names}


def read_csv_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None, keep_others: bool = False
) -> DataFrame:
    """Read a headed CSV where empty cells and ``NA`` are null.

    With a schema, columns are taken by header name -- any order, others
    ignored, or kept as strings with ``keep_others`` -- and cast to the schema's types with ANSI casts, so a
    malformed value fails the read instead of turning into a silent null.
    Without one, types are inferred (an extra pass over the data).
    """
    reader = (
        spark.read.option("header", True)
        .option("nullValue", NA_TOKEN)
        .option("emptyValue", None)
        .option("mode", "FAILFAST")
    )
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if isinstance(schema, str):  # DDL such as "a int, b string"
        schema = spark.createDataFrame([], schema).schema
    # strings; partition columns keep their inferred types
    return typed(reader.csv(path), schema, path, keep_others)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    replace_partitions: bool = False,
) -> None:
    """Write a ledger (K1). CSV gets a header and the ``NA`` null token.

    Partitioning by ``input_year`` lets report queries prune whole years.
    With ``replace_partitions`` an overwrite replaces only the partitions
    present in ``df`` (e.g. re-running one year), leaving the others.  The
    write goes through Spark's commit protocol, so a lost executor only
    re-runs its tasks.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if replace_partitions:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", True).option("nullValue", NA_TOKEN)
    writer.format(fmt).save(path)


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An account-level export: the known columns typed, all others kept."""
    if path.endswith(".csv"):
        return read_csv_table(spark, path, schema, keep_others=True)
    return typed(spark.read.parquet(path), schema, path, keep_others=True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder in the session's checkpoint folder, removed when the
    session ends (see ``session.ensure_checkpoint_dir``)."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/emberledger/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint in
    the session's checkpoint folder; a lost executor does not lose it.  Runs
    a job, so no registered query needs it to be built."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def literal_table(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str
) -> DataFrame:
    """A small literal table (S3), e.g. a mapping or a value domain.

    Its size is the length of ``rows``, known here, so it is marked as a
    bounded dimension for ``lookup_join``.
    """
    return mark_bounded(spark.createDataFrame(list(rows), schema), len(rows))
