"""Publishing ledgers as versions (K1).

A run that overwrites its ledgers in place leaves a mixture, or nothing, if it
fails half-way, and a report may read one ledger before and another after it. Here
a run writes all its ledgers into a folder of its own and then replaces one
small file, the manifest, by an atomic rename. Readers follow the manifest:
they see the old version or the new one, of all ledgers, never parts of either.

    root/_current               the version readers use
    root/versions/<version>/    its ledgers, never changed once published
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from emberledger.sources.io import read_csv_table, write_table

MANIFEST, VERSIONS = "_current", "versions"


class Root:
    """The files of a folder, in any store that Spark's file systems reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path(self.root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def under(self, *names: str) -> str:
        return "/".join([self.root, *names])

    def read(self, name: str) -> str | None:
        path = self.path(self.under(name))
        if not self.fs.exists(path):
            return None
        stream = self.fs.open(path)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write a file under another name, then move it over the old one."""
        new = self.under(f".{name}-{uuid.uuid4().hex}")
        stream = self.fs.create(self.path(new), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        overwrite = self.jvm.java.lang.reflect.Array.newInstance(
            self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1
        )
        overwrite[0] = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        qualified = [self.path(x).makeQualified(self.fs.getUri(), self.fs.getWorkingDirectory()) for x in (new, self.under(name))]
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        context.rename(*qualified, overwrite)

    def folders(self, name: str) -> list[str]:
        path = self.path(self.under(name))
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def delete(self, *names: str) -> None:
        self.fs.delete(self.path(self.under(*names)), True)


def _manifest(root: Root) -> dict | None:
    text = root.read(MANIFEST)
    return json.loads(text) if text else None


def publish(
    spark: SparkSession, root: str, ledgers: Mapping[str, tuple[DataFrame, Sequence[str]]], fmt: str = "parquet"
) -> str:
    """Write ``ledgers`` (name -> DataFrame and partition columns) as a new
    version and make it the current one; return its name.

    If any write fails, the error is raised and readers keep the version they
    had; what was written of the new one is removed. Of two runs that publish at once
    each has its own folder, and the last to finish is current.
    """
    at = Root(spark, root)
    old = _manifest(at)
    version = f"{(old['number'] if old else 0) + 1:08d}-{uuid.uuid4().hex[:8]}"
    try:
        for name, (df, partition_by) in ledgers.items():
            write_table(df, at.under(VERSIONS, version, name), fmt, partition_by=partition_by, mode="error")
    except BaseException:
        at.delete(VERSIONS, version)
        raise
    at.replace(MANIFEST, json.dumps({"number": int(version.split("-")[0]), "version": version, "format": fmt, "ledgers": list(ledgers)}))
    return version


class Published:
    """The ledgers of one version, fixed when it is opened: later versions
    do not show, so all reads of a report agree."""

    def __init__(self, spark: SparkSession, root: str, version: str | None = None):
        self._at = Root(spark, root)
        manifest = _manifest(self._at)
        if manifest is None:
            raise FileNotFoundError(f"nothing is published in {root}")
        self.version, self.format = version or manifest["version"], manifest["format"]

    def path(self, name: str) -> str:
        return self._at.under(VERSIONS, self.version, name)

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        if self.format == "csv":
            return read_csv_table(self._at.spark, self.path(name), schema)
        reader = self._at.spark.read
        return (reader.schema(schema) if schema is not None else reader).format(self.format).load(self.path(name))


def retire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all versions but the current one and the ``keep`` before it;
    return what was removed. Versions that come after the current one are
    being written and stay."""
    at = Root(spark, root)
    manifest = _manifest(at)
    if manifest is None:
        return []
    before = [v for v in at.folders(VERSIONS) if int(v.split("-")[0]) < manifest["number"]]
    gone = before[: max(0, len(before) - keep)]
    for version in gone:
        at.delete(VERSIONS, version)
    return gone
