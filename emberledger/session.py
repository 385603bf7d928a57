"""Session settings the operators are designed for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    initial_partitions: int | None = None,
    advisory_partition_bytes: str | None = None,
) -> SparkSession:
    """A session with adaptive execution on (runtime coalescing, skew-join
    splitting, sort-merge -> broadcast re-planning) and no UI server.

    Static planning never broadcasts on file-size estimates
    (``autoBroadcastJoinThreshold=-1``): a join side is broadcast by
    ``lookup_join`` after its size is proven; other joins are sort-merge
    joins, which AQE may convert from measured sizes
    (``adaptive.autoBroadcastJoinThreshold``).

    ``spark.checkpoint.dir`` is read from the cluster's configuration, see
    ``ensure_checkpoint_dir``.

    On a large cluster pass ``initial_partitions`` (e.g. 20000 for ~100 TB
    of facts) and ``advisory_partition_bytes`` (e.g. ``"256MB"``): the big
    shuffles -- fact-to-fact joins and the first partial aggregates -- start
    that wide and AQE coalesces the small post-aggregation stages back down.
    """
    b = SparkSession.builder.appName("emberledger")
    if master:
        b = b.master(master)
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")
        .config("spark.sql.session.timeZone", "UTC")
        # materialized intermediates are deleted once no DataFrame uses them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if initial_partitions:
        b = b.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions))
    if advisory_partition_bytes:
        b = b.config("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory_partition_bytes)
    spark = b.getOrCreate()
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for materialized intermediates, shared by all executors.

    The session's own folder (``spark.checkpoint.dir`` or
    ``setCheckpointDir``) always wins. Only a ``local`` master, whose
    executor shares the driver's disk, may fall back to a temporary folder;
    on any other master a missing setting raises, because executors would
    each write to their own disk.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master {sc.master})")
        named = "file:" + tempfile.mkdtemp(prefix="emberledger-checkpoints-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()
