"""Session helpers: the configuration the library relies on, and the shared
folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library assumes.  AQE re-plans joins and
# partition counts at run time and splits skewed join partitions; the session
# time zone is pinned so that date arithmetic matches SQL engines that use
# naive timestamps.  Broadcasts chosen from file-size estimates are off: AQE
# chooses them from the measured size of a finished shuffle.
DEFAULT_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def shuffle_partitions_for(shuffle_bytes: int, partition_bytes: int = 256 << 20) -> int:
    """Initial shuffle partition count for the largest expected shuffle: the
    Spark default of 200 would put ~500 GB in each reducer of a 100 TB
    shuffle.  AQE coalesces smaller stages down to the advisory size."""
    return max(200, -(-shuffle_bytes // partition_bytes))


def build_session(master: str | None = None, app_name: str = "starfold",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  expected_shuffle_bytes: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset and let spark-submit decide, and give
    ``expected_shuffle_bytes`` (the largest fact) or ``shuffle_partitions``.
    The checkpoint folder is only set when the cluster has not named one.
    """
    if shuffle_partitions is None and expected_shuffle_bytes:
        shuffle_partitions = shuffle_partitions_for(expected_shuffle_bytes)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if master is None or not master.startswith("local"):
        # On a cluster, coalesce small shuffle partitions to the advisory
        # size rather than to the core count (Spark's advice for clusters);
        # locally, keeping all cores busy matters more.
        builder = builder.config("spark.sql.adaptive.coalescePartitions.parallelismFirst",
                                 "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The checkpoint folder in use (Spark adds a random sub-folder to the
    one named in ``spark.checkpoint.dir``)."""
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    return jdir.get() if jdir.isDefined() else None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster names.  Only a local-mode
    session (tests, a laptop) without one gets a scratch folder; on a cluster
    a machine-local folder would not survive the loss of an executor, so an
    unset ``spark.checkpoint.dir`` is an error there."""
    current = checkpoint_dir(spark)
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        spark.sparkContext.setCheckpointDir(named)
    elif not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                           "(HDFS, S3, ...) for lineage cuts")
    else:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starfold-ckpt-"))
    return checkpoint_dir(spark)


_stored: ContextVar[list[str] | None] = ContextVar("starfold_stored", default=None)


@contextmanager
def temporaries(spark: SparkSession) -> Iterator[None]:
    """What ``materialize`` stores inside the block is removed at its end: for a
    step that has written its result and needs its copies no more.  Threads
    started inside take part if they run in a copy of the context."""
    paths: list[str] = []
    token = _stored.set(paths)
    try:
        yield
    finally:
        _stored.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in paths:
            p = hadoop(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and
    read it back: a lineage cut that, unlike ``checkpoint()``, keeps columnar
    storage, so later scans prune columns and push filters."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/starfold-{name}-{uuid.uuid4().hex[:12]}"
    if (paths := _stored.get()) is not None:
        paths.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
