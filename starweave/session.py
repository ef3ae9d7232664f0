"""Session helpers: table loading and a shared checkpoint location.

Nothing here creates machine-local scratch space on a cluster: the checkpoint
directory is read from ``spark.checkpoint.dir`` (set by the cluster), and only a
local test session that has none gets a directory under the warehouse.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def local_session(app: str = "starweave", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench: local mode, AQE on, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory the cluster names; set one only if unset.

    On a cluster ``spark.checkpoint.dir`` points to shared storage and is used
    as is, scheme included. Where it is unset, a local-mode session gets a fresh
    temporary directory; on any other master this raises, because executors
    could not see a folder made on the driver's disk.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir is unset on master {sc.master}: name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="starweave-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


# Paths handed out by scratch_path in this process and not yet released.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint directory, for written tables."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def scratch_mark() -> int:
    """A mark for ``release_scratch``: only paths handed out later are released."""
    return len(_SCRATCH)


def release_scratch(spark: SparkSession, since: int = 0) -> int:
    """Delete the scratch tables handed out since ``since`` (all by default) and
    return how many paths were released. Call it when the frames that read them
    have been written or consumed; frames stay lazy until then."""
    gone = _SCRATCH[since:]
    for path in gone:
        remove_path(spark, path)
    del _SCRATCH[since:]
    return len(gone)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete the file or folder at ``path``, on whatever storage its scheme names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder at ``path``, on whatever storage its scheme names?"""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


# Spark's setting: shuffle files go when the statement that made them has ended.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a statement are removed as soon as it has ended, and not when the driver's garbage
    collector comes to it: a job of many written steps then holds the shuffles of one step on disk, not of all. For
    steps that end in a write or are collected once; a frame collected again would shuffle again."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Register the driver's parquet tables as temp views under their own names."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint directory and read
    it back: the lineage is cut, later readers scan only the columns they use,
    and a lost executor costs a re-read, not a recomputation. ``compression``
    is Spark's own unless given."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)
