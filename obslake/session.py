"""Session helpers: a local session for tests/bench, and the shared scratch
folder every written intermediate goes to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: str | None = None


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "obslake") -> SparkSession:
    """Session for tests and the bench on one machine.

    On a cluster, the session comes from spark-submit; nothing here is needed
    there.  AQE stays on so joins re-plan from measured sizes and skewed
    shuffle partitions are split.
    """
    listing = str(int(cores) * 2) if str(cores).isdigit() else "16"
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Landing writes one file per (batch, source) directory, so its cost
        # follows the number of files, not bytes.  With the default 1 MB
        # floor, AQE merges a few MB of small documents into 1-3 write tasks
        # on this machine; a 64 KB floor keeps all cores writing.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # Local disk only: without the native Hadoop library every file and
        # directory Hadoop creates forks a `chmod` process.  The raw local
        # filesystem skips the `.crc` side file (half the forks), and vfork
        # makes each fork cheaper.  Cluster filesystems fork nothing.
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
        .config("spark.driver.extraJavaOptions", "-Djdk.lang.Process.launchMechanism=VFORK")
        # Opening a local file costs far less than the 4 MB of reading the
        # default assumes; with it, a lake of tiny documents became one task
        # per ~32 files.  (Object stores open slowly: keep the default there.)
        .config("spark.sql.files.openCostInBytes", str(256 * 1024))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("OBSLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Listing a lake of many small directories: a few listing tasks, not
        # one task per directory (the default allows up to 10,000).
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", listing)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Only a ``local[...]`` session (a test on one
    machine) may fall back to a local folder; on a cluster executors could
    not see one, so a missing setting is an error there.
    """
    global _LOCAL_SCRATCH
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach "
                         "(HDFS or an object store); scratch tables, models, reports and "
                         "streaming checkpoints are written below it")
    if _LOCAL_SCRATCH is None:
        _LOCAL_SCRATCH = tempfile.mkdtemp(prefix="obslake-ckpt-")
        spark.sparkContext.setCheckpointDir(_LOCAL_SCRATCH)
    return _LOCAL_SCRATCH


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below ``<checkpoint root>/obslake``.

    ``unique=True`` appends a fresh id, for outputs that must start empty.
    """
    segs = [checkpoint_root(spark), "obslake", *parts]
    if unique:
        segs.append(uuid.uuid4().hex)
    return "/".join(segs)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, through the Hadoop FileSystem of the path's
    scheme (local, HDFS, object stores)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))
