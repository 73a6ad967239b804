"""Session factory and the shared folders every job writes to.

Checkpoints, lineage cuts and scratch output go below ``spark.checkpoint.dir``,
which on a cluster names a folder all executors share. We read it from the
session and only fill it in when it is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings every job relies on: a fixed time zone (event times and oracle
# comparisons), ANSI semantics (bad casts raise unless try_* is used) and AQE
# (coalesced shuffle partitions, runtime broadcast of small join sides, split
# of skewed join partitions).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(
    app: str = "quire",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the base settings applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime part of the base settings to an existing session and
    make sure a checkpoint folder is known."""
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.adaptive.enabled"):
        spark.conf.set(k, BASE_CONF[k])
    checkpoint_dir(spark)
    return spark


_LOCAL_DIRS: dict[str, str] = {}
_SCRATCH: dict[str, list[str]] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session: ``spark.checkpoint.dir``,
    or else the folder given to ``SparkContext.setCheckpointDir``.

    Only a local master may do without either: a fresh folder under the system
    temp dir is then created and registered with the context. On a cluster each
    executor would write to its own disk, so there it is an error."""
    sc = spark.sparkContext
    known = sc.getCheckpointDir()
    path = sc.getConf().get(CHECKPOINT_CONF, None) or _LOCAL_DIRS.get(sc.applicationId) or known
    if not path:
        if not _is_local(sc.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share (master {sc.master})")
        path = _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="quire-ckpt-")
    if known is None:
        sc.setCheckpointDir(path)
    return path


def _is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this session has made and return how many;
    for the end of a job, when no DataFrame over them is needed any more."""
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        remove_path(spark, p)
    return len(paths)


def scratch_folders(spark: SparkSession) -> list[str]:
    """The scratch folders this session has made and not deleted, oldest first."""
    return list(_SCRATCH.get(spark.sparkContext.applicationId, ()))


def drop_scratch(spark: SparkSession, paths: list[str], reader: DataFrame) -> list[str]:
    """Delete those of the scratch folders that ``reader`` reads no file of; the
    ones that remain."""
    used = reader.inputFiles() if paths else []
    left = [p for p in paths if any(f"/{os.path.basename(p)}/" in f for f in used)]
    known = _SCRATCH.get(spark.sparkContext.applicationId, [])
    for p in paths:
        if p not in left:
            remove_path(spark, p)
            if p in known:
                known.remove(p)
    return left


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_scratch(df: DataFrame, name: str, compression: str | None = None) -> str:
    """Write a step's result to a new scratch folder and return its path. With
    Spark's own clean-up on, the shuffle files of the step go when it ends, not
    when the driver happens to collect its plan, so that a job of many steps
    needs the disk of one. (The switch is the session's, and is put back; on a
    session that lacks it the files stay until Spark's cleaner takes them.)
    ``compression`` is the Parquet codec, the session's by default."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", compression) if compression else df.write
    before = spark.conf.get(_CLEANUP, None)
    if before is None:
        writer.parquet(path)
        return path
    spark.conf.set(_CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours in whatever file system it lies."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path is a folder in whatever file system it lies."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).isDirectory(hadoop_path)


def complete_folders(spark: SparkSession, folder: str, prefix: str, mark: str | None = "_SUCCESS") -> list[int]:
    """Numbers of the ``<prefix><number>`` folders below a folder, ascending;
    with ``mark`` only those whose write was committed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    done = lambda n: mark is None or fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/{mark}"))
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix) and done(n))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/quire-scratch/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def local_test_session(cores: int = 4, partitions: int = 8) -> SparkSession:
    """Session used by tests and the bench on one machine."""
    return get_spark(
        app="quire-local",
        master=f"local[{cores}]",
        shuffle_partitions=partitions,
        extra={"spark.driver.memory": os.environ.get("QUIRE_DRIVER_MEMORY", "8g")},
    )
