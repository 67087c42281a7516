"""SparkSession construction and lineage-cutting helpers.

On a cluster the session comes from the platform; we only fill in settings that are
unset.  ``spark.checkpoint.dir`` must name a shared folder on a cluster; a scratch folder is
chosen only when the setting is absent (tests, local runs).
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings we want on every session; applied only where the user has not set them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "kitchenlens",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    explicit = dict(conf or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    active = SparkSession.getActiveSession()
    if active is not None:
        # a running session (a cluster platform's): keep its settings, fill in only what is
        # unset, and apply what the caller asked for explicitly (runtime-settable keys only)
        for k, v in {**DEFAULT_CONF, **explicit}.items():
            if k in explicit or active.conf.get(k, None) is None:
                try:
                    active.conf.set(k, v)
                except Exception:       # static settings cannot change in a running session
                    pass
        spark = active
    else:
        builder = SparkSession.builder.appName(app)
        if master:
            builder = builder.master(master)
        for k, v in {**DEFAULT_CONF, **explicit}.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    A scratch folder is chosen where none is set and the session runs in one process (tests).  On a
    cluster a machine-local folder would lose what other machines write, so an unset folder is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        path = tempfile.mkdtemp(prefix="kitchenlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    The written table survives executor loss (no recomputation from the raw inputs), later scans
    get column pruning and filter pushdown, and columnar files are cheaper to write than
    row-serialised RDD checkpoints.
    """
    import uuid
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    if not _STAGES:
        atexit.register(_release_all)
    df.write.mode("overwrite").parquet(path)
    _STAGES[path] = spark
    out = spark.read.parquet(path)
    out.stage_path = path
    return out


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared checkpoint folder; what is written there is deleted with the stage tables."""
    import uuid
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"
    if not _STAGES:
        atexit.register(_release_all)
    _STAGES[path] = spark
    return path


_STAGES: dict[str, SparkSession] = {}


def drop_stage(df: DataFrame) -> None:
    """Delete the table behind a frame that ``cut_lineage`` returned, once nothing reads it any more."""
    _delete(df.sparkSession, df.stage_path)


def is_written(df: DataFrame) -> bool:
    """Whether the table behind a frame that ``cut_lineage`` returned is still there."""
    return df.stage_path in _STAGES


def release_stages(spark: SparkSession) -> None:
    """Delete all stage tables this process has written for a session; call it when the results that
    read them have been written or collected.  Runs by itself when the process ends."""
    for path in [p for p, s in _STAGES.items() if s is spark]:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    _STAGES.pop(path, None)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _release_all() -> None:
    for path, spark in list(_STAGES.items()):
        if spark.sparkContext._jsc is None:      # the session was stopped: only a local folder can still be reached
            shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)
        else:
            _delete(spark, path)
