"""Spark session defaults and the shared checkpoint folder.

Nothing here hand-schedules work: the settings only size shuffles, enable
adaptive execution (runtime coalescing, skew-join splitting, runtime
broadcast of small shuffled sides) and keep the UI off.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerline") -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` and ``shuffle_partitions`` are only applied when given, so a
    cluster submit keeps whatever the cluster configures.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_FALLBACK: dict[str, str] = {}


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        v = spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - some sessions refuse core keys
        v = None
    if not v:
        try:
            v = spark.sparkContext.getConf().get(key, None)
        except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
            v = None
    return v or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared file system and is used as is.
    Where it is unset, a session with a local master gets a scratch folder, once
    per process, and any other master is refused; core settings cannot be changed at runtime, so it is remembered here.
    """
    d = _conf(spark, "spark.checkpoint.dir")
    if not d:
        master = _conf(spark, "spark.master") or ""
        if not master.startswith("local[") and master != "local":
            raise ValueError("spark.checkpoint.dir is not set: on a cluster it must name a folder that all machines share")
        d = _LOCAL_FALLBACK.get("dir") or _LOCAL_FALLBACK.setdefault("dir", tempfile.mkdtemp(prefix="ledgerline-ckpt-"))
    try:
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
    except Exception:  # noqa: BLE001 - Spark Connect: RDD checkpoints are not used there
        pass
    return d


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` once as a Parquet table under the shared
    checkpoint folder and reading it back.

    Unlike ``Dataset.checkpoint()`` (which computes the plan a second time to
    write it unless cached) this computes once; the result survives executor
    loss because it lives on the shared file system, and downstream stages
    get a columnar, pruneable scan.
    """
    spark = df.sparkSession
    path = scratch_table_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "tables", name)

