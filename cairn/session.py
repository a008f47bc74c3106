"""Session construction and lineage helpers.

Every job takes an existing SparkSession. ``build_session`` is only for
local runs (tests, bench); on a cluster the session comes from the
launcher and keeps its own settings.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC for date arithmetic that must agree
# with the SQL oracle, AQE for runtime coalescing and skew splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # merge session windows inside each partition before the shuffle, so a
    # hot key's events arrive as a few partial sessions
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "cairn",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("CAIRN_DRIVER_MEMORY", "8g"))
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_job_conf(spark)
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings the operators assume (idempotent). They
    stay set, as the frames that a query returns run later under them."""
    for key in (
        "spark.sql.session.timeZone",
        "spark.sql.adaptive.enabled",
        "spark.sql.adaptive.skewJoin.enabled",
        "spark.sql.sources.partitionOverwriteMode",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition",
    ):
        spark.conf.set(key, BASE_CONF[key])


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; that value always
    wins. Only when nothing is configured (local tests) a fresh folder is
    created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: give the cluster a shared folder "
                "(distributed file system or object store) for lineage cuts and stream state"
            )
        conf_dir = tempfile.mkdtemp(prefix="cairn-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediates."""
    return f"{run_folder(spark)}/{name}"


def run_folder(spark: SparkSession) -> str:
    """The folder of everything this application writes in between."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}"


_TABLES: dict[str, set[str]] = {}


def note_table(spark: SparkSession, table: str) -> None:
    """Remember a catalog table over files in the run folder."""
    _TABLES.setdefault(spark.sparkContext.applicationId, set()).add(table)


def clean_up(spark: SparkSession) -> None:
    """Remove the run folder and the catalog entries over it. Call it when
    the results of the run's queries have been read or stored elsewhere."""
    for table in sorted(_TABLES.pop(spark.sparkContext.applicationId, ())):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    and continue from the written files.

    This cuts the lineage (later stages and retries after an executor loss
    read the files instead of recomputing the plan), computes the input
    once (an eager ``Dataset.checkpoint`` runs its plan twice unless it is
    cached), and keeps later scans columnar and prunable.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}_{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
