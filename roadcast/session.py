"""Session settings and shared-folder helpers.

Every operator in the package takes DataFrames; this module only supplies the
session conventions the operators rely on:

* UTC session time zone (timestamps are compared with other engines),
* ANSI mode left on (Spark 4 default) -- operators use ``try_*`` functions
  where the reference relied on non-ANSI nulls,
* adaptive query execution with skew-join splitting,
* ``spark.sql.legacy.javaCharsets`` so legacy text encodings such as cp949
  can be read and written by the CSV source.

Iterative operators cut their lineage with reliable ``checkpoint()`` into
``spark.checkpoint.dir``.  On a cluster that setting must name a shared folder;
it is only filled in here when the session has none (local runs and tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.legacy.javaCharsets": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "roadcast", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package conventions applied.

    Master and shuffle width stay as submitted unless they are given.
    """
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_conventions(spark)
    return spark


def apply_conventions(spark: SparkSession) -> None:
    """Set the runtime-settable conventions on an existing session."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; one is chosen only when none is set.

    A cluster names a shared folder in ``spark.checkpoint.dir``.  When the
    setting is absent a folder under the local temp directory is used for
    local masters (tests); on any other master that is an error, since
    executors do not share it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.match(r"local(\[[^,\]]*(,[^,\]]*)?\])?$", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = os.path.join(tempfile.gettempdir(), f"roadcast-ckpt-{uuid.uuid4().hex[:12]}")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    Used for materialised intermediate tables and for the file-based proofs,
    so nothing lands in a machine-local folder on a cluster.
    """
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/roadcast-scratch/{name}-{uuid.uuid4().hex[:12]}"


def write_read(df: DataFrame, path: str) -> DataFrame:
    """Materialise ``df`` once as Parquet in the shared folder and read it back.

    One job (a reliable checkpoint of an unpersisted frame would compute it
    twice) and the lineage ends at the files.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
