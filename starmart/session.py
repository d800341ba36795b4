"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the warehouse semantics depend on (not tuning): naive timestamps are
# compared and formatted in UTC, and casts raise like the source database does.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",     # of a repeated key in a JSON object the last stays
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(master: str | None = None, app: str = "starmart", partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the jobs expect.

    ``partitions`` sizes ``spark.sql.shuffle.partitions``; on a cluster leave it
    unset and let AQE coalesce from the cluster default.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required runtime settings to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system. Where it is unset, the
    folder given to ``setCheckpointDir`` is used; a local session without either
    gets a scratch folder of its own, any other session an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    root = root or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="starmart-ckpt-"))
        root = sc.getCheckpointDir()
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), "starmart", f"{name}-{uuid.uuid4().hex}")


COMPACT = "zstd"      # codec of the warehouse's own tables: documents and keys take about half of the default's bytes


def materialise(df: DataFrame, name: str = "table", compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and read it
    back: lineage is cut, the data survives executor loss, and Catalyst gets
    real size statistics for the next joins (broadcast decisions)."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)


def bucketed(df: DataFrame, cols: list[str], buckets: int, name: str = "bucketed") -> DataFrame:
    """Writes ``df`` once as a table of ``buckets`` hash buckets of ``cols``, one sorted file each, and reads it back.

    Tables bucketed alike meet on these columns without an exchange. The table is external, below the shared checkpoint
    folder; its catalogue name is dropped again, the data stay.
    """
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    (df.repartition(buckets, *cols).write.bucketBy(buckets, *cols).sortBy(*cols).option("compression", COMPACT)
     .option("path", scratch_path(spark, name)).saveAsTable(table))
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out
