"""Session helpers: one place for the configuration the engine relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the engine's semantics depend on.  The session time zone must be UTC:
# instants are stored as UTC and business dates are derived with an explicit zone.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings that matter for scale; applied only when building our own session.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "basketry", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = {**SCALE_CONF, **REQUIRED_CONF,
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": os.environ.get("BASKETRY_DRIVER_MEMORY", "16g")}
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_semantics(spark)
    return spark


def ensure_semantics(spark: SparkSession) -> None:
    """Pin the settings results depend on (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


#: What a task gets at most: 32 MB of a file, 16 MB of an exchange, so that a hash table of its rows stays in memory.
SIZE_CONF = {
    "spark.sql.files.maxPartitionBytes": 32 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
}
INPUT_PER_TASK = 16 << 20
#: Parquet's sizes understate the rows in memory; with this a table is broadcast only where its rows are few.
FILE_FACTOR = 4.0


def size_tasks(spark: SparkSession, input_bytes: int) -> None:
    """Shuffle partitions by the size of the input and small tasks; a session that asks for more or smaller ones keeps its own."""
    for k, most in SIZE_CONF.items():
        if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(k)) > most:
            spark.conf.set(k, str(most))
    parts = -(-input_bytes // INPUT_PER_TASK)
    if int(spark.conf.get("spark.sql.shuffle.partitions")) < parts:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    if float(spark.conf.get("spark.sql.sources.fileCompressionFactor")) < FILE_FACTOR:
        spark.conf.set("spark.sql.sources.fileCompressionFactor", str(FILE_FACTOR))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``.

    Without one, only a local session (driver and executors are one process) gets
    a scratch folder; on a cluster executors would each write to their own disk,
    so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="basketry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder; removed when the driver's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def write_stage(df: DataFrame, path: str, by: list[str] | None = None) -> DataFrame:
    """Write a derived table as Parquet under the shared folder and read it back.

    With ``by`` it is partitioned by these columns, so that a filter on them reads their folders only; rows are
    rebalanced by them first (AQE splits a large partition over tasks), so there are few files.
    """
    if not by:
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a new shared folder and read it back: a cut in the lineage."""
    return write_stage(df, shared_path(df.sparkSession, name))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
