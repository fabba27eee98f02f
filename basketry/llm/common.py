"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Words are runs of anything but these six ASCII white-space characters.
SPACE_CLASS = r"[\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Functions run by ``mapInArrow`` are then found by name on every machine, and
    module-level caches live as long as a worker does.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.realpath(os.path.join(tempfile.mkdtemp(prefix="basketry-ship-"), "basketry_code.zip"))
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("basketry", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder; removed when the driver's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files, and what made them is not
    run again for each later use.
    """
    path = shared_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text (null: no words), all on the JVM side."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), "")


def crc_mod(key: Column, mod: int) -> Column:
    """crc32 of the key's decimal text, modulo ``mod``; used to split train from held out."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(mod)


def hash_sample(rows: DataFrame, docs: DataFrame, key: str, n: int) -> DataFrame:
    """The documents whose keys are the first ``n`` different keys of ``rows`` by hash order.

    Only keys are sorted; the ``n`` found, a bound of the caller, are broadcast, so the
    documents are scanned but never shuffled.  Rows that share a key are all there: a caller that
    collects takes one of each key.
    """
    return having(docs, key, first_keys(rows, key, n))


def first_keys(rows: DataFrame, key: str, n: int) -> DataFrame:
    """(_key) of the first ``n`` different keys of ``rows`` by hash order."""
    keys = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("_key")).distinct()
    return keys.orderBy(F.xxhash64("_key"), "_key").limit(n)


def having(docs: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The documents with one of a bounded number of keys."""
    return docs.join(F.broadcast(keys.select(F.col("_key").alias(key))), key, "left_semi")
