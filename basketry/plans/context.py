"""The staged source tables for one input folder.

Staging is done once per session: each source-shaped table (the fixture
mapping of the driver tables) is written as Parquet under the shared
checkpoint folder and read back, like the reference's staging layer.  Every
later query scans the staged table (column pruning, filter push-down) rather
than re-deriving it from the raw tables, and lost executors re-read files
instead of recomputing joins.  ``basketry.materialize=false`` keeps the whole
chain as one lazy plan (used to inspect end-to-end plans).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..session import FILE_FACTOR, ensure_semantics, shared_path, size_tasks, write_stage
from ..sources import fixtures as fx


class Sources:
    def __init__(self, spark: SparkSession, sf_dir: str):
        ensure_semantics(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self._base = None

    def _stage(self, name: str, df: DataFrame) -> DataFrame:
        if self.spark.conf.get("basketry.materialize", "true").lower() == "false":
            return df
        if self._base is None:
            self._base = shared_path(self.spark, "basketry-staging")
        path = f"{self._base}/{name}"
        return write_stage(df, path)

    def table(self, name: str) -> DataFrame:
        return fx.read_table(self.spark, self.sf_dir, name)

    @cached_property
    def transactions_raw(self) -> DataFrame:
        return self._stage("transactions_raw", fx.transactions_raw(self.spark, self.sf_dir))

    @cached_property
    def transactions(self) -> DataFrame:
        return self._stage("transactions", fx.transactions(self.spark, self.sf_dir))

    @cached_property
    def promotions(self) -> DataFrame:
        return self._stage("promotions", fx.promotions(self.spark, self.sf_dir))

    @cached_property
    def products(self) -> DataFrame:
        return self._stage("products", fx.products(self.spark, self.sf_dir))

    @cached_property
    def demographics(self) -> DataFrame:
        return self._stage("demographics", fx.demographics(self.spark, self.sf_dir))

    @cached_property
    def campaigns(self) -> DataFrame:
        return self._stage("campaigns", fx.campaigns(self.spark, self.sf_dir))

    @cached_property
    def campaign_descriptions(self) -> DataFrame:
        return self._stage("campaign_descriptions", fx.campaign_descriptions(self.spark, self.sf_dir))

    @cached_property
    def coupons(self) -> DataFrame:
        return self._stage("coupons", fx.coupons(self.spark, self.sf_dir))

    @cached_property
    def coupon_redemptions_raw(self) -> DataFrame:
        return self._stage("coupon_redemptions_raw", fx.coupon_redemptions_raw(self.spark, self.sf_dir))

    @cached_property
    def coupon_redemptions(self) -> DataFrame:
        return self._stage("coupon_redemptions",
                           fx.coupon_redemptions(self.spark, self.sf_dir, self.coupon_redemptions_raw))

    def source(self, name: str) -> DataFrame:
        return getattr(self, name)


def input_files(spark: SparkSession, sf_dir: str) -> str:
    """Names, lengths and times of the input files: what tells one delivery in a folder from another."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def listed(path) -> list[str]:
        out = []
        for f in fs.listStatus(path):
            out += listed(f.getPath()) if f.isDirectory() else [f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}"]
        return out
    found = [x for t in fx.INPUT_TABLES if fs.exists(p := jvm.org.apache.hadoop.fs.Path(folder, f"{t}.parquet")) for x in (t, *listed(p))]
    return "\n".join(found)


_CACHE: dict[tuple[int, str, str, str], "Sources"] = {}


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The staged sources: one for each live session, folder and state of its files; changed files are staged anew."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, input_files(spark, sf_dir))
    if key not in _CACHE:
        files = sum(int(line.split(" ")[-2]) for line in key[3].splitlines() if " " in line)
        size_tasks(spark, int(files * FILE_FACTOR))     # the rows are shuffled, not the files
        _CACHE[key] = Sources(spark, sf_dir)
    return _CACHE[key]
