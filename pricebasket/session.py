"""Spark session settings and lineage cuts."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # coalesce shuffle partitions towards this size (defaults to 64m)
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # scan splits: 100 TB of inputs in ~400k tasks rather than ~800k
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = "local[8]", shuffle_partitions: int = 8, app: str = "pricebasket",
                extra: dict | None = None) -> SparkSession:
    """A session with AQE (runtime re-planning, skew-join splitting) on.
    ``master=None`` keeps what spark-submit / the cluster provides."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for lineage cuts, which the driver and all executors must share:
    ``spark.checkpoint.dir``.  Where it is unset, a local master takes a folder of
    its warehouse; on a cluster that could be a machine's own disk, so it is an
    error there, raised before any work is done."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_cuts"
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cuts_folder(spark: SparkSession) -> str:
    """This application's own folder of cuts, of all subpackages.  It is deleted
    by ``remove_cuts``, else when the driver's JVM ends: results that are read
    lazily need their cuts as long as the application lives."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pricebasket/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def cut_lineage(df: DataFrame, name: str = "stage", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Materialise a reused intermediate as a parquet table in the shared
    checkpoint folder and read it back: a lost executor recomputes from
    there, not from the raw scans, and later reads keep column pruning and
    filter pushdown (an RDD checkpoint would not)."""
    path = f"{cuts_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    for seen in _cut_watchers:
        seen(name, df)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_cuts(spark: SparkSession) -> None:
    """Delete the cuts of this application, after its results are published.
    DataFrames that still read them can't be used any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(cuts_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Called with (name, DataFrame) before each cut is written: plan reports and
#: tests look at the plans of all legs of a query, not of the last one only.
_cut_watchers: list[Callable[[str, DataFrame], None]] = []


@contextlib.contextmanager
def watch_cuts(seen: Callable[[str, DataFrame], None]) -> Iterator[None]:
    _cut_watchers.append(seen)
    try:
        yield
    finally:
        _cut_watchers.remove(seen)
