"""Tables written between stages of a job.

They cut lineage and let one Python pass feed several consumers. They go to the folder that the cluster names in
``spark.checkpoint.dir``, which all executors share, so a lost executor loses nothing. Only a local master without
that setting gets a temporary folder of its own.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_USED: dict[str, str] = {}
#: Bytes that a partition of a large shuffle should hold.
PARTITION = 128 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder for staged tables; raises on a cluster that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="textloom-stage-")
        atexit.register(shutil.rmtree, _LOCAL[app], True)
    return f"file://{_LOCAL[app]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back; later reads prune columns."""
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    home = f"{shared_dir(spark)}/textloom/{app}"
    if app not in _USED:
        _USED[app] = home
        atexit.register(clear, spark)
    path = f"{home}/{uuid.uuid4().hex}/{name}"
    # hashed keys fill fewer bytes than their type has; this codec finds that
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete the application's staged tables; results that still read them must have been written before.

    Runs by itself when the driver ends, on clusters too; a driver that is killed leaves its folder behind.
    """
    try:
        home = _USED.pop(spark.sparkContext.applicationId, None)
        if home:
            path = spark._jvm.org.apache.hadoop.fs.Path(home)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session has ended before
        return


def sized(df: DataFrame, size: int, *keys: str) -> DataFrame:
    """``df`` in as many partitions by its keys as ``size`` bytes fill, where that is more than a shuffle has anyway."""
    n = -(-size // PARTITION)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan of fewer partitions than cores over all cores; larger inputs stay as they are."""
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
