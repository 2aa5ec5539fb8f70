"""Runtime settings the plans rely on."""

from __future__ import annotations

import atexit

from pyspark.sql import DataFrame, SparkSession, functions as F

# AQE splits a hot join key by itself. Forcing the split matters where a join on
# order_id feeds a grouping that starts with order_id: there the split costs one
# more shuffle, and Spark would otherwise leave the hot partition whole.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Turn on adaptive skew handling. These are per-session SQL settings."""
    for key, value in ADAPTIVE.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, or a folder in the warehouse where none is configured.

    On a cluster the warehouse must then be on shared storage: executors cannot
    read what others wrote to a local disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
    context = spark.sparkContext
    if not configured and not context.master.startswith("local") and folder.partition(":")[0] in ("file", folder):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_scratch: set[str] = set()


def scratch_folder(spark: SparkSession) -> str:
    """A folder of this application in the shared one, for tables without a place of their own. It goes with the application."""
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    if folder not in _scratch:
        _scratch.add(folder)
        atexit.register(_remove, spark, folder)
    return folder


def _remove(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is not None:  # not stopped yet
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared(rows: DataFrame, key: str, joined: bool = False) -> DataFrame:
    """rows shuffled by ``key`` in such a way that all readers in a query use the same shuffle.

    Spark shuffles once for several readers only if they ask for the same columns under the same filters. Rows are
    packed here, and what each reader needs is picked behind the shuffle: no column is pruned and no filter is
    pushed before it in one reader alone. Grouping by ``key`` needs no other shuffle. Where readers join by the key,
    which would push a filter on it, ``joined`` takes the key from the packed row too, at the price of that.
    """
    columns = [c for c in rows.columns if joined or c != key]
    packed = rows.select(F.col(key).alias("by"), F.array(F.struct(*columns)).alias("row")).repartition("by")
    return packed.selectExpr("inline(row)") if joined else packed.selectExpr(f"by AS {key}", "inline(row)")
