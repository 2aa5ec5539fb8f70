"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(column: str = "text") -> Column:
    """A text as it is, empty for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns of df that none of the new names replaces; a result column replaces one of its name."""
    new = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in new]


def map_batches(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow whose workers find this package where the driver has it.

    On a cluster the package is installed or sent with --py-files; the path matters where
    the driver merely has it on sys.path. Batches are kept to 8 MB in this session: each is
    held several times over, by the executor and by its Python worker.
    """
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    return df.mapInArrow(task, schema)


def add_columns(df: DataFrame, text: Column, fields: dict[str, str], work: Callable[[list[str]], dict[str, list]], keep: list[str] | None = None) -> DataFrame:
    """df with columns worked out from a text, batch by batch and without a shuffle.

    fields: name and SQL type of the new columns. work: gets the texts of an Arrow batch, in
    pieces of a bounded size, and returns a list for each field. keep: the columns to carry.
    """
    kept = without(df, fields) if keep is None else keep
    schema = ", ".join([f"`{c.replace('`', '``')}` {df.schema[c].dataType.simpleString()}" for c in kept] + [f"`{c}` {t}" for c, t in fields.items()])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                made = work(piece.column(len(kept)).to_pylist())
                types = [arrow_type(t) for t in fields.values()]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(i) for i in range(len(kept))] + [pa.array(made[c], t) for c, t in zip(fields, types)],
                    names=kept + list(fields),
                )

    quoted = [F.col(f"`{c.replace('`', '``')}`") for c in kept]
    return map_batches(df.select(*quoted, text.alias("__text")), task, schema)


def arrow_type(sql: str) -> pa.DataType:
    if sql.startswith("array<"):
        return pa.list_(arrow_type(sql[6:-1]))
    if sql.startswith("struct<"):
        return pa.struct([(p.split(":")[0], arrow_type(p.split(":")[1])) for p in sql[7:-1].split(",")])
    return {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}[sql]


def pieces(batch: pa.RecordBatch, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about `size` bytes; a longer row is a slice of its own."""
    rows = max(1, batch.num_rows)
    step = max(1, rows * size // max(size, batch.nbytes))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


# ---- intermediate tables ----------------------------------------------------------------

_folders: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application under spark.checkpoint.dir, or, where that is unset, under the warehouse.

    On a cluster the warehouse must then be on shared storage: what is written to a local disk is not there for others.
    """
    set_, base = spark.conf.get("spark.checkpoint.dir", None), spark.conf.get("spark.sql.warehouse.dir")
    if not set_ and not spark.sparkContext.master.startswith("local") and base.partition(":")[0] in ("file", base):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = set_ or base
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}-llm"


def save(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back: cuts the lineage and survives lost executors.

    The results that read it are lazy, so it stays until the application ends.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if folder not in _folders:
        _folders.add(folder)
        atexit.register(_remove, spark, folder)
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is None:  # stopped already
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
