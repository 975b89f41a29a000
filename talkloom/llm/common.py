"""Shared helpers of the training-data operators.

Executors may be lost at any time and share no local folder with the driver, so lineage is only ever
cut by writing a table into the folder that the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_own_dir: dict[str, str] = {}
_roots: set[str] = set()
#: Paths of the tables that cut() has written in this thread, in order; other threads' queries have lists of their own.
_written = threading.local()


def _tables() -> list[str]:
    if not hasattr(_written, "paths"):
        _written.paths = []
    return _written.paths


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only where it is unset on one machine (tests) a folder of our own.

    Raises RuntimeError where it is unset on a cluster, whose executors would not see a folder of the driver's.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = tempfile.mkdtemp(prefix="talkloom-")
    return _own_dir[app]


def cut(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write df as a table (partitioned by the column ``by``, its last) into the shared folder and read it back.

    The table's known size also lets Spark decide whether a later join may broadcast it.
    """
    spark = df.sparkSession
    root = f"{shared_dir(spark)}/talkloom-{spark.sparkContext.applicationId}"
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    _tables().append(path)
    if root not in _roots:
        _roots.add(root)
        atexit.register(_remove, spark, root)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session has ended before us; the folder is the cluster's to clean
        pass


def mark() -> int:
    """A place in the order of this thread's tables, for release()."""
    return len(_tables())


def release(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Remove the tables that cut() wrote in this thread after a mark, all but those that ``keep`` reads. What else reads them is lost."""
    kept = [f.rsplit("/", 1)[0] for f in keep.inputFiles()] if keep is not None else []
    left = []
    for path in _tables()[since:]:
        if any(f.endswith(path) or path.rsplit("/", 1)[-1] == f.rsplit("/", 1)[-1] for f in kept):
            left.append(path)
        else:
            _remove(spark, path)
    _tables()[since:] = left


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8(column: pa.Array) -> list[bytes | None]:
    """The strings of an Arrow column as UTF-8 bytes, without decoding them."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until df has no column of that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
