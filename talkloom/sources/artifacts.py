"""Reading and writing of artifact tables and documents."""

from __future__ import annotations

import tempfile
import tomllib
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkloom.schemas import schema

_dirs: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path in the folder of spark.checkpoint.dir; where that is unset on one machine (tests), in one of our own.

    Raises RuntimeError where it is unset on a cluster, whose executors would not see a folder of the driver's.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc = spark.sparkContext
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if sc.applicationId not in _dirs:
            _dirs[sc.applicationId] = tempfile.mkdtemp(prefix="talkloom-")
        root = _dirs[sc.applicationId]
    return f"{root.rstrip('/')}/talkloom-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder of spark.checkpoint.dir (see shared_folder)."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:  # where spark.checkpoint.dir is set, Spark has set it
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The rows written as a table in the shared folder and read again: unlike a checkpoint's, their size is known to the plans
    that read them, and they lie compressed."""
    path = shared_folder(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything matches a path (or pattern), in whatever file system it names."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(fs_path)
    return found is not None and len(found) > 0


def read_json(spark: SparkSession, path: str, name: str, strict: bool = True, lines: bool = False) -> DataFrame:
    """A JSON artifact (one document or list, or a record a line) under its declared schema; malformed input fails and the
    message names the file."""
    reader = spark.read.schema(schema(name)).option("multiLine", not lines).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    return reader.json(path)


def read_optional(spark: SparkSession, path: str, name: str) -> DataFrame:
    """As read_json, or an empty table where there is no such artifact."""
    return read_json(spark, path, name) if exists(spark, path) else spark.createDataFrame([], schema(name))


def read_table(spark: SparkSession, path: str, kind: str = "parquet", **options: str) -> DataFrame:
    """Tables kept in any of Spark's formats (parquet, orc, csv, json, avro where its package is there, jdbc)."""
    return spark.read.format(kind).options(**options).load(path)


def with_position(df: DataFrame) -> DataFrame:
    """Add _pos, the order of rows as read, which first-wins rules need; a position that was stored stays.

    Files come in order of their names, their parts and rows in order within, however Spark deals files out to tasks.
    """
    if "_pos" in df.columns:
        return df
    if not df.inputFiles():
        return df.withColumn("_pos", F.monotonically_increasing_id())
    at = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block")]
    placed = df.select("*", *at, F.monotonically_increasing_id().alias("__row"))
    parts = placed.groupBy("__file", "__block").agg(F.count("*").alias("n"), F.min("__row").alias("__first"))
    before = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)  # one row for each part of a file
    parts = parts.select("__file", "__block", "__first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__begin"))
    placed = placed.join(parts, ["__file", "__block"])
    return placed.withColumn("_pos", F.col("__begin") + F.col("__row") - F.col("__first")).drop("__file", "__block", "__row", "__first", "__begin")


def read_documents(spark: SparkSession, pattern: str, name: str, key: str = "video_id") -> DataFrame:
    """One document a file; those without a key go, and of two with one key the file last by name wins."""
    from talkloom.operators.ordering import keep_last

    rows = read_json(spark, pattern, name).withColumn("_file", F.input_file_name())
    return keep_last(rows, F.col(key), F.col("_file")).drop("_file")


def read_optional_documents(spark: SparkSession, pattern: str, name: str, key: str = "video_id") -> DataFrame:
    """As read_documents, or an empty table where no file matches."""
    return read_documents(spark, pattern, name, key) if exists(spark, pattern) else spark.createDataFrame([], schema(name))


def read_schedule(spark: SparkSession, path: str) -> DataFrame:
    """Raw sessions of a local .toml (key sessions) or of a JSON file."""
    if path.endswith(".toml"):
        import json

        text = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())  # one small hand-written file
        rows = tomllib.loads(text).get("sessions", [])
        fields = schema("raw_session").fieldNames()
        flat = [tuple(json.dumps(r[f]) if f == "speakers" and f in r and not isinstance(r[f], str) else r.get(f) for f in fields) for r in rows]
        return with_position(spark.createDataFrame(flat, schema("raw_session")))
    return with_position(read_json(spark, path, "raw_session"))


def write_artifact(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Overwrite a whole artifact."""
    df.write.mode("overwrite").format(kind).save(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_results(df: DataFrame, path: str) -> None:
    """Add a batch of results; what is there already is skipped by an anti-join on restart."""
    df.write.mode("append").parquet(path)


def _remote(path: str):
    """Hadoop's file system and path for a path that names one (hdfs://, s3a://, ...); None for plain local paths."""
    spark = SparkSession.getActiveSession()
    if "://" not in path or spark is None:
        return None
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return fs_path.getFileSystem(spark._jsc.hadoopConfiguration()), fs_path


def write_text(path: str, text: str) -> None:
    """A report file, written by the driver."""
    if remote := _remote(path):
        out = remote[0].create(remote[1], True)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        return
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(text, encoding="utf-8")


def read_text(path: str, default: str = "") -> str:
    """A report file's text; ``default`` where there is none."""
    if remote := _remote(path):
        if not remote[0].exists(remote[1]):
            return default
        return SparkSession.getActiveSession().read.text(path, wholetext=True).first()["value"]
    return Path(path).read_text(encoding="utf-8") if Path(path).exists() else default


def remove_pages(folder: str) -> None:
    """Delete the Markdown files of a folder."""
    if remote := _remote(f"{folder}/*.md"):
        for found in remote[0].globStatus(remote[1]) or []:
            remote[0].delete(found.getPath(), False)
        return
    for old in Path(folder).glob("*.md"):
        old.unlink()


def media(spark: SparkSession, path: str, pattern: str = "*.mp4") -> DataFrame:
    """Landed media: path, modificationTime, length, and content, which is read only if asked for."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
