"""Tables, documents and audit rows to files, on any file system that Spark writes to."""

from __future__ import annotations

import json
import os
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(rows: DataFrame, path: str, order: str | None = None) -> None:
    """JSON lines with all fields, nulls too; sorted by a key if one is given."""
    (rows.orderBy(order) if order else rows).write.option("ignoreNullFields", "false").mode("overwrite").json(path)


def file_system(spark: SparkSession, path: str):
    """(Hadoop's file system of path, path as it wants it)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = file_system(spark, path)
    return system.exists(where)


def write_concatenated(rows: DataFrame, path: str) -> None:
    """Pretty JSON objects one after another, for readers that want them so."""
    rows.select(F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def write_document(value: dict, path: str) -> None:
    """One JSON document; written beside its place first, so that a reader never sees half of it."""
    spark = SparkSession.active()
    system, where = file_system(spark, path)
    _, new = file_system(spark, f"{path}.new")
    out = system.create(new, True)
    out.write(bytearray(json.dumps(value, ensure_ascii=False, indent=2), "utf-8"))
    out.close()
    system.delete(where, True)
    if not system.rename(new, where):
        raise OSError(f"{path} could not be put in place")


def replace_table(rows: DataFrame, path: str) -> None:
    """A new version of a table that rows may have been read from: written in full beside it, then put in its place.

    Between the two renames the table stands as path.old only; what fails there can be put right by hand, nothing is lost.
    """
    spark = SparkSession.active()
    write_jsonl(rows, f"{path}.new")
    (system, where), (_, new), (_, old) = (file_system(spark, p) for p in (path, f"{path}.new", f"{path}.old"))
    system.delete(old, True)
    if system.exists(where) and not system.rename(where, old):
        raise OSError(f"{path} could not be moved")
    if not system.rename(new, where):
        raise OSError(f"{path} could not be put in place")
    system.delete(old, True)


def audit_rows(rows: DataFrame, level: str, stage: str, message, path: str) -> DataFrame:
    """(at, level, stage, message, path), a row for each row."""
    return rows.select(F.current_timestamp().alias("at"), F.lit(level).alias("level"), F.lit(stage).alias("stage"), message.alias("message"), F.col(path).cast("string").alias("path"))


def write_audit(rows: DataFrame, folder: str) -> None:
    """All rows, and those of warnings and of errors alone, as folders of level=..."""
    rows.write.mode("append").partitionBy("level").json(folder)


def note(spark: SparkSession, stage: str, message: str, path: str, folder: str) -> None:
    """One audit row at level INFO: the beginning or the end of a stage."""
    write_audit(audit_rows(spark.range(1).select(F.lit(path).alias("path")), "INFO", stage, F.lit(message), "path"), folder)


def now() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")


def materialize(entries: DataFrame, files: DataFrame, folder: str) -> None:
    """The bytes of kept files as a table in folders by source, engine and page type."""
    kept = entries.filter("should_materialize_normalized").select("source_key", F.col("original_relative_path").alias("relative"), "engine_family", "page_type_guess", "normalized_relative_path")
    kept.join(files.select("source_key", "relative", "content"), ["source_key", "relative"]).write.mode("overwrite").partitionBy("source_key", "engine_family", "page_type_guess").parquet(folder)


def copy_files(entries: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """Kept files under their new names below root, a folder that all executors share; (path, written)."""
    kept = entries.filter("should_materialize_normalized").select("source_key", F.col("original_relative_path").alias("relative"), "normalized_relative_path")
    rows = kept.join(files.select("source_key", "relative", "content"), ["source_key", "relative"]).select("normalized_relative_path", "content")

    def write(batches):
        import pyarrow as pa

        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                place = os.path.join(root, name)
                os.makedirs(os.path.dirname(place), exist_ok=True)
                part = f"{place}.{os.getpid()}.part"
                with open(part, "wb") as file:
                    file.write(content)
                os.replace(part, place)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([True] * batch.num_rows)], ["path", "written"])

    return rows.mapInArrow(write, "path string, written boolean")


def run_id(now: datetime | None = None) -> str:
    return (now or datetime.now(UTC)).strftime("run-%Y%m%d-%H%M%S-") + f"{(now or datetime.now(UTC)).microsecond // 1000:03d}"


def counters(spark: SparkSession, row: DataFrame) -> dict:
    """The one row of counters as a dictionary."""
    return row.first().asDict()
