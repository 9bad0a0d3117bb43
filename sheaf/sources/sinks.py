"""Outputs: JSON Lines files, record files, and training-set views."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from sheaf.fixed import DATASET_VIEWS


def write_jsonl(
    rows: DataFrame, path: str, fields: Sequence[str], order: Sequence[str] = ()
) -> int:
    """Write compact JSON lines with the given members; return the number of rows.

    An existing target is refused. With ``order`` the part files, read by name, are in
    that order; without it no sort takes place.
    """
    return write_lines(rows.withColumn("_line", F.to_json(F.struct(*fields))), path, "_line", order)


def write_lines(rows: DataFrame, path: str, line_col: str, order: Sequence[str] = ()) -> int:
    """Write ready JSON text, one row per line; return the number of rows.

    The files are written beside the target and moved there once all are complete, so a
    failed write leaves nothing behind, and a repeated one finds nothing to add to,
    however the cluster commits its tasks.
    """
    spark = rows.sparkSession
    require_new(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    aside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    if order:
        rows = rows.orderBy(*order)
    written = Observation("written")
    lines = rows.select(F.col(line_col).alias("value")).observe(written, F.count(F.lit(1)).alias("n"))
    try:
        lines.write.text(aside.toString())
        if not fs.rename(aside, target):
            raise FileExistsError(f"cannot move the finished files to {path}")
    except BaseException:
        fs.delete(aside, True)
        raise
    return written.get["n"]


def require_new(spark: SparkSession, path: str) -> None:
    """Refuse an existing target before any work is done."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        raise FileExistsError(f"the target {path} already exists")


def write_records(parts: DataFrame, path: str) -> int:
    """Write extraction records in (paper path, part) order, one record per line.

    One line per record instead of one indented array: the files can be split, and an
    array would have to pass through a single task.
    """
    return write_lines(parts, path, "record_json", order=["doc_path", "batch_no"])


def dataset_view(samples: DataFrame, name: str) -> DataFrame:
    """Samples under the column names of the training-set manifest."""
    return samples.select(*[F.col(src).alias(dst) for dst, src in DATASET_VIEWS[name].items()])
