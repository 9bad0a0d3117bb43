"""What several operators share: the white space of the contract, texts without nulls, table reads."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

#: The characters that separate words, everywhere in this subpackage: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def in_chunks(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one holds about ``most`` bytes of text, or a single row.

    Arrow batches are counted in rows; a few hundred long texts would otherwise sit in
    a worker's memory several times over.
    """
    for batch in batches:
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0))
        cut = np.cumsum(sizes) // most
        start = 0
        for end in [*(np.flatnonzero(np.diff(cut)) + 1).tolist(), batch.num_rows]:
            if end > start:
                yield batch.slice(start, end - start)
            start = end


def crc32(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").data)


def as_struct(df: DataFrame) -> Column:
    """A whole row as one value, so that its columns clash with no others, whatever they are called."""
    return F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in df.columns))


def rows_staying(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``kept`` (doc_id, text_hash), with their columns.

    ``text_hash`` is :func:`text_hash`. Of rows of ``docs`` that share id and text one
    stays, whichever Spark meets first; ``kept`` may name a row more than once.
    """
    own = docs.select(as_struct(docs).alias("row"), F.col("doc_id").alias("id"), text_hash().alias("hash"))
    named = kept.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    repeated = own.groupBy("id", "hash").count().filter("count > 1").select(
        F.col("id").alias("_id"), F.col("hash").alias("_hash")
    )

    def same(other: DataFrame) -> Column:
        return own["id"].eqNullSafe(other["_id"]) & (own["hash"] == other["_hash"])

    staying = own.join(named, same(named), "leftsemi")
    # only repeated rows pay for a shuffle of whole rows by key
    once = staying.join(repeated, same(repeated), "leftanti")
    more = staying.join(repeated, same(repeated), "leftsemi").dropDuplicates(["id", "hash"])
    return once.unionByName(more).select("row.*")


def text_hash(column: str = "text") -> Column:
    """Tells apart rows that share an id; null counts as empty."""
    return F.xxhash64(text_or_empty(column), F.length(text_or_empty(column)))


def sampled(rows: DataFrame, most: int, *columns: str) -> list[Row]:
    """The ``most`` rows with the smallest hashes of ``columns``, on the driver; all rows if they are fewer.

    A threshold on the hash, from the number of rows, leaves hardly more than ``most``
    rows to be sent, however many partitions there are. No two rows may be alike in
    ``columns``: they would share a hash, and one repeated row could pass the threshold
    any number of times. ``rows`` is read twice.
    """
    n = rows.count()
    keyed = rows.withColumn("_order", F.xxhash64(*columns))
    if n > most:
        share = most / n * (1 + 6 / most**0.5)
        if share < 1:
            keyed = keyed.filter(F.col("_order") < int(share * 2**64) - 2**63)
    found = sorted(keyed.collect(), key=lambda r: (r["_order"], *(repr(r[c]) for c in columns)))
    return found[:most]
