"""Token counts from flat token files: ids of two bytes, no index, one id at the end of each document.

Files are cut into blocks. Each block is searched for the end id on its own, in numpy;
it gives the lengths of the documents that lie inside it, the tokens before its first
end, and those after its last. A prefix scan over the blocks of a file, or of several
files that follow each other, then adds up what runs over block borders, however many
blocks a document spans, and numbers the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sheaf.llm.common import in_chunks, text_or_empty
from sheaf.session import stage, staged_path

END_ID = 2
WIDTH = 2
BLOCK_BYTES = 1 << 20
#: Bytes of ids after which the writer begins another file; a file is read as one value before it is cut.
FILE_BYTES = 32 << 20

BLOCKS = "path string, block int, n_tokens bigint, head bigint, inner array<bigint>, tail bigint, n_ends bigint"


@lru_cache(maxsize=2)
def _pieces(model_path: str):  # noqa: ANN202
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path)


@contextmanager
def same_splits(spark: SparkSession) -> Iterator[None]:
    """Scans of a table inside are dealt to partitions alike, also if executors come or go between them."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def write_token_files(docs: DataFrame, model_path: str, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Writes the ids of every document of ``docs`` (text), in its order, each followed by the end id.

    A file ends with the document that brings it to ``file_bytes``, so it is larger than
    that by less than one document. It is one record of Spark's text sink, whose line
    separator writes the last end id: the two bytes of that id are two ASCII signs, and
    the encoder never gives it. Null and empty texts are an end alone.
    """

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, rows, size = _pieces(model_path), [], 0

        def record() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([end.join(rows)], pa.binary())], names=["ids"])

        for batch in in_chunks(batches, "text"):
            for text in batch.column("text").to_pylist():
                ids = np.array(model.encode(text, num_threads=1), dtype=np.int64)
                if (ids == END_ID).any() or ids.max(initial=0) >= 1 << 8 * WIDTH:
                    raise ValueError("an id is the end of a document, or too large for the file")
                rows.append(ids.astype(f"<u{WIDTH}").tobytes())
                size += len(rows[-1]) + WIDTH
                if size >= file_bytes:
                    yield record()
                    rows, size = [], 0
        if rows:
            yield record()

    end = END_ID.to_bytes(WIDTH, "little")
    flat = docs.select(text_or_empty().alias("text")).mapInArrow(tokens, "ids binary")
    flat.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", end.decode("ascii")).option(
        "compression", "none"
    ).option("maxRecordsPerFile", 1).text(path)


def blocks_of(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES, end_id: int = END_ID) -> DataFrame:
    """One row per block of the files under ``path``, see the head of the module.

    A file is one value until it is cut, so it must be below Spark's limit of 2 GB. A
    file whose size is not a whole number of ids is refused.
    """
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("path", "length", "content")
    n = F.ceil(F.col("length") / block_bytes).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.substring("content", i * block_bytes + 1, F.lit(block_bytes))
    )
    blocks = files.select("path", F.posexplode(cut).alias("block", "bytes"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "bytes"):
            rows = []
            for raw in batch.column("bytes"):
                data = raw.as_buffer()
                if data.size % WIDTH:
                    raise ValueError("a token file does not hold a whole number of ids")
                ids = np.frombuffer(data, dtype=f"<u{WIDTH}")
                ends = np.flatnonzero(ids == end_id)
                head = int(ends[0]) if len(ends) else len(ids)
                tail = len(ids) - 1 - int(ends[-1]) if len(ends) else 0
                rows.append((len(ids), head, np.diff(ends) - 1, tail, len(ends)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), batch.column("block"), *(pa.array(list(c), t) for c, t in zip(columns, types, strict=True))],
                names=["path", "block", "n_tokens", "head", "inner", "tail", "n_ends"],
            )

    return blocks.mapInArrow(search, BLOCKS)


def stitched(blocks: DataFrame, stream: str = "path", order: tuple[str, ...] = ("block",)) -> DataFrame:
    """``stream, nth`` (document in its stream, from 0), ``n_tokens`` without the end id, ``ended``.

    A stream is what the blocks with one value of the column ``stream`` hold, by
    ``order``: a file, or files that follow each other. Tokens after its last end are a
    document that has not ended. A window holds the blocks of one stream, some thousands
    at most.
    """
    in_stream = Window.partitionBy(stream).orderBy(*order)
    before = in_stream.rowsBetween(Window.unboundedPreceding, -1)
    # what a block hands on: all of it without an end, else what follows its last end
    scan = blocks.withColumn("left_over", F.when(F.col("n_ends") > 0, F.col("tail")).otherwise(F.col("n_tokens")))
    scan = scan.withColumn("since", F.sum((F.col("n_ends") > 0).cast("int")).over(in_stream))
    scan = scan.withColumn("open", F.sum("left_over").over(Window.partitionBy(stream, "since").orderBy(*order)))
    scan = scan.withColumns({
        "carried": F.coalesce(F.lag("open").over(in_stream), F.lit(0)),
        "nth_first": F.coalesce(F.sum("n_ends").over(before), F.lit(0)),
        "is_last": F.lead("block").over(in_stream).isNull(),
    })
    whole = F.when(
        F.col("n_ends") > 0, F.concat(F.array(F.col("carried") + F.col("head")), F.col("inner"))
    ).otherwise(F.array().cast("array<bigint>"))
    docs = scan.select(stream, "nth_first", F.posexplode(whole).alias("k", "n_tokens")).select(
        stream, (F.col("nth_first") + F.col("k")).alias("nth"), "n_tokens", F.lit(True).alias("ended")
    )
    unended = scan.filter("is_last and open > 0").select(
        stream, (F.col("nth_first") + F.col("n_ends")).alias("nth"), F.col("open").alias("n_tokens"), F.lit(False).alias("ended")
    )
    return docs.unionByName(unended)


def token_counts(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES, end_id: int = END_ID) -> DataFrame:
    """Tokens of every document in the flat files under ``path``; no files, or empty ones, give no rows."""
    return stitched(stage(blocks_of(spark, path, block_bytes, end_id), "token-blocks"))


def counted_documents(docs: DataFrame, model_path: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``doc_id, n_tokens, shard, position`` of every row of ``docs``, by way of flat token files.

    A task writes the files of a shard, in which ``position`` counts from 0.

    ``docs`` must be a plain scan of files: it is read twice, once for the token files and
    once for the ids in the same order, and the two are held against each other.
    """
    spark = docs.sparkSession
    path = staged_path(spark, "token-files")
    with same_splits(spark):
        write_token_files(docs, model_path, path, file_bytes)
        at = F.monotonically_increasing_id()
        order = stage(docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), F.shiftright(at, 33).cast("int").alias("shard"),
            at.bitwiseAND(F.lit((1 << 33) - 1)).alias("position"),
        ), "token-order")
    part, nth_file = (F.regexp_extract("path", r"part-(\d+)-.*-c(\d+)[^/]*$", g).cast("bigint") for g in (1, 2))
    blocks = stage(blocks_of(spark, path), "token-blocks").select("*", part.cast("int").alias("shard"), nth_file.alias("nth_file"))
    counts = stitched(blocks, "shard", ("nth_file", "block")).select("shard", F.col("nth").alias("position"), "n_tokens")
    both = order.join(counts, ["shard", "position"], "full")
    whole = F.col("n_tokens").isNotNull() & F.coalesce(F.col("position") >= 0, F.lit(False))
    fault = F.raise_error("the documents were dealt differently while they were read").cast("bigint")
    return both.select("doc_id", F.when(whole, F.col("n_tokens")).otherwise(fault).alias("n_tokens"), "shard", "position")
