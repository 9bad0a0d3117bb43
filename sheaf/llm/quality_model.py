"""A quality score for documents: boosted trees over statistics of the text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sheaf.llm.boosting import Trees, fit
from sheaf.llm.common import in_chunks, sampled, text_or_empty
from sheaf.session import stage

#: The most labelled documents the trees are trained on: those with the smallest hashes of their ids.
TRAINING_ROWS = 20_000
HELD_OUT = 2
PREDICTED_FROM = 0.7

_CLASSES = {
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "small": b"abcdefghijklmnopqrstuvwxyz", "digits": b"0123456789",
    "stops": b".,;:?", "calls": b"!", "symbols": b"#*$%&<>", "bars": b"|", "quotes": b"\"'", "lines": b"\n",
    "spaces": b" \t\r\x0b\x0c",
}
FEATURES = [
    *_CLASSES, "beyond_ascii", "log_bytes", "log_words", "bytes_per_word", "distinct_words", "commonest_word",
    "distinct_pairs", "words_per_line", "repeated_lines", "longest_word",
]
_BYTE_CLASS = np.full(256, len(_CLASSES) + 1, dtype=np.int64)
for _k, _chars in enumerate(_CLASSES.values()):
    _BYTE_CLASS[list(_chars)] = _k
_BYTE_CLASS[128:] = len(_CLASSES)


def statistics(text: bytes) -> list[float]:
    """The features of one text, ``FEATURES`` in order; shares of bytes, words, pairs and lines."""
    counts = np.bincount(
        _BYTE_CLASS, np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256), len(_CLASSES) + 2
    )
    n = max(len(text), 1)
    words = text.split()  # bytes are split at [\x20\x09-\x0D]
    w = max(len(words), 1)
    seen = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [
        *(counts[: len(_CLASSES) + 1] / n).tolist(), float(np.log1p(len(text))), float(np.log1p(len(words))),
        len(text) / w, len(seen) / w, max(seen.values(), default=0) / w,
        len(set(zip(words, words[1:], strict=False))) / max(w - 1, 1),
        w / max(len(lines), 1), 1 - len(set(lines)) / max(len(lines), 1), float(min(max(map(len, seen), default=0), 1000)),
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``features`` for every row of ``docs`` (doc_id, text); null text counts as empty."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            rows = np.array([statistics(t) for t in texts]).reshape(len(texts), len(FEATURES))
            offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))],
                names=["doc_id", "features"],
            )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(measure, "doc_id bigint, features array<double>")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def learn(measured: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> Trees:
    """Trees from labelled rows outside the held-out fold; ``most`` bounds what comes to the driver.

    Labels that are null or not 0 or 1 are left out, as are ids labelled both ways.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality").filter(
        F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != HELD_OUT)
    ).groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("other")).filter("label = other")
    examples = measured.join(known, "doc_id").select("doc_id", "features", "label").dropDuplicates(["doc_id", "features"])
    rows = sampled(stage(examples, "quality-labelled"), most, "doc_id", "features")
    features = np.array([r["features"] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    return fit(features, np.array([r["label"] for r in rows], dtype=float))


def scored(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs`` (doc_id, text; others are ignored).

    Null and empty texts are scored like any other, rows that share an id each by its own
    text. A null id is not held out. Without usable labels every score is one half.
    """
    measured = stage(with_statistics(docs), "quality-features")
    trees = learn(measured, labels, most)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.asarray(batch.column("features").flatten()).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(trees.probability(flat))], names=["doc_id", "score"]
            )

    return measured.mapInArrow(score, "doc_id bigint, score double").select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted"),
    )
