"""Ranked lexical search by scanning documents with an automaton of the items' terms.

No index of documents is kept. The terms of the items make an Aho-Corasick automaton, each
term guarded by a separator on both sides, so that it matches whole terms only; the
automaton is broadcast, and each document's text runs through it once, which counts the
occurrences of every item term. These counts are written, since the weights need sums over
all documents first. Scores are integers: a term's share of a document is added to the
items that hold the term, and each task passes on its best documents for each item.

Items go in blocks whose terms have a bounded size, one scan of the documents per block.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sheaf.llm.common import in_chunks
from sheaf.session import stage

MOST = 10
#: Bytes of terms, and of their places in items, that one automaton is made of.
BLOCK_BYTES = 4 << 20
#: Cells of the table documents x items, and places, that a worker scores at a time.
CELLS = 1 << 21
#: Groups that the best documents of an item are thinned out in before they meet in one.
SALTS = 256

_SEPARATOR = 0x20
#: Bytes of UTF-8: ASCII digits and letters are terms, A-Z in lower case, and so is all that is not ASCII.
_TABLE = bytes(
    b if b >= 0x80 or chr(b).isalnum() and not chr(b).isupper() else b + 32 if chr(b).isupper() else _SEPARATOR
    for b in range(256)
)


def guarded(text: str | None) -> bytes:
    """The terms of a text in UTF-8, each between two separators."""
    return b" " + (text or "").encode("utf-8", "surrogatepass").translate(_TABLE) + b" "


def n_terms(guarded_text: bytes) -> int:
    inside = np.frombuffer(guarded_text, np.uint8) != _SEPARATOR
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]))


def item_terms(items: DataFrame, id_column: str = "item_id", column: str = "text") -> DataFrame:
    """``item, item_id, term, times``: the distinct terms of each row of ``items``, which ``item`` numbers."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in in_chunks([batch], "text", 1 << 20):
                rows = [
                    (item, own, term, times)
                    for item, own, text in zip(*(chunk.column(k).to_pylist() for k in range(3)))
                    for term, times in Counter(guarded(text).split()).items()
                ]
                yield pa.RecordBatch.from_pydict({
                    name: pa.array([r[k] for r in rows], kind)
                    for k, (name, kind) in enumerate(
                        [("item", pa.int64()), ("item_id", pa.int64()), ("term", pa.binary()), ("times", pa.int64())]
                    )
                })

    numbered = items.select(
        F.monotonically_increasing_id().alias("item"), F.col(f"`{id_column}`").cast("bigint").alias("item_id"),
        F.col(f"`{column}`").cast("string").alias("text"),
    )
    return numbered.mapInArrow(split, "item bigint, item_id bigint, term binary, times bigint")


def blocks(terms: DataFrame, most: int = BLOCK_BYTES) -> list[DataFrame]:
    """``terms`` cut by item into tables of at most ``most`` bytes each.

    An item that is larger alone is a block of its own.
    """
    size = F.sum(F.length("term") + 48)
    parts = max(1, -(-(terms.agg(size.alias("b")).first()["b"] or 0) // most))
    while True:
        part = F.pmod(F.xxhash64("item"), F.lit(parts))
        sizes = terms.groupBy(part.alias("part")).agg(size.alias("b"), F.count_distinct("item").alias("items"))
        if not sizes.filter((F.col("b") > most) & (F.col("items") > 1)).limit(1).count():
            return [terms.filter(part == k) for k in range(parts)]
        parts *= 2


class Vocabulary:
    """The terms of a block of items: their numbers, and the items that hold each."""

    def __init__(self, rows: list):
        self.items = sorted({(r["item"], r["item_id"]) for r in rows}, key=itemgetter(0))
        self.terms = sorted({bytes(r["term"]) for r in rows})
        place = {item: k for k, (item, _) in enumerate(self.items)}
        number = {term: k for k, term in enumerate(self.terms)}
        held = sorted((number[bytes(r["term"])], place[r["item"]], r["times"]) for r in rows)
        term, item, times = np.array(held, np.int64).reshape(-1, 3).T
        self.first = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.item, self.times = item, times

    @property
    def places(self) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        """Items, and where the terms stand in them, as plain values: what a broadcast can carry anywhere."""
        return self.items, self.first, self.item, self.times

    def automaton(self) -> ahocorasick.Automaton:
        """Reads UTF-8 as one character per byte."""
        found = ahocorasick.Automaton()
        for k, term in enumerate(self.terms):
            found.add_word((b" " + term + b" ").decode("latin-1"), k)
        found.make_automaton()
        return found


def scanned(docs: DataFrame, vocabulary: Vocabulary, column: str = "text") -> DataFrame:
    """``doc_id, n`` (terms of the document), ``terms, tf``: the block's terms in it, and how often."""
    sc = docs.sparkSession.sparkContext
    automaton = sc.broadcast(vocabulary.automaton())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, second = automaton.value.iter, itemgetter(1)
        for batch in batches:
            for chunk in in_chunks([batch], "text"):
                n, terms, tf = [], [], []
                for text in chunk.column("text").to_pylist():
                    own = guarded(text)
                    n.append(n_terms(own))
                    found = Counter(map(second, find(own.decode("latin-1"))))
                    terms.append(list(found))
                    tf.append(list(found.values()))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": chunk.column("doc_id"), "n": pa.array(n, pa.int64()),
                    "terms": pa.array(terms, pa.list_(pa.int32())), "tf": pa.array(tf, pa.list_(pa.int32())),
                })

    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(f"`{column}`").cast("string").alias("text")
    )
    return texts.mapInArrow(scan, "doc_id bigint, n bigint, terms array<int>, tf array<int>")


class Best:
    """The best documents of every item seen so far; equal scores by id, null ids last."""

    def __init__(self, items: int, most: int):
        self.most = most
        self.least = np.ones(items, np.int64)
        self.found = np.zeros((0, 4), np.int64)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.least)
        self.waiting.append(np.stack([item, -scores[doc, item], no_id[doc], ids[doc]], axis=1))
        self.n_waiting += len(doc)
        if self.n_waiting > 10 * self.most * len(self.least):
            self.thin()

    def thin(self) -> np.ndarray:
        rows = np.concatenate([self.found, *self.waiting])
        rows = rows[np.lexsort(rows.T[::-1])]
        first = np.searchsorted(rows[:, 0], np.arange(len(self.least) + 1))
        rank = np.arange(len(rows)) - first[rows[:, 0]]
        self.found, self.waiting, self.n_waiting = rows[rank < self.most], [], 0
        last = self.found[:, 0][(rank[rank < self.most] == self.most - 1)]
        self.least[last] = -self.found[rank[rank < self.most] == self.most - 1, 1]
        return self.found


def _flat(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64)


def scores_of(
    n: np.ndarray, lengths: np.ndarray, terms: np.ndarray, tf: np.ndarray, weights: np.ndarray,
    places: tuple[list, np.ndarray, np.ndarray, np.ndarray], n_docs: int, n_all: int,
) -> np.ndarray:
    """Scores (documents, items) of documents with ``n`` terms, ``lengths`` of them distinct item terms."""
    doc = np.repeat(np.arange(len(n)), lengths)
    m = 100 - 75 + (75 * n * n_docs) // max(n_all, 1)
    share = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
    items, first, item, times = places
    count = first[terms + 1] - first[terms]
    place = np.repeat(first[terms] - np.cumsum(count) + count, count) + np.arange(count.sum())
    scores = np.zeros(len(n) * len(items), np.int64)
    cell = np.repeat(doc, count) * len(items) + item[place]
    np.add.at(scores, cell, np.repeat(share, count) * times[place])
    return scores.reshape(len(n), -1)


def ranked_block(counts: DataFrame, vocabulary: Vocabulary, most: int = MOST) -> DataFrame:
    """``item, item_id, rank, doc_id, score`` from the counts of :func:`scanned`."""
    sums = counts.filter("n > 0").agg(F.count("n").alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_all = sums["docs"], sums["terms"] or 0
    weights = np.zeros(len(vocabulary.terms), np.int64)
    for r in counts.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        weights[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))
    known = counts.sparkSession.sparkContext.broadcast((vocabulary.places, weights))
    widest = int(np.diff(vocabulary.first).max(initial=1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, weights = known.value
        named = places[0]
        best = Best(len(named), most)
        rows = max(1, CELLS // len(named))
        for batch in batches:
            sizes = np.asarray(pa.compute.list_value_length(batch.column("terms")))
            # a document has each term once, so this bounds the places of a chunk
            cut = np.maximum(np.cumsum(sizes) * widest // (4 * CELLS), np.arange(len(sizes)) // rows)
            for part in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(cut)) + 1):
                chunk = batch.slice(part[0], len(part)) if len(part) else batch.slice(0, 0)
                ids = chunk.column("doc_id")
                scores = scores_of(
                    np.asarray(chunk.column("n")), sizes[part], _flat(chunk.column("terms")),
                    _flat(chunk.column("tf")), weights, places, n_docs, n_all,
                )
                best.add(scores, np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()).astype(np.int64))
        found = best.thin()
        items = np.array([item for item, _ in named], np.int64)
        own = [named[k][1] for k in found[:, 0]]
        yield pa.RecordBatch.from_pydict({
            "item": pa.array(items[found[:, 0]]), "item_id": pa.array(own, pa.int64()),
            "doc_id": pa.array(found[:, 3], mask=found[:, 2] == 1), "score": pa.array(-found[:, 1]),
        })

    rows = counts.filter("size(terms) > 0").mapInArrow(score, "item bigint, item_id bigint, doc_id bigint, score bigint")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # each task sends `most` rows an item at the most; two rounds keep the last group small, however many tasks
    thinned = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).withColumn(
        "rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))
    ).filter(F.col("rank") <= most)
    return thinned.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(
        F.col("rank") <= most
    ).select("item", "item_id", "rank", "doc_id", "score")


def ranked(
    docs: DataFrame, items: DataFrame, most: int = MOST, block_bytes: int = BLOCK_BYTES, column: str = "text"
) -> DataFrame:
    """``item, item_id, rank, doc_id, score``: the best documents for every row of ``items``.

    Null texts have no terms, and neither have texts of separators alone. Repeated rows of
    ``docs`` are ranked each; repeated rows of ``items`` are answered each and told apart by
    ``item``. Equal scores go by id, null ids last. An item without a document of positive
    score has no row; no documents or no items give an empty table. Only doc_id, item_id
    and the text are read, so further columns may have any name.
    """
    spark: SparkSession = docs.sparkSession
    terms = stage(item_terms(items), "search-terms")
    found = None
    for block in blocks(terms, block_bytes):
        rows = block.collect()
        if not rows:
            continue
        vocabulary = Vocabulary(rows)
        counts = stage(scanned(docs, vocabulary, column), "search-counts")
        best = ranked_block(counts, vocabulary, most)
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], "item bigint, item_id bigint, rank int, doc_id bigint, score bigint")
    return found
