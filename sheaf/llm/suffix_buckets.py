"""Repeated passages, by bucket-pointer refinement of suffixes.

A passage is a string of ``LENGTH`` bytes; every byte covered by one that also starts
anywhere else goes. Suffixes are compared to that depth only, and not one by one:

* **Initial buckets.** Every passage has an anchor, its smallest 32-byte gram by hash, and a
  distance to it. Passages that share an anchor and lie within ``width`` (128) bytes of one
  another share a gram of ``LENGTH - width + 1`` (273) bytes. The run of such passages is one
  row, a *piece*; its bucket is the gram's identifier. Equal passages have equal anchors and
  distances, so they are in the same bucket, wherever their documents stand. A piece alone
  in its bucket holds no repeated passage and is finished, as most are.
* **Refinement.** A piece equal as a whole to another is finished too: all of it is repeated.
  The others of a bucket are cut into pieces an eighth as wide, in which a passage starts up to 15
  bytes before, then at the start of, a longer gram. What that gram adds lies before and after
  the old one, so its identifier is made of the bucket identifier at the later offset where the
  old gram starts, and of the added bytes; the next refinement builds on that identifier in
  turn. After two refinements a piece is one passage.

Identifiers are hashes, so buckets are made by shuffle and no rank needs a global order. Two
passages count as equal if two 64-bit hashes agree, of the first gram and of the rest.

Texts are scanned twice: the first scan only counts buckets, the second returns pieces of
buckets that a bit table of bounded size lets through; what it lets through wrongly falls out
when pieces meet the counts. Texts are moved once, to be cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sheaf.llm.common import in_chunks, text_hash, text_or_empty
from sheaf.session import few_files, stage

LENGTH = 400
#: Starts of passages looked at together; their places and hash share a 64-bit number.
SEGMENT = 1 << 18
_PLACE = np.uint64((1 << 19) - 1)
#: A refined piece is this part of the one before.
FINER = 8
#: Bits of the table that pieces must pass: sixteen a bucket, within these bounds (32 MB).
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28

_FACTOR = 0x9E3779B97F4A7C15
_BYTES = np.array([xxhash.xxh3_64_intdigest(bytes([b]), 7) for b in range(256)], np.uint64)
_hash = xxhash.xxh3_64_intdigest


class Shape:
    """The lengths that follow from the length of a passage."""

    def __init__(self, length: int):
        if length < 8:
            raise ValueError("a passage has 8 bytes or more")
        self.length = length
        self.gram = 1 << (length // 8).bit_length() - 1
        self.width = 1 << (length // 3).bit_length() - 1

    def widths(self) -> list[int]:
        """Of the pieces, level by level; the last is 1."""
        found = [self.width]
        while found[-1] > 1:
            found.append(max(1, found[-1] // FINER))
        return found


def anchors(text: np.ndarray, shape: Shape) -> np.ndarray:
    """For every start of a passage in ``text`` (bytes), the place of its smallest gram, the first of equal ones."""
    n = len(text) - shape.length + 1
    grams, size, factor = _BYTES[text], 1, _FACTOR
    while size < shape.gram:
        grams = grams[:-size] * np.uint64(factor) + grams[size:]
        size, factor = size * 2, factor * factor % 2**64
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    window, size = shape.length - shape.gram + 1, 1
    while size * 2 <= window:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:n], least[window - size : window - size + n])
    return (least & _PLACE).astype(np.int64)


class Pieces:
    """The pieces of a column of texts."""

    def __init__(self, column: pa.Array, shape: Shape):
        self.shape = shape
        column = column.cast(pa.large_binary())
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        self.data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
        self.ends = ends - ends[0]
        parts = [self._segment(s) for s in range(0, len(self.data) - shape.length + 1, SEGMENT)]
        joined = [np.concatenate(p) for p in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 6
        #: Place of the shared gram in the data, least and greatest distance of a start before it, row.
        self.at, self.lo, self.hi, self.row, self.bucket, self.whole = joined

    def _segment(self, start: int) -> tuple[np.ndarray, ...]:
        """Pieces whose passages start in a segment of the data."""
        shape, width = self.shape, self.shape.width
        text = self.data[start : start + SEGMENT + shape.length - 1]
        n = len(text) - shape.length + 1
        first = int(np.searchsorted(self.ends, start, "right")) - 1
        last = int(np.searchsorted(self.ends, start + n, "left"))
        ends = self.ends[first : last + 1] - start
        fits = np.zeros(n + 1, np.int8)
        opens, closes = np.clip(ends[:-1], 0, n), np.clip(ends[1:] - shape.length + 1, 0, n)
        some = closes > opens
        fits[opens[some]] += 1
        fits[closes[some]] -= 1
        place = np.flatnonzero(np.cumsum(fits[:-1], dtype=np.int8))
        if not len(place):
            return tuple(np.zeros(0, np.int64) for _ in range(6))
        anchor = anchors(text, shape)[place]
        distance = (anchor - place) // width
        new = np.flatnonzero(
            (np.diff(place) != 1) | (np.diff(anchor) != 0) | (np.diff(distance) != 0)
        ) + 1
        begin, stop = np.concatenate([[0], new]), np.concatenate([new, [len(place)]]) - 1
        far = distance[begin]
        at = anchor[begin] - far * width
        lo, hi = at - place[stop], at - place[begin]
        raw, core = text.tobytes(), shape.length - width + 1
        bucket = [_hash(raw[a : a + core], k) for a, k in zip(at.tolist(), far.tolist())]
        whole = [
            _hash(raw[a - h : a - b + shape.length], h * width + b) for a, b, h in zip(at.tolist(), lo.tolist(), hi.tolist())
        ]
        row = np.searchsorted(self.ends, start + place[begin], "right") - 1
        return at + start, lo, hi, row, _signed(bucket), _signed(whole)

    def grouped(self) -> tuple[np.ndarray, np.ndarray]:
        """An order of the pieces by class, and where in it each class begins."""
        order = np.lexsort((self.whole, self.bucket))
        bucket, whole = self.bucket[order], self.whole[order]
        new = (np.diff(bucket) != 0) | (np.diff(whole) != 0)
        return order, np.flatnonzero(np.concatenate([[True], new]))[: len(order)]


def _signed(hashes: list[int]) -> np.ndarray:
    return np.array(hashes, np.uint64).view(np.int64)


def bucket_counts(texts: DataFrame, shape: Shape) -> DataFrame:
    """``bucket, mixed`` of the buckets with several pieces.

    ``mixed`` if a piece differs from all others of its bucket; else all pieces are repeated.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in in_chunks([batch], "text"):
                found = Pieces(chunk.column("text"), shape)
                order, new = found.grouped()
                yield pa.RecordBatch.from_pydict({
                    "bucket": found.bucket[order[new]], "whole": found.whole[order[new]],
                    "n": np.diff(new, append=len(order)).astype(np.int64),
                })

    classes = texts.select("text").mapInArrow(count, "bucket bigint, whole bigint, n bigint").groupBy(
        "bucket", "whole"
    ).agg(F.sum("n").alias("n"))
    return classes.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.max((F.col("n") == 1).cast("int")).alias("single")
    ).filter("n > 1").select("bucket", (F.col("single") == 1).alias("mixed"))


def bit_table(buckets: DataFrame) -> np.ndarray:
    """Words of a table of bits, one of them set for each bucket; at most ``MOST_BITS``, however many there are."""
    n = buckets.count()
    bits = min(max(1 << (16 * n).bit_length(), LEAST_BITS), MOST_BITS)
    bit = F.pmod("bucket", F.lit(bits))
    words = buckets.groupBy(F.floor(bit / 64).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 64).cast("int"))).alias("set")
    ).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[np.asarray(words["word"])] = np.asarray(words["set"])
    return table.view(np.uint64)


def _passes(table: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    bit = bucket.view(np.uint64) % np.uint64(len(table) * 64)
    return (table[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


PIECE = (
    "bucket bigint, part bigint, whole bigint, known boolean, doc_id bigint, text_hash bigint, at bigint, "
    "lo int, hi int, before binary, after binary"
)


def found_pieces(texts: DataFrame, several: np.ndarray, mixed: np.ndarray, shape: Shape) -> DataFrame:
    """Pieces whose bucket the tables let through.

    ``before`` and ``after`` are the bytes around the shared gram, where the bucket may be mixed.
    A class that is repeated within a batch is settled there: its stretches come back joined,
    without a bucket, and one piece of it, as ``known``, for others to be compared with.
    """
    sc = texts.sparkSession.sparkContext
    tables = sc.broadcast((several, mixed))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        several, mixed = tables.value
        for batch in batches:
            for chunk in in_chunks([batch], "text"):
                yield _found(chunk, Pieces(chunk.column("text"), shape), several, mixed, shape)

    return texts.mapInArrow(find, PIECE)


def _found(
    chunk: pa.RecordBatch, p: Pieces, several: np.ndarray, mixed: np.ndarray, shape: Shape
) -> pa.RecordBatch:
    order, new = p.grouped()
    sizes = np.diff(new, append=len(order))
    repeated = np.zeros(len(order), bool)
    repeated[order] = np.repeat(sizes > 1, sizes)
    maybe = _passes(mixed, p.bucket)
    example = np.zeros(len(order), bool)
    example[order[new]] = True
    keep = np.flatnonzero(np.where(repeated, example & maybe, _passes(several, p.bucket)))
    at, lo, hi = p.at[keep], p.lo[keep], p.hi[keep]
    core = shape.length - shape.width + 1
    raw = p.data
    before, after = [], []
    for a, b, h, m in zip(at.tolist(), lo.tolist(), hi.tolist(), maybe[keep].tolist()):
        before.append(raw[a - h : a].tobytes() if m else None)
        after.append(raw[a + core : a + shape.length - b].tobytes() if m else None)
    # stretches of the batch's own repeats, joined where they touch within a document
    sure = np.flatnonzero(repeated)
    start, stop, row = p.at[sure] - p.hi[sure], p.at[sure] - p.lo[sure] + shape.length, p.row[sure]
    cut = np.flatnonzero((row[1:] != row[:-1]) | (start[1:] > stop[:-1])) + 1
    begin = np.concatenate([[0], cut]).astype(np.int64)[: len(sure)]
    end = np.concatenate([cut, [len(sure)]]).astype(np.int64)[: len(begin)] - 1
    rows = np.concatenate([p.row[keep], row[begin]])
    n, m = len(keep), len(begin)
    place = np.concatenate([at, start[begin]]) - p.ends[rows]
    taken = pa.array(rows)
    none = np.concatenate([np.zeros(n, bool), np.ones(m, bool)])

    def padded(values: np.ndarray) -> pa.Array:
        return pa.array(np.concatenate([values, np.zeros(m, values.dtype)]), mask=none)

    return pa.RecordBatch.from_arrays([
        padded(p.bucket[keep]), padded(np.zeros(n, np.int64)), padded(p.whole[keep]),
        pa.array(np.concatenate([repeated[keep], np.ones(m, bool)])),
        chunk.column("doc_id").take(taken), chunk.column("text_hash").take(taken),
        pa.array(place),
        # a stretch is told as a piece is: it reaches from at - hi to at - lo + length
        pa.array(np.concatenate([lo, shape.length - (stop[end] - start[begin])]), pa.int32()),
        pa.array(np.concatenate([hi, np.zeros(m, np.int64)]), pa.int32()),
        pa.array([*before, *[None] * m], pa.binary()), pa.array([*after, *[None] * m], pa.binary()),
    ], names=[c.split()[0] for c in PIECE.split(", ")])


def stretches(pieces: DataFrame, length: int) -> DataFrame:
    """``doc_id, text_hash, start, stop`` that the passages of pieces cover."""
    return pieces.select(
        "doc_id", "text_hash", (F.col("at") - F.col("hi")).alias("start"),
        (F.col("at") - F.col("lo") + length).alias("stop"),
    )


SAME = ["bucket", "part", "whole"]


def settled(pieces: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """What the pieces' classes decide: stretches found repeated, and the classes with one piece each."""
    first = [F.first(c).alias(c) for c in ("doc_id", "text_hash", "at", "lo", "hi", "before", "after")]
    classes = stage(
        few_files(pieces.groupBy(*SAME).agg(F.count("*").alias("n"), F.max("known").alias("known"), *first)),
        "passage-classes",
    )
    repeated = pieces.filter("not known").join(classes.filter("n > 1").select(*SAME), SAME)
    return stretches(repeated, length), classes


def unsettled(classes: DataFrame) -> DataFrame:
    """The pieces of :func:`settled` that are to be refined.

    They are those of buckets with several classes, one of which is a single piece not
    known to be repeated.
    """
    alone = (F.col("n") == 1) & ~F.col("known")
    open_ = stage(
        few_files(classes.groupBy("bucket", "part").agg(
            F.count("*").alias("classes"), F.max(alone.cast("int")).alias("alone")
        ).filter("classes > 1 and alone = 1").select("bucket", "part")),
        "passage-open",
    )
    return classes.join(open_, ["bucket", "part"]).withColumn("known", ~alone).drop("n")


def refined(pieces: DataFrame, width: int, finer: int) -> DataFrame:
    """The pieces cut into pieces of width ``finer``, with identifiers of the longer grams."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in PIECE.split(", ")]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for r in batch.to_pylist():
                lo, hi, before, after = r["lo"], r["hi"], r["before"], r["after"]
                old = r["part"].to_bytes(8, "little", signed=True)
                for c in range(lo // finer * finer, hi + 1, finer):
                    low, high, reach = max(c, lo), min(c + finer - 1, hi), width - c - finer
                    part = _hash(old + before[hi - c :] + after[:reach], c)
                    head, tail = before[hi - high : hi - c], after[reach : width - 1 - low]
                    whole = _hash(part.to_bytes(8, "little") + head + tail, (high - c) * finer + low - c)
                    row = (
                        r["bucket"], part - (part >> 63 << 64), whole - (whole >> 63 << 64), r["known"],
                        r["doc_id"], r["text_hash"], r["at"] - c, low - c, high - c, head, tail,
                    )
                    for column, value in zip(out, row):
                        column.append(value)
            kinds = batch.schema
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, kinds.field(k).type) for k, v in zip(names, out)], names=names
            )

    return pieces.select(*[c.split()[0] for c in PIECE.split(", ")]).mapInArrow(cut, PIECE)


def repeated_stretches(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, text_hash, start, stop`` of bytes of ``texts`` covered by repeated passages.

    ``texts`` has doc_id, text (not null) and text_hash. Stretches may overlap and repeat.
    """
    shape = Shape(length)
    buckets = stage(few_files(bucket_counts(texts, shape)), "passage-buckets")
    found = stage(
        found_pieces(texts, bit_table(buckets), bit_table(buckets.filter("mixed")), shape), "passage-pieces"
    )
    # buckets without an odd piece are repeated throughout
    plain = found.filter("not known").join(buckets.filter("not mixed").select("bucket"), "bucket")
    covered = stretches(found.filter("bucket is null"), length).unionByName(stretches(plain, length))
    pieces = stage(
        few_files(found.filter("bucket is not null and before is not null").join(
            buckets.filter("mixed").select("bucket"), "bucket", "leftsemi"
        )),
        "passage-mixed",
    )
    widths = shape.widths()
    for width, finer in zip(widths, [*widths[1:], 0]):
        repeated, classes = settled(pieces, length)
        covered = covered.unionByName(repeated)
        if finer:
            pieces = stage(few_files(refined(unsettled(classes), width, finer)), "passage-refined")
    return covered


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in in_chunks([batch], "text"):
            rows = [
                cut(text, found) for text, found in
                zip(chunk.column("text").cast(pa.binary()).to_pylist(), chunk.column("found").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([
                chunk.column("doc_id"), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)),
                pa.array([r[3] for r in rows], pa.binary()), pa.array([r[4] for r in rows], pa.list_(pa.int64())),
            ], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_bytes", "removed"])


def cut(text: bytes, found: list[dict] | None) -> tuple[int, int, int, bytes, list[int]]:
    """Bytes, bytes removed, runs removed, what is left, and starts and ends of the runs, in turn."""
    if not found:
        return len(text), 0, 0, text, []
    spans = np.array([(f["start"], f["stop"]) for f in found], np.int64)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > reach[:-1]]))
    start, stop = spans[new, 0], reach[np.append(new[1:], len(spans)) - 1]
    kept, last = [], 0
    for a, b in zip(start.tolist(), stop.tolist()):
        kept.append(text[last:a])
        last = b
    kept.append(text[last:])
    return len(text), int((stop - start).sum()), len(start), b"".join(kept), np.stack([start, stop], 1).ravel().tolist()


def without_repeated_passages(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_bytes, removed.

    ``kept_bytes`` is what is left of the text's UTF-8 bytes, which may begin or end inside a
    character; ``removed`` lists starts and ends of the removed runs. Null text counts as empty;
    a text shorter than ``length`` bytes loses nothing. Repeated rows count as different places,
    so of two equal long texts, with equal ids or not, nothing stays. Passages may overlap
    themselves. An empty table gives an empty table. Only doc_id and text are read, so further
    columns may have any name.
    """
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"), text_hash().alias("text_hash")
    )
    found = stage(
        few_files(repeated_stretches(texts, length).groupBy("doc_id", "text_hash").agg(
            F.collect_set(F.struct("start", "stop")).alias("found")
        )),
        "passage-stretches",
    ).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("own"), "found")
    return texts.join(
        found, texts["doc_id"].eqNullSafe(found["id"]) & (texts["text_hash"] == found["own"]), "left"
    ).select("doc_id", "text", "found").mapInArrow(
        _cut_texts,
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_bytes binary, removed array<bigint>",
    )
