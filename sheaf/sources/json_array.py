"""Files that hold one JSON value, normally a long array, read by many tasks.

Spark cuts a text file into byte ranges if it knows what separates its rows. A comma does:
it separates the items of an array, and though it also stands in strings and inside items,
a row never has to be larger than an item. Where a range lies in the structure depends on
all bytes before it, but what a range does to that is short: whether it holds an odd
number of quotes, and how much deeper it leaves off, if entered outside of a string or
inside of one. One row per range is summed up, running sums give every range its entry,
and in a second scan each range cuts its own items. Only items that cross a border between
ranges are put together by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheaf.functions.binding import let
from sheaf.functions.json_text import canonical, root_kind
from sheaf.operators.ordering import MAX_BROADCAST_RANGES, running_sums
from sheaf.session import stage

QUOTE, BACKSLASH, COMMA = 34, 92, 44
BOM = b"\xef\xbb\xbf"
BLANKS = b" \t\n\r"
COMPRESSED = r"\.(gz|gzip|bz2|deflate|lz4|snappy|zst|zstd)\z"
RANGE = ["path", "split_start"]
_STEP = np.zeros(256, np.int8)
_STEP[[91, 123]], _STEP[[93, 125]] = 1, -1


@dataclass
class Structure:
    """What stands where in a stretch of bytes that is entered outside of a string."""

    data: np.ndarray
    #: Number of quotes up to and with each byte, modulo 2.
    odd: np.ndarray
    step: np.ndarray

    @staticmethod
    def of(text: bytes) -> Structure:
        data = np.frombuffer(text, np.uint8)
        places = np.arange(len(data))
        # a quote is one unless an odd number of backslashes stands before it
        other = np.maximum.accumulate(np.where(data != BACKSLASH, places, -1)) if len(data) else places
        quotes = np.flatnonzero(data == QUOTE)
        before = quotes - 1 - np.where(quotes > 0, other[quotes - 1], -1)
        marks = np.zeros(len(data), np.uint8)
        marks[quotes[before % 2 == 0]] = 1
        return Structure(data, np.bitwise_xor.accumulate(marks), _STEP[data])

    def change(self, inside: int) -> int:
        """How much deeper the stretch leaves off; ``inside`` is 1 if it is entered in a string."""
        return int(self.step[self.odd == inside].sum())

    def leaves_inside(self, inside: int) -> int:
        return inside ^ (int(self.odd[-1]) if len(self.odd) else 0)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool, bytes]]:
    """Batches cut by byte range, whether each is the first of its range, and its bytes with their commas."""
    last = None
    for batch in batches:
        paths, starts = batch.column("path").to_pylist(), batch.column("split_start").to_pylist()
        keys = list(zip(paths, starts, strict=True))
        at = 0
        while at < len(keys):
            end = at + 1
            while end < len(keys) and keys[end] == keys[at]:
                end += 1
            part, new = batch.slice(at, end - at), keys[at] != last
            text = b",".join(part.column("value").to_pylist())
            yield part, new, text if new else b"," + text
            last, at = keys[at], end


def scanned(spark: SparkSession, path: str) -> DataFrame:
    """``path, split_start, size, pos, value`` (bytes): the stretches between commas, in order."""
    return spark.read.text(path, lineSep=",").select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split_start"),
        F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("pos"),
        F.col("value").cast("binary").alias("value"),
    )


SUMMARY = (
    "path string, split_start bigint, size bigint, bytes bigint, quotes bigint, outside bigint, inside bigint, root string"
)


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SUMMARY.split(", ")]
    now: list | None = None

    def row() -> pa.RecordBatch:
        kinds = [pa.string(), *[pa.int64()] * 6, pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(now, kinds, strict=True)], names=names)

    for part, new, text in _ranges(batches):
        if new:
            if now is not None:
                yield row()
            key = [part.column(c)[0].as_py() for c in ("path", "split_start", "size")]
            now = [*key, 0, 0, 0, 0, None]
        found = Structure.of(text)
        now[3] += len(text)
        odd = now[4] % 2
        now[4] += found.leaves_inside(0)
        now[5] += found.change(odd)
        now[6] += found.change(1 - odd)
        if now[7] is None:
            head = text.removeprefix(BOM).lstrip(BLANKS)
            now[7] = head[:1].decode("latin-1") or None
    if now is not None:
        yield row()


def entries(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """``path, split_start, in_string, depth, is_array`` at the start of every range.

    Ends the job if a file is empty, ends inside a string or an item, or after a comma.
    """
    ranges = stage(rows.mapInArrow(_summarise, SUMMARY), "json-ranges")
    placed = running_sums(ranges, ["split_start"], {"quotes": "_quotes"}, within=["path"])
    entered = F.pmod("_quotes", F.lit(2))
    placed = placed.withColumn("in_string", entered.cast("int")).withColumn(
        "change", F.when(entered == 1, F.col("inside")).otherwise(F.col("outside"))
    )
    placed = running_sums(placed, ["split_start"], {"change": "depth"}, within=["path"])
    files = placed.groupBy("path").agg(
        F.min_by("root", "split_start").alias("root"), F.sum("quotes").alias("quotes"), F.sum("change").alias("left"),
        (F.sum("bytes") + F.count("*") - 1).alias("bytes"), F.max("size").alias("size"),
    )
    # Spark drops a comma at the end of a file, and may drop the mark at its start
    whole = (F.col("size") - F.col("bytes")).isin(0, len(BOM)) | F.col("path").rlike(COMPRESSED)
    fine = whole & (F.col("quotes") % 2 == 0) & (F.col("left") == 0) & F.col("root").isNotNull()
    every = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"))
    files = stage(every.join(files, "path", "left").select("path", F.coalesce(fine, F.lit(False)).alias("fine"), "root"), "json-files")
    broken = files.filter("not fine").first()
    if broken is not None:
        raise ValueError(f"broken JSON, the file is not one JSON value: {broken['path']}")
    # one row per file against one per range of it
    return placed.join(files.select("path", (F.col("root") == "[").alias("is_array")), "path").select(
        *RANGE, "in_string", "depth", "is_array"
    )


FRAGMENT = "path string, split_start bigint, nth bigint, begins boolean, ends boolean, junk boolean, item binary"


class _Cutter:
    """Cuts one range into items: what it holds of each, and how many ended before it."""

    def __init__(self, start: int, in_string: int, depth: int, is_array: bool):
        self.start, self.inside, self.depth, self.is_array = start, in_string, depth, is_array
        self.nth = 0
        #: Whether the current item begins in this range; before the array opens there is none.
        self.begins = in_string == 0 and depth == 1 and start > 0
        self.held: list[bytes] = []
        self.open = not is_array or depth > 0 or in_string == 1
        self.out: list[tuple[int, bool, bool, bool, bytes]] = []

    def _end(self, ends: bool) -> None:
        self.out.append((self.nth, self.begins, ends, False, b"".join(self.held)))
        self.held = []
        self.nth += ends
        self.begins = True

    def _between(self, text: bytes) -> None:
        """Bytes before the array opens or after it closes: there should only be blanks."""
        if text.strip(BLANKS):
            self.out.append((self.nth, True, False, True, b""))

    def read(self, text: bytes) -> None:
        if not self.is_array:
            self.held.append(text)
            return
        found = Structure.of(text)
        outside = found.odd == self.inside
        step = np.where(outside, found.step, 0)
        depth = self.depth + np.cumsum(step, dtype=np.int64)
        commas = (found.data == COMMA) & outside & (depth == 1)
        opens, closes = (step == 1) & (depth == 1), (step == -1) & (depth == 0)
        done = 0
        for k in np.flatnonzero(commas | opens | closes).tolist():
            if commas[k]:
                self.held.append(text[done:k])
                self._end(True)
            elif opens[k]:
                self._between(text[done:k])
                self.open, self.begins = True, True
                if found.data[k] != 91 or self.nth:
                    self._between(b"x")  # a second value, or an object after the array
            else:
                self.held.append(text[done:k])
                self._end(True)
                self.open = False
                if found.data[k] != 93:
                    self._between(b"x")
            done = k + 1
        if self.open:
            self.held.append(text[done:])
        else:
            self._between(text[done:])
        self.inside = found.leaves_inside(self.inside)
        self.depth = int(depth[-1]) if len(depth) else self.depth

    def finish(self) -> list[tuple]:
        if not self.is_array:
            return [(0, self.start == 0, False, False, b"".join(self.held))]
        if self.open:
            # a comma follows every range but a file's last, which leaves no array open
            self._end(self.inside == 0 and self.depth == 1)
        return self.out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in FRAGMENT.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.binary()]
    cutter, key = None, None

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*[(*key, *f) for f in found], strict=True)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for part, new, text in _ranges(batches):
        if new:
            if cutter:
                yield rows(cutter.finish())
            key = tuple(part.column(c)[0].as_py() for c in RANGE)
            cutter = _Cutter(key[1], *(part.column(c)[0].as_py() for c in ("in_string", "depth", "is_array")))
            text = text.removeprefix(BOM) if key[1] == 0 else text
        cutter.read(text)
        if cutter.out:
            done, cutter.out = cutter.out, []
            yield rows(done)
    if cutter:
        yield rows(cutter.finish())


def read_items(spark: SparkSession, path: str, most_broadcast: int = MAX_BROADCAST_RANGES) -> DataFrame:
    """``path, item_no, is_array, item``: the items of files that hold one JSON value each.

    An array gives its items as they are written, numbered from 0; any other value is the
    one item of its file. A blank item is kept where it stands for a mistake (``[1,,2]``),
    and left out if it is all an array holds. A file that is not one value ends the job,
    or has items that are not (see :func:`checked_items`).
    """
    rows = scanned(spark, path)
    at = stage(entries(spark, path, rows), "json-entries")
    if at.count() <= most_broadcast:
        entered = rows.join(F.broadcast(at), RANGE)
    else:
        entered = rows.join(at, RANGE).repartition(*RANGE).sortWithinPartitions(*RANGE, "pos")
    columns = [*RANGE, "value", "in_string", "depth", "is_array"]
    found = stage(entered.select(columns).mapInArrow(_cut, FRAGMENT), "json-fragments")
    ended = found.groupBy(*RANGE).agg(F.sum(F.col("ends").cast("int")).alias("ended"), F.max("junk").alias("junk"))
    based = stage(running_sums(ended, ["split_start"], {"ended": "_base"}, within=["path"]), "json-bases")
    odd = based.filter("junk").first()
    if odd is not None:
        raise ValueError(f"broken JSON, the file is not one JSON value: {odd['path']}")
    base = based.select(*RANGE, "_base")
    arrays = at.groupBy("path").agg(F.first("is_array").alias("is_array"), F.count("*").alias("ranges"))
    numbered = found.join(F.broadcast(base) if based.count() <= most_broadcast else base, RANGE).withColumn(
        "item_no", F.col("_base") + F.col("nth")
    )
    whole = numbered.filter("begins and ends").select("path", "item_no", "item")
    # an item is put together from as many ranges as it is long
    joined = numbered.filter("not (begins and ends)").groupBy("path", "item_no").agg(
        F.array_sort(F.collect_list(F.struct("split_start", F.col("item").cast("string").alias("item")))).alias("parts")
    ).select("path", "item_no", F.array_join("parts.item", ",").cast("binary").alias("item"))
    items = whole.unionByName(joined).join(arrays, "path")
    total = found.groupBy("path").agg(F.sum(F.col("ends").cast("int")).alias("items"))
    text = F.col("item").cast("string")
    blank = F.col("is_array") & (F.trim(F.translate(text, "\t\n\r", "   ")) == "") & (F.col("items") == 1)
    return items.join(total, "path").filter(~blank).select("path", "item_no", "is_array", text.alias("item"))


def checked_items(items: DataFrame, objects: bool = False, source: Column | None = None) -> DataFrame:
    """``items`` in canonical form; text that is not one JSON value ends the job, naming its file.

    With ``objects`` so does any other value than an object.
    """
    source = F.col("path") if source is None else source

    def fault(reason: str) -> Column:
        return F.raise_error(F.concat(F.lit(f"{reason}: "), source)).cast("string")

    def judged(value: Column) -> Column:
        told = F.when(value.isNull(), fault("broken JSON, the file is not one JSON value"))
        if objects:
            wrong = F.when(F.col("is_array"), fault("an item of the array is not an object")).otherwise(
                fault("the value is neither an object nor an array")
            )
            told = told.when(root_kind("item") != "object", wrong)
        return told.otherwise(value)

    return items.withColumn("item", let(canonical("item"), judged))
