"""Packing documents into training sequences by linear grouping and best fit.

All planning is done on the histogram of piece lengths, which has at most ``capacity``
rows whatever the corpus: large lengths are put in groups of equal cardinality and
rounded up to the largest of their group; a small set of configurations (which groups
share a sequence) is optimised by column generation; actual lengths take the places of
the rounded ones; everything else, the small pieces above all, goes by best fit
decreasing into the space that is left. The plan is a list of segments, "pieces
``a..b`` of length ``l`` go to sequences from ``s`` on, ``q`` to a sequence, at offset
``o``", whose number depends on the capacity alone. A piece finds its place from its
number among the pieces of its length, which is a running sum over partitions plus its
number in its partition.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from sheaf.llm.common import crc32, in_chunks, text_or_empty
from sheaf.session import stage

CAPACITY = 1024
END_ID = 2
#: Pieces longer than this share of a sequence are large: three at most fit together.
LARGE_SHARE = 1 / 4
GROUPS = 400

#: The split pattern and the end-of-text token of the byte-level vocabulary (fixed values).
BYTE_BPE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
BYTE_BPE_SPECIAL = {"<|endoftext|>": 50256}
#: White space as the split pattern means it, in runs so long that the pattern's engine could run out of stack.
LONG_BLANKS = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"


@lru_cache(maxsize=2)
def byte_bpe(ranks_path: str) -> Callable[[str], np.ndarray]:
    """Encoder of the byte-level vocabulary in a file of ranks.

    Gives the ids of ``Tokenizer.from_file`` of the same vocabulary's JSON file with
    ``add_special_tokens=False``, the end-of-text string included, several times faster.
    Very long runs of white space do not go through the split pattern: it would make one
    part of such a run, less its last character if something other follows.
    """
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding(
        "byte_bpe", pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks, special_tokens=BYTE_BPE_SPECIAL
    )

    def plain(text: str) -> np.ndarray:
        return encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=())

    def encode(text: str) -> np.ndarray:
        out, done = [], 0
        for run in LONG_BLANKS.finditer(text):
            ends = run.end() == len(text) or text.startswith(tuple(BYTE_BPE_SPECIAL), run.end())
            stop = run.end() if ends else run.end() - 1
            out.append(plain(text[done : run.start()]))
            out.append(np.array(encoding._encode_single_piece(text[run.start() : stop]), dtype=np.uint32))
            done = stop
        return np.concatenate([*out, plain(text[done:])]) if out else plain(text)

    return encode


def pieces(
    docs: DataFrame, ranks_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Token pieces of every document, in its order; only documents over ``capacity`` are cut.

    All pieces but a document's first have ``capacity`` tokens. ``part`` is the task that
    made the piece and ``nth`` its number among that task's pieces of its length.
    With ``with_ids`` the ids come as a further column.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_bpe(ranks_path)
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in in_chunks(batches, "text"):
            rows: list[tuple] = []
            all_ids = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(encode(text), end_id).astype("<u4")
                start, end = 0, (len(ids) - 1) % capacity + 1
                while start < len(ids):
                    n = end - start
                    rows.append((doc_id, len(all_ids), start, n, crc32(ids[start:end]), part, seen[n]))
                    all_ids.append(ids[start:end])
                    seen[n] += 1
                    start, end = end, end + capacity
            columns = [list(c) for c in zip(*rows, strict=True)] or [[]] * 7
            starts = np.asarray(columns[2], dtype=np.int64)
            # the number of a piece in its document: rows since the last one that starts at 0
            at = np.arange(len(starts))
            columns[1] = at - np.maximum.accumulate(np.where(starts == 0, at, 0))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            if with_ids:
                arrays.append(pa.array(all_ids, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(cut, PIECES + (", ids array<bigint>" if with_ids else ""))


# -- the plan, on a histogram ---------------------------------------------------------
def equal_groups(lengths: list[int], counts: list[int], groups: int) -> list[list[tuple[int, int]]]:
    """Lengths in falling order, dealt into groups of about equal cardinality.

    A group is a list of (length, count); its first length is its largest. A length
    that fills whole groups by itself becomes one group, as rounding is free there.
    """
    each = max(1, -(-sum(counts) // groups))
    out: list[list[tuple[int, int]]] = []
    room = 0
    for length, count in zip(lengths, counts, strict=True):
        while count:
            if room == 0:
                if count >= each:
                    out.append([(length, count)])
                    break
                out.append([])
                room = each
            take = min(room, count)
            out[-1].append((length, take))
            room -= take
            count -= take
    return out


def best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The multiset of sizes that fits in ``capacity`` with the greatest value."""
    best = np.zeros(capacity + 1)
    chosen = []
    for _ in range(capacity // int(sizes.min())):
        now, pick = best.copy(), np.full(capacity + 1, -1)
        for k, size in enumerate(sizes):
            with_k = best[: capacity + 1 - size] + values[k]
            better = with_k > now[size:] + 1e-12
            now[size:][better] = with_k[better]
            pick[size:][better] = k
        if not (pick >= 0).any():
            break
        best = now
        chosen.append(pick)
    counts = np.zeros(len(sizes), dtype=np.int64)
    room = capacity
    for pick in reversed(chosen):
        k = pick[room]
        if k >= 0:
            counts[k] += 1
            room -= int(sizes[k])
    return counts, float(best[capacity])


def optimal_configurations(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 3000
) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use each, rounded down from the linear optimum.

    Column generation: start with one configuration per size, price by a knapsack, swap
    columns of the basis until no configuration is worth more than one sequence.
    """
    basis = [np.eye(len(sizes), dtype=np.int64)[k] * (capacity // size) for k, size in enumerate(sizes)]
    inverse = np.diag(1.0 / np.array([b[k] for k, b in enumerate(basis)]))
    used = inverse @ demand
    for _ in range(rounds):
        config, value = best_configuration(sizes, np.maximum(inverse.sum(axis=0), 0), capacity)
        if value <= 1 + 1e-7:
            break
        direction = inverse @ config
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(direction > 1e-9, used / direction, np.inf)
        leaving = int(np.argmin(ratio))
        if not np.isfinite(ratio[leaving]):
            break
        pivot = inverse[leaving] / direction[leaving]
        inverse -= np.outer(direction, pivot)
        inverse[leaving] = pivot
        used = np.maximum(inverse @ demand, 0)
        basis[leaving] = config
    left = demand.astype(np.int64).copy()
    out = []
    for config, x in sorted(zip(basis, used, strict=True), key=lambda p: -p[1]):
        on = config > 0
        times = min(int(x + 1e-6), int((left[on] // config[on]).min()) if on.any() else 0)
        if times > 0:
            left -= config * times
            out.append((config, times))
    return out


class Plan:
    """Segments of pieces with the same length, and the free space of the sequences so far."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.left = dict(histogram)
        self.next = dict.fromkeys(histogram, 0)
        self.capacity = capacity
        self.sequences = 0
        self.segments: list[tuple[int, int, int, int, int, int]] = []  # length, from, to, sequence, per, offset
        self.free: dict[int, list[tuple[int, int]]] = {}  # free tokens: [(first sequence, how many)]

    def put(self, length: int, count: int, sequence: int, per: int, offset: int) -> None:
        a = self.next[length]
        self.segments.append((length, a, a + count, sequence, per, offset))
        self.next[length] = a + count
        self.left[length] -= count

    def open(self, count: int, free: int) -> None:
        if count and free:
            self.free.setdefault(free, []).append((self.sequences, count))
        self.sequences += count

    def use_configurations(self, groups: list[list[tuple[int, int]]], plan: list[tuple[np.ndarray, int]]) -> None:
        """Open a sequence for every planned configuration and put actual pieces in the places of each group."""
        stock = [list(g) for g in groups]
        for config, times in plan:
            runs = [(self.sequences, times, 0)]  # first sequence, how many, tokens in each
            for k in np.flatnonzero(config).tolist():
                for _ in range(int(config[k])):
                    after = []
                    for first, many, filled in runs:
                        while many:
                            length, there = stock[k][0]
                            take = min(many, there)
                            self.put(length, take, first, 1, filled)
                            after.append((first, take, filled + length))
                            first, many = first + take, many - take
                            if take == there:
                                stock[k].pop(0)
                            else:
                                stock[k][0] = (length, there - take)
                    runs = after
            for first, many, filled in runs:
                if filled < self.capacity:
                    self.free.setdefault(self.capacity - filled, []).append((first, many))
            self.sequences += times

    def best_fit(self, length: int) -> None:
        """Put all pieces of one length where they leave least space, opening sequences when none has room."""
        while self.left[length]:
            count = self.left[length]
            free = min((f for f in self.free if f >= length), default=None)
            if free is None:
                free, (first, many) = self.capacity, (self.sequences, -(-count // (self.capacity // length)))
                self.sequences += many
            else:
                first, many = self.free[free].pop()
                if not self.free[free]:
                    del self.free[free]
            per = free // length
            full = min(many, count // per)
            if full:
                self.put(length, full * per, first, per, self.capacity - free)
                self._keep(free - per * length, first, full)
                first, many = first + full, many - full
            rest = count - full * per
            if many and rest:
                rest = min(rest, per)
                self.put(length, rest, first, rest, self.capacity - free)
                self._keep(free - rest * length, first, 1)
                first, many = first + 1, many - 1
            self._keep(free, first, many)

    def _keep(self, free: int, first: int, many: int) -> None:
        if free and many:
            self.free.setdefault(free, []).append((first, many))


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """Places for all pieces of a histogram (length to count) of lengths 1 to ``capacity``.

    On few pieces, rounding can cost more than configurations gain; the plan is then the
    one of no large pieces, which is best fit decreasing.
    """
    plans = [_planned(histogram, capacity, groups), _planned(histogram, capacity, 0)]
    return min(plans, key=lambda p: p.sequences)


def _planned(histogram: dict[int, int], capacity: int, groups: int) -> Plan:
    plan = Plan({n: c for n, c in histogram.items() if c}, capacity)
    whole = plan.left.get(capacity, 0)
    if whole:
        plan.put(capacity, whole, plan.sequences, 1, 0)
        plan.open(whole, 0)
    large = sorted((n for n in plan.left if LARGE_SHARE * capacity < n < capacity), reverse=True)
    if large and groups:
        grouped = equal_groups(large, [plan.left[n] for n in large], groups)
        sizes = np.array([g[0][0] for g in grouped])
        demand = np.array([sum(c for _, c in g) for g in grouped], dtype=float)
        plan.use_configurations(grouped, optimal_configurations(sizes, demand, capacity))
    for length in sorted(plan.left, reverse=True):
        plan.best_fit(length)
    return plan


# -- placing --------------------------------------------------------------------------
def place(staged: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a staged table of :func:`pieces`.

    The table is read three times, so it has to be written first: a piece's number must
    not change between counting and placing.
    """
    counts = staged.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stage(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "packing-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = np.array(
        sorted(plan_sequences(histogram, capacity, groups).segments) or [(0,) * 6], dtype=np.int64
    )

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one sorted key for (length, number); numbers stay below 2 ** 48
        keys = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            row = table[np.searchsorted(keys, (length << 48) + rank, side="right") - 1]
            nth = rank - row[:, 1]
            out = batch.drop_columns(["rank"])
            out = out.append_column("sequence_id", pa.array(row[:, 3] + nth // row[:, 4]))
            yield out.append_column("offset", pa.array(row[:, 5] + nth % row[:, 4] * length))

    ranked = staged.join(counts.select("length", "part", "base"), ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("nth")).drop("part", "nth", "base")
    schema = ", ".join(f"{n} {t}" for n, t in ranked.drop("rank").dtypes)
    return ranked.mapInArrow(locate, schema + ", sequence_id bigint, offset bigint")


def pack(
    docs: DataFrame, ranks_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Packs every row of ``docs`` (doc_id, text; other columns are ignored), one row per piece.

    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, if asked for, ``ids``.
    Null and empty texts are one piece of the end id alone. Rows that share an id, or have
    none, are packed like any other. An empty table gives an empty table.
    """
    return place(stage(pieces(docs, ranks_path, capacity, end_id, with_ids), "packing-pieces"), capacity)
