"""Near duplicates by b-bit MinHash, with every link confirmed on full shingle sets.

1. One pass over the texts makes a sketch per document: the size and a 128-bit digest of
   its shingle set, 32 band keys of four minima each, and two bits of each of the 128
   minima packed in four longs. The minima are mixed first, each in its own way: the
   lowest bits of the values themselves would be those of the shingle under all functions.
2. Documents with equal sets become one class, whose first document stands for it.
3. Classes that share a band key are candidates. In every bucket each member is first
   compared with the bucket's smallest only: the similarity estimated by counting equal
   bits, corrected for chance, discards most, and full sets decide the others. Sets of few
   shingles are not estimated but compared, as that costs no more.
4. The links found give components. A bucket whose members are by now all in one
   component needs nothing more, however large it is. In the others, and only there,
   members of different components are compared, in blocks.
5. New links join the old ones, and the components of all of them are the result.

Two texts with a similarity of 0.8 share no band with probability 5e-8, and more similar
ones with less; the estimate would have to be wrong by six standard deviations to discard
a link. No bucket, partner or candidate is capped.

Sums by bucket, node or component are written before they are joined back. Both sides of
such a join are then shuffled by it, and Spark can split the rows of one hot key; on a
side that still lies as it was summed it could not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sheaf.llm.common import in_chunks, rows_staying, text_hash, text_or_empty
from sheaf.llm.components import components
from sheaf.llm.shingles import common, mixed, shingle_sets
from sheaf.session import stage

HASHES, BAND_ROWS, BITS = 128, 4, 2
BANDS, WORDS = HASHES // BAND_ROWS, HASHES * BITS // 64
#: Links need 100 * intersection >= SIMILARITY * union.
SIMILARITY = 80
#: Estimates below this discard a candidate: 0.8 less six standard deviations.
LEAST_ESTIMATE = 0.55
#: Sets up to this size are compared without an estimate.
SMALL_SET = 64
#: Shingles compared with one set before the comparison is given to another task.
STAR_SHINGLES = 1 << 16
#: Members of a bucket, and their shingles, that are compared with one another at a time.
BLOCK_MEMBERS, BLOCK_SHINGLES = 2048, 1 << 20

_LOW_BITS = 0x5555555555555555
_factors = np.random.default_rng(20260101).integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

SKETCH = (
    "doc_id bigint, text_hash bigint, n_shingles bigint, set_1 bigint, set_2 bigint, bands array<bigint>, "
    + ", ".join(f"bits_{k} bigint" for k in range(WORDS))
)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest of the shingles' values under each hash function (uint32)."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for a in range(0, len(short), 1024):
        np.minimum(out, (_factors[:, None] * short[None, a : a + 1024]).min(axis=1), out=out)
    return out


def _sketch_columns(sets: list[np.ndarray]) -> list[pa.Array]:
    least = np.stack([minima(s) for s in sets]) if sets else np.empty((0, HASHES), np.uint32)
    wide = least.reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), wide.shape[:2])
    for r in range(BAND_ROWS):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + wide[:, :, r])
    own = np.arange(1, HASHES + 1, dtype=np.uint64) << np.uint64(32)
    low = (mixed(least.astype(np.uint64) | own) & np.uint64((1 << BITS) - 1)).reshape(-1, WORDS, 64 // BITS)
    packed = np.bitwise_or.reduce(low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)), axis=2)
    zero = np.uint64(0)
    digests = [
        np.array([mixed(s + np.uint64(salt)).sum() if len(s) else zero for s in sets], dtype=np.uint64)
        for salt in (0, 0x632BE59BD9B4E019)
    ]
    as_long = lambda x: pa.array(x.view(np.int64))
    offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS)
    return [
        pa.array([len(s) for s in sets], pa.int64()), *map(as_long, digests),
        pa.ListArray.from_arrays(offsets, as_long(np.ascontiguousarray(keys).ravel())),
        *(as_long(np.ascontiguousarray(packed[:, w])) for w in range(WORDS)),
    ]


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """One row per document, see the head of the module."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SKETCH.split(", ")]
        for batch in in_chunks(batches, "text", 1 << 20):
            own = [batch.column("doc_id"), batch.column("text_hash")]
            yield pa.RecordBatch.from_arrays(own + _sketch_columns(shingle_sets(batch.column("text"), k)), names=names)

    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_hash().alias("text_hash"), text_or_empty().alias("text")
    )
    return texts.mapInArrow(sketch, SKETCH)


def bit_names(side: str) -> list[Column]:
    return [F.col(f"bits_{w}").alias(f"{side}_{w}") for w in range(WORDS)]


def estimated_similarity(a: str = "a", b: str = "b") -> Column:
    """Jaccard similarity from the share of equal low bits, less what chance makes equal."""
    different = F.lit(0)
    for w in range(WORDS):
        x = F.col(f"{a}_{w}").bitwiseXOR(F.col(f"{b}_{w}"))
        either = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(_LOW_BITS))
        different = different + F.bit_count(either)
    chance = 0.5**BITS
    return (1 - different / HASHES - chance) / (1 - chance)


def _may_be_linked(a: str, b: str) -> Column:
    return (F.greatest(a, b) <= SMALL_SET) | (estimated_similarity() >= LEAST_ESTIMATE)


def _close(different: np.ndarray, larger: np.ndarray) -> np.ndarray:
    """The same in numpy, from the numbers of different minima and of shingles in the larger set."""
    chance = 0.5**BITS
    return (larger <= SMALL_SET) | ((1 - different / HASHES - chance) / (1 - chance) >= LEAST_ESTIMATE)


def _sizes_allow(a: str, b: str) -> Column:
    return 100 * F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def star_candidates(bands: DataFrame, classes: DataFrame) -> DataFrame:
    """``a, b``: the smallest member of a bucket and each other member that may be linked to it."""
    hubs = bands.groupBy("key").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("members"))
    hubs = stage(hubs.filter("members > 1"), "near-hubs")
    stars = stage(bands.join(hubs, "key").filter("node <> a").select(
        "a", F.col("node").alias("b")
    ).distinct(), "near-stars")
    left = classes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), *bit_names("a"))
    right = classes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), *bit_names("b"))
    return stars.join(right, "b").join(left, "a").filter(
        _sizes_allow("n_a", "n_b") & _may_be_linked("n_a", "n_b")
    ).select("a", "b", "n_a", "n_b")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b) whose full shingle sets are similar enough, as ``a, b``.

    The partners of one ``a`` are dealt into blocks of about ``STAR_SHINGLES`` shingles;
    the text of ``a`` goes once to every block. A task reads a block's rows sorted, ``a``
    first, and holds one set besides the one it compares.
    """
    per_a = pairs.groupBy("a").agg(
        F.greatest(
            F.lit(1), F.ceil(F.sum("n_b") / F.greatest(F.lit(STAR_SHINGLES), 8 * F.max("n_a")))
        ).alias("blocks")
    )
    per_a = stage(per_a, "near-blocks")
    dealt = pairs.join(per_a, "a").withColumn("block", F.pmod(F.xxhash64("b"), "blocks").cast("int"))
    dealt = stage(dealt.select("a", "b", "block"), "near-pairs")
    wanted = dealt.select("a", "block", F.lit(1).alias("role"), F.col("b").alias("node")).unionByName(
        dealt.select("a", "block", F.lit(0).alias("role"), F.col("a").alias("node")).distinct()
    )
    wanted = wanted.join(classes.select("node", "doc_id", "text_hash"), "node")
    texts = _texts(docs)
    found = wanted.join(
        texts, wanted["doc_id"].eqNullSafe(texts["_id"]) & (wanted["text_hash"] == texts["_hash"])
    ).select("a", "block", "role", "node", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, np.empty(0, dtype=np.uint64)
        for batch in in_chunks(batches, "text", 1 << 20):
            keys = zip(*(batch.column(c).to_pylist() for c in ("a", "block", "role", "node")), strict=True)
            links = []
            for (a, block, role, node), other in zip(keys, shingle_sets(batch.column("text"), k), strict=True):
                if role == 0:
                    now, own = (a, block), other
                elif now == (a, block):
                    if _linked(own, other):
                        links.append((a, node))
                else:
                    raise ValueError(f"the text of node {a} is missing: the documents changed while they were read")
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    # enough partitions for single texts to be large; Spark merges small ones
    return found.repartition("a", "block").sortWithinPartitions("a", "block", "role").mapInArrow(
        compare, "a bigint, b bigint"
    )


def _partners(group: pa.RecordBatch, joined: Callable[[int, int], bool]) -> Iterator[tuple[int, np.ndarray]]:
    """For rows of one block, the rows of the other that may be linked to them and meet here first.

    ``joined`` tells whether two components are known to be one by now. Two members share
    several buckets if they are close; only the first of these looks at them.
    """
    get = lambda c: np.asarray(group.column(c))
    component, size, block, band = get("component"), get("n_shingles"), get("block"), int(group.column("band")[0].as_py())
    bits = np.stack([get(f"bits_{w}").view(np.uint64) for w in range(WORDS)], axis=1)
    bands = np.asarray(group.column("bands").flatten()).reshape(-1, BANDS)
    first = np.flatnonzero(block == get("x")[0])
    second = np.flatnonzero(block == get("y")[0])
    for i in first.tolist():
        x = bits[second] ^ bits[i]
        different = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(_LOW_BITS)).sum(axis=1)
        low, high = np.minimum(size[second], size[i]), np.maximum(size[second], size[i])
        near = second[_close(different, high) & (component[second] != component[i]) & (100 * low >= SIMILARITY * high)]
        near = near[(bands[near] == bands[i]).argmax(axis=1) == band]
        yield i, np.array([j for j in near.tolist() if not joined(int(component[i]), int(component[j]))], dtype=np.int64)


def crossing_links(bands: DataFrame, classes: DataFrame, docs: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """``a, b``: links between different components of ``found`` (node, component) inside one bucket.

    In a bucket the component with most members is the main one: its members are not
    compared with each other. All others meet each other and the main ones, in blocks of
    bounded numbers of members and shingles. A first pass over the blocks, on bits alone,
    names the members that may be linked to any other; a second gets their texts and
    decides. Pairs never become rows: a block gives the links that join components, one
    less than it has components at most. A bucket of two needs no second look, as its
    star was the pair itself.
    """
    placed = bands.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = stage(placed.select("key", "band", "node", "component"), "near-placed")
    mixed_keys = placed.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.min("component").alias("low"), F.max("component").alias("high")
    ).filter("members > 2 and low <> high").select("key")
    mixed_keys = stage(mixed_keys, "near-keys")
    member = placed.join(mixed_keys, "key").join(classes.drop("set_1", "set_2"), "node")
    member = stage(member, "near-unsettled")
    parts = member.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"))
    blocks = lambda n, size: F.ceil(F.greatest(n / BLOCK_MEMBERS, size / BLOCK_SHINGLES)).cast("int")
    per_key = parts.groupBy("key").agg(
        F.max(F.struct("n", "size", "component")).alias("main"), F.sum("n").alias("n"), F.sum("size").alias("size")
    ).select(
        "key", F.col("main.component").alias("main"),
        blocks(F.col("main.n"), F.col("main.size")).alias("mains"),
        blocks(F.col("n") - F.col("main.n"), F.col("size") - F.col("main.size")).alias("others"),
    )
    per_key = stage(per_key, "near-key-blocks")
    # blocks 0 to others-1 hold the others, the next ones the main component
    is_main = F.col("component") == F.col("main")
    dealt = member.join(per_key, "key").withColumn(
        "block",
        F.when(is_main, F.col("others") + F.pmod(F.xxhash64("node"), "mains"))
        .otherwise(F.pmod(F.xxhash64("node"), "others")).cast("int"),
    )
    last = F.when(is_main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    dealt = dealt.withColumn("met", F.explode(F.sequence(F.lit(0), last))).withColumns(
        {"x": F.least("block", "met"), "y": F.greatest("block", "met")}
    ).drop("met", "main", "mains", "others")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _sorted_groups(batches, ("key", "x", "y")):
            near: set[int] = set()
            for i, partners in _partners(group, lambda c, d: False):
                if len(partners):
                    near.update(partners.tolist())
                    near.add(i)
            if near:
                yield group.take(pa.array(sorted(near)))

    schema = ", ".join(f"{n} {t}" for n, t in dealt.dtypes)
    in_blocks = dealt.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    named = stage(in_blocks.mapInArrow(name, schema), "near-named")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _sorted_groups(in_chunks(batches, "text", 1 << 20), ("key", "x", "y")):
            sets = shingle_sets(group.column("text"), k)
            node, component = group.column("node").to_pylist(), group.column("component").to_pylist()
            root = {c: c for c in component}

            def find(c: int, root: dict[int, int] = root) -> int:
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            links = []
            for i, partners in _partners(group, lambda c, d: find(c) == find(d)):
                for j in partners.tolist():
                    c, d = find(component[i]), find(component[j])
                    if c != d and _linked(sets[i], sets[j]):
                        root[c] = d
                        links.append((node[i], node[j]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[e] for x in links], pa.int64()) for e in (0, 1)], names=["a", "b"]
            )

    full = named.join(_texts(docs), named["doc_id"].eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    return full.drop("_id", "_hash").repartition("key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(
        decide, "a bigint, b bigint"
    )


def _texts(docs: DataFrame) -> DataFrame:
    """Texts by id and hash. Rows alike in both come several times; each has the same shingles."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("_id"), text_hash().alias("_hash"), text_or_empty().alias("text")
    )


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = common(a, b)
    return both > 0 and 100 * both >= SIMILARITY * (len(a) + len(b) - both)


def _sorted_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Rows of one key at a time from batches sorted by it; holds one group and one batch."""
    held: list[pa.RecordBatch] = []

    def whole() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k)) for k in keys]
        changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for a, b in pairwise([0, *changes.tolist(), batch.num_rows]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield whole()
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield whole()


def near_duplicates(docs: DataFrame, k: int) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored), shingles of ``k`` words.

    ``doc_id, text_hash, n_shingles``, ``class_id`` (smallest id with the same shingle set),
    ``component_id`` (smallest id that can be reached over links), ``kept``.
    Null and empty texts have no shingles and are linked with nothing. Rows are what is
    linked: rows that share an id are linked only if their texts are, and among rows of
    one component with its smallest id exactly one is kept. Ids that are null come last
    when the smallest is sought. An empty table gives an empty table.
    """
    sketch = sketches(docs, k).withColumn("node", F.monotonically_increasing_id())
    sketch = stage(sketch, "near-sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("node")))
    same_set = ["n_shingles", "set_1", "set_2"]
    filled = sketch.filter("n_shingles > 0")
    sets = stage(filled.groupBy(same_set).agg(first.alias("first")), "near-classes")
    members = filled.select(*same_set, "node", "doc_id", "text_hash").join(sets, same_set).select(
        "node", "doc_id", "text_hash", "n_shingles", F.col("first.node").alias("class"),
        F.col("first.doc_id").alias("class_id"),
    )
    classes = stage(
        filled.join(sets.select(F.col("first.node").alias("node")), "node", "leftsemi"), "near-representatives"
    )
    bands = classes.select("node", F.posexplode("bands").alias("band", "key"))
    stars = stage(star_candidates(bands, classes), "near-candidates")
    links = stage(confirmed(stars, classes, docs, k), "near-links")
    links = links.unionByName(crossing_links(bands, classes, docs, components(links), k))
    settled = stage(components(links), "near-components")
    # the smallest id of a component; its classes' first documents hold it
    named = classes.select("node", "doc_id").join(settled, "node").groupBy("component").agg(first.alias("least"))
    named = stage(named, "near-least")
    named = stage(settled.join(named, "component").select(F.col("node").alias("class"), "least"), "near-names")
    in_class = members.join(named, "class", "left").select(
        "node", "doc_id", "text_hash", "n_shingles", "class_id",
        F.when(F.col("least").isNull(), F.col("class_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
        (F.coalesce(F.col("least.node"), F.col("class")) == F.col("node")).alias("kept"),
    )
    alone = sketch.filter("n_shingles = 0").select(
        "node", "doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("class_id"),
        F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"),
    )
    return in_class.unionByName(alone).drop("node")


def without_near_duplicates(docs: DataFrame, k: int = 5) -> DataFrame:
    """The rows of ``docs`` kept by :func:`near_duplicates`: one of each component, all its columns."""
    return rows_staying(docs, near_duplicates(docs, k).filter("kept"))
