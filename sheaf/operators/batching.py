"""Greedy batching of an ordered table, exact and distributed.

A batch takes records in id order until it is full or the next one would exceed the
character budget. Where a batch starts depends on every earlier record, yet from a given
start the next start is decided by at most ``batch_size`` records. So each chunk of ids is
summed up, by pointer doubling, as a function: "entered at offset e, the first start behind the chunk is at
offset f(e), after n(e) batches". These short functions are composed, which gives every
chunk its true entry, and a second pass over the chunks numbers the batches.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sheaf.fixed import BATCH_CHARS, BATCH_RECORDS
from sheaf.session import stage

CHUNK_ROWS = 1 << 18
_MAP = "chunk bigint, exits array<int>, counts array<bigint>"
_ENTRY = "chunk bigint, entry int, base bigint"


def _starts_of(chars, batch_size: int, max_chars: int):
    """For each row the index of the row that opens the next batch."""
    import numpy as np

    n = len(chars)
    total = np.concatenate(([0], np.cumsum(np.asarray(chars, dtype=np.int64))))
    row = np.arange(n)
    by_chars = np.searchsorted(total, total[:-1] + max_chars, side="right") - 1
    return np.minimum(np.minimum(np.maximum(by_chars, row + 1), row + batch_size), n)


def _summarise(batch_size: int, max_chars: int, chunk_rows: int):
    starts_of = _starts_of

    def summarise(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        rows = rows.sort_values("id")
        own = int((rows["id"] < (key[0] + 1) * chunk_rows).sum())
        nxt = starts_of(rows["chars"].to_numpy(), batch_size, max_chars)[:own]
        # each round follows twice as many batches; rows behind the chunk are where it ends
        end = np.concatenate([nxt, np.arange(own, own + batch_size + 1)])
        seen = np.concatenate([np.ones(own, np.int64), np.zeros(batch_size + 1, np.int64)])
        while (end[:own] < own).any():
            seen[:own] += seen[end[:own]]
            end[:own] = end[end[:own]]
        entry = np.arange(batch_size)
        exits, counts = end[entry] - own, seen[entry]
        return pd.DataFrame({"chunk": [key[0]], "exits": [exits.tolist()], "counts": [counts.tolist()]})

    return summarise


def _compose(key: tuple, maps: pd.DataFrame) -> pd.DataFrame:
    """One function for a run of neighbouring chunks."""
    import numpy as np

    maps = maps.sort_values("chunk")
    at = np.arange(len(maps["exits"].iloc[0]))
    seen = np.zeros(len(at), dtype=np.int64)
    for exits, counts in zip(maps["exits"], maps["counts"]):
        seen += np.asarray(counts)[at]
        at = np.asarray(exits)[at]
    return pd.DataFrame({"chunk": [key[0]], "exits": [at.tolist()], "counts": [seen.tolist()]})


def _walk(key: tuple, entries: pd.DataFrame, maps: pd.DataFrame) -> pd.DataFrame:
    """Entry offset and number of earlier batches for each chunk of a run."""
    maps = maps.sort_values("chunk")
    at, base = (int(entries["entry"].iloc[0]), int(entries["base"].iloc[0]))
    out = []
    for chunk, exits, counts in zip(maps["chunk"], maps["exits"], maps["counts"]):
        out.append((chunk, at, base))
        at, base = int(exits[at]), base + int(counts[at])
    return pd.DataFrame(out, columns=["chunk", "entry", "base"])


def _opened(nxt, at: int):
    """The starts that follow one another from ``at`` on, as marks of the rows."""
    import numpy as np

    n = len(nxt)
    jump = np.append(nxt, n)
    jumps = [jump]
    while (jumps[-1][:n] < n).any():
        jumps.append(jumps[-1][jumps[-1]])
    # what any number of steps reaches: each round adds what lies a power of two further
    reached = np.array([min(at, n)])
    for jump in reversed(jumps):
        reached = np.concatenate([reached, jump[reached]])
        reached = reached[reached < n] if (reached < n).any() else reached[:1]
    opens = np.zeros(n + 1, dtype=np.int64)
    opens[reached] = 1
    return opens[:n]


def _number(batch_size: int, max_chars: int):
    starts_of, opened = _starts_of, _opened

    def number(key: tuple, entries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        rows = rows.sort_values("id")
        opens = opened(starts_of(rows["chars"].to_numpy(), batch_size, max_chars), int(entries["entry"].iloc[0]))
        # rows before the first start belong to the batch that began in an earlier chunk
        batch = int(entries["base"].iloc[0]) - 1 + np.cumsum(opens)
        return pd.DataFrame({"id": rows["id"].to_numpy(), "batch_no": batch})

    return number


def assign_batches(
    sizes: DataFrame,
    batch_size: int = BATCH_RECORDS,
    max_chars: int = BATCH_CHARS,
    chunk_rows: int = CHUNK_ROWS,
    fan_in: int | None = None,
) -> DataFrame:
    """Give each (``id``, ``chars``) its 0-based ``batch_no``; ids are dense from 0.

    Only these two numbers pass through Python. Chunks are equal slices of the id range,
    so no group can be larger than ``chunk_rows`` plus ``batch_size``.
    """
    spark = sizes.sparkSession
    chunk_rows = max(chunk_rows, batch_size)
    fan_in = fan_in or max(16, min(4096, 4_000_000 // batch_size))
    numbered = sizes.select(
        F.col("id").cast("bigint").alias("id"),
        F.col("chars").cast("bigint").alias("chars"),
        F.expr(f"id div {chunk_rows}").alias("chunk"),
    )
    # the first rows of a chunk are also shown to the chunk before, whose last batch may end there
    near = (F.col("id") % chunk_rows < batch_size - 1) & (F.col("chunk") > 0)
    shown = numbered.select(
        "id", "chars",
        F.explode(F.when(near, F.array("chunk", F.col("chunk") - 1)).otherwise(F.array("chunk"))).alias("chunk"),
    )
    maps = shown.groupBy("chunk").applyInPandas(_summarise(batch_size, max_chars, chunk_rows), _MAP)
    maps = stage(maps, "chunk-maps")

    start = spark.range(1).select(
        F.lit(0).cast("bigint").alias("run"), F.lit(0).alias("entry"), F.lit(0).cast("bigint").alias("base")
    )
    runs = maps.withColumn("run", F.expr(f"chunk div {fan_in}"))
    if maps.count() > fan_in:
        # one function per run of chunks; a walk over the runs gives each run its entry
        composed = runs.groupBy("run").applyInPandas(_compose, _MAP).withColumn("run", F.lit(0).cast("bigint"))
        start = (
            start.groupBy("run").cogroup(composed.groupBy("run")).applyInPandas(_walk, _ENTRY)
            .withColumnRenamed("chunk", "run")
        )
    entries = start.groupBy("run").cogroup(runs.groupBy("run")).applyInPandas(_walk, _ENTRY)
    return (
        entries.groupBy("chunk").cogroup(numbered.groupBy("chunk"))
        .applyInPandas(_number(batch_size, max_chars), "id bigint, batch_no bigint")
    )
