"""Secrets: base patterns, and candidates that read like labelled credentials.

The base spans of a text leave parts of its runs of credential characters; candidates
are the pieces of ``LEAST_CANDIDATE`` or more in them: the whole of it, and its parts
between joining signs, for every choice of the signs taken to join; each also without the
signs at its ends. A first pass over the texts gathers short values, of which a bounded
sample makes the automata: one per kind of labelled credential, and one of unlabelled
candidates as the background. The second pass scores all candidates where they stand: one
is a secret if some kind's automaton reads it at least as well as all but the oddest of
its own examples, and better than the background does. Of secrets that overlap the longest
counts. Candidates are places, and never leave the worker that finds them.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sheaf.llm.automata import Automaton, codes, infer
from sheaf.llm.common import as_struct, in_chunks, sampled, text_hash, text_or_empty
from sheaf.llm.spans import SECRETS, Span, find, joined, replaced, sha256
from sheaf.session import stage

#: The shortest value the base patterns label.
LEAST_CANDIDATE = 12
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
JOINING = "=/._-+"
VALUE = re.compile(r"[A-Za-z0-9+/_.=-]+\Z")
#: The most examples of a kind an automaton is inferred from, and their greatest length.
TRAINING_EXAMPLES, TRAINING_LENGTH = 400, 128
#: Share of a kind's examples that may score below its threshold.
ODDEST = 0.02
#: A candidate must beat the background by so much a character (natural logarithm).
LEAST_GAIN = 0.1

#: Candidates scored at a time.
AT_ONCE = 100_000

SPANS = "array<struct<kind:string,start:int,end:int>>"


@lru_cache(maxsize=None)  # one for each set of joining signs
def _cutters(signs: str) -> list[re.Pattern]:
    """What cuts a run, by every choice of ``signs``; an = at the end of a part is padding."""
    chosen = chain.from_iterable(combinations(signs, n) for n in range(1, len(signs) + 1))
    return [
        re.compile("|".join("(?<!=)=++(?=[^=])" if c == "=" else re.escape(c) for c in some)) for some in chosen
    ]


def parts(run: str) -> list[tuple[int, int]]:
    """Where candidates in a run of credential characters start and end, by start. Time is linear in the run."""
    found = set()

    def add(a: int, b: int) -> None:
        if b - a >= LEAST_CANDIDATE:
            found.add((a, b))
            bare = run[a:b].lstrip(JOINING)
            head, tail = b - a - len(bare), len(bare) - len(bare.rstrip(JOINING))
            found.update({(a + head, b), (a, b - tail), (a + head, b - tail)} if bare else ())

    add(0, len(run))
    signs = "".join(c for c in JOINING if c in run)
    for cutter in _cutters(signs) if signs else ():
        start = 0
        for m in cutter.finditer(run):
            add(start, m.start())
            start = m.end()
        add(start, len(run))
    return sorted((a, b) for a, b in found if b - a >= LEAST_CANDIDATE)


def candidates(text: str, own: list[Span]) -> Iterator[tuple[int, int]]:
    """Candidates outside the base spans ``own``, which are sorted by start."""
    k, done = 0, 0
    for m in CANDIDATE.finditer(text):
        at = max(m.start(), done)
        while True:
            while k < len(own) and own[k][2] <= at:
                k += 1
            cut = k < len(own) and own[k][1] < m.end()
            end = max(at, own[k][1]) if cut else m.end()
            if end - at >= LEAST_CANDIDATE:
                yield from ((at + a, at + b) for a, b in parts(text[at:end]))
            if not cut:
                break
            at = done = max(at, own[k][2])
            if at >= m.end():
                break


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_hash().alias("text_hash"), text_or_empty().alias("text")
    )


def base_spans(text: str) -> list[Span]:
    kinds = list(SECRETS)
    return sorted(find(text, SECRETS), key=lambda s: (s[1], kinds.index(s[0])))


def labelled(docs: DataFrame) -> DataFrame:
    """``kind, value``: credentials the base patterns label, and candidates as kind ``''``.

    Only values short enough to learn from; each comes once from a batch.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches, "text"):
            found = set()
            for text in batch.column("text").to_pylist():
                own = base_spans(text)
                for k, a, b in own:
                    value = VALUE.search(text, a, b)[0] if k == "assign" else text[a:b]
                    if len(value) <= TRAINING_LENGTH:
                        found.add((k, value))
                found.update(("", text[a:b]) for a, b in candidates(text, own) if b - a <= TRAINING_LENGTH)
            rows = list(zip(*sorted(found), strict=True)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in rows], names=["kind", "value"])

    return _texts(docs).select("text").mapInArrow(search, "kind string, value string")


@dataclass(frozen=True)
class Formats:
    """Automata by kind with their thresholds, and the background."""

    kinds: dict[str, tuple[Automaton, float]]
    background: Automaton

    def matches(self, read: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which places in a text's codes read like credentials of some kind."""
        plain = self.background.scores_at(read, start, end)
        plain = np.where(np.isfinite(plain), plain, -5.0)  # refused: as odd as can be
        good = np.zeros(len(start), dtype=bool)
        for automaton, least in self.kinds.values():
            score = automaton.scores_at(read, start, end)
            good |= (score >= least) & (score > plain + LEAST_GAIN)
        return good


def learn(credentials: DataFrame, most: int = TRAINING_EXAMPLES) -> Formats:
    """Automata from labelled values (kind, value); kind ``''`` is the background.

    Of each kind the ``most`` values with the smallest hashes are used, ``2 * most`` for
    the background; the sample is what comes to the driver. Few examples make an automaton
    that reads little else; a kind without any has none.
    """
    usable = stage(credentials.filter(F.length("value") <= TRAINING_LENGTH).distinct(), "secret-labels")
    examples = {}
    for kind in [*SECRETS, ""]:
        rows = usable.filter(F.col("kind") == kind)
        examples[kind] = [r["value"] for r in sampled(rows, most if kind else 2 * most, "value")]
    kinds = {}
    for kind in SECRETS:
        if examples[kind]:
            automaton = infer(examples[kind])
            kinds[kind] = (automaton, float(np.quantile(automaton.scores(examples[kind]), ODDEST)))
    return Formats(kinds, infer(examples[""]))


def _longest(good: np.ndarray, owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[int]:
    """Of the good candidates those that overlap no longer one of their row, in order."""
    taken: dict[int, list[tuple[int, int]]] = {}  # starts and ends by row, in order: they do not overlap
    chosen = []
    for k in good[np.lexsort((start[good], start[good] - end[good]))].tolist():
        own, span = taken.setdefault(int(owner[k]), []), (int(start[k]), int(end[k]))
        at = bisect_left(own, span)
        if not (at and own[at - 1][1] > span[0] or at < len(own) and own[at][0] < span[1]):
            own.insert(at, span)
            chosen.append(k)
    return sorted(chosen)


def _format_spans(texts: list[str], base: list[list[Span]], formats: Formats) -> list[list[Span]]:
    """What the automata add to each text."""
    read = codes("".join(texts))
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    held: list[tuple[int, int, int]] = []
    good = [np.empty((0, 3), np.int64)]

    def judge() -> None:
        rows = np.array(held, np.int64).reshape(-1, 3)
        held.clear()
        at = first[rows[:, 0]]
        good.append(rows[formats.matches(read, at + rows[:, 1], at + rows[:, 2])])

    for k, (text, own) in enumerate(zip(texts, base, strict=True)):
        for a, b in candidates(text, own):
            held.append((k, a, b))
            if len(held) >= AT_ONCE:
                judge()
    judge()
    owner, start, end = np.concatenate(good).T
    out: list[list[Span]] = [[] for _ in texts]
    for k in _longest(np.arange(len(owner)), owner, start, end):
        out[owner[k]].append(("format", int(start[k]), int(end[k])))
    return [sorted(spans, key=lambda s: s[1]) for spans in out]


def secret_spans(docs: DataFrame, credentials: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored).

    ``doc_id, text_hash``, ``base`` and ``format`` (arrays of kind, start, end), the latter
    the spans the automata add. Without labelled ``credentials`` (kind, value) those that
    the base patterns find in ``docs`` are the labels. Null and empty texts have no spans.
    """
    formats = learn(labelled(docs) if credentials is None else credentials)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

        def listed(spans: list[list[Span]]) -> pa.Array:
            return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in own] for own in spans], span)

        for batch in in_chunks(batches, "text"):
            texts = batch.column("text").to_pylist()
            base = [base_spans(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), listed(base), listed(_format_spans(texts, base, formats))],
                names=["doc_id", "text_hash", "base", "format"],
            )

    return _texts(docs).mapInArrow(search, f"doc_id bigint, text_hash bigint, base {SPANS}, format {SPANS}")


def redacted(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with every span of :func:`secret_spans` replaced by ``[KIND]``; all rows and columns stay.

    A column ``n_chars`` is set to the new length where the text changed. Texts without
    spans are not sent to Python.
    """
    # written, so that texts are searched once for the two joins below
    marked = stage(spans.select(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.concat("base", "format").alias("spans")
    ).filter(F.size("spans") > 0).dropDuplicates(["id", "hash"]), "secret-marks")

    @F.pandas_udf("string")
    def hide(texts, lists):  # noqa: ANN001, ANN202
        import pandas as pd

        def one(text, own) -> str:  # noqa: ANN001
            spans: list[Span] = [(s["kind"], s["start"], s["end"]) for s in own]
            return replaced(text, spans, lambda kind: f"[{kind.upper()}]")

        return pd.Series([one(t, s) for t, s in zip(texts, lists, strict=True)])

    keyed = docs.select(as_struct(docs).alias("row"), F.col("doc_id").alias("_id"), text_hash().alias("_hash"))
    same = keyed["_id"].eqNullSafe(marked["id"]) & (keyed["_hash"] == marked["hash"])
    clean = keyed.join(marked, same, "leftanti").select("row.*")
    dirty = keyed.join(marked, same).select("row", hide(text_or_empty("row.text"), "spans").alias("hidden"))
    row = F.col("row").withField("text", F.col("hidden"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("hidden").cast(docs.schema["n_chars"].dataType))
    return clean.unionByName(dirty.select(row.alias("row")).select("row.*"))


def digest_columns(spans: DataFrame) -> DataFrame:
    """The columns of the query: counts, the digest of the base spans, all spans as text."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*SECRETS, "format"]
        for batch in batches:
            rows = []
            for base, more in zip(batch.column("base").to_pylist(), batch.column("format").to_pylist(), strict=True):
                own = [(s["kind"], s["start"], s["end"]) for s in base]
                added = [(s["kind"], s["start"], s["end"]) for s in more]
                every = sorted(own + added, key=lambda s: (s[1], kinds.index(s[0])))
                rows.append((*(sum(s[0] == k for s in every) for k in kinds), sha256(joined(own)), joined(every)))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_format", "base_sha256", "spans"],
            )

    return spans.mapInArrow(
        digest, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_format bigint, "
        "base_sha256 string, spans string"
    )
