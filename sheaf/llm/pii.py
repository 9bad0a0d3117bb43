"""Personal data: base patterns, and spans a conditional random field adds.

Words without a digit or @ are pinned to the label "outside". A chain of labels falls
apart at pinned words, so decoding only the runs of other words, between labels
"outside", gives exactly the labels that decoding whole texts would. Words of more than
``LONG_WORD`` characters, and words with East Asian script, are cut into tokens first,
as whole records and sentences can stand there without a space. One pass over the
texts finds base spans and runs; the field is trained on a small labelled table of runs,
and all runs are then decoded in batches.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sheaf.llm.common import in_chunks, sampled, text_hash, text_or_empty
from sheaf.llm.crf import Crf, train
from sheaf.llm.spans import IP, PERSONAL, PHONE, InOrder, Span, find, joined, sha256
from sheaf.session import stage

#: A word with a digit or @. It starts after white space and no sign is looked at twice.
MARKED = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*")
GAP = re.compile(r"[\x20\x09-\x0D]+\Z")
BEFORE = re.compile(r"[^\x20\x09-\x0D]{1,40}\Z")
#: What stands between the tokens of a word that is cut, and East Asian script, which is a token by itself.
LONG_WORD = 80
EAST = r"\u2E80-\u9FFF\uAC00-\uD7AF\uF900-\uFAFF\uFE30-\uFE4F\uFF00-\uFFEF\U00020000-\U0003FFFF"
BETWEEN = ",;:=?!&|/\"'<>{}\\[\\]\\\\"
EASTERN = re.compile(f"[{EAST}]")
TOKEN = re.compile(f"[{EAST}]+|[^{BETWEEN}{EAST}]+")
DIGIT_OR_AT = re.compile("[0-9@]")
#: Words of a run whose features are held at a time.
BLOCK_WORDS = 4096
#: Rows of the labelled table used, and words of a run used, for training.
TRAINING_RUNS, TRAINING_WORDS = 2000, 24
#: A decoded run must beat "nothing here" by so much (natural logarithm), and hold so many digits or an @.
LEAST_GAIN, LEAST_DIGITS = 3.0, 7

KINDS = list(PERSONAL)
LABELS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]
SPAN = "struct<kind:string,start:int,end:int>"
RUN = "struct<words:array<string>,starts:array<int>,before:string,labels:array<int>>"
FOUND = f"doc_id bigint, text_hash bigint, base array<{SPAN}>, runs array<{RUN}>"

_SHAPES = str.maketrans(
    "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "9" * 10 + "A" * 26 + "a" * 26
)


def _told(shape: str) -> str:
    """A shape as it is, or a digest of the whole of one that is long."""
    return shape if len(shape) <= LONG_WORD else f"#{zlib.crc32(shape.encode())}"


def word_features(word: str) -> tuple[str, ...]:
    """Names of a word's own features: its shape, its shape without lengths, its ends, its numbers of digits.

    All are of the whole word, however long it is.
    """
    return _kept_features(word) if len(word) <= LONG_WORD else _features(word)


def _features(word: str) -> tuple[str, ...]:
    shape = word.translate(_SHAPES)
    short = re.sub(r"(.)\1+", r"\1", shape)
    digits = shape.count("9")
    return (
        "shape=" + _told(shape), "short=" + _told(short), "first=" + shape[:2], "last=" + shape[-2:],
        f"digits={min(digits, 20)}", f"dots={min(word.count('.'), 4)}", f"at={word.count('@')}",
        "edge=" + word[:1] + word[-1:] if not word[:1].isalnum() else "edge=",
    )


@lru_cache(maxsize=100_000)
def _kept_features(word: str) -> tuple[str, ...]:
    return _features(word)


def run_features(words: list[str], before: str) -> list[list[str]]:
    """Features of every word of a run: its own, and the short shapes of its neighbours."""
    own = [word_features(w) for w in words]
    around = ["before=" + before.lower().rstrip(":=")[-12:], *(f[1] for f in own), "after"]
    return [
        [*f, "prev:" + around[k], "next:" + around[k + 2], "bias"] for k, f in enumerate(own)
    ]


def runs_of(text: str) -> Iterator[tuple[list[str], list[int], str]]:
    """Runs of neighbouring marked words: the words, their starts, the word before."""
    words: list[str] = []
    starts: list[int] = []
    end = 0

    def run() -> tuple[list[str], list[int], str]:
        head = text[max(0, starts[0] - 60) : starts[0]].rstrip(" \t\n\x0b\x0c\r")
        before = BEFORE.search(head)
        return words, starts, before[0] if before else ""

    for m in MARKED.finditer(text):
        if words and m.start() - end > 1 and not GAP.match(text, end, m.start()):
            yield run()
            words, starts = [], []
        words.append(m[0])
        starts.append(m.start())
        end = m.end()
    if words:
        yield run()


def token_runs(text: str) -> Iterator[tuple[list[str], list[int], str]]:
    """The runs of a text with the words that are to be cut in tokens; a token without a digit or @ ends a run."""
    for words, starts, before in runs_of(text):
        if all(len(w) <= LONG_WORD and (w.isascii() or not EASTERN.search(w)) for w in words):
            yield words, starts, before
            continue
        own: list[str] = []
        places: list[int] = []
        for word, start in zip(words, starts, strict=True):
            cut = len(word) > LONG_WORD or EASTERN.search(word)
            for a, token in [(m.start(), m[0]) for m in TOKEN.finditer(word)] if cut else [(0, word)]:
                if DIGIT_OR_AT.search(token):
                    own.append(token)
                    places.append(start + a)
                    continue
                if own:
                    yield own, places, before
                    own, places = [], []
                before = token[-40:]
        if own:
            yield own, places, before


def run_labels(words: list[str], starts: list[int], spans: InOrder) -> list[int]:
    """The label of each word by the first of the spans that overlap it."""
    labels, last = [], None
    for word, start in zip(words, starts, strict=True):
        span = min(spans.touching(start, start + len(word)), default=None)
        labels.append(0 if span is None else 1 + 2 * KINDS.index(spans.spans[span][0]) + (span == last))
        last = span
    return labels


def undecided(text: str, own: list[Span]) -> list[Span]:
    """What looks like a phone number or an address but fails its check: runs with it are no examples."""
    loose = [("phone", *m.span()) for m in PHONE.finditer(text)] if "+" in text else []
    loose += [("ip", *m.span()) for m in IP.finditer(text)] if "." in text else []
    known = set(own)
    return [s for s in loose if s not in known]


def found_spans(docs: DataFrame) -> DataFrame:
    """Per document: base spans by kind and start, and its runs with the labels those spans give (null: undecided)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        run = pa.list_(pa.struct([
            ("words", pa.list_(pa.string())), ("starts", pa.list_(pa.int32())), ("before", pa.string()),
            ("labels", pa.list_(pa.int32())),
        ]))
        for batch in in_chunks(batches, "text"):
            base, runs = [], []
            for text in batch.column("text").to_pylist():
                own = find(text, PERSONAL)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in own])
                open_, known = InOrder(undecided(text, own)), InOrder(own)
                runs.append([
                    {
                        "words": w, "starts": s, "before": b,
                        "labels": None if open_.touching(s[0], s[-1] + len(w[-1])) else run_labels(w, s, known),
                    }
                    for w, s, b in token_runs(text)
                ])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(base, span), pa.array(runs, run)],
                names=["doc_id", "text_hash", "base", "runs"],
            )

    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_hash().alias("text_hash"), text_or_empty().alias("text")
    )
    return texts.mapInArrow(search, FOUND)


@dataclass(frozen=True)
class Tagger:
    """A trained field and the numbers of its features."""

    numbers: dict[str, int]
    crf: Crf

    def rows(self, words: list[str], before: str) -> list[list[int]]:
        return [[self.numbers.get(f, 0) for f in fs] for fs in run_features(words, before)]

    def blocks(self, words: list[str], before: str) -> Iterator[list[list[int]]]:
        """:meth:`rows` of a long run, some at a time."""
        for a in range(0, len(words), BLOCK_WORDS):
            head = min(a, 1)  # a neighbour on both sides, for its shape
            yield self.rows(words[a - head : a + BLOCK_WORDS + 1], before)[head : head + BLOCK_WORDS]

    def spans(self, runs: list[dict]) -> list[list[Span]]:
        """What each run adds: spans of whole words less the signs around them."""
        short = [r for r in runs if len(r["words"]) <= BLOCK_WORDS]
        found = zip(*self.crf.decode([self.rows(r["words"], r["before"]) for r in short]), strict=True)
        decoded, gains = [], []
        for r in runs:
            whole = len(r["words"]) <= BLOCK_WORDS
            labels, gain = next(found) if whole else self.crf.decode_blocks(self.blocks(r["words"], r["before"]))
            decoded.append(labels)
            gains.append(gain)
        return [
            _spans_of(r["words"], r["starts"], labels) if gain >= LEAST_GAIN and labels.any() else []
            for r, labels, gain in zip(runs, decoded, gains, strict=True)
        ]


def _spans_of(words: list[str], starts: list[int], labels: np.ndarray) -> list[Span]:
    spans: list[list] = []
    last = 0
    for word, start, label in zip(words, starts, labels.tolist(), strict=True):
        if label:
            kind, inside = KINDS[(label - 1) // 2], label % 2 == 0
            head = len(word) - len(word.lstrip("\"'<[{,;:=|"))
            body = word[head:].rstrip("\"'>]},;:.!?|")
            a, b = start + head, start + head + len(body)
            if inside and last and (last - 1) // 2 == (label - 1) // 2:
                spans[-1][2] = b
                spans[-1][3] += body
            else:
                spans.append([kind, a, b, body])
        last = label
    return [
        (f"likely_{kind}", a, b) for kind, a, b, body in spans
        if ("@" in body) == (kind == "email") and (kind == "email" or sum(c.isdigit() for c in body) >= LEAST_DIGITS)
    ]


def learn(labelled: DataFrame, most: int = TRAINING_RUNS) -> Tagger:
    """A tagger from a table of runs (words, before, labels); runs without labels are left out.

    Half of the ``most`` rows used are runs with personal data, half without, of each the
    ones with the smallest hashes; that sample is what comes to the driver.
    """
    usable = labelled.filter((F.size("words") <= TRAINING_WORDS) & F.col("labels").isNotNull()).select("words", "before", "labels")
    usable = stage(usable.dropDuplicates(["words", "before"]), "pii-labels")
    with_data = F.exists("labels", lambda x: x > 0)
    runs = []
    for wanted in (with_data, ~with_data):
        runs += sampled(usable.filter(wanted), most // 2, "words", "before")
    named = [run_features(r["words"], r["before"]) for r in runs]
    numbers = {f: k + 1 for k, f in enumerate(sorted({f for run in named for fs in run for f in fs}))}
    sequences = [[[numbers[f] for f in fs] for fs in run] for run in named]
    return Tagger(numbers, train(sequences, [list(r["labels"]) for r in runs], len(numbers) + 1, len(LABELS)))


def personal_spans(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored).

    ``doc_id, text_hash``, ``base`` and ``likely`` (arrays of kind, start, end); the latter
    are spans the field adds, none of which overlaps a base span. Without a ``labelled``
    table (words, before, labels) the runs of ``docs`` themselves, labelled by the base
    patterns, are the table a sample is taken from. Null and empty texts have no spans.
    """
    found = stage(found_spans(docs), "pii-spans")
    if labelled is None:
        labelled = found.select(F.explode("runs").alias("r")).select("r.*")
    tagger = learn(labelled)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            bases, runs = batch.column("base").to_pylist(), batch.column("runs").to_pylist()
            added = iter(tagger.spans([r for own in runs for r in own]))
            out = []
            for base, own in zip(bases, runs, strict=True):
                known = InOrder([(s["kind"], s["start"], s["end"]) for s in base])
                fresh = [s for _ in own for s in next(added)]  # by start, as runs and words are
                out.append([
                    {"kind": k, "start": a, "end": b} for k, a, b in fresh if not known.touching(a, b)
                ])
            yield batch.drop_columns(["runs"]).append_column("likely", pa.array(out, span))

    return found.mapInArrow(judge, f"doc_id bigint, text_hash bigint, base array<{SPAN}>, likely array<{SPAN}>")


def digest_columns(spans: DataFrame) -> DataFrame:
    """The columns of the query: counts, the digest of the base spans, all spans as text."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = [*KINDS, *(f"likely_{k}" for k in KINDS)]
        for batch in batches:
            rows = []
            for base, more in zip(batch.column("base").to_pylist(), batch.column("likely").to_pylist(), strict=True):
                own = [(s["kind"], s["start"], s["end"]) for s in base]
                added = [(s["kind"], s["start"], s["end"]) for s in more]
                every = sorted(own + added, key=lambda s: (order.index(s[0]), s[1]))
                rows.append((*(sum(s[0] == k for s in own) for k in KINDS), len(added), sha256(joined(own)), joined(every)))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            types = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "n_likely", "base_sha256", "spans"],
            )

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return spans.mapInArrow(digest, f"doc_id bigint, {counts}, n_likely bigint, base_sha256 string, spans string")
