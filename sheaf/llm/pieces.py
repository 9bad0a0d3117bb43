"""SentencePiece encoding with seeded merge dropout, and decoding.

The vocabulary of a SentencePiece BPE model is read from its file; merging is done here.
A text is cut before runs of spaces and at line ends, which no piece crosses, and every
segment is merged on its own: an agenda holds the neighbouring pairs that form a piece,
best score first, leftmost among equals. Each candidate taken from the agenda is skipped
if a hash of (seed, document, place in the text, piece) falls under the dropout rate:
every occurrence of a word in every document has draws of its own, and an encoding
depends on nothing but these. What does not depend on draws is kept by workers: a
segment's trace is what is taken from its agenda, in order, and the ids this ends in, if
nothing is skipped; from each skipped candidate another trace branches off. A trace that
only one occurrence in a batch asks for is not made: that occurrence is merged by itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, count, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sheaf.llm.common import crc32, in_chunks, text_hash, text_or_empty

DROPOUT, SEED = 0.1, 17
#: Traces after which a worker starts anew, and the longest segment whose traces it keeps.
KEPT_SEGMENTS, KEPT_LENGTH = 600_000, 48
#: Occurrences in a batch from which on a trace is made for them.
SHARED_BY = 4

#: Segments merged together: their tables should stay in a processor's cache.
GROWN_ROWS = 1 << 13
#: Occurrences whose draws are made together.
FOLLOWED_ROWS = 1 << 16

_M, _PIECE = (1 << 64) - 1, (1 << 32) - 1
_FACTOR, _SPREAD = 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F
_NONE = np.int64((1 << 62) - 1)


class _Column:
    """An array that grows at its end."""

    def __init__(self, dtype: type = np.int32):
        self.n, self.room = 0, np.empty(1024, dtype=dtype)

    def add(self, values: np.ndarray) -> None:
        n = self.n + len(values)
        if n > len(self.room):
            self.room = np.concatenate((self.room[: self.n], np.empty(2 * n - self.n, dtype=self.room.dtype)))
        self.room[self.n : n] = values
        self.n = n


class _Traces:
    """What draws can lead to, so far: traces with their draws and ids.

    Draws are numbered over all traces. A draw is a place in its segment and the piece
    that is made there unless it is skipped; then ``child`` is the trace that goes on, or
    -1 while nobody has needed it.
    """

    def __init__(self):
        self.root: dict[str, int] = {}
        self.segment: list[str] = []
        self.skips: list[tuple[int, ...]] = []  # the steps skipped on the way, the last one just before the first draw
        self.first, self.draws, self.start, self.length = _Column(np.int64), _Column(), _Column(np.int64), _Column()
        self.ids, self.place, self.piece, self.child = _Column(), _Column(), _Column(), _Column()


class PieceCodec:
    """Encoder and decoder of one model file, dropout rate and seed."""

    def __init__(self, model_path: str, dropout: float = 0.0, seed: int = SEED):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        normal, self.bytes_of, self.byte_id = {}, [b""] * model.get_piece_size(), [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value], self.bytes_of[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                normal[piece] = i
                self.bytes_of[i] = piece.replace("▁", " ").encode()
        # in a text the sign for a space is an ordinary sign: it must come back
        self.char_id = {(" " if p == "▁" else p): i for p, i in normal.items() if len(p) == 1}
        order = {s: k for k, s in enumerate(sorted({-model.get_score(i) for i in normal.values()}))}
        #: Whether each piece has a score of its own; then equal ranks are equal pieces.
        self.own_scores = len(order) == len(normal)
        self.merge: dict[int, int] = {}  # left id, right id: rank of the score, id of the piece
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = normal.get(piece[:cut]), normal.get(piece[cut:])
                if left is not None and right is not None:
                    self.merge[left << 20 | right] = order[-model.get_score(i)] + 1 << 32 | i
        self.id_of = np.full(0x110000, -1, dtype=np.int32)
        self.id_of[[ord(c) for c in self.char_id]] = list(self.char_id.values())
        self.pairs = np.array(sorted(self.merge), dtype=np.int64)
        self.results = np.array([self.merge[p] for p in self.pairs.tolist()], dtype=np.int64)
        self.one_line = "\n" in self.char_id  # else no piece crosses a line end either
        self.cut = re.compile(" +[^ ]*|[^ ]+")
        self.limit, self.seed = int(dropout * (1 << 53)), seed
        self.traces = _Traces()

    def encode_all(self, texts: list[str], keys: list[int]) -> list[list[int]]:
        """Ids of texts with the keys of their documents; a space is put before a text, as the model expects.

        Empty texts have none.
        """
        return [ids.tolist() for ids in self.encode_arrays(texts, keys)]

    def encode_arrays(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        cut = [self._segments(" " + t) if t else [] for t in texts]
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        segments = list(chain.from_iterable(cut))
        # words repeat: what does not depend on the place is looked up once for each
        encoded = pa.array(segments, pa.large_string()).dictionary_encode()
        word, words = np.asarray(encoded.indices).astype(np.int64), encoded.dictionary.to_pylist()
        word_lengths = np.fromiter(map(len, words), np.int64, len(words))
        lengths = word_lengths[word]
        place = np.cumsum(lengths) - lengths  # in its text, once that of the text is taken off
        firsts = np.cumsum(counts) - counts
        some = counts > 0
        place -= np.repeat(place[firsts[some]], counts[some])
        key = np.repeat(self._key(np.array([k & _M for k in keys], dtype=np.uint64)), counts)
        short = lengths <= KEPT_LENGTH
        own = self.traces
        known = np.fromiter((own.root.get(s, -1) for s in words), np.int64, len(words))
        times = np.bincount(word, minlength=len(words))
        fresh = np.flatnonzero((known < 0) & (word_lengths <= KEPT_LENGTH) & (times >= SHARED_BY))
        known[fresh] = self._grow([(words[k], ()) for k in fresh.tolist()])
        trace = known[word]
        kept = np.flatnonzero(trace >= 0)
        trace[kept] = self._followed(trace[kept], key[kept], place[kept])
        kept, alone = np.flatnonzero(trace >= 0), np.flatnonzero(short & (trace < 0))
        long = np.flatnonzero(~short)
        more = [self._merged(segments[k], keys[d], int(place[k])) for k, d in zip(
            long.tolist(), (np.searchsorted(firsts, long, "right") - 1).tolist(), strict=True
        )]
        single, starts, sizes = self._merged_alone([segments[k] for k in alone.tolist()], key[alone], place[alone])
        pool = np.concatenate((own.ids.room[: own.ids.n], single, np.array(list(chain.from_iterable(more)), dtype=np.int32)))
        start, n = np.empty(len(segments), dtype=np.int64), np.empty(len(segments), dtype=np.int64)
        start[kept], n[kept] = own.start.room[trace[kept]], own.length.room[trace[kept]]
        start[alone], n[alone] = own.ids.n + starts, sizes
        n[long] = np.fromiter(map(len, more), np.int64, len(more))
        start[long] = own.ids.n + len(single) + np.cumsum(n[long]) - n[long]
        stops = np.cumsum(n)
        flat = pool[np.repeat(start - stops + n, n) + np.arange(stops[-1] if len(stops) else 0)]
        bounds = np.concatenate(([0], stops))[np.concatenate(([0], np.cumsum(counts)))].tolist()
        if len(own.segment) >= KEPT_SEGMENTS:
            self.traces = _Traces()
        return [flat[a:b] for a, b in pairwise(bounds)]

    def encode(self, text: str, key: int = 0) -> list[int]:
        return self.encode_all([text], [key])[0]

    def _followed(self, trace: np.ndarray, key: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The traces that occurrences of segments end in, from those they begin with; -1 where a trace is not made."""
        own, trace = self.traces, trace.copy()
        rows = np.arange(len(trace)) if self.limit else np.empty(0, np.int64)
        while len(rows):
            # all draws of a trace at once; the first that is skipped leads to another trace
            found = [self._first_skipped(rows[a : a + FOLLOWED_ROWS], trace, key, place) for a in range(0, len(rows), FOLLOWED_ROWS)]
            rows, draw = (np.concatenate(x) for x in zip(*found, strict=True))
            fresh = own.child.room[draw] < 0
            new, one, times = np.unique(draw[fresh], return_index=True, return_counts=True)
            shared = times >= SHARED_BY
            new, parents = new[shared], trace[rows[fresh][one[shared]]]
            wanted = []
            for p, k in zip(parents.tolist(), (new - own.first.room[parents]).tolist(), strict=True):
                skips = own.skips[p]
                wanted.append((own.segment[p], (*skips, k + (skips[-1] + 1 if skips else 0))))
            numbers = self._grow(wanted)
            own.child.room[new] = numbers
            trace[rows] = own.child.room[draw]
            rows = rows[trace[rows] >= 0]
        return trace

    def _merged_alone(
        self, segments: list[str], key: np.ndarray, place: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of occurrences of short segments, one behind the other, and where those of each start and how many they are."""
        n = np.empty(len(segments), dtype=np.int64)
        widths = (np.fromiter(map(len, segments), np.int64, len(segments)) + 7) // 8
        order, found = np.argsort(widths, kind="stable"), [np.empty(0, dtype=np.int32)]
        bounds = np.searchsorted(widths[order], np.unique(widths)).tolist() + [len(order)]
        for a, b in pairwise(bounds):
            for part in (order[k : min(k + GROWN_ROWS, b)] for k in range(a, b, GROWN_ROWS)):
                def skipped(_, rows, at, piece, key=key[part], place=place[part]) -> np.ndarray:  # noqa: ANN001
                    return self._skipped(key[rows], place[rows] + at, piece)

                ids, n[part] = self._merge_rows([segments[k] for k in part.tolist()], 8 * int(widths[part[0]]), skipped)
                found.append(ids)
        start = np.empty(len(segments), dtype=np.int64)
        start[order] = np.cumsum(n[order]) - n[order]
        return np.concatenate(found), start, n

    def _first_skipped(
        self, rows: np.ndarray, trace: np.ndarray, key: np.ndarray, place: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``rows`` whose trace has a draw that is skipped, and the first such draw."""
        own = self.traces
        n = own.draws.room[trace[rows]].astype(np.int64)
        stops = np.cumsum(n)
        draw = np.repeat(own.first.room[trace[rows]] - stops + n, n) + np.arange(stops[-1])
        row = np.repeat(rows, n)
        at = np.flatnonzero(self._skipped(key[row], place[row] + own.place.room[draw], own.piece.room[draw]))
        row = row[at]
        first = np.ones(len(at), dtype=bool)
        first[1:] = row[1:] != row[:-1]
        return row[first], draw[at[first]]

    def _grow(self, wanted: list[tuple[str, tuple[int, ...]]]) -> np.ndarray:
        """Add the traces of segments after some skipped steps; those after none are the segments' roots. Their numbers."""
        own = self.traces
        numbers = np.empty(len(wanted), dtype=np.int64)
        by_width: dict[int, list[int]] = {}
        for k, (segment, _) in enumerate(wanted):
            by_width.setdefault(-(-len(segment) // 8), []).append(k)
        for width, members in by_width.items():
            for a in range(0, len(members), GROWN_ROWS):
                part = members[a : a + GROWN_ROWS]
                segments, skips = [wanted[k][0] for k in part], [wanted[k][1] for k in part]
                forced: dict[int, list[int]] = {}
                for r, steps in enumerate(skips):
                    for step in steps:
                        forced.setdefault(step, []).append(r)
                last = np.array([steps[-1] if steps else -1 for steps in skips])
                seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                mask = np.zeros(len(part), dtype=bool)

                def skipped(step, rows, place, piece, last=last, seen=seen, mask=mask, forced=forced) -> np.ndarray:  # noqa: ANN001
                    new = last[rows] < step
                    seen.append((rows[new], place[new], piece[new]))
                    if step not in forced:
                        return np.zeros(len(rows), dtype=bool)
                    mask[:] = False
                    mask[forced[step]] = True
                    return mask[rows]

                ids, lengths = self._merge_rows(segments, 8 * width, skipped)
                row, place, piece = (np.concatenate(x) for x in zip(*seen, strict=True)) if seen else [np.empty(0, np.int64)] * 3
                order = np.argsort(row, kind="stable")
                draws = np.bincount(row, minlength=len(part))
                numbers[part] = new = np.arange(len(own.segment), len(own.segment) + len(part))
                own.first.add(own.place.n + np.cumsum(draws) - draws)
                own.draws.add(draws)
                own.place.add(place[order])
                own.piece.add(piece[order])
                own.child.add(np.full(len(row), -1))
                own.start.add(own.ids.n + np.cumsum(lengths) - lengths)
                own.length.add(lengths)
                own.ids.add(ids)
                own.segment += segments
                own.skips += skips
                own.root.update((s, k) for s, steps, k in zip(segments, skips, new.tolist(), strict=True) if not steps)
        return numbers

    def _segments(self, text: str) -> list[str]:
        if self.one_line:
            return self.cut.findall(text)
        out = []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            if "" in rest:  # several spaces stay together, before the word they lead to
                out += self.cut.findall(line)
            else:
                if head:
                    out.append(head)
                out += [" " + w for w in rest]
            out.append("\n")
        return out[:-1]

    def decode(self, ids: list[int]) -> str:
        """The text of some ids; the space that encoding puts first is taken away."""
        of = self.bytes_of
        return b"".join([of[i] for i in ids])[1:].decode()

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What neighbouring symbols merge to (rank << 32 | piece), or ``_NONE``."""
        pair = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.results[at], _NONE)

    def _merged_together(self, segments: list[str], key: int, width: int) -> list[list[int]]:
        """:meth:`_merged` of many short segments."""
        mixed = self._key(np.array([key & _M], dtype=np.uint64))
        ids, lengths = self._merge_rows(segments, width, lambda _, rows, place, piece: self._skipped(mixed, place, piece))
        return [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]

    def _merge_rows(
        self, segments: list[str], width: int, skipped_in: Callable[..., np.ndarray]
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many short segments, and how many each has: in each round every segment takes one entry of its agenda.

        A segment is a row of symbols, of what each merges to with the next one, and of
        where its neighbours stand.
        ``skipped_in(round, rows, places, pieces)`` tells which entries are skipped.
        """
        rows = len(segments)
        columns = np.arange(width + 1)
        lengths = np.fromiter(map(len, segments), np.int64, rows)
        symbol = np.full((rows, width + 1), -3, dtype=np.int32)
        symbol[columns < lengths[:, None]] = self.id_of[np.frombuffer("".join(segments).encode("utf-32-le"), "<u4")]
        after = np.broadcast_to(columns + 1, symbol.shape).astype(np.int32)
        before = np.broadcast_to(columns - 1, symbol.shape).astype(np.int32)
        merges = np.full((rows, width + 1), _NONE)
        merges[:, :-1] = self._look_up(symbol[:, :-1], symbol[:, 1:])
        live = np.arange(rows)
        for step in count():
            # the best score first, the leftmost of equals: ranks are above, pieces below
            table = merges if len(live) == rows else merges[live]
            k = table.argmin(axis=1) if self.own_scores else (table >> 32).argmin(axis=1)
            found = merges[live, k]
            some = found != _NONE
            live, k, found = live[some], k[some], found[some]
            if not len(live):
                break
            piece = (found & _PIECE).astype(np.int32)
            skipped = skipped_in(step, live, k, piece)
            merges[live[skipped], k[skipped]] = _NONE
            r, k, piece = live[~skipped], k[~skipped], piece[~skipped]
            # the right symbol goes; its place stays empty, and its neighbours are linked
            j = after[r, k]
            m = after[r, j]
            symbol[r, k], symbol[r, j], merges[r, j] = piece, -2, _NONE
            after[r, k], before[r, m] = m, k
            merges[r, k] = self._look_up(piece, symbol[r, m])
            b = before[r, k]
            left = b >= 0
            r, b = r[left], b[left]
            merges[r, b] = self._look_up(symbol[r, b], piece[left])
        used = symbol >= -1
        flat, sizes = symbol[used], used.sum(axis=1)
        unknown = np.flatnonzero(flat == -1)
        if len(unknown):  # signs outside the vocabulary become their bytes
            row, at = (x[unknown] for x in np.nonzero(used))
            signs = [segments[r][k].encode() for r, k in zip(row.tolist(), at.tolist(), strict=True)]
            n = np.ones(len(flat), dtype=np.int64)
            n[unknown] = np.fromiter(map(len, signs), np.int64, len(signs))
            sizes += np.bincount(row, n[unknown] - 1, len(sizes)).astype(np.int64)
            flat = np.repeat(flat, n)
            flat[flat == -1] = np.array(self.byte_id)[np.frombuffer(b"".join(signs), np.uint8)]
        return flat, sizes

    def _key(self, keys: np.ndarray) -> np.ndarray:
        """Keys of documents, mixed with the seed."""
        h = (keys ^ np.uint64(self.seed * _FACTOR & _M)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return h ^ h >> np.uint64(31)

    def _skipped(self, key: np.ndarray, place: np.ndarray, piece: np.ndarray) -> np.ndarray:
        h = key ^ (place.astype(np.uint64) << np.uint64(20) | piece.astype(np.uint64)) * np.uint64(_FACTOR)
        return ((h ^ h >> np.uint64(32)) * np.uint64(_SPREAD)) >> np.uint64(11) < np.uint64(self.limit)

    def _merged(self, segment: str, key: int, start: int = 0) -> list[int]:
        """Ids of a segment that begins at ``start`` of a text."""
        get, merge, limit = self.char_id.get, self.merge.get, self.limit
        symbol = [get(c, -1) for c in segment]
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # an entry is a score's rank and a place; what it merges is looked up when it is taken
        agenda = [
            found & ~_PIECE | k for k, pair in enumerate(pairwise(symbol)) if (found := merge(pair[0] << 20 | pair[1]))
        ]
        heapify(agenda)
        key = int(self._key(np.array([key & _M], dtype=np.uint64))[0])
        while agenda:
            entry = heappop(agenda)
            k = entry & _PIECE
            j = after[k]
            if j >= n or symbol[k] < 0:
                continue
            found = merge(symbol[k] << 20 | symbol[j])
            if not found or (found ^ entry) > _PIECE:
                continue  # what stood here has been merged with something else
            piece = found & _PIECE
            if limit:
                h = (key ^ (start + k << 20 | piece) * _FACTOR) & _M
                if ((h ^ h >> 32) * _SPREAD & _M) >> 11 < limit:
                    continue
            symbol[k], symbol[j] = piece, -2
            after[k] = m = after[j]
            if m < n:
                before[m] = k
                found = merge(piece << 20 | symbol[m])
                if found:
                    heappush(agenda, found & ~_PIECE | k)
            b = before[k]
            if b >= 0:
                found = merge(symbol[b] << 20 | piece)
                if found:
                    heappush(agenda, found & ~_PIECE | b)
        ids = []
        k = 0
        while k < n:
            if symbol[k] >= 0:
                ids.append(symbol[k])
            else:
                ids += [self.byte_id[x] for x in segment[k].encode()]
            k = after[k]
        return ids


@lru_cache(maxsize=4)
def codec(model_path: str, dropout: float, seed: int) -> PieceCodec:
    return PieceCodec(model_path, dropout, seed)


def _texts(docs: DataFrame) -> DataFrame:
    """``key`` is what the draws of a row depend on: its id, or the hash of its text if it has none."""
    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(
        doc_id.alias("doc_id"), text_hash().alias("text_hash"), F.coalesce(doc_id, text_hash()).alias("key"),
        text_or_empty().alias("text"),
    )


def encoded(
    docs: DataFrame, model_path: str, dropout: float = DROPOUT, seed: int = SEED
) -> DataFrame:
    """``doc_id, text_hash, ids`` for every row of ``docs`` (doc_id, text; others are ignored).

    Null and empty texts have no ids; rows that share an id are encoded each by itself.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path, dropout, seed)
        for batch in in_chunks(batches, "text", 8 << 20):
            ids = own.encode_all(batch.column("text").to_pylist(), batch.column("key").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(ids, pa.list_(pa.int32()))],
                names=["doc_id", "text_hash", "ids"],
            )

    return _texts(docs).mapInArrow(encode, "doc_id bigint, text_hash bigint, ids array<int>")


def decoded(tokens: DataFrame, model_path: str) -> DataFrame:
    """``tokens`` (with a column ids) with a column ``text`` in its place; null ids give null."""
    columns = [c for c in tokens.columns if c not in ("ids", "text")]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path, 0.0, SEED)
        for batch in batches:
            texts = [None if ids is None else own.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield batch.select(columns).append_column("text", pa.array(texts, pa.string()))

    schema = ", ".join(f"`{n}` {t}" for n, t in tokens.select(*columns).dtypes)
    return tokens.select(*columns, "ids").mapInArrow(decode, schema + ", text string")


def round_trips(
    docs: DataFrame, model_path: str, dropout: float = DROPOUT, seed: int = SEED
) -> DataFrame:
    """What encoding and decoding every row of ``docs`` gives, in one pass.

    ``doc_id, n_tokens, n_byte_tokens`` (of signs outside the vocabulary),
    ``ids_crc32`` (as little-endian unsigned 32-bit numbers), ``lossless``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_path, dropout, seed)
        is_byte = np.zeros(len(own.bytes_of), dtype=bool)
        is_byte[own.byte_id] = True
        for batch in in_chunks(batches, "text", 8 << 20):
            texts, rows = batch.column("text").to_pylist(), []
            for text, ids in zip(texts, own.encode_arrays(texts, batch.column("key").to_pylist()), strict=True):
                rows.append((len(ids), int(is_byte[ids].sum()), crc32(ids), own.decode(ids.tolist()) == text))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=["doc_id", "n_tokens", "n_byte_tokens", "ids_crc32", "lossless"],
            )

    return _texts(docs).drop("text_hash").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, n_byte_tokens bigint, ids_crc32 bigint, lossless boolean"
    )
