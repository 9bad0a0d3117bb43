import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sheaf.llm import packing as pk

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_encoder_gives_the_tokenizer_ids(tokenizer):
    random.seed(1)
    parts = ["a", "B", " ", "\n", "'s", "1", "é", "中", "😀", "́", "​", "don't", "  ", "\xa0", "<|endoftext|>"]
    encode = pk.byte_bpe(RANKS)
    for _ in range(500):
        text = "".join(random.choices(parts, k=random.randint(0, 40)))
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_runs_of_white_space_outside_the_pattern(tokenizer, monkeypatch):
    """Cut at any length, such runs give the ids of the tokenizer, whatever stands around them."""
    import re

    monkeypatch.setattr(pk, "LONG_BLANKS", re.compile(pk.LONG_BLANKS.pattern.replace("4096", "3")))
    encode = pk.byte_bpe(RANKS)
    random.seed(8)
    parts = ["a", " ", "  ", "\n", "\t", "\r\n", "   ", "\xa0", "\u3000", "1", "'s", "é", "\x1c", "\u200b", "<|endoftext|>", "<"]
    for _ in range(3000):
        text = "".join(random.choices(parts, k=random.randint(0, 30)))
        assert encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("blank", [" ", "\t", "\n", " \n", "\r\n\t", "\u3000"])
def test_very_long_white_space(tokenizer, blank):
    text = "x" + blank * (3_000_000 // len(blank)) + "y" + blank * 10_000 + "<|endoftext|>" + blank * 5000
    ids = pk.byte_bpe(RANKS)(text)
    assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check(rows, want, capacity):
    """want: ids of every document with its end, a list per doc_id."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert sum(len(x) for d in want.values() for x in d) == sum(r["length"] for r in rows)
    for doc_id, documents in want.items():
        if len(documents) > 1:
            continue  # rows that share an id
        at = 0
        for k, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            ids = np.array(documents[0][at : at + r["length"]], "<u4")
            assert zlib.crc32(ids.tobytes()) == r["ids_crc32"]
            assert r["length"] == capacity or k == 0
            at += r["length"]
        assert at == len(documents[0])
    return len(by_sequence)


@pytest.mark.parametrize("capacity", [64, 1024])
def test_every_document_is_packed(spark, odd, sf_dir, tokenizer, capacity):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.selectExpr("doc_id + 1000 AS doc_id", "text").unionByName(odd.select("doc_id", "text"))
    want = defaultdict(list)
    for r in docs.collect():
        want[r["doc_id"]].append([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2])
    rows = pk.pack(docs, RANKS, capacity).collect()
    used = check(rows, want, capacity)
    assert used <= 1.02 * sum(len(x) for d in want.values() for x in d) / capacity + 2


def test_ids_come_with_the_pieces(odd):
    for r in pk.pack(odd, RANKS, with_ids=True).collect():
        assert len(r["ids"]) == r["length"]
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]


def test_no_rows(nothing):
    assert pk.pack(nothing, RANKS).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 101, 4000) if seed % 2 else np.minimum(rng.exponential(30, 4000).astype(int) + 1, 100)
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
    plan = pk.plan_sequences(histogram, 100, 20)
    filled, seen = defaultdict(list), defaultdict(int)
    for length, a, b, first, per, offset in sorted(plan.segments):
        assert a == seen[length]
        seen[length] = b
        for n in range(b - a):
            filled[first + n // per].append((offset + n % per * length, length))
    assert seen == histogram
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 100
    alone = pk._planned(histogram, 100, 0).sequences
    assert len(filled) == plan.sequences <= alone


def test_configurations_beat_best_fit():
    # sizes where filling greedily strands space: 51 with 27 and 22, not 51 with 49
    histogram = {51: 600, 27: 600, 26: 600, 23: 1200}
    plan = pk.plan_sequences(histogram, 100, 40)
    assert plan.sequences <= pk._planned(histogram, 100, 0).sequences
    assert plan.sequences >= -(-sum(n * c for n, c in histogram.items()) // 100)
