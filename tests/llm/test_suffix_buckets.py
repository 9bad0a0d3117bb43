import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sheaf import session
from sheaf.llm import suffix_buckets as sb
from sheaf.llm.common import text_hash, text_or_empty


def brute(texts, length):
    """Per text: bytes, removed bytes, runs, digest of the rest; from every passage of every text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[p : p + length] for t in raw for p in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t) + 1, np.int32)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p] += 1
                if p + length < len(gone):
                    gone[p + length] -= 1
        gone = np.cumsum(gone)[: len(t)] > 0
        runs = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, rows, length, parts=5):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    got = [
        (r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept_bytes"]).hexdigest())
        for r in sb.without_repeated_passages(docs, length).collect()
    ]
    want = [(i, *w) for (i, _), w in zip(rows, brute([t for _, t in rows], length))]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return got


def planted(seed, n, length):
    """Texts with copies, shared passages of about the length, one letter changed, and periods."""
    rng = random.Random(seed)
    letters = "abcdé 文"

    def words(k):
        return "".join(rng.choice(letters) for _ in range(k))

    shared = [words(rng.randrange(length // 2, 3 * length)) for _ in range(4)]
    texts = []
    for _ in range(n):
        text = words(rng.randrange(4 * length))
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            a = rng.randrange(len(s))
            text += s[a : a + rng.randrange(2 * length)] + words(rng.randrange(length))
        if texts and rng.random() < 0.3:
            old = list(rng.choice(texts))
            if old and rng.random() < 0.7:
                old[rng.randrange(len(old))] = "#"
            text = "".join(old)
        if rng.random() < 0.1:
            text += words(rng.randrange(1, 4)) * rng.randrange(length)
        texts.append(text)
    return texts


@pytest.mark.parametrize("length,seed", [(8, 0), (24, 1), (50, 2), (400, 3)])
def test_matches_brute_force(spark, length, seed):
    rows = list(enumerate(planted(seed, 60, length)))
    got = check(spark, rows, length)
    assert 0 < sum(r[2] for r in got) < sum(r[1] for r in got)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = check(spark, [(r["doc_id"], r["text"]) for r in docs], 400)
    assert any(0 < r[2] < r[1] for r in got)


def test_a_common_passage_amid_different_texts(spark):
    """A bucket with very many different pieces, and passages just long enough or too short."""
    rng = random.Random(5)
    word = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    for size in (38, 40, 45):
        common = word(size)
        check(spark, [(k, word(70) + common + word(70)) for k in range(60)], 40)


def test_odd_texts(spark, odd, nothing):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(spark, rows, 400)
    check(spark, rows, 9)
    wide = odd.selectExpr("*", "1 AS at", "2 AS `a.b`", "3 AS found", "4 AS id", "5 AS bucket")
    assert sb.without_repeated_passages(wide).count() == len(rows)
    assert sb.without_repeated_passages(nothing).count() == 0
    assert sb.without_repeated_passages(odd.filter("text is null")).count() == 2


def test_repeats_across_segments(spark, monkeypatch):
    """Passages that cross a border between segments, in texts longer than a segment."""
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh ") for _ in range(sb.SEGMENT + 5000))
    cut_at = sb.SEGMENT - 300
    check(spark, [(1, long), (2, "x" + long[cut_at : cut_at + 900]), (3, long[100:600] + "!")], 400)


def test_equal_passages_have_equal_anchors():
    shape = sb.Shape(400)
    rng = np.random.default_rng(4)
    passage = rng.integers(97, 105, 900).astype(np.uint8)
    alone = sb.anchors(passage, shape)
    amid = sb.anchors(np.concatenate([rng.integers(97, 105, 700).astype(np.uint8), passage]), shape)
    assert (amid[700:] - 700 == alone).all()


def test_bit_table_is_bounded(spark, monkeypatch):
    """With a table far too small everything passes, and the result is the same."""
    monkeypatch.setattr(sb, "LEAST_BITS", 64)
    monkeypatch.setattr(sb, "MOST_BITS", 64)
    check(spark, list(enumerate(planted(11, 40, 30))), 30)


def test_the_operator_reads_what_brute_force_reads(spark):
    docs = spark.createDataFrame([(1, "ab" * 300), (1, "ab" * 300), (2, None)], "doc_id bigint, text string")
    texts = docs.select("doc_id", text_or_empty().alias("text"), text_hash().alias("text_hash"))
    spans = sb.repeated_stretches(texts).distinct().collect()
    assert min(r["start"] for r in spans) == 0 and max(r["stop"] for r in spans) == 600


def test_stages_write_few_files(spark, monkeypatch, tmp_path):
    """However many partitions a shuffle has; and what no later stage reads is not written at all."""
    written = []

    def stage(df, name):
        path = tmp_path / f"{len(written)}-{name}"
        written.append(path)
        return session.stage(df, name, str(path))

    monkeypatch.setattr(sb, "stage", stage)
    changed = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        check(spark, list(enumerate(planted(6, 80, 40))), 40)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {p.name: len(list(p.glob("part-*"))) for p in written}
    assert max(files.values()) <= 2 * spark.sparkContext.defaultParallelism, files
    levels = len(sb.Shape(40).widths())
    assert [sum(n.endswith(kind) for n in files) for kind in ("classes", "open", "refined")] == [
        levels, levels - 1, levels - 1
    ]
