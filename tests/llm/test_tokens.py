import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from sheaf.llm import pieces, token_files as tf

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def texts(n=1500):
    random.seed(3)
    parts = ["a", "B", " ", "  ", "\n", "é", "中", "😀", "\t", "the", "\xa0", "ing ", "0", "word ", "unbelievable "]
    return ["".join(random.choices(parts, k=random.randint(0, 60))) for _ in range(n)]


def test_without_dropout_ids_are_the_models(plain):
    own = texts() + ["x" * 5000, "the " * 2000, "ab" * 3000]
    for text, ids in zip(own, pieces.PieceCodec(MODEL).encode_all(own, [0] * len(own)), strict=True):
        assert ids == plain.encode(text)


def test_dropout_varies_repeats_and_is_lossless(plain):
    own = [*texts(600), "▁ ▁a▁", "\x00", "<0x41></s>"]
    codec, again = pieces.PieceCodec(MODEL, 0.3, 5), pieces.PieceCodec(MODEL, 0.3, 5)
    a = codec.encode_all(own, [k % 3 for k in range(len(own))])
    assert [codec.decode(ids) for ids in a] == own
    # one at a time, in another order: the same ids
    for k in reversed(range(len(own))):
        assert again.encode(own[k], k % 3) == a[k]
    other_slot, other_seed = codec.encode_all(own, [7] * len(own)), pieces.PieceCodec(MODEL, 0.3, 6).encode_all(own, [0] * len(own))
    assert a != other_slot and a != other_seed and other_slot != other_seed
    assert sum(map(len, a)) > 1.1 * sum(len(plain.encode(t)) for t in own)


def test_merging_together_is_merging_alone():
    codec = pieces.PieceCodec(MODEL, 0.25, 9)
    segments = [s for s in {s for t in texts(800) for s in codec._segments(" " + t)} if len(s) <= 24]
    assert codec._merged_together(segments, 2, 24) == [codec._merged(s, 2) for s in segments]


def test_forgetting_segments_changes_nothing(monkeypatch):
    own = texts(300)
    want = pieces.PieceCodec(MODEL, 0.2, 1).encode_all(own, [0] * len(own))
    monkeypatch.setattr(pieces, "KEPT_SEGMENTS", 20)
    codec = pieces.PieceCodec(MODEL, 0.2, 1)
    assert [codec.encode(t) for t in own] == want


def test_tables_go_there_and_back(spark, odd, nothing):
    tokens = pieces.encoded(odd, MODEL)
    back = pieces.decoded(tokens, MODEL)
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=key) == sorted(
        ((r["doc_id"], r["text"] or "") for r in odd.collect()), key=key
    )
    rows = pieces.round_trips(odd, MODEL).collect()
    assert all(r["lossless"] for r in rows)
    want = sorted((len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in tokens.collect())
    assert sorted((r["n_tokens"], r["ids_crc32"]) for r in rows) == want
    assert pieces.round_trips(nothing, MODEL).count() == 0


@pytest.mark.parametrize("block_bytes", [2, 6, 64, 1 << 20])
def test_counts_are_stitched_across_blocks(spark, tmp_path, block_bytes):
    rng = np.random.default_rng(block_bytes)
    want = set()
    for f, (n, ended) in enumerate([(0, True), (1, True), (40, True), (40, False), (1, False), (300, True)]):
        lengths = rng.choice([0, 0, 1, 2, 3, 7, 40, 200], n).tolist()
        if not ended:
            lengths[-1] = max(lengths[-1], 1)
        ids = [x for k in lengths for x in [*rng.integers(3, 60_000, k).tolist(), 2]]
        ids = ids if ended else ids[:-1]
        np.array(ids, "<u2").tofile(tmp_path / f"{f}.bin")
        want |= {(f, k, m, ended or k < n - 1) for k, m in enumerate(lengths)}
    rows = tf.token_counts(spark, str(tmp_path), block_bytes).collect()
    got = {(int(r["path"].rsplit("/", 1)[1][0]), r["nth"], r["n_tokens"], r["ended"]) for r in rows}
    assert got == want and len(rows) == len(want)


def test_a_cut_file_is_refused(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole number of ids"):
        tf.token_counts(spark, str(tmp_path)).collect()


def test_documents_get_their_counts(spark, odd, sf_dir, plain, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text").unionByName(
        odd.select("doc_id", "text")
    )
    docs.repartition(4).write.parquet(path := str(tmp_path / "docs"))
    docs = spark.read.parquet(path)
    for file_bytes in (20_000, tf.FILE_BYTES):
        rows = tf.counted_documents(docs, MODEL, file_bytes).collect()
        key = lambda x: (x[0] is None, x[0] or 0, x[1])
        want = sorted(((r["doc_id"], len(plain.encode(r["text"] or ""))) for r in docs.collect()), key=key)
        assert sorted(((r["doc_id"], r["n_tokens"]) for r in rows), key=key) == want


def test_files_are_bounded_by_their_ids(spark, plain, tmp_path):
    own = ["", None, "word " * 3000, "a", "", "unbelievable " * 40, None] * 3 + ["x"]
    spark.createDataFrame([(t,) for t in own], "text string").coalesce(1).write.parquet(path := str(tmp_path / "docs"))
    tf.write_token_files(spark.read.parquet(path), MODEL, out := str(tmp_path / "ids"), 1000)
    files = sorted((tmp_path / "ids").glob("part-*"))
    want = [plain.encode(t or "") for t in own]
    assert np.concatenate([np.fromfile(f, "<u2") for f in files]).tolist() == [x for ids in want for x in [*ids, 2]]
    sizes = [f.stat().st_size for f in files]
    assert len(sizes) > 3 and max(sizes) < 1000 + 2 * max(map(len, want)) + 2 and all(s >= 1000 for s in sizes[:-1])
    assert tf.token_counts(spark, out).count() == len(own)


def test_no_documents(spark, nothing, tmp_path):
    nothing.write.parquet(path := str(tmp_path / "none"))
    assert tf.counted_documents(spark.read.parquet(path), MODEL).count() == 0


def test_every_occurrence_and_document_draws_for_itself(plain):
    word = " unbelievable"
    codec = pieces.PieceCodec(MODEL, 0.3, 5)
    ids = codec.encode_all([word[1:] + word * 200] * 40, [2 * k for k in range(40)])
    assert len(set(map(tuple, ids))) == 40  # documents of one parity
    single = codec.encode_all([word[1:]] * 4000, list(range(4000)))
    # one document's occurrences of a word are cut in as many ways as those of many documents, or nearly
    inside = [tuple(x) for x in "".join(f"|{i}" for i in ids[0]).split("".join(f"|{i}" for i in single[0]))]
    assert len({tuple(x) for x in single[:200]}) > 30 and len(inside) < 100
    assert {tuple(x) for x in single} >= {tuple(plain.encode(word[1:]))}


def test_kept_traces_are_what_merging_each_occurrence_gives():
    own, codec = texts(400), pieces.PieceCodec(MODEL, 0.25, 9)
    for text, ids, key in zip(own, codec.encode_all(own, list(range(400))), range(400), strict=True):
        want, place = [], 0
        for s in codec._segments(" " + text) if text else []:
            want += codec._merged(s, key, place)
            place += len(s)
        assert ids == want


def test_rows_without_id_draw_by_their_text(spark):
    docs = spark.createDataFrame([(None, f"unbelievable unbelievable {k}") for k in range(60)], "doc_id bigint, text string")
    rows = [tuple(r["ids"][:4]) for r in pieces.encoded(docs, MODEL, 0.3).collect()]
    assert len(set(rows)) > 5


@pytest.mark.parametrize("shared_by", [1, 3, 1000])
def test_traces_made_or_not_give_the_same_ids(monkeypatch, shared_by):
    own = [*texts(300), "unbelievable 中😀 " * 20, "\x00\x01 é￿" * 3, ""]
    keys = list(range(len(own)))
    monkeypatch.setattr(pieces, "SHARED_BY", shared_by)
    codec = pieces.PieceCodec(MODEL, 0.25, 9)
    for _ in range(2):  # the second time traces of the first are there
        for text, ids, key in zip(own, codec.encode_all(own, keys), keys, strict=True):
            want, place = [], 0
            for s in codec._segments(" " + text) if text else []:
                want += codec._merged(s, key, place)
                place += len(s)
            assert ids == want and codec.decode(ids) == text
    assert not codec.encode_all([], []) and codec.encode_all([""], [1]) == [[]]
