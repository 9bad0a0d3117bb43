import hashlib
import random
import re
import time
import tracemalloc

import numpy as np
import pytest

from sheaf.llm import pii, secrets, spans
from sheaf.llm.automata import infer
from sheaf.llm.crf import Crf, train

PATTERNS = {
    "assign": r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (2 if k % 2 else 1) for k, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def passes(kind, m):
    digits = re.sub("[^0-9]", "", m[0])
    return {
        "assign": lambda: len(m[2]) >= 12, "access": lambda: len(m[0]) >= 18, "hex": lambda: len(m[0]) >= 16,
        "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def brute(text, kinds):
    return [(k, *m.span()) for k in kinds for m in re.finditer(PATTERNS[k], text or "") if passes(k, m)]


def texts():
    random.seed(11)
    parts = [
        "token", " = ", ":", '"', "'", "secret", "API_KEY", "apikey", "PASSWORD", "=", "abcdef0123456789", "AKIA", "Z9Y8X7W6V5U4T3S2",
        "a", "f", "0", "9", " ", "  ", "-", "@", ".", "mail", "x.y", "%", "+", "(555)", "4111 1111 1111 1111", "4012888888881881",
        "10.0.0.1", "256.1.1.1", "1.2.3", "\n", "é", "中", "😀", "ſ", "K", "_", "+1 (275) 555-5927", "٣",
    ]
    return ["".join(random.choices(parts, k=random.randint(0, 30))) for _ in range(4000)] + [
        "a@b.c%d@e.f", "..@x.y", "@x.y", "a@@b.c", "x@y", "a@b..c", "0" * 4000 + ".1.1.1", "00000000000255.1.1.1",
    ]


@pytest.mark.parametrize("finders", [spans.SECRETS, spans.PERSONAL])
def test_base_spans_match_the_plain_patterns(finders):
    for text in texts():
        assert spans.find(text, finders) == brute(text, finders), text


@pytest.mark.parametrize("finders", [spans.SECRETS, spans.PERSONAL])
def test_long_runs_take_linear_time(finders):
    for text in ("1" * 300_000, "a" * 300_000, "+" * 100_000, "1." * 100_000, "@" * 100_000, "token" * 50_000, " " * 300_000):
        spans.find(text, finders)
        list(pii.runs_of(text))


def digest(found):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest()


def test_secrets_of_every_document(spark, odd, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text")
    docs = docs.unionByName(odd.select("doc_id", "text")).unionByName(
        spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(texts()[:300])], "doc_id bigint, text string")
    )
    rows = secrets.digest_columns(secrets.secret_spans(docs)).collect()
    assert len(rows) == docs.count()
    want = {}
    order = list(spans.SECRETS)
    for r in docs.collect():
        found = sorted(brute(r["text"], order), key=lambda s: (s[1], order.index(s[0])))
        want.setdefault(r["doc_id"], []).append((digest(found), [sum(s[0] == k for s in found) for k in order], found))
    for r in rows:
        own = [w for w in want[r["doc_id"]] if w[0] == r["base_sha256"]]
        assert own
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == own[0][1]
        listed = [s for s in r["spans"].split(",") if s and not s.startswith("format")]
        assert listed == [f"{k}:{a}:{b}" for k, a, b in own[0][2]]


def test_automata_find_unlabelled_secrets_and_leave_words(spark):
    rng = random.Random(4)
    key = lambda head, n: head + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=n))
    words = ["".join(rng.choices("aeioutnrsl", k=rng.randint(16, 22))) for _ in range(300)]
    rows = [f"some {key('AKIA', 16)} here and {w} too" for w in words] + [f"plain {w} text" for w in words]
    rows += [f"other {key('ASIA', 16)} key" for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_format"] for r in secrets.digest_columns(secrets.secret_spans(docs)).collect()}
    assert all(got[i] == 0 for i in range(600))
    assert sum(got[i] for i in range(600, 620)) >= 16


def test_secrets_joined_to_their_surroundings_are_found(spark):
    rng = random.Random(4)
    key = lambda head, n=16: head + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=n))
    words = ["".join(rng.choices("aeioutnrsl", k=rng.randint(16, 22))) for _ in range(300)]
    rows = [f"some {key('AKIA')} here and {w} too" for w in words]
    around = ["it was {}.", "key={} then", "see a/b/{}/c", "AWS_ACCESS_KEY_ID={}", "-{}-", "x?sig={}&y", "AKIA" + "Z" * 16 + "/{}"]
    rows += [a.format(key("ASIA")) for a in around for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    spans_of = {r["doc_id"]: r["format"] for r in secrets.secret_spans(docs).collect()}
    assert not any(spans_of[i] for i in range(300))
    for k in range(len(around)):
        own = [(rows[i], spans_of[i]) for i in range(300 + 6 * k, 306 + 6 * k)]
        hits = sum(any(f["start"] <= t.index("ASIA") and f["end"] >= t.index("ASIA") + 20 for f in fs) for t, fs in own)
        assert hits >= 4, around[k]


def test_nine_and_ten_examples_give_like_results(spark):
    rng = random.Random(4)
    key = lambda: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16))
    words = ["".join(rng.choices("aeioutnrsl", k=rng.randint(16, 22))) for _ in range(100)]
    # a format of fixed classes, which the pattern labels after a name only
    value = lambda: "ZQ" + "".join(rng.choice("0123456789") for _ in range(14))
    counts = []
    for n in (9, 10):
        rows = [f"token = {value()} and {w}" for w in words[:n]] + [f"plain {w} text" for w in words[n:]]
        rows += [f"here is {value()} alone" for _ in range(20)]
        docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
        got = {r["doc_id"]: r["n_format"] for r in secrets.digest_columns(secrets.secret_spans(docs)).collect()}
        assert not any(got[i] for i in range(100))
        counts.append(sum(got[i] for i in range(100, 120)))
    assert counts == [20, 20]


def test_a_run_of_a_megabyte_is_judged_by_places():
    rng = random.Random(1)
    hidden = "AKIB" + "Z7" * 8
    run = "".join(rng.choices("abcdefgh-=./_+XYZ0123456789", k=500_000)) + "/" + hidden + "/" + "".join(
        rng.choices("abcdefgh-=./_+XYZ0123456789", k=500_000)
    )
    examples = ["AKIA" + "".join(rng.choices("GHIJKLMNOPQRSTUVWXYZ", k=1)) + "".join(
        x + y for x, y in zip(rng.choices("GZ", k=8), rng.choices("0123456789", k=8), strict=True)) for _ in range(50)]
    automaton = infer([e[:4] + e[5:] for e in examples])
    formats = secrets.Formats({"access": (automaton, -9.0)}, infer(["abc"]))
    tracemalloc.start()
    (found,) = secrets._format_spans([run], [[]], formats)
    assert tracemalloc.get_traced_memory()[1] < 400 << 20
    tracemalloc.stop()
    assert ("format", 500_001, 500_001 + len(hidden)) in found


def test_scores_at_places_are_those_of_the_texts():
    rng = random.Random(5)
    text = "".join(rng.choices("abcxyz019AGZ+/_=é中 ", k=3000))
    automaton = infer(text[a : a + rng.randint(1, 20)] for a in range(0, 2900, 7))
    places = [(a, a + rng.randint(0, 60)) for a in rng.choices(range(2900), k=500)]
    start, end = np.array(places).T
    from sheaf.llm.automata import codes

    alone = [automaton.scores([text[a:b]])[0] for a, b in places]
    assert np.allclose(automaton.scores_at(codes(text), start, end), alone, equal_nan=True)


def test_parts_of_a_run():
    run = "AWS_SECRET_ACCESS_KEY=abcd/efgh+ijkl-mnop=="
    found = {run[a:b] for a, b in secrets.parts(run)}
    assert {run, "abcd/efgh+ijkl-mnop==", "abcd/efgh+ijkl-mnop", "efgh+ijkl-mnop=="} <= found
    assert all(len(p) >= 12 for p in found)
    own = [("assign", 3, 20), ("hex", 10, 20)]
    assert list(secrets.candidates("ab " + "x" * 17 + "y" * 13 + " z", own)) == [(20, 33)]
    for c in "a-=.":
        secrets.parts(c * 300_000)
    assert len(secrets.parts("a-=./_+" * 20_000)) < 100


def test_redaction_keeps_rows_and_columns(spark, odd):
    text = "my token = abcdef0123456789abcd, again token = abcdef0123456789abcd!"
    docs = spark.createDataFrame(
        [(1, text, 5), (1, text, 5), (2, "clean", 5), (None, None, None), (None, text, 1)],
        "doc_id bigint, text string, n_chars bigint",
    )
    clean = secrets.redacted(docs, secrets.secret_spans(docs))
    assert clean.columns == docs.columns
    rows = sorted(map(tuple, clean.collect()), key=repr)
    hidden = "my [ASSIGN], again [ASSIGN]!"
    n = len(hidden)
    assert rows == sorted([(1, hidden, n), (1, hidden, n), (2, "clean", 5), (None, None, None), (None, hidden, n)], key=repr)
    assert secrets.redacted(odd, secrets.secret_spans(odd)).count() == odd.count()


def test_no_rows(nothing):
    assert secrets.secret_spans(nothing).count() == 0
    assert pii.personal_spans(nothing).count() == 0


def test_automaton_of_fixed_and_free_lengths():
    rng = random.Random(2)
    hexes = ["".join(rng.choices("0123456789abcdef", k=40)) for _ in range(200)]
    automaton = infer(hexes)
    scores = automaton.scores([*hexes[:50], "zzzzzzzzzzzzzzzzzzzz", "", "ABC"])
    assert np.isfinite(scores[:50]).mean() > 0.9
    assert not np.isfinite(scores[50]) and not np.isfinite(scores[52])
    assert not np.isfinite(infer([]).scores(["a"])).any()
    assert len(automaton.next) < 200  # states were merged


def test_personal_data_of_every_document(spark, odd, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text")
    docs = docs.unionByName(odd.select("doc_id", "text")).unionByName(
        spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(texts()[:300])], "doc_id bigint, text string")
    )
    rows = pii.digest_columns(pii.personal_spans(docs)).collect()
    assert len(rows) == docs.count()
    want = {}
    for r in docs.collect():
        found = brute(r["text"], spans.PERSONAL)
        want.setdefault(r["doc_id"], {})[digest(found)] = [sum(s[0] == k for s in found) for k in spans.PERSONAL]
    for r in rows:
        assert want[r["doc_id"]][r["base_sha256"]] == [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]]
        own = [tuple(s.split(":")) for s in r["spans"].split(",") if s]
        base = [(int(a), int(b)) for k, a, b in own if not k.startswith("likely")]
        for k, a, b in own:
            if k.startswith("likely"):
                assert not any(x < int(b) and int(a) < y for x, y in base)


def test_labels_are_those_of_the_first_span_that_overlaps():
    rng = random.Random(3)
    for _ in range(300):
        words = ["x" * rng.randint(1, 9) for _ in range(rng.randint(1, 12))]
        starts = np.cumsum([0] + [len(w) + rng.randint(0, 3) for w in words[:-1]]).tolist()
        own = []
        for kind in pii.KINDS:
            at = 0
            while (at := at + rng.randint(0, 12)) < 60:
                own.append((kind, at, at := at + rng.randint(1, 15)))
        want, last = [], None
        for word, start in zip(words, starts, strict=True):
            span = next((s for s in own if s[1] < start + len(word) and start < s[2]), None)
            want.append(0 if span is None else 1 + 2 * pii.KINDS.index(span[0]) + (span == last))
            last = span
        assert pii.run_labels(words, starts, spans.InOrder(own)) == want


def test_a_list_of_a_megabyte_of_addresses_takes_linear_time(spark):
    """The whole path: base spans, labels of runs, decoding, and what the field adds."""
    text = " ".join(f"a{k}@mail{k % 7}.example.com, +1 (275) 555-{k % 10000:04}" for k in range(25_000))
    assert len(text) > 10**6
    docs = spark.createDataFrame([(1, text), (2, text.replace(" ", ""))], "doc_id bigint, text string")
    begin = time.monotonic()
    rows = {r["doc_id"]: r for r in pii.digest_columns(pii.personal_spans(docs)).collect()}
    assert rows[1]["n_email"] == 25_000 and time.monotonic() - begin < 120


def test_features_see_the_whole_of_a_long_word():
    long = "ab" * 60
    seen = {pii.word_features(w) for w in (long, long + "1", long[:50] + "7" + long[50:], long[:90] + "-" + long[90:])}
    assert len(seen) == 4
    assert max(len(f) for f in pii.word_features("a1" * 500_000)) < 100


def test_field_finds_what_patterns_miss_and_leaves_clean_texts(spark):
    rng = random.Random(6)
    d = lambda n: "".join(rng.choices("0123456789", k=n))
    rows = [f"call +1 ({d(3)}) 555-{d(4)} now, page {d(2)} of {d(3)}" for _ in range(200)]
    rows += [f"write to ab.{d(2)}@mail{d(1)}.example.com or room {d(3)}" for _ in range(200)]
    rows += [f"in {d(4)} there were {d(2)} of them" for _ in range(200)]
    rows += [f"call +1 ({d(3)}) 555-{d(4)} {d(6)} now" for _ in range(20)]  # too many digits for the pattern
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in pii.digest_columns(pii.personal_spans(docs)).collect()}
    assert all(got[i]["n_likely"] == 0 for i in range(600))
    assert sum(got[i]["n_likely"] > 0 for i in range(600, 620)) >= 15


def test_personal_data_deep_in_long_words_is_found(spark):
    rng = random.Random(6)
    d = lambda n: "".join(rng.choices("0123456789", k=n))
    late = lambda: f"+1({d(3)})555-{d(10)}"  # noqa: E731  too many digits for the pattern
    phone = pii.LABELS.index("B-phone")
    known = [([late()], "phone", [phone]) for _ in range(200)] + [([d(rng.randint(1, 6))], "in", [0]) for _ in range(200)]
    labelled = spark.createDataFrame(known, "words array<string>, before string, labels array<int>")
    rows = [f"in {d(4)} there were {d(2)} of them" for _ in range(50)]
    rows += ['{"name":"' + "abc" * 40 + '","phone":"' + late() + '","room":"' + "x" * 100 + '"}' for _ in range(20)]
    rows += ["中文" * 60 + late() + "中文" * 60 for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["likely"] for r in pii.personal_spans(docs, labelled).collect()}
    assert not any(got[i] for i in range(50))
    for first in (50, 70):
        hits = [rows[i][s["start"] : s["end"]] for i in range(first, first + 20) for s in got[i]]
        assert len(hits) >= 15 and all(h.startswith("+1(") and len(h) == 21 for h in hits)


def test_long_runs_are_decoded_as_one():
    rng = np.random.default_rng(1)
    crf = Crf(rng.normal(size=(60, 9)), rng.normal(size=(9, 9)))
    names = [f"{n}={v}" for n in ("shape", "short", "digits") for v in ("9", "99", "1", "2")]
    tagger = pii.Tagger({n: k + 1 for k, n in enumerate([*names, "bias", "prev:short=9", "next:short=9"])}, crf)
    words = ["".join(rng.choice(list("0123456789"), rng.integers(1, 4))) for _ in range(9000)]
    (text_run,) = pii.token_runs(" ".join(words))
    assert text_run[0] == words
    labels, gain = crf.decode_blocks(tagger.blocks(words, "x"))
    (want,), (more,) = crf.decode([tagger.rows(words, "x")])
    assert labels.tolist() == want.tolist() and abs(gain - more) < 1e-6


def test_runs_hold_every_marked_word():
    for text in texts()[:1500]:
        found = [(w, s) for ws, ss, _ in pii.runs_of(text) for w, s in zip(ws, ss, strict=True)]
        words = [(m[0], m.start()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text) if re.search("[0-9@]", m[0])]
        assert found == words


def test_viterbi_matches_all_paths():
    import itertools

    rng = np.random.default_rng(1)
    crf = Crf(rng.normal(size=(6, 3)), rng.normal(size=(3, 3)))
    sequences = [rng.integers(0, 6, (n, 2)).tolist() for n in (1, 2, 4, 4)]
    paths, gains = crf.decode(sequences)

    def score(rows, path):
        path = (0, *path, 0)
        return sum(crf.emit[f, y] for fs, y in zip(rows, path[1:-1], strict=True) for f in fs) + sum(
            crf.move[a, b] for a, b in zip(path, path[1:], strict=False)
        )

    for rows, path, gain in zip(sequences, paths, gains, strict=True):
        best = max(itertools.product(range(3), repeat=len(rows)), key=lambda p: score(rows, p))
        assert tuple(path) == best
        assert abs(gain - (score(rows, best) - score(rows, (0,) * len(rows)))) < 1e-9


def test_training_fits_a_chain():
    sequences = [[[1], [2], [3]], [[2], [3]], [[3], [1]]] * 5
    labels = [[0, 1, 2], [1, 2], [0, 0]] * 5
    crf = train(sequences, labels, 4, 3)
    assert [p.tolist() for p in crf.decode(sequences)[0]] == labels
    assert not train([], [], 4, 3).emit.any()
