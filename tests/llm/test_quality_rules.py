import re
from collections import Counter

from sheaf.llm import quality_rules as qr


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {
        i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)
    }
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_capitals": len(re.findall("[A-Z]", text)),
    }


def test_measures_match_brute_force(spark, odd, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = qr.with_measures(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert {m: r[m] for m in qr.MEASURES} == brute(r["text"])


def test_overlapping_windows(spark):
    texts = ["a a a a", "a b c x a b c", "a b a b a b", "q a b c d z a b c d", "a b c"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in qr.with_measures(docs).collect()}
    assert got == {i: brute(t)["n_repeat_words"] for i, t in enumerate(texts)}


def test_policies_and_ablations(spark, sf_dir):
    rows = qr.ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")).cache()
    seen = rows.collect()
    for policy in (qr.BASE, qr.PRODUCTION):
        mask = policy.mask()
        kept = {r["doc_id"] for r in rows.filter(qr.passes(policy)).collect()}
        assert kept == {r["doc_id"] for r in seen if not r["failed"] & mask}
        for a in qr.ablations(rows, policy).collect():
            bit = 1 << list(qr.RULES).index(a["rule"])
            assert a["failed"] == sum(bool(r["failed"] & bit) for r in seen)
            assert a["kept_without"] == sum(not r["failed"] & (mask & ~bit) for r in seen)


def test_verdicts_name_the_rule_they_hang_on(spark, sf_dir):
    rows = qr.ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")).cache()
    seen = rows.collect()
    for policy in (qr.BASE, qr.PRODUCTION):
        mask = policy.mask()
        kept = sum(not r["failed"] & mask for r in seen)
        for r in qr.judged(rows, policy).collect():
            own = r["failed"] & mask
            only = [name for k, name in enumerate(qr.RULES) if own == 1 << k]
            assert r["kept"] == (own == 0) and r["only_rule"] == (only[0] if only else None)
            assert r["kept_without"] == (kept + sum(x["failed"] & mask == own for x in seen) if only else None)


def test_rejected_documents_go_and_columns_stay(odd):
    kept = qr.kept_documents(odd)
    assert kept.columns == odd.columns
    assert {r["text"] for r in kept.collect()} == set()  # all are short or repeat themselves


def test_clean_documents_stay(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    good = docs.join(labels.filter("quality = 1"), "doc_id").select(*docs.columns)
    kept = {r["doc_id"] for r in qr.kept_documents(good).collect()}
    for r in good.collect():
        m = brute(r["text"])
        base = m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
        assert (r["doc_id"] in kept) == (not base)


def test_no_rows(nothing):
    assert qr.ledger(nothing).count() == 0
    assert qr.kept_documents(nothing).columns == nothing.columns
    assert {r["kept"] for r in qr.ablations(qr.ledger(nothing), qr.BASE).collect()} == {0}


def test_runs_without_python(odd):
    plan = qr.ledger(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
