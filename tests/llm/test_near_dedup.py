import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sheaf.llm import near_dedup as nd
from sheaf.llm.components import components
from sheaf.llm.shingles import common, shingle_sets


def shingles(text, k):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def roots(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def brute(docs, k):
    """Component (smallest id, null ids last) and set size of every row, by all pairs of distinct sets."""
    rows = [(r["doc_id"] is None, r["doc_id"], n, shingles(r["text"], k)) for n, r in enumerate(docs)]
    by_set = defaultdict(list)
    for row in rows:
        by_set[row[3]].append(row)
    sets = [s for s in by_set if s]
    links = [
        (i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if 100 * len(a & b) >= 80 * len(a | b)
    ]
    root = roots(range(len(sets)), links)
    least = {}
    for i, s in enumerate(sets):
        for no_id, doc_id, n, _ in by_set[s]:
            key = (no_id, doc_id or 0, n)
            least[root[i]] = min(least.get(root[i], key), key)
    out = []
    for no_id, doc_id, n, s in rows:
        best = least[root[sets.index(s)]] if s else (no_id, doc_id or 0, n)
        out.append((doc_id, len(s), None if best[0] else best[1]))
    return out, len(set(root.values())) + sum(not s for *_, s in rows)


def near_copies(seed, families=6, size=40):
    """Families of texts at, just over and just under the bound, chains, and a passage many share."""
    random.seed(seed)
    words = [f"w{i}" for i in range(400)]
    passage = random.choices(words, k=12)
    texts = []
    for _ in range(families):
        base = random.choices(words, k=random.choice([8, 30, 90]))
        for _ in range(size):
            own = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2, 3, 6])):
                own[random.randrange(len(own))] = random.choice(words)
            texts.append(" ".join(own + (passage if random.random() < 0.3 else [])))
            base = own if random.random() < 0.2 else base
    return texts + [" ".join(passage + random.choices(words, k=20)) for _ in range(60)]


@pytest.mark.parametrize("k", [4, 5])
def test_components_match_brute_force(spark, odd, sf_dir, k):
    texts = near_copies(k)
    docs = spark.createDataFrame([(5000 + 7 * i % 999, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    docs = docs.unionByName(odd.select("doc_id", "text")).unionByName(
        spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id + 100000 AS doc_id", "text")
    ).repartition(5)
    docs.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/near-{k}")
    docs = spark.read.parquet(path)
    rows = nd.near_duplicates(docs, k).collect()
    want, groups = brute(docs.collect(), k)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=key) == sorted(want, key=key)
    assert sum(r["kept"] for r in rows) == groups
    assert all(r["doc_id"] == r["component_id"] for r in rows if r["kept"])


def test_blocks_of_a_bucket_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_MEMBERS", 7)
    monkeypatch.setattr(nd, "STAR_SHINGLES", 300)
    docs = spark.createDataFrame(list(enumerate(near_copies(9, 3, 80))), "doc_id bigint, text string")
    want, _ = brute(docs.collect(), 4)
    rows = nd.near_duplicates(docs, 4).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows) == sorted(want)


def test_one_of_each_component_stays(odd):
    kept = nd.without_near_duplicates(odd, 5)
    assert kept.columns == odd.columns
    texts = [r["text"] for r in kept.collect()]
    assert texts.count("one") == 1 and texts.count("two words") == 1


def test_no_rows(nothing):
    assert nd.near_duplicates(nothing, 4).count() == 0
    assert nd.without_near_duplicates(nothing).count() == 0


def estimates(left, right):
    """Estimated similarities of pairs of sets, from the packed bits of their sketches."""
    def words(sets):
        columns = nd._sketch_columns(sets)
        return np.stack([np.asarray(c).view(np.uint64) for c in columns[-nd.WORDS:]], axis=1)

    x = words(left) ^ words(right)
    different = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(nd._LOW_BITS)).sum(axis=1)
    return (1 - different / nd.HASHES - 0.25) / 0.75


def test_estimates_follow_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
    for shared in (0.5, 0.8, 0.95):
        n = int(2000 * shared)
        (estimate,) = estimates([np.sort(pool[:2000])], [np.sort(pool[2000 - n : 4000 - n])])
        assert abs(estimate - n / (4000 - n)) < 0.2


@pytest.mark.parametrize("shared,apart", [(4, 1), (80, 10)])
def test_no_link_is_discarded_for_its_lowest_bits(shared, apart):
    """Sets at exactly 0.8 whose few different shingles differ from the shared ones in bit 0 of every value."""
    rng = np.random.default_rng(5)
    left, right = [], []
    for _ in range(15_000):
        high = rng.choice(2**32, shared + 2 * apart, replace=False).astype(np.uint64) & ~np.uint64(1)
        high[shared:] |= np.uint64(1)
        own = (high << np.uint64(32)) | rng.integers(0, 2**32, len(high)).astype(np.uint64)
        # one shingle more on one side only, where that makes 0.8
        left.append(np.sort(own[: shared + apart]))
        right.append(np.sort(own[:shared] if shared == 4 else np.concatenate([own[:shared], own[shared + apart :]])))
    found = estimates(left, right)
    assert abs(found.mean() - 0.8) < 0.005 and found.std() < 0.05
    sizes = np.array([max(len(a), len(b)) for a, b in zip(left, right, strict=True)])
    different = np.rint((1 - (found * 0.75 + 0.25)) * nd.HASHES)
    assert nd._close(different, sizes).all()


def test_shingle_hashes_are_sets_of_word_sequences():
    random.seed(5)
    parts = ["a", "B", " ", "\n", "é", "ab ", "\xa0", "中 "]
    texts = ["".join(random.choices(parts, k=random.randint(0, 60))) for _ in range(400)] + [None, "", " ", "x y " * 300_000]
    for k in (1, 4, 5):
        sets, want = shingle_sets(pa.array(texts), k), [shingles(t, k) for t in texts]
        assert [len(s) for s in sets] == [len(s) for s in want]
        assert [common(a, b) for a, b in zip(sets, sets[1:], strict=False)] == [
            len(a & b) for a, b in zip(want, want[1:], strict=False)
        ]
    assert [len(s) for s in shingle_sets(pa.array(texts).slice(3, 5), 4)] == [len(shingles(t, 4)) for t in texts[3:8]]
    assert shingle_sets(pa.array([], pa.string()), 4) == []


def test_components_of_chains_stars_and_loops(spark):
    random.seed(7)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    rest = [(random.randrange(2000, 2200), random.randrange(2000, 2200)) for _ in range(120)]
    links = [*chain, *star, *rest, (5, 5), (None, 3), (7, 6)]
    random.shuffle(links)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    links = [(a, b) for a, b in links if a is not None and a != b]
    assert got == roots({n for pair in links for n in pair}, links)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
