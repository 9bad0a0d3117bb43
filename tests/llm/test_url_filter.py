import random
import re

import pytest

from sheaf.llm import url_filter as uf

URLS = [
    None, "", "no scheme", "http://", "https://WWW.Example.COM/en/1?x#y", "http://example.com/en/", "http://a.example.com/en",
    "http://example.com", "http://notexample.com/en/", "ftp://x.net/es/1", "http://net/fr/#a", "http://x.net:80/es/", "x://y://z.com/a",
    "http://casino.org/", "http://my-casino-win.org/a", "http://mycasino.org/", "http://x.org/?q=CASINO", "http://free-bets.org",
    "http://freebets.org", "http://x.org/payday/abc/loan", "http://x.org/archive/pdf", "http://poker.com/", "http://x.org/a?b://c",
    "http://x.org\n/path\nline", "http://.com/", "http://com./", "é://ü.com/ß",
    "http://x.org/payday\n\r\nloan\n", "http://x.org/poker\n",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def matches(pattern, text):
    """Follows a pattern through a text, sign by sign."""
    if not all(part in text for part in re.split(r"[*^]", pattern)):
        return False
    at = set(range(len(text) + 1))
    for c in pattern:
        if c == "*":
            at = set(range(min(at), len(text) + 1)) if at else at
        elif c == "^":
            at = {k for k in at if k in (0, len(text))} | {k + 1 for k in at if k < len(text) and not re.match("[0-9a-z]", text[k])}
        else:
            at = {k + 1 for k in at if k < len(text) and text[k] == c}
    return bool(at)


def brute(url, hosts, patterns):
    host, path = parts(url)
    fits = [
        (len(h + p), len(h), h + p, v) for h, p, v in hosts
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")
    hits = [(len(p), p, v) for p, v in patterns if url is not None and matches(p, lower)]
    rule, pattern = max(fits, default=None), max(hits, default=None)
    verdict = rule[3] if rule else pattern[2] if pattern else "allow"
    return host, path, rule and rule[2], pattern and pattern[1], verdict


@pytest.mark.parametrize("more", [[], [("*", "block")], [("^x*org^", "block"), ("org/^", "allow")]])
def test_every_url_matches_brute_force(spark, sf_dir, more):
    patterns = uf.PATTERN_RULES + more
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS * 2)], "page_id bigint, url string").unionByName(
        spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr("page_id + 1000 AS page_id", "url")
    )
    rows = uf.judged(pages, uf.host_table(spark, uf.HOST_RULES), uf.pattern_table(spark, patterns)).collect()
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["pattern"], r["verdict"]) for r in map(none_last, rows))
    want = sorted((r["page_id"], *none_row(brute(r["url"], uf.HOST_RULES, patterns))) for r in pages.collect())
    assert got == want


def test_thousands_of_patterns(spark):
    draw = random.Random(8)
    words = ["".join(draw.choices("abcde01", k=draw.randint(1, 3))) for _ in range(150)]
    patterns = {
        "".join(draw.choice(["^", "*", "", "-", "/"]) + draw.choice(words) for _ in range(draw.randint(1, 3))) + draw.choice(["^", "*", ""])
        for _ in range(4000)
    }
    rules = [(p, draw.choice(["allow", "block"])) for p in sorted(patterns)]
    urls = ["http://" + "".join(draw.choice(words) + draw.choice("./-_?\n") for _ in range(draw.randint(1, 6))) for _ in range(250)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rows = uf.judged(pages, uf.host_table(spark, uf.HOST_RULES), uf.pattern_table(spark, rules)).collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["pattern"], r["verdict"]) for r in rows}
    assert len(rules) > 3000 and got == {k: brute(u, uf.HOST_RULES, rules) for k, u in enumerate(urls)}
    assert len({g[3] for g in got.values()}) > 100


def none_row(values):
    return tuple("" if v is None else v for v in values)


def none_last(row):
    return {k: "" if v is None and k in ("rule", "pattern") else v for k, v in row.asDict().items()}


def test_patterns_lie_under_their_rarest_token(spark):
    urls = spark.createDataFrame([("http://win.com/a",)] * 3 + [("http://casino.com/",)], "url string")
    index = uf.pattern_index(urls, uf.pattern_table(spark, [("^casino-win^", "block"), ("*ab", "block"), ("^win-zzz^", "block")]))
    assert {r["pattern"]: r["key"] for r in index.collect()} == {"^casino-win^": "casino", "*ab": "", "^win-zzz^": "zzz"}
    assert uf.pattern_tokens("ab^cd*ef^gh^") == ["gh"]


def test_no_rows_and_no_rules(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, rule string")
    hosts, patterns = uf.host_table(spark, uf.HOST_RULES), uf.pattern_table(spark, uf.PATTERN_RULES)
    assert uf.judged(pages, hosts, patterns).count() == 0
    some = spark.createDataFrame([(1, "http://a.com/"), (None, None)], "page_id bigint, url string")
    none = uf.judged(some, hosts.limit(0), patterns.limit(0)).collect()
    assert {r["verdict"] for r in none} == {"allow"} and {r["rule"] for r in none} == {None}
