import pytest

ODD_TEXTS = [
    None, "", " \t\n", "one", "two words", "a b c", "A B C d e f g", "x " * 3000, "y" * 50_000, "éèê 中文 😀 \x00 ▁ ﬁ",
    "same line\nsame line\nsame line", "a\x0bb\x0cc\rd", "<|endoftext|> </s> <s>", "  lead and  double  ", "\n\n\n",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, ties, repeated rows and ids, very long texts, columns that clash with internal names or hold dots."""
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, "one"), (3, "one"), (3, "another text under the same id"), (None, "no id"), (None, None), (-7, "two words")]
    clashing = ["_hash", "_key", "_id", "_spans", "_named", "_order", "_text", "row", "hash", "spans", "a.b", "count", "x"]
    rows = [(i, t, f"src{k % 3}", k, "x", 1.0, *[f"{c}{k}" for c in clashing]) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, source string, node int, text_hash string, failed double, "
        + ", ".join(f"`{c}` string" for c in clashing)
    ).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, source string")


@pytest.fixture(scope="session")
def sf_dir():
    import os

    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("test tables are not here")
    return path
