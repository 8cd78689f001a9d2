import os

import pytest

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, score string, fp string, id int, row int, key string, label string, chunk int, range int, mix_kept string"


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    return FOLDER


@pytest.fixture(scope="session")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, characters of all planes."""
    long = "The quick brown fox jumps over a lazy dog near the old river bank. " * 4000
    texts = [
        None, "", "  \n\t ", "one", "ÀÉ ß", "a b c d e", "A  B\nC D E", "a b c d e", long, long + "x", "世界 \U0001f600 don't we'll  go", "x" * 30000,
        "\x1c\x85 odd", "'s't're", long,
    ]
    extra = ("clash",) * 3 + (7, 7, "clash", "clash", 7, 7, "clash")
    rows = [(k, t, "en" if k % 2 else None, "src0" if k % 3 else None, len(t or ""), *extra) for k, t in enumerate(texts)]
    rows += [rows[5], (None, "a b c d e", "de", "src1", None, *extra), (None, None, None, None, None, *((None,) * len(extra)))]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def encoding():
    import base64

    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Sets:
    """Union of classes, the smallest member first."""

    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


@pytest.fixture(scope="session")
def sets():
    return Sets
