import pytest

LONG_WORD = "x1" * 40_000
LONG = " ".join(f"w{i % 7919} mail{i}@a.example" if i % 500 == 0 else f"w{i % 7919}" for i in range(30_000))
SHARED = "one two three four five six seven eight nine ten eleven twelve"

#: Null ids and texts, empty texts, ties, repeated rows, long texts, signs beyond ASCII.
ROWS = [
    (1, None), (2, ""), (3, " \t\n "), (4, "word"), (5, "two words"),
    (6, SHARED), (7, SHARED), (7, SHARED), (8, SHARED.upper()), (None, SHARED), (None, None),
    (9, LONG), (10, LONG_WORD), (11, "É été Ñandú ẞ straße İ ﬁ 日本語 😀 call +1 (555) 010-9999 now"),
    (12, "a@b.co " * 300), (13, " nbsp wide \x1f"), (14, "é" * 5),
]
#: Columns with names that operators use inside, filled with nulls and strings.
CLASHING = [
    "_id", "_key", "_text", "label", "rep", "node", "tokens", "component", "gid", "value", "kind",
    "blob", "path", "_next", "_range", "_full", "_digest", "score", "start", "n_shingles", "id",
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [
        (number, text, None if place % 3 else "en", None, None if place % 2 else 3,
         *(None if place % 2 else "clash" for _ in CLASHING))
        for place, (number, text) in enumerate(ROWS)
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, "
    return spark.createDataFrame(rows, schema + ", ".join(f"`{c}` string" for c in CLASHING))


@pytest.fixture(scope="session")
def empty_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def edge_labels(spark):
    rows = [(1, 1, 0), (4, 1, 1), (5, 0, 1), (6, 1, 0), (6, 1, 0), (7, None, None), (None, 1, 1),
            (9, 0, 0), (11, 1, 1), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def documents(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """Id to text, an empty one for null."""
    return {row.doc_id: row.text or "" for row in documents.select("doc_id", "text").collect()}
