import pytest

#: Texts that are awkward for every operator: null, empty, blank, no letters, other scripts, combining marks, long runs.
ODD = [
    None,
    "",
    " \t\n",
    "12 34 !!",
    "été été İstanbul ǅ 你好世界 \U0001f600‍\U0001f680 ẞΣσς",
    "don't you'll it's 'sat' we’re",
    "<|startoftext|>hello<|endoftext|> <|not special|>",
    "a b c\u0085d\x1ce\x0bf",
    "x" * 30_000,
    "word " * 20_000,
    "\x00nul\x00 bytes",
    "one two three four",
    "one two three four five",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """ODD with extra columns of clashing names, a repeated row and a null id."""
    rows = [(900 + i, t, None, "s", None, 1.0, "x", b"y", 2, 3) for i, t in enumerate(ODD)]
    rows += [rows[3], rows[4], (None, "the text of nobody", "en", "s", 18, 1.0, "x", b"y", 2, 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, ids binary, slot int, word int").cache()


@pytest.fixture(scope="session")
def all_docs(spark, sf, odd_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.unionByName(odd_docs.select(*docs.columns)).cache()
