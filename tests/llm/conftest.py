import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "two words",
    "The quick brown fox, it's 3.5 times \"faster\"... than é́ and ＡＢ １２!",
    "x" * 5000,
    "long text again " * 20000,
    "<|endoftext|> is only text here",
    "### $$$ 127.0.0.1 ... ,,, a@b.c",
    "line one\n\nline two\n three  four \n",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows."""
    rows = [(n, t, "en" if n % 2 else None, None, None) for n, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (None, "no id here at all", None, "s", 3), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(spark):
    """Adds columns whose names the operators use inside."""
    names = ["fp", "_row", "n_words", "positions", "items", "at", "given", "root", "start", "label", "lang_pred", "_at"]

    def add(df):
        from pyspark.sql import functions as F

        return df.withColumns({n: F.lit(f"mine {n}") for n in names if n not in df.columns})

    return add


@pytest.fixture(scope="session")
def tables(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")

