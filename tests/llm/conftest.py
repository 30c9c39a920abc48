import pytest

from vidpulse.llm.common import tokenizer_path


@pytest.fixture(scope="session")
def path():
    return tokenizer_path()


@pytest.fixture(scope="session")
def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


ODD_TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "one",
    "Hello, it's WE'LL don't 12.5 ½ ²x ªº",
    "café Ça Σίσυφος ΣΑΣ. 中文 テスト",
    "<|endoftext|>x<|startoftext|> <|endoftext|",
    "İstanbul \x1c a\x1d\x85b\xa0c",
    "a" * 3000,
    "word " * 20_000,
    "ab" * 200 + " !!!???...",
    "\u023a x\u023e\u023e yȺy ẞ",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts with repeated, null and far ids and a column whose name clashes."""
    rows = [(i, t, "en", "s", i, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, "one", "en", "s", 3, "x"), (None, "one", None, None, None, None), (2**40, "last one", "en", "s", 1, "")]
    schema = "doc_id long, text string, lang string, source string, n long, ids string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
