import re
import unicodedata
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from vidpulse.llm import language
from vidpulse.llm.queries import QUERIES

SENTENCES = {
    "en": "the house on the hill was built with the stone that they had found there",
    "de": "das haus auf dem hügel wurde mit dem stein gebaut den sie dort gefunden hatten",
}


@pytest.fixture(scope="module")
def content():
    return language.dictionaries({k: [v] for k, v in SENTENCES.items()})


def test_dictionaries_have_one_size(content):
    assert len({len(x) for x in content.values()}) == 1


def test_a_short_language_shortens_no_other(content):
    texts = {k: [v] for k, v in SENTENCES.items()}
    found = language.dictionaries({**texts, "xx": ["salve"], "yy": ["123 45"], "zz": [""]})
    assert found == {**content, "xx": b"salve"}
    full = {"aa": ["ab " * 20_000], "bb": ["cd " * 10_500]}
    assert {k: len(v) for k, v in language.dictionaries(full).items()} == {"aa": language.DICTIONARY_BYTES, "bb": 31_499}
    judge = language.Classifier(found).judge
    for lang, text in SENTENCES.items():
        name, margin = judge(f"{text} 7")
        assert name == lang and margin >= 0.2


def test_judge(content):
    judge = language.Classifier(content).judge
    assert judge("They HAD found the stone on the hill, 12 times!")[0] == "en"
    assert judge("sie hatten das haus mit dem stein gefunden " * 500)[0] == "de"
    assert judge(None) == judge("") == judge("12 -- 3_") == ("und", 0.0)


@pytest.mark.parametrize("text", ["²½", "Ⅷ 12 ¾", "①②", "_²_"])
def test_numerals_are_no_letters(content, text):
    judge = language.Classifier(content).judge
    assert judge(text) == ("und", 0.0) and judge(f"{text} {SENTENCES['de']}")[0] == "de"


def plainly(content, text):
    """The smallest sum of frames, one frame for each piece, each compressor made anew."""
    if text is None or not any(unicodedata.category(c).startswith("L") for c in text):
        return "und", 0.0
    spaced = "".join(c if ord(c) > 127 or c.isalpha() else " " for c in text.lower())
    raw = re.sub("[ ]+", " ", spaced).strip(" ").encode()
    sizes = {}
    for lang, own in content.items():
        made = zstandard.ZstdCompressor(
            level=language.LEVEL, dict_data=zstandard.ZstdCompressionDict(own, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            write_checksum=False, write_content_size=False, write_dict_id=False,
        )
        sizes[lang] = sum(len(made.compress(raw[i : i + language.PIECE])) for i in range(0, len(raw), language.PIECE))
    best, second = sorted(sizes.values())[:2]
    return next(lang for lang, n in sizes.items() if n == best), 1 - best / second


def test_predictions_against_a_plain_loop(spark, sf_dir, odd_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learned = language.learn(docs)
    for table in (docs, odd_docs):
        found = sorted((str(r.doc_id), r.lang_pred, round(r.score, 12)) for r in language.predict(table, learned).collect())
        expected = [(r.doc_id, *plainly(learned, r.text)) for r in table.collect()]
        assert found == sorted((str(i), lang, round(score, 12)) for i, lang, score in expected)


def test_no_and_one_language():
    assert language.Classifier({}).judge("abc") == ("und", 0.0)
    assert language.Classifier({"en": b"abc"}).judge("abc") == ("en", 1.0)


def test_held_out_is_a_checksum_of_the_id(spark):
    rows = spark.range(200).select("id", language.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def test_sample_is_bounded_and_distinct(spark):
    rows = [(f"text number {i % 300}", "en" if i % 2 else "de") for i in range(3000)] + [("x" * 9000, "en"), (None, "en"), ("y", None)]
    found = language.sample(spark.createDataFrame(rows, "text string, lang string"), 20)
    assert set(found) == {"en", "de"}
    assert all(5 <= len(v) == len(set(v)) <= 80 for v in found.values())
    assert language.sample(spark.createDataFrame([], "text string, lang string")) == {}


def test_long_texts_are_learned_by_pieces(spark):
    long = [(f"{i} " + SENTENCES["de"] * 200, "de") for i in range(3)] + [("1 " * 9000 + "salve", "xx"), ("12", "yy")]
    docs = spark.createDataFrame([*long, (SENTENCES["en"], "en")], "text string, lang string")
    found = language.sample(docs)
    assert {k: len(v) for k, v in found.items()} == {"de": 3, "en": 1, "xx": 1}
    assert found["xx"] == ["salve"] and all(len(x) == language.SAMPLE_CHARS for x in found["de"])
    assert language.Classifier(language.learn(docs)).judge(SENTENCES["de"])[0] == "de"


def test_query_tells_held_out_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = QUERIES["op4_language"](spark, sf_dir)
    assert found.count() == docs.count() and found.filter("score < 0 or score > 1").isEmpty()
    rows = found.join(docs, "doc_id").filter("held_out and lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows)
    assert sum(r.rejected for r in rows) <= 0.1 * len(rows)


def test_odd_rows(odd_docs, no_docs, content):
    found = language.predict(odd_docs, content)
    assert found.count() == odd_docs.count()
    assert {r.doc_id for r in found.filter("lang_pred = 'und'").collect()} >= {0, 1, 2}
    kept = language.identified(odd_docs, content)
    assert kept.schema == odd_docs.schema and kept.filter("text is null").isEmpty()
    assert language.predict(no_docs, content).count() == language.identified(no_docs, content).count() == 0
    assert language.predict(odd_docs, {}).filter("lang_pred <> 'und'").isEmpty()
