import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vidpulse.llm import quality
from vidpulse.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    found, covered, seen, dup = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if found[w] > 1:
            covered.update(range(i, i + 8))
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    n = len(words)
    return [n, sum(map(len, words)), symbols, dup, len(covered), n < 20 or 100 * len(covered) > 30 * n]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab é#|\n\r\t\x85.", max_size=60), max_size=5))
def test_counts_equal_brute_force(texts):
    columns, cleaned = quality.judge(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert [columns[c][i] for c in (*COUNTS, "base_failed")] == brute(text)
    assert len(cleaned) == len(texts)


PHRASES = (
    "all rights reserved|terms of use|terms of service|privacy policy|cookie policy|cookie settings|cookie consent"
    "|use cookies|uses cookies|enable javascript|javascript is disabled|javascript is required|sign in to|sign up for"
    "|subscribe to our|subscribe to the|newsletter|click here|read more|skip to content|skip to main content"
    "|lorem ipsum|follow us on|share this on|share on|page not found|powered by"
).split("|")


@pytest.mark.parametrize("phrase", PHRASES)
def test_phrases_count_in_short_lines_only(phrase):
    clean = " ".join(f"word{i}" for i in range(500))
    long, short = f"{clean} {phrase} the end.", f"Please {phrase} now."
    columns, cleaned = quality.judge(pa.array([long, f"{clean}.\n{short}"]))
    assert cleaned.to_pylist() == [long, f"{clean}."]
    assert columns["kept"].tolist() == [True, True]


def test_query(spark, sf_dir):
    found = {r.doc_id: r for r in QUERIES["op7_quality"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(docs)
    for r in docs:
        row = found[r.doc_id]
        assert [*(row[c] for c in COUNTS), row.base_failed] == brute(r.text)
        assert not (row.base_failed and row.kept)


def test_junk_goes_and_clean_documents_stay(spark, sf_dir):
    found = QUERIES["op7_quality"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = found.join(labels, "doc_id").filter("not base_failed").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    assert sum(r.kept for r in rows if r.quality == 0) <= 0.1 * sum(r.quality == 0 for r in rows)


GOOD = "The boat left the harbour early and came back with the evening tide."
MORE = "Nobody on the pier had seen so many herring in a single day before."
LAST = "By nightfall every barrel in the village was full to the brim."


@pytest.mark.parametrize(
    "line",
    ["Home | News | Sport | About", "a&&& b&&& c%%%", "BUY!! NOW!! CHEAP!!", "click here", "All rights reserved.", "next page", "Tous droits réservés, la maison du port.", "En savoir plus : lire la suite de cet article.", "Diese Seite verwendet Cookies für Besucher.", "ALLE RECHTE VORBEHALTEN, der Verlag am Hafen.", "Lea nuestra política de privacidad antes de entrar.", "Síguenos en todas las redes."],
)
def test_bad_lines_are_removed(line):
    columns, cleaned = quality.judge(pa.array([f"{GOOD}\n{line}\n{MORE}\n\n{LAST}"]))
    assert cleaned[0].as_py() == f"{GOOD}\n{MORE}\n\n{LAST}"
    assert columns["kept"][0] and columns["n_removed_lines"][0] == 1


def test_long_lines_keep_phrases_of_any_language():
    line = "Le notaire lui fit lire la suite du testament, wo man weiterlesen konnte, y ella quiso leer más " + " ".join(["mot"] * 60) + "."
    columns, cleaned = quality.judge(pa.array([f"{GOOD}\n{line}"]))
    assert cleaned[0].as_py().endswith(line) and columns["n_removed_lines"][0] == 0


def test_a_document_that_loses_too_much_goes():
    bad = "\n".join(f"w{i} | x{i} | y{i} | z{i}" for i in range(30))
    columns, _ = quality.judge(pa.array([f"{GOOD}\n{bad}"]))
    assert not columns["base_failed"][0] and not columns["kept"][0]


def test_rows_pass_with_their_columns(odd_docs, no_docs):
    kept = quality.clean(odd_docs)
    assert kept.schema == odd_docs.schema and kept.count() == 0
    assert quality.quality_rules(odd_docs).count() == odd_docs.count()
    texts = quality.quality_rules(odd_docs, texts=True).filter("doc_id = 0").collect()
    assert texts[0].cleaned is None and not texts[0].kept
    assert quality.clean(no_docs).count() == 0 and quality.quality_rules(no_docs).count() == 0


def test_length_column_follows_the_text(spark):
    docs = spark.createDataFrame([(1, f"{GOOD}\nclick here\n{MORE}", 5)], "doc_id long, text string, n_chars int")
    row = quality.clean(docs).first()
    assert row.n_chars == len(row.text) and "click" not in row.text
