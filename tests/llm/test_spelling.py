import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from vidpulse.llm import spelling
from vidpulse.llm.queries import QUERIES

UPPER = str.maketrans(spelling.UPPER, spelling.LOWER)


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute_pairs(words):
    """Words that share what one deletion leaves, compared one by one."""
    left = defaultdict(set)
    for w in words:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            left[v].add(w)
    return {(a, b) for group in left.values() for a in group for b in group if one_edit(a, b)}


def brute_rows(counts, ratio=5):
    near = defaultdict(list)
    for a, b in brute_pairs(counts):
        near[a].append(b)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= ratio * n else None
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return rows


def brute_counts(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def columns(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def grouped(spark, counts, **options):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    return columns(spelling.group_variants(words, **options))


@pytest.mark.parametrize("most_pairs", [1, 40, 4096])
def test_words_of_few_letters(spark, most_pairs):
    pick = random.Random(5)
    counts = {"".join(pick.choices("abé", k=pick.randint(6, 9))): pick.choice([5, 9, 25, 70, 400, 5000]) for _ in range(700)}
    assert grouped(spark, counts, most_pairs=most_pairs) == brute_rows(counts)


def test_half_shared_by_many_words(spark):
    """A third of the words begin alike, and a chain of forms has several links."""
    pick = random.Random(6)
    counts = {"interna" + "".join(pick.choices("abcdefgh", k=7)): 5 + pick.randrange(90) for _ in range(1500)}
    counts |= {"colour": 5, "colours": 25, "colourss": 125, "colousss": 625, "coloussss": 3125, "ÿ" * 300: 5, "ÿ" * 301: 25}
    rows = grouped(spark, counts, most_pairs=500)
    assert rows == brute_rows(counts)
    assert next(r for r in rows if r[0] == "colour")[2] == "coloussss"


def test_ties_go_to_the_first_word(spark):
    counts = {"zebras": 5, "zebrbs": 100, "zebrás": 100, "xebras": 100}
    assert next(r for r in grouped(spark, counts) if r[0] == "zebras")[1] == "xebras"


def test_odd_rows(spark, odd_docs, no_docs):
    runs = spelling.letter_runs(odd_docs, min_length=1)
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    expected = Counter((i, m.translate(UPPER)) for i, t in texts for m in re.findall("[A-Za-zÀ-ÿ]+", t or ""))
    assert Counter(tuple(r) for r in runs.collect()) == expected
    empty = spelling.count_words(spelling.letter_runs(no_docs).withColumnRenamed("run", "word"))
    assert spelling.group_variants(empty).collect() == []


def test_without_letter(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([("aébc", i) for i in range(4)], "run string, at long").coalesce(1)
    left = rows.select(spelling.without_letter(F.col("run"), F.col("at"))).collect()
    assert [r[0] for r in left] == ["ébc", "abc", "aéc", "aéb"]


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert columns(QUERIES["op11_spelling"](spark, sf_dir)) == brute_rows(brute_counts(docs))
