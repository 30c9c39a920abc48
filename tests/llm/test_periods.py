import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from vidpulse.llm import periods
from vidpulse.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_runs(words):
    """Each start and period tried; a stretch counts under its smallest period."""
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - i + q
            if end > i and length >= max(6, 4 * q):
                found.setdefault((i, length), q)
            i = end + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    h, n = zlib.crc32(str("" if doc_id is None else doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected_row(doc_id, text):
    words = planted(doc_id, WORD.findall(text or ""))
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    milli = 1000 * best[1] // best[2] if runs else None
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        doc_id, len(runs), *best, milli,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
    )


def runs_of(words, group=None):
    codes = np.unique(np.array(words), return_inverse=True)[1].astype(np.int64)
    group = np.zeros(len(words), np.int64) if group is None else np.array(group)
    return [tuple(r) for r in periods.find_runs(codes, group).tolist()]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=4), st.integers(1, 9)), max_size=9))
def test_repeated_parts(parts):
    words = [x for part, times in parts for x in part * times]
    assert runs_of(words) == brute_runs(words) if words else True


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), max_size=25), min_size=1, max_size=6))
def test_texts_side_by_side(texts):
    flat = [x for t in texts for x in t]
    group = [k for k, t in enumerate(texts) for _ in t]
    expected, at = [], 0
    for t in texts:
        expected += [(s + at, n, q) for s, n, q in brute_runs(t)]
        at += len(t)
    if flat:
        assert runs_of(flat, group) == expected


def test_long_periods_and_long_texts():
    pick = random.Random(3)
    part = [pick.randrange(500) for _ in range(400)]
    words = [0] * 9 + part * 5 + part[:17] + [7, 8] * 3000 + [1] * 5 + [2] + [3] * 100_000
    found = runs_of(words)
    assert (9, 2017, 400) in found and (2026, 6000, 2) in found and found[-1][1:] == (100_000, 1)
    assert len(found) == 4 and found[0][1:] == (9, 1)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = periods.periodic_runs(odd_docs).collect()
    texts = {}
    for r in odd_docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    assert len(rows) == odd_docs.count()
    for r in rows:
        possible = []
        for text in texts[r.doc_id]:
            words = WORD.findall(text or "")
            runs = brute_runs(words) if len(words) < 1000 else [(0, len(words), 1)]
            possible.append((runs, collapsed(words, runs)))
        assert ([tuple(x) for x in r.runs], r.collapsed) in possible
    assert periods.periodic_runs(no_docs).collect() == []


def test_query_against_brute_force(spark, tmp_path, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = [r for r in rows if len(r[1] or "") < 20_000]
    rows += [(i, "go on " * 30 + "x y z " * (i % 5)) for i in range(10_000, 10_060)]
    rows += [(None, None), (None, "a b c d e f g h"), (7, ""), (8, "b b b b b b"), (8, "b b b b b b"), (9, "a b a b a b a b")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = [tuple(r) for r in QUERIES["op13_periods"](spark, str(tmp_path)).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(found, key=key) == sorted((expected_row(*r) for r in rows), key=key)
