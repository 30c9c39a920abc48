import itertools
import re
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vidpulse.llm import jaccard
from vidpulse.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def grams(text):
    words = WORD.findall((text or "").translate(LOW))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute(rows):
    """``(doc_id, n, component)`` of each row, by comparing all pairs that share an n-gram."""
    sets = [grams(t) for _, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(set)
    for k, s in enumerate(sets):
        if rows[k][0] is not None:
            for g in s:
                holders[g].add(k)
    pairs = set()
    for found in holders.values():
        pairs.update(itertools.combinations(sorted(found), 2))
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((top(rows[a][0]), top(rows[b][0])))
            up[y] = x
    return sorted(((i, len(s), i if i is None or not s else top(i)) for (i, _), s in zip(rows, sets)), key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def near_copies():
    """Chains, near misses, copies, a passage that many share, and short texts."""
    rows, base = [], [f"w{i}" for i in range(60)]
    for k in range(12):
        words = list(base)
        words[(5 * k) % 60] = f"x{k}"
        words += [f"y{j}" for j in range(k)]
        rows.append((100 + k, " ".join(words)))
    passage = " ".join(f"p{i}" for i in range(30))
    rows += [(200 + k, f"{passage} " + " ".join(f"q{k}_{i}" for i in range(5 + 6 * (k % 5)))) for k in range(25)]
    rows += [(300 + k, "the same few words here") for k in range(9)] + [(310, "The  SAME\nfew words here"), (311, "the same few")]
    rows += [(400, None), (401, ""), (402, " \n"), (None, "the same few words here"), (100, "repeated id with other words in it")]
    return rows + [(100, rows[0][1]), (100, None), (101, ""), (300, None)]


@pytest.mark.parametrize("kwargs", [{}, {"chunk_grams": 200, "split_run": 3}, {"chunk_grams": 40}, {"chunk_rows": 3}, {"chunk_rows": 2, "chunk_grams": 60}])
def test_small_cases_in_one_and_many_chunks(spark, kwargs):
    docs = spark.createDataFrame(near_copies(), "doc_id long, text string").repartition(4)
    assert found(jaccard.jaccard_components(docs, **kwargs)) == brute(near_copies())


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert found(QUERIES["op10_jaccard"](spark, sf_dir)) == brute(rows)


def test_prefixes_share_enough_columns():
    for n in range(1, 200):
        for m in range(n, 200):
            least = -(-75 * (n + m) // 175)
            if least <= n:
                # Even with all shared columns last, so many lie in both prefixes.
                want = jaccard.least_shared(n)
                assert min(jaccard.prefix_size(n) - (n - least), jaccard.prefix_size(m) - (m - least)) >= want


def test_runs_of_many_documents_make_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRED", 3)
    docs = spark.createDataFrame(near_copies(), "doc_id long, text string").repartition(2)
    assert found(jaccard.jaccard_components(docs)) == brute(near_copies())


@pytest.mark.parametrize("paired", [2, 3, 32])
@pytest.mark.parametrize("batch", [1, 4, 100])
def test_every_pair_of_a_column_meets(spark, monkeypatch, paired, batch):
    monkeypatch.setattr(jaccard, "PAIRED", paired)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    rows = [(c, -1, n, 100 * c + k) for c, size in enumerate([1, 2, 3, 4, 9, 1, 40, 2]) for k, n in enumerate(sorted((7 * k * k) % 31 + 20 for k in range(size)))]
    try:
        got = jaccard.column_runs(spark.createDataFrame(rows + rows[5:9], "column long, part long, n long, class long").coalesce(1)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    pairs, blocks = set(), defaultdict(set)
    for r in got:
        if r.paired:
            pairs.add((r.column, r.pivot, r["class"]))
        else:
            blocks[r.column, r.pivot].update((r.pivot, r["class"]))
    for (c, _, n, a), (d, _, m, b) in itertools.product(rows, rows):
        if c == d and a < b and 75 * max(n, m) <= 100 * min(n, m):
            assert (c, a, b) in pairs or any(c == k[0] and {a, b} <= v for k, v in blocks.items())


def test_sets_equal_brute_force():
    texts = [t or "" for _, t in near_copies()]
    assert [len(s) for s in jaccard.gram_sets(pa.array(texts))] == [len(grams(t)) for t in texts]


def test_components_of_a_long_path(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    labels = jaccard.components(edges.repartition(3)).collect()
    assert len(labels) == 301 and {r.component_id for r in labels} == {0}


def test_one_of_each(spark, odd_docs, no_docs):
    docs = spark.createDataFrame(near_copies(), "doc_id long, text string").withColumn("count", F.lit(1))
    kept = jaccard.one_of_each(docs)
    rows = brute(near_copies())
    want = {i for i, _, _ in rows} - {i for i, _, c in rows if i != c}
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, want))
    assert jaccard.one_of_each(odd_docs).schema == odd_docs.schema
    assert jaccard.one_of_each(no_docs).count() == jaccard.jaccard_components(no_docs).count() == 0
