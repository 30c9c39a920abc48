import numpy as np
import pytest
from pyspark.sql import functions as F

from vidpulse.llm import neighbours
from vidpulse.llm.queries import QUERIES


def brute(ids, x, asked, k):
    found = {}
    for q in asked:
        score = x @ x[np.flatnonzero(ids == q)[0]]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        found[int(q)] = [int(ids[i]) for i in order]
    return found


def found(df):
    rows = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        own = rows.setdefault(r.query_id, [])
        own.append(r.vec_id)
        assert r["rank"] == len(own)
    return rows


def test_query_recall(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    ids, x = table.vec_id.to_numpy(), np.array(table.embedding.tolist(), np.float64)
    want = brute(ids, x, ids[ids % 20 == 0], 20)
    got = found(QUERIES["op3_neighbours"](spark, sf_dir))
    assert set(got) == set(want)
    assert np.mean([len(set(got[q]) & set(want[q])) / len(want[q]) for q in want]) >= 0.9


def test_recall_with_few_probes(spark):
    draw = np.random.default_rng(0)
    centres = draw.normal(size=(40, 32))
    x = (centres[draw.integers(0, 40, 8000)] + 0.6 * draw.normal(size=(8000, 32))).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = found(neighbours.nearest(frame, F.col("vec_id") % 200 == 0, k=10, probes=10))
    want = brute(np.arange(8000), x.astype(np.float64), range(0, 8000, 200), 10)
    assert np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= 0.9


@pytest.mark.parametrize("part", [4096, 4])
def test_lengths_ties_and_unusable_vectors(spark, part, monkeypatch):
    monkeypatch.setattr(neighbours, "PART", part)
    monkeypatch.setattr(neighbours, "QUERY_PART", part)
    draw = np.random.default_rng(1)
    rows = [(i, [float(v) for v in draw.normal(size=6) * draw.uniform(0.2, 3)]) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)] + [rows[3], rows[3]]
    bad = [(200, None), (220, [0.0] * 6), (240, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (260, [float("nan")] * 6)]
    bad += [(None, rows[1][1]), (280, [1.0, 2.0]), (300, [float("inf")] + [0.0] * 5), (320, [])]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("class", F.lit("x"))
    kept = dict(rows)
    ids, x = np.array(list(kept)), np.array(list(kept.values()), np.float32).astype(np.float64)
    assert found(neighbours.nearest(frame, F.col("vec_id") % 20 == 0)) == brute(ids, x, [i for i in ids if i % 20 == 0], 20)


def test_fewer_candidates_than_asked(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    assert found(neighbours.nearest(frame, F.col("vec_id") % 20 == 0)) == {0: [20, 1], 20: [0, 1]}
    assert found(neighbours.nearest(frame.filter("vec_id = 0"), F.col("vec_id") % 20 == 0)) == {}
    assert found(neighbours.nearest(frame.limit(0), F.col("vec_id") % 20 == 0)) == {}


def test_queries_with_empty_cells_probe_all(spark):
    draw = np.random.default_rng(2)
    near = draw.normal(size=(6000, 16)) * 0.01 + np.eye(16)[0]
    x = np.concatenate([near, -np.eye(16)[:1]]).astype(np.float32)
    frame = spark.createDataFrame([(i + 1, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = found(neighbours.nearest(frame, F.col("vec_id") == 6001, probes=1, k=5))
    assert got == brute(np.arange(1, 6002), x.astype(np.float64), [6001], 5)


def test_levels_grow_with_the_data():
    assert neighbours.level_widths(1000, 64) == [64]
    assert len(neighbours.level_widths(5 * 10**6, 64)) == 2 and len(neighbours.level_widths(10**9, 64)) == 3
    hashing = neighbours.Hashing(10**7, 64, 1.0, True)
    x = np.random.default_rng(3).normal(size=(50, 64))
    own = hashing.cell(hashing.on_sphere(x, True), 0)
    probed = hashing.probe(hashing.on_sphere(x, True), 0, hashing.probes)
    assert (probed == own[:, None]).any(1).all() and probed.max() < hashing.cells
    assert all(len(set(row)) == hashing.probes for row in probed.tolist())


@pytest.mark.parametrize("part", [131_072, 200])
def test_equal_scores_go_to_smaller_ids(spark, part, monkeypatch):
    """Vectors of small whole numbers, most of whose products are equal, in one region or several."""
    monkeypatch.setattr(neighbours, "PART", part)
    draw = np.random.default_rng(5)
    x = draw.integers(-1, 2, (3000, 8)).astype(np.float32)
    x = x[(x != 0).any(1)]
    ids = draw.permutation(len(x)) * 3
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    frame = frame.repartition(5)
    got = found(neighbours.nearest(frame, F.col("vec_id") % 300 == 0, k=10))
    assert got == brute(ids, x.astype(np.float64), [i for i in ids if i % 300 == 0], 10)


def test_regions_and_parts_change_nothing(spark, monkeypatch):
    draw = np.random.default_rng(8)
    x = (draw.normal(size=(20, 16))[draw.integers(0, 20, 6000)] + 0.5 * draw.normal(size=(6000, 16))).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    results = []
    for part, lot in ((131_072, 1_048_576), (500, 7)):
        monkeypatch.setattr(neighbours, "PART", part)
        monkeypatch.setattr(neighbours, "QUERY_PART", lot)
        results.append(found(neighbours.nearest(frame, F.col("vec_id") % 100 == 0, k=10, probes=6)))
    assert results[0] == results[1]


def test_cut_of_a_cell_keeps_the_smaller_class():
    near = np.repeat(np.eye(4), 50, axis=0)
    owner = np.random.default_rng(6).permutation(200)
    ((row, classes, score),) = neighbours.best_of_cell(np.eye(4)[:2], near, owner, 3)
    for q in (0, 1):
        assert sorted(classes[row == q]) == sorted(owner[50 * q : 50 * q + 50])[:4] and (score == 1).all()


def test_recall_of_random_vectors_at_size():
    """The hardest case, vectors without clusters: what the probed cells hold of the true neighbours."""
    draw = np.random.default_rng(7)
    x = draw.standard_normal((200_000, 64), np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    asks = x[:60]
    score = asks @ x.T
    score[np.arange(60), np.arange(60)] = -9
    top = np.argpartition(-score, 20, axis=1)[:, :20]
    hashing = neighbours.Hashing(len(x), 64, 1.0, True)
    met = np.zeros(top.shape, bool)
    for t in range(neighbours.TABLES):
        probed = hashing.probe(asks.astype(np.float64), t, hashing.probes)
        cells = hashing.cell(x[top.reshape(-1)].astype(np.float64), t).reshape(top.shape)
        met |= (cells[:, :, None] == probed[:, None, :]).any(2)
    assert met.mean() >= 0.93


def test_share_of_probed_cells_follows_one_rule():
    for n in (1, 100, 4096, 10_256, 10**5, 10**7, 10**9):
        hashing = neighbours.Hashing(n, 64, 1.0, True)
        share = min(1.0, (neighbours.MET / n) ** 0.5)
        assert hashing.cells * share <= hashing.probes <= hashing.cells * share + 1
