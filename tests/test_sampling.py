import datetime

import pytest
from pyspark.sql import functions as F

from vidpulse.operators import sampling


def logs(spark, n=3000):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return spark.range(n).select(
        F.col("id").alias("event_id"),
        (start + F.make_dt_interval(secs=F.col("id") * 10)).alias("event_time"),
        F.pmod(F.xxhash64("id"), F.lit(60)).cast("string").alias("video_id"),
    )


def test_sample_has_the_exact_size_and_is_repeatable(spark):
    narrowed = sampling.sample_n(logs(spark), 1234, "event_id")
    plain = sampling.sample_n(logs(spark).repartition(9), 1234, "event_id")
    assert narrowed.count() == 1234 and narrowed.exceptAll(plain).count() == 0
    other = sampling.sample_n(logs(spark), 1234, "event_id", 7)
    assert other.intersect(plain).count() < 800
    assert sampling.sample_n(logs(spark), 5000, "event_id").count() == 3000
    assert sampling.sample_n(logs(spark), 5, "event_id").count() == 5


def test_sample_of_copies_keeps_its_size(spark):
    copies = spark.range(900).select((F.col("id") % 3).alias("k"), "id")
    assert sampling.sample_n(copies, 400, "k").count() == 400


def test_sample_keys(spark):
    keys = [r[0] for r in sampling.sample_keys(logs(spark), "video_id", 30).collect()]
    assert len(set(keys)) == 30


def test_sample_with_replacement(spark):
    drawn = sampling.sample_with_replacement(logs(spark), 2500, ["event_time", "event_id"])
    assert drawn.count() == 2500
    distinct = drawn.select("event_id").distinct().count()
    assert 1500 < distinct < 1900  # 3000 * (1 - exp(-2500 / 3000)) = 1696
    assert sampling.sample_with_replacement(logs(spark, 40), 2500, ["event_id"]).count() == 40
    assert sampling.sample_with_replacement(logs(spark, 0), 2500, ["event_id"]).count() == 0
    assert sampling.draw_rows(logs(spark, 40), 2500, ["event_id"]).count() == 2500
    assert sampling.draw_rows(logs(spark), 1_200_000, ["event_id"]).count() == 1_200_000


def test_trend_injection(spark):
    base = logs(spark)
    both = sampling.inject_trend(base, n_videos=5, n=100).collect()
    assert len(both) == 3100
    times = [r["event_time"] for r in both]
    assert times == sorted(times)
    added = sampling.shifted_trend_rows(base, n_videos=5, n=100).collect()
    assert len({r["video_id"] for r in added}) <= 5
    originals = {r["event_id"]: r["event_time"] for r in base.collect()}
    for row in added:
        shift = (row["event_time"] - originals[row["event_id"]]).total_seconds()
        assert 0 <= shift <= 3599
        assert originals[row["event_id"]] >= datetime.datetime(2024, 1, 1, 3)


def test_synthetic_log(spark):
    df = sampling.generate_logs(spark.range(20_000)).cache()
    row = df.agg(
        F.count("*").alias("n"), F.min("duration"), F.max("duration"), F.min("video_id"), F.max("video_id"),
        F.min("user_id"), F.max("user_id"), F.avg("watch_time"), F.avg("is_like"), F.avg("is_share"),
        F.min("event_time"), F.max("event_time"), F.max(F.col("watch_time") - F.col("duration")),
        F.min("watch_ratio"), F.max("watch_ratio"),
    ).first()
    assert row["n"] == 20_000 and (row[1], row[2]) == (10, 179)
    assert (row[3], row[4]) == (1, 1000) and row[5] >= 1 and 4990 < row[6] <= 5000
    assert 28 < row[7] < 36  # mean of min(U[10..179], Exp(40))
    like = df.agg(F.avg(0.05 + 0.25 * F.col("watch_ratio"))).first()[0]
    share = df.agg(F.avg(0.01 + 0.08 * F.col("watch_ratio"))).first()[0]
    assert row[8] == pytest.approx(like, abs=0.01) and row[9] == pytest.approx(share, abs=0.01)
    assert row[10] >= datetime.datetime(2026, 5, 1, 8) and row[11] < datetime.datetime(2026, 5, 1, 14)
    assert row[12] <= 0 and row[13] >= 0 and row[14] <= 1
    again = sampling.generate_logs(spark.range(20_000).repartition(5))
    assert df.exceptAll(again).count() == 0


def test_a_cut_that_lets_through_too_few_is_made_good(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = spark.range(20_000).select(F.col("id").alias("k"))
    want = sorted(r.k for r in sampling.sample_n(rows, 300, "k").collect())
    monkeypatch.setattr(sampling, "SLACK", -3)
    assert sorted(r.k for r in sampling.sample_n(rows, 300, "k").collect()) == want
    assert len(want) == 300 and sampling.sample_n(rows, 30_000, "k").count() == 20_000
    assert sampling.sample_n(rows, 0, "k").count() == 0
