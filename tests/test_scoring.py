import datetime

import pytest
from pyspark.sql import functions as F

from vidpulse.operators import scoring

DAY = datetime.datetime(2024, 1, 1)
COLUMNS = (
    "video_id string, window_start timestamp_ntz, window_end timestamp_ntz, views_count bigint, unique_users bigint,"
    " avg_watch_ratio double, growth_rate double, engagement_count bigint"
)

# Views, mean ratio, growth, engagement and score of known rows, whose
# table ranged over views 1..31, growth 0..20, ratio 0.0025..1, engagement 0..13.
KNOWN = [
    (20, 0.52665, 20.0, 8, 0.7007337574705996),
    (30, 0.5860533333333334, 0.875, 11, 0.6415304181929182),
    (31, 0.4597709677419355, 0.631578947368421, 10, 0.6149627542802416),
    (15, 0.6653733333333334, 15.0, 7, 0.5878428314375683),
    (18, 0.4397388888888889, 18.0, 4, 0.5854874579611422),
    (22, 0.5901909090909091, 1.2, 12, 0.5512943021890391),
    (30, 0.3088666666666667, 0.25, 6, 0.5204493364822312),
    (27, 0.5460259259259259, -0.1, 5, 0.5133366036173054),
    (13, 0.7178615384615384, 13.0, 3, 0.5005462695199537),
]


def table(spark, rows):
    return spark.createDataFrame(
        [(str(i), DAY, DAY, v, v, r, g, e) for i, (v, r, g, e) in enumerate(rows)], COLUMNS
    )


def test_min_max_score_of_known_rows(spark):
    ends = {
        "views_score": (1.0, 31.0),
        "growth_score": (0.0, 20.0),
        "watch_ratio_score": (0.0025, 1.0),
        "engagement_score": (0.0, 13.0),
    }
    scored = scoring.score_hot(table(spark, [k[:4] for k in KNOWN]), "minmax", 0.7, ranges=ends)
    rows = {r["video_id"]: r for r in scored.collect()}
    for i, known in enumerate(KNOWN):
        assert rows[str(i)]["hot_score"] == pytest.approx(known[4], abs=1e-12)
    assert [i for i in range(len(KNOWN)) if rows[str(i)]["hot_label"] == "HOT"] == [0]


def test_max_scaled_score(spark):
    rows = scoring.score_hot(table(spark, [(10, 0.5, 4.0, 0), (5, 1.0, -0.5, 0)]), threshold=0.5).collect()
    # No engagement at all: the maximum counts as 1.
    assert rows[0]["hot_score"] == pytest.approx(0.4 + 0.25 + 0.1)
    assert rows[1]["hot_score"] == pytest.approx(0.2 - 0.25 * 0.125 + 0.2)
    assert [(r["predicted_hot"], r["hot_label"]) for r in rows] == [(1, "HOT"), (0, "NOT_HOT")]


def test_maxima_replace_null_and_zero(spark):
    top = scoring.score_maxima(table(spark, [(0, None, None, 0)])).first()
    assert (top["max_views"], top["max_growth"], top["max_engagement"]) == (1.0, 1.0, 1.0)


def test_constant_columns_score_zero(spark):
    rows = scoring.score_hot(table(spark, [(3, 0.5, 3.0, 1)] * 2), "minmax").collect()
    assert [r["hot_score"] for r in rows] == [0.0, 0.0]
    assert [r["hot_label"] for r in rows] == ["HOT", "HOT"]  # all equal the quantile


def test_null_and_nan_scores_are_not_hot(spark):
    rows = scoring.score_hot(
        table(spark, [(3, None, 3.0, 1), (2, float("nan"), 2.0, 1), (1, 0.5, 1.0, 0)])
    ).orderBy("video_id").collect()
    assert [r["hot_label"] for r in rows] == ["NOT_HOT", "NOT_HOT", "HOT"]


@pytest.mark.parametrize("threshold", ["exact", "approx"])
@pytest.mark.parametrize("scaling", ["max", "minmax"])
def test_no_rows(spark, scaling, threshold):
    assert scoring.score_hot(table(spark, []), scaling, threshold).count() == 0


def test_exact_threshold(spark):
    features = table(spark, [(i % 37 + 1, (i % 11) / 11, float(i % 5), i % 3) for i in range(600)])
    rows = scoring.score_hot(features).collect()
    scores = sorted(r["hot_score"] for r in rows)
    place = 0.99 * (len(scores) - 1)
    low, high = scores[int(place)], scores[int(place) + 1]
    cut = low + (place - int(place)) * (high - low)
    assert {r["hot_score"] >= cut - 1e-12 for r in rows if r["predicted_hot"]} == {True}
    assert 0 < sum(r["predicted_hot"] for r in rows) <= 12


def test_approximate_threshold_is_near(spark):
    features = table(spark, [(i, 0.5, 0.0, 0) for i in range(1, 2001)])
    hot = scoring.score_hot(features, threshold="approx").filter("predicted_hot = 1").count()
    assert 18 <= hot <= 23


def test_top_hot(spark):
    scored = scoring.score_hot(table(spark, [(5, 0.5, 0.0, 0)] * 30 + [(9, 0.5, 0.0, 0)]), threshold=0.45)
    assert [r["video_id"] for r in scoring.top_hot(scored).collect()] == ["30"]
    everyone = scoring.top_hot(scored, 3, only_hot=False)
    assert [r["video_id"] for r in everyone.collect()] == ["30", "0", "1"]
    assert scoring.hot_only(scored).count() == 1


def test_unknown_scaling_and_missing_columns(spark):
    with pytest.raises(ValueError, match="unknown scaling"):
        scoring.score_hot(table(spark, []), "log")
    with pytest.raises(ValueError, match="growth_rate"):
        scoring.score_hot(table(spark, []).drop("growth_rate"))
    with pytest.raises(ValueError, match="hot_label"):
        scoring.hot_only(spark.range(1).select(F.col("id").alias("video_id")))
