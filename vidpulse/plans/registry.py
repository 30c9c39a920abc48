"""Named queries over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidpulse.operators import caching, cleaning, features, panes, profiling, replay, sampling, scoring
from vidpulse.operators.incremental import HotStore
from vidpulse.operators.order import approx_quantile, exact_quantiles, kth_values, take_best, with_global_rank
from vidpulse.plans import inputs
from vidpulse.plans.inputs import DAY, NTZ, table
from vidpulse.schemas import HOT, HOT_QUANTILE, LOG_COLUMNS, REQUEST_SCAN_ROWS, STATIC_THRESHOLD, WATCHLIST_QUANTILE
from vidpulse.session import hadoop_path, shared_folder, stage
from vidpulse.sources import topic
from vidpulse.sources.manifest import peek_files
from vidpulse.sources.sinks import publish, write_table, write_topic
from vidpulse.sources.tables import read_csv, read_csv_text, read_table
from vidpulse.sources.tables import replay as replay_log
from vidpulse.sources.tables import scan
from vidpulse.streaming.features import stream_cells
from vidpulse.streaming.medallion import append_available, drain, read_silver, run_bronze, run_silver
from vidpulse.streaming.stateful import (
    read_running_stats,
    running_stats_each_batch,
    stream_clamped,
    stream_growth,
)

Query = Callable[[SparkSession, str], DataFrame]
PLACES = 10
QUERIES: dict[str, Query] = {}

MEANS = ("avg_watch_ratio", "avg_watch_time", "watch_ratio_score", "hot_score")


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, *more: str) -> DataFrame:
    """Means depend on the order of addition in their last bits."""
    names = [c for c in df.columns if c in (*MEANS, *more)]
    return df.withColumns({c: F.round(c, PLACES) for c in names}) if names else df


# --- sources and messages -----------------------------------------------------


@query
def topic_peek(spark, d):
    return topic.peek_topic(inputs.topic(spark, d), 10)


@query
def scan_pruned_limit(spark, d):
    return scan(inputs.video_log(spark, d), ["video_id"], REQUEST_SCAN_ROWS, ["event_time", "event_id"])


@query
def replay_head(spark, d):
    return replay_log(inputs.video_log(spark, d), 5000)


@query
def csv_published(spark, d):
    """The log published as CSV over an older version of it, read with its schema."""
    path = f"{_folder(spark, 'csv')}/log"
    logs = inputs.video_log(spark, d)
    publish(logs.filter(F.col("event_id") % 2 == 0), path, fmt="csv")
    publish(logs, path, fmt="csv")
    return read_csv(spark, path, logs.schema)


@query
def csv_clean_strict(spark, d):
    """The dirty log from CSV, every field as text, through the strict cleaner."""
    path = f"{_folder(spark, 'csv')}/log"
    write_table(inputs.dirty_log(spark, d), path, fmt="csv")
    return cleaning.clean_logs(read_csv_text(spark, path), "strict", NTZ)


@query
def to_messages(spark, d):
    return inputs.topic(spark, d).select(
        "event_id", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


@query
def to_messages_fields(spark, d):
    return topic.parse_messages(inputs.topic(spark, d), keep=("event_id",))


@query
def parse_messages(spark, d):
    return topic.parse_messages(inputs.broken_topic(spark, d), keep=("event_id",))


# --- streams ------------------------------------------------------------------


def _folder(spark, label):
    """A new shared folder, removed when the session's JVM ends."""
    fs, root = hadoop_path(spark, f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}")
    fs.mkdirs(root)
    fs.deleteOnExit(root)
    return str(root)


def _drained(spark, d):
    """Bronze and silver after two drains of a topic that grew in between."""
    root = _folder(spark, "medallion")
    paths = {n: f"{root}/{n}" for n in ("topic", "bronze", "silver", "bronze-state", "silver-state")}
    messages = inputs.broken_topic(spark, d).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    for part in (F.col("offset") % 2 == 0, F.col("offset") % 2 == 1):
        write_topic(messages.filter(part).select("key", "value", "partition", "offset", "timestamp"), paths["topic"], fmt="parquet")
        run_bronze(spark, paths["topic"], paths["bronze"], paths["bronze-state"], topic_fmt="parquet")
        run_silver(spark, paths["bronze"], paths["silver"], paths["silver-state"])
    return paths


@query
def bronze_drain(spark, d):
    return read_table(spark, _drained(spark, d)["bronze"]).drop("raw_data", "timestamp")


@query
def silver_drain(spark, d):
    silver = read_table(spark, _drained(spark, d)["silver"])
    return silver.withColumn("event_time", F.col("event_time").cast(NTZ))


def _rewrite_files(spark, path):
    """The rows of a folder's files in other files, in another order; the old files go."""
    fs, root = hadoop_path(spark, path)
    old = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().endswith(".parquet")]
    rows = stage(spark.read.parquet(*(str(p) for p in old)), "rewritten")
    rows.repartitionByRange(3, F.desc("offset")).write.mode("append").parquet(path)
    for file in old:
        fs.delete(file, False)


@query
def silver_rewritten_drain(spark, d):
    """The same as ``silver_drain`` where all files of bronze are rewritten before the second drain."""
    root = _folder(spark, "rewritten")
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    messages = topic.to_bronze(inputs.broken_topic(spark, d).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp")))
    for part in (0, 1):
        if part:
            _rewrite_files(spark, bronze)
        messages.filter(F.col("offset") % 2 == part).coalesce(2).write.mode("append").parquet(bronze)
        run_silver(spark, bronze, silver, f"{root}/silver-state", rewritten=True)
    return read_silver(spark, silver).withColumn("event_time", F.col("event_time").cast(NTZ))


@query
def topic_peek_files(spark, d):
    """The same as ``topic_peek`` from files, of which only those with the first offsets are opened."""
    root = _folder(spark, "topic")
    messages = inputs.topic(spark, d).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    messages.drop("event_id").repartitionByRange(6, "partition", "offset").write.parquet(f"{root}/topic")
    return peek_files(spark, f"{root}/topic", 10)


def _halves(spark, rows, label):
    """``rows`` in two files, the earlier half of the time first, and a stream over them."""
    root = _folder(spark, label)
    middle = F.lit("2024-01-16").cast("timestamp")

    def stream():
        return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")

    def fill(first):
        half = rows.filter((F.col("event_time") < middle) if first else (F.col("event_time") >= middle))
        half.coalesce(1).write.mode("append").parquet(f"{root}/in")

    return root, stream, fill


def _timed(logs):
    return logs.withColumn("event_time", F.col("event_time").cast("timestamp"))


@query
def growth_drain(spark, d):
    """Growth of the windows that two drains closed, with the state of the first used by the second."""
    root, stream, fill = _halves(spark, _timed(inputs.strict_log(spark, d)), "growth")
    for first in (True, False):
        fill(first)
        append_available(stream_cells(stream(), DAY), f"{root}/cells", f"{root}/cells-state")
        cells = read_table(spark, f"{root}/cells").schema
        grown = stream_growth(spark.readStream.schema(cells).parquet(f"{root}/cells"))
        append_available(grown, f"{root}/grown", f"{root}/grown-state")
    found = read_table(spark, f"{root}/grown")
    return found.select("video_id", F.col("window_start").cast(NTZ).alias("window_start"), "views_count", "growth_rate")


@query
def running_stats_drain(spark, d):
    """Statistics after each request, over two drains; the second goes on from the totals of the first."""
    served = _timed(_served(spark, d)).select("event_id", "event_time", "status", "latency_ms")
    root, stream, _ = _halves(spark, served, "requests")
    rows = stage(served, "served")
    middle = rows.count() // 2
    for part in (F.col("event_id") < middle, F.col("event_id") >= middle):
        rows.filter(part).coalesce(1).write.mode("append").parquet(f"{root}/in")
        drain(running_stats_each_batch(stream(), f"{root}/log", f"{root}/state", ["event_id"]))
    return read_running_stats(spark, f"{root}/log").drop("event_id", "event_time")


@query
def clamp_drain(spark, d):
    """The clamp cleaner over two drains of the dirty log, with copies in both."""
    dirty = inputs.dirty_log(spark, d)
    root = _folder(spark, "clamp")
    for part in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1):
        dirty.filter(part).coalesce(1).write.mode("append").parquet(f"{root}/in")
        logs = spark.readStream.schema(dirty.schema).parquet(f"{root}/in")
        append_available(stream_clamped(logs, "400 days"), f"{root}/out", f"{root}/state")
    return read_table(spark, f"{root}/out").withColumn("event_time", F.col("event_time").cast(NTZ))


# --- columns and cleaning -----------------------------------------------------


@query
def normalize_columns(spark, d):
    return cleaning.normalize_columns(inputs.loose_log(spark, d))


@query
def standardize(spark, d):
    return cleaning.standardize(inputs.source_log(spark, d), NTZ)


@query
def with_defaults(spark, d):
    return cleaning.with_defaults(cleaning.normalize_columns(inputs.loose_log(spark, d)))


@query
def coerce_types(spark, d):
    return cleaning.coerce_types(inputs.text_log(spark, d), NTZ)


@query
def clean_loose(spark, d):
    """The chain for exports of unknown layout, with times in milliseconds."""
    raw = cleaning.with_defaults(cleaning.normalize_columns(inputs.export_log(spark, d)))
    return cleaning.clean_logs(raw, "clamp", NTZ)


@query
def clean_strict_text(spark, d):
    return cleaning.clean_logs(inputs.text_log(spark, d), "strict", NTZ)


@query
def to_messages_rejects(spark, d):
    logs = inputs.video_log(spark, d)
    bad = F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("u"), "user_id")).otherwise(F.col("user_id"))
    return topic.to_messages(logs.withColumn("user_id", bad), keep=("event_id",)).select("event_id")


@query
def coerce_predictions(spark, d):
    return rounded(caching.coerce_predictions(inputs.messy_predictions(spark, d)))


@query
def reconcile_labels(spark, d):
    ready = caching.coerce_predictions(inputs.messy_predictions(spark, d))
    return caching.reconcile_labels(ready).select("video_id", "window_start", "predicted_hot", "hot_label")


@query
def clean_strict(spark, d):
    return cleaning.clean_logs(inputs.dirty_log(spark, d), "strict", NTZ)


@query
def clean_clamp(spark, d):
    return cleaning.clean_logs(inputs.dirty_log(spark, d), "clamp", NTZ)


@query
def clean_feature_input(spark, d):
    return cleaning.clean_logs(inputs.dirty_log(spark, d), "feature", NTZ)


@query
def dedup_logs(spark, d):
    return cleaning.dedup_logs(inputs.dirty_log(spark, d).select(*LOG_COLUMNS))


# --- features -----------------------------------------------------------------


@query
def video_features(spark, d):
    return rounded(features.video_features(inputs.strict_log(spark, d)))


@query
def video_features_split(spark, d):
    logs = cleaning.clean_logs(inputs.dirty_log(spark, d), "feature", NTZ)
    return rounded(features.video_features(logs, split_engagement=True))


@query
def video_features_big(spark, d):
    logs = cleaning.clean_logs(inputs.big_log(spark, d), "feature", NTZ)
    return rounded(features.video_features(logs, "30 days"))


@query
def unique_users(spark, d):
    return features.unique_users(inputs.strict_log(spark, d), DAY)


@query
def unique_users_rollup(spark, d):
    """Users per day, from half-hour panes and not from the log."""
    half_hours = stage(panes.make_panes(inputs.strict_log(spark, d)), "panes")
    cells = panes.compose_cells(half_hours, DAY)
    return cells.select("video_id", "window_start", "views_count", "unique_users")


@query
def video_features_rollup(spark, d):
    """Features of 30 days, from day panes of the large log."""
    logs = cleaning.clean_logs(inputs.big_log(spark, d), "feature", NTZ)
    days = stage(panes.make_panes(logs, DAY), "panes")
    return rounded(panes.compose_features(days, "30 days"))


@query
def growth_rate(spark, d):
    grown = features.video_features(inputs.strict_log(spark, d), DAY)
    return grown.select("video_id", "window_start", "views_count", "growth_rate")


@query
def top_features(spark, d):
    return rounded(scoring.top_features(features.video_features(inputs.strict_log(spark, d), DAY)))


# --- scores and labels --------------------------------------------------------


@query
def score_maxima(spark, d):
    day = features.video_features(inputs.strict_log(spark, d), DAY)
    return scoring.score_maxima(day).drop("rows")


@query
def hot_max_p99(spark, d):
    return rounded(inputs.predictions(spark, d))


@query
def hot_incremental(spark, d):
    """Labels after two batches of cells, of which the second reads the first one's tail only."""
    store = HotStore(spark, _folder(spark, "hot-store"))
    half_hours = stage(panes.make_panes(inputs.strict_log(spark, d)), "panes")
    early = F.col("pane_start") < F.lit("2024-01-16").cast(NTZ)
    for k, part in enumerate((early, ~early)):
        store.add(panes.compose_cells(half_hours.filter(part), DAY), k)
    return rounded(store.predictions())


@query
def hot_minmax_p99(spark, d):
    return rounded(inputs.predictions(spark, d, scaling="minmax"))


@query
def hot_minmax_static(spark, d):
    return rounded(inputs.predictions(spark, d, scaling="minmax", threshold=STATIC_THRESHOLD))


@query
def hot_quantiles(spark, d):
    score = F.col("hot_score")
    found = exact_quantiles(
        inputs.predictions(spark, d),
        {
            "p99_all": (score, HOT_QUANTILE),
            "p95_not_hot": (F.when(F.col("hot_label") != HOT, score), WATCHLIST_QUANTILE),
        },
    )
    return spark.range(1).select(*(F.round(F.lit(v), PLACES).alias(n) for n, v in found.items()))


@query
def quantile_special_values(spark, d):
    """Quantiles of a column with NaN and infinite values."""
    price = F.when(F.col("o_orderkey") % 97 == 0, float("nan")).when(F.col("o_orderkey") % 89 == 0, float("inf"))
    price = price.when(F.col("o_orderkey") % 83 == 0, float("-inf")).otherwise(F.col("o_totalprice"))
    wanted = {f"q{int(1000 * q)}": (F.col("price"), q) for q in (0.0, 0.25, 0.5, 0.95, 1.0)}
    found = exact_quantiles(table(spark, d, "orders").select(price.alias("price")), wanted)
    return spark.range(1).select(*(F.round(F.lit(v), 4).alias(n) for n, v in found.items()))


@query
def rank_many_ranges(spark, d):
    """Rank by price, in ranges of a thousand rows."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return with_global_rank(orders, [F.desc("o_totalprice"), "o_orderkey"], "place", max(1, orders.count() // 1000))


def _rank_bounds(df):
    """Rows, and the scores one thousandth of the rows below and above the HOT quantile."""
    n, per_mille = df.count(), round(1000 * HOT_QUANTILE)
    low, high = max(1, (per_mille - 1) * n // 1000), min(n, -(-(per_mille + 1) * n // 1000))
    return n, *kth_values(df, [("hot_score", low - 1), ("hot_score", high - 1)])


@query
def hot_quantile_approx(spark, d):
    """The scores at the ends of the sketch's rank error, and whether its cut lies between them."""
    scored = stage(scoring.hot_scores(inputs.day_features(spark, d))[0].select("hot_score"), "scored")
    cut = approx_quantile(scored, "hot_score", HOT_QUANTILE, 0.001)
    rows, low, high = _rank_bounds(scored)
    ends = spark.createDataFrame([(rows, low, high, low <= cut <= high)], "rows bigint, low double, high double, within boolean")
    return ends.withColumns({c: F.round(c, PLACES) for c in ("low", "high")})


@query
def hot_max_approx(spark, d):
    """HOT rows above the sketch's rank error and other rows below it: all that there are."""
    rows = stage(inputs.predictions(spark, d, threshold="approx"), "approx")
    _, low, high = _rank_bounds(rows)
    score, hot = F.round("hot_score", PLACES), F.col("predicted_hot") == 1
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(hot & (score > F.round(F.lit(high), PLACES))).alias("hot_above"),
        F.count_if(~hot & (score < F.round(F.lit(low), PLACES))).alias("other_below"),
    )


@query
def all_hot(spark, d):
    return rounded(caching.all_hot(inputs.predictions(spark, d)))


@query
def top_hot(spark, d):
    return rounded(scoring.top_hot(inputs.predictions(spark, d)))


@query
def top_any(spark, d):
    return rounded(scoring.top_hot(inputs.predictions(spark, d, scaling="minmax"), only_hot=False))


# --- cache recommendation -----------------------------------------------------


@query
def cache_rank(spark, d):
    ranked = caching.with_cache_rank(inputs.predictions(spark, d))
    return ranked.select("video_id", "window_start", "cache_rank")


@query
def cache_recommendation(spark, d):
    return rounded(inputs.recommendations(spark, d, ordered=True))


def _decided(spark, d):
    """Decisions without ranks, which the reports below do not need."""
    ready = caching.reconcile_labels(caching.coerce_predictions(inputs.predictions(spark, d)))
    return caching.decide(ready)


@query
def cache_kpis(spark, d):
    return caching.evaluate_cache(_decided(spark, d))


@query
def kpi_percent(spark, d):
    return rounded(caching.kpi_percent(_decided(spark, d)), "percent")


@query
def hits_and_misses(spark, d):
    return caching.hits_and_misses(_decided(spark, d))


@query
def latency_comparison(spark, d):
    return rounded(caching.latency_comparison(_decided(spark, d)), "latency_ms")


@query
def top_decided(spark, d):
    return rounded(caching.top_decided(_decided(spark, d)))


@query
def label_counts(spark, d):
    return profiling.value_counts_of(_decided(spark, d), ["hot_label", "cache_decision", "cache_priority"])


@query
def run_summary(spark, d):
    day = inputs.day_features(spark, d)
    predicted = scoring.score_hot(day)
    return profiling.run_summary(day, predicted, caching.recommend_cache(predicted, ordered=False))


# --- requests -----------------------------------------------------------------


@query
def cache_policy(spark, d):
    return rounded(replay.cache_policy(inputs.hot_rows(spark, d)))


@query
def top_cached(spark, d):
    return rounded(caching.top_cached(inputs.hot_rows(spark, d), 20))


@query
def top_videos(spark, d):
    return rounded(replay.top_videos(replay.cache_policy(inputs.hot_rows(spark, d)), 5))


def _served(spark, d):
    return replay.serve_requests(inputs.requests(spark, d), inputs.policy(spark, d))


REQUEST_COLUMNS = [
    "event_id",
    "video_id",
    "hot_score",
    "hot_label",
    "window_start",
    "window_end",
    "cache_decision",
    "status",
    "served_from",
    "latency_ms",
]


@query
def serve_requests(spark, d):
    return rounded(_served(spark, d).select(*REQUEST_COLUMNS))


@query
def miss_pool(spark, d):
    return replay.miss_pool(inputs.video_log(spark, d), inputs.policy(spark, d))


@query
def request_stats(spark, d):
    hot = inputs.hot_rows(spark, d)
    policy = stage(replay.cache_policy(hot), "policy")
    served = replay.serve_requests(inputs.requests(spark, d), policy)
    return replay.request_stats(served, hot, policy)


@query
def running_stats(spark, d):
    """Statistics after each request; the event id is the arrival number here."""
    log = _served(spark, d).select(
        (F.col("event_id") + 1).alias("request_id"), "status", "latency_ms"
    )
    return replay.with_running_stats(stage(log, "request-log"))


@query
def replay_policy(spark, d):
    requests = inputs.requests(spark, d).select("event_time", "event_id", "video_id", "latency_ms")
    return rounded(replay.replay_policy(requests, inputs.policy(spark, d)))


@query
def stratified_requests(spark, d):
    sets = replay.stratified_requests(inputs.video_log(spark, d), inputs.policy(spark, d), 3000, 0.4)
    return sets.select("event_id", "video_id", "draw_id")


@query
def viral_requests(spark, d):
    sets = replay.viral_requests(inputs.video_log(spark, d), inputs.policy(spark, d), 500, 5, 0.9)
    return sets.select("event_id", "video_id", "draw_id")


# --- samples ------------------------------------------------------------------


@query
def sample_n(spark, d):
    return sampling.sample_n(inputs.video_log(spark, d), 2500, "event_id").drop("watch_ratio")


@query
def sample_keys(spark, d):
    return sampling.sample_keys(inputs.video_log(spark, d), "video_id", 30)


@query
def trend_rows(spark, d):
    logs = inputs.video_log(spark, d)
    videos = sampling.sample_keys(logs, "video_id", 30)
    return sampling.select_trending(logs, videos, sampling.trend_start(logs)).select("event_id", "video_id")


@query
def sample_replace(spark, d):
    logs = inputs.video_log(spark, d).select("event_time", "event_id", "video_id")
    return sampling.sample_with_replacement(logs, 20_000, ["event_time", "event_id"])


@query
def inject_trend(spark, d):
    logs = inputs.video_log(spark, d)
    return sampling.inject_trend(logs).select("event_id", "event_time", "video_id", "watch_time")


@query
def trend_union(spark, d):
    """Rows per video before and after the trend was added."""
    logs = inputs.video_log(spark, d)
    added = stage(sampling.shifted_trend_rows(logs).select("video_id"), "trend")
    both = logs.select("video_id", F.lit(0).alias("added")).unionByName(added.withColumn("added", F.lit(1)))
    return both.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("added").alias("added_rows")
    )


# --- profiles -----------------------------------------------------------------


@query
def table_counts(spark, d):
    names = ["events", "customer", "orders", "part", "lineitem"]
    return profiling.table_counts({n: table(spark, d, n) for n in names})


@query
def describe_numeric(spark, d):
    return profiling.describe_numeric(table(spark, d, "orders").select("o_totalprice", "o_custkey"))


@query
def describe_text(spark, d):
    return profiling.describe_text(
        table(spark, d, "orders").select("o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("date"))
    )


@query
def describe_text_keys(spark, d):
    """Columns of many values: a key, a shared one, and one in which a value stands out."""
    orders = table(spark, d, "orders")
    often = F.when(F.col("o_orderkey") % 4 > 0, F.col("o_custkey")).otherwise(-1).cast("string")
    keys = [F.col(c).cast("string").alias(c) for c in ("o_orderkey", "o_custkey")]
    return profiling.describe_text(orders.select(*keys, often.alias("often")))


@query
def top_many(spark, d):
    """More first rows than one task merges."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return take_best(lines, 40_000, "l_extendedprice", ["l_orderkey", "l_linenumber"])


@query
def null_profile(spark, d):
    return profiling.null_profile(inputs.dirty_log(spark, d))


@query
def duplicate_profile(spark, d):
    return profiling.duplicate_profile(inputs.dirty_log(spark, d))


@query
def ratio_profile(spark, d):
    return profiling.ratio_profile(inputs.source_log(spark, d))


@query
def histogram(spark, d):
    bins = profiling.histogram(inputs.source_log(spark, d), "play_time_ms", 50, clip_q=0.99)
    return bins.withColumns({c: F.round(c, 6) for c in ("bin_low", "bin_high")})


@query
def ratio_histogram(spark, d):
    rated = profiling.with_raw_ratio(inputs.source_log(spark, d))
    bins = profiling.histogram(rated, "watch_ratio_raw", 60, clip_low=0, clip_high=2)
    return bins.withColumns({c: F.round(c, 6) for c in ("bin_low", "bin_high")})


@query
def interaction_rates(spark, d):
    return profiling.interaction_rates(inputs.source_log(spark, d))


@query
def time_range(spark, d):
    return profiling.time_range(cleaning.standardize(inputs.source_log(spark, d), NTZ))


@query
def events_per_day(spark, d):
    return profiling.events_per_day(inputs.video_log(spark, d))


@query
def category_counts(spark, d):
    return profiling.value_counts(table(spark, d, "customer"), "c_mktsegment")
