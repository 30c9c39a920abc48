"""Hot labels that follow new cells without reading the old ones.

A store keeps all cells by batch and, in one small version that changes as a whole:

* ``model``: one row with the counts, maxima and least growth so far, ``floor`` and ``cut``;
* ``scores``: one row, the merged KLL sketch of all scores;
* ``tail``: the cells that score at least ``floor``, the only ones that can be HOT.

Beside the cells lie the last windows of the videos of each batch, from which the next
growth follows; every ``COMPACT`` batches they are merged.

Scores are divided by table-wide maxima, so a larger maximum changes every score, but all
of them one way: the part of growth below zero comes nearer to zero, everything else
falls. A cell outside the tail therefore still scores less than ``floor`` plus that bounded
rise, and the exact quantile is found by rank in the tail as long as it lies above. The
merged sketch says where the next floor should be; it only decides how large the tail
is, never the result. Where the tail does not reach, one narrow scan of all cells builds it anew.

Labels and scores are projections on reading: no stored cell is ever rewritten, and HOT cells
are read from the tail alone. A repeated batch number changes nothing.
"""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidpulse.functions import finite_or_null
from vidpulse.operators.order import kth_values
from vidpulse.operators.scoring import label_hot
from vidpulse.schemas import CELL_COLUMNS, FEATURE_COLUMNS, HOT_QUANTILE, PREDICTION_COLUMNS, ScoreWeights
from vidpulse.session import hadoop_path, stage
from vidpulse.sources.versions import current_version, new_version

#: The tail aims at so many times the cells above the quantile.
TAIL_SHARE = 4
#: Batches after which the last windows of all videos are written together.
COMPACT = 64
#: Scores are sums of doubles; a floor is raised by this before cells are left out.
MARGIN = 1e-9
LATEST = ("video_id", "window_start", "views_count")
STATE = (
    "batch_id long, rows long, scored long, max_views double, max_growth double, max_engagement double,"
    " min_growth double, latest_from long, floor double, cut double, rebuilt boolean"
)


@dataclass(frozen=True)
class Model:
    """What scores and labels are made of, and where it stands."""

    batch_id: int
    rows: int
    scored: int
    max_views: float | None
    max_growth: float | None
    max_engagement: float | None
    min_growth: float | None
    latest_from: int = 0
    floor: float | None = None
    cut: float | None = None
    rebuilt: bool = False

    def divisors(self) -> tuple[float, float, float]:
        """Maxima as divisors: null and 0 become 1."""
        return tuple(float(x) if x else 1.0 for x in (self.max_views, self.max_growth, self.max_engagement))


def scored_by(cells: DataFrame, model: Model, weights: ScoreWeights) -> DataFrame:
    """Cells with component scores and ``hot_score`` under the model's maxima."""
    views, growth, engagement = model.divisors()
    scaled = cells.withColumns(
        {
            "views_score": F.col("views_count") / F.lit(views),
            "growth_score": F.col("growth_rate") / F.lit(growth),
            "watch_ratio_score": F.col("avg_watch_ratio"),
            "engagement_score": F.col("engagement_count") / F.lit(engagement),
        }
    )
    score = (
        F.lit(weights.views) * F.col("views_score")
        + F.lit(weights.growth) * F.col("growth_score")
        + F.lit(weights.watch_ratio) * F.col("watch_ratio_score")
        + F.lit(weights.engagement) * F.col("engagement_score")
    )
    return scaled.withColumn("hot_score", finite_or_null(score))


def with_growth_from(cells: DataFrame, latest: DataFrame) -> DataFrame:
    """Growth of new cells; a video's first new window follows its last row in ``latest``.

    A window that does not come after that row makes the job fail.
    """
    videos = cells.select("video_id").distinct()
    before = latest.join(videos, "video_id", "left_semi").select("video_id", "window_start", "views_count")
    both = cells.select(*CELL_COLUMNS, F.lit(True).alias("_new")).unionByName(
        before.withColumn("_new", F.lit(False)), allowMissingColumns=True
    )
    by_video = Window.partitionBy("video_id")
    previous = F.coalesce(F.lag("views_count").over(by_video.orderBy("window_start")), F.lit(0))
    last = F.max(F.when(~F.col("_new"), F.col("window_start"))).over(by_video)
    grown = both.withColumn("_previous", previous).withColumn("_last", last).filter("_new")
    rate = (
        F.when(
            F.col("window_start") <= F.col("_last"),
            F.raise_error(F.lit("a batch holds windows that are not after those of earlier batches")).cast("double"),
        )
        .when(F.col("_previous") == 0, F.col("views_count").cast("double"))
        .otherwise((F.col("views_count") - F.col("_previous")) / F.col("_previous"))
    )
    return grown.withColumn("growth_rate", rate).select(*FEATURE_COLUMNS)


class HotStore:
    """Cells, scores and labels below ``path``, added to batch by batch in the order of time.

    A batch's windows begin after all windows of the same videos before it, as
    closed windows of a stream do; an older or repeated window raises.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        quantile: float = HOT_QUANTILE,
        weights: ScoreWeights = ScoreWeights(),
        tail_share: float = TAIL_SHARE,
    ):
        if min(asdict(weights).values()) < 0:
            raise ValueError("weights must not be negative")
        self.spark, self.path, self.quantile, self.weights = spark, path, quantile, weights
        self.tail_share = tail_share

    # --- reading ---

    def model(self) -> Model | None:
        folder = current_version(self.spark, f"{self.path}/state")
        if folder is None:
            return None
        return Model(**self.spark.read.schema(STATE).parquet(f"{folder}/model").first().asDict())

    def cells(self, model: Model | None = None) -> DataFrame:
        """All cells of batches that were added whole."""
        return self._cells((model or self.model()).batch_id, self._table("tail").schema)

    def predictions(self) -> DataFrame:
        """All cells with scores and labels: a projection of the stored ones."""
        model = self.model()
        return label_hot(scored_by(self.cells(model), model, self.weights), model.cut).select(*PREDICTION_COLUMNS)

    def hot(self) -> DataFrame:
        """The HOT cells, from the tail alone."""
        model = self.model()
        tail = self._table("tail")
        labelled = label_hot(scored_by(tail, model, self.weights), model.cut)
        return labelled.filter("predicted_hot = 1").select(*PREDICTION_COLUMNS)

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{current_version(self.spark, f'{self.path}/state')}/{name}")

    def _by_batch(self, name: str, schema: T.StructType, first: int, last: int) -> DataFrame:
        """The rows that batches ``first`` to ``last`` left; other folders are not listed as input."""
        root = f"{self.path}/{name}"
        schema = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
        found = self.spark.read.schema(schema).option("basePath", root)
        return found.parquet(root).filter(F.col("batch_id").between(first, last)).drop("batch_id")

    def _cells(self, upto: int, schema: T.StructType) -> DataFrame:
        """Cells lie by batch and day, so that later readers can skip both."""
        by_day = T.StructType([*schema.fields, T.StructField("day", T.DateType())])
        return self._by_batch("cells", by_day, 0, upto).select(*FEATURE_COLUMNS)

    # --- adding ---

    def add(self, cells: DataFrame, batch_id: int) -> Model:
        """Add a batch of closed cells (without growth), ``batch_id`` from 0 on, and return the new model."""
        before = self.model()
        if before is not None and batch_id <= before.batch_id:
            return before
        grown = self._write(cells, batch_id, before)
        rows, *largest, least = grown.agg(
            F.count(F.lit(1)),
            F.max("views_count").cast("double"),
            F.max("growth_rate"),
            F.max("engagement_count").cast("double"),
            F.min("growth_rate"),
        ).first()
        if before is not None:
            rows += before.rows
            largest = [_largest(a, b) for a, b in zip(largest, (before.max_views, before.max_growth, before.max_engagement))]
            least = least if before.min_growth is None else min(before.min_growth, math.inf if least is None else least)
        latest_from = self._write_latest(grown, batch_id, before)
        draft = Model(batch_id, rows, 0, *largest, least, latest_from)
        scored = stage(scored_by(grown, draft, self.weights), "batch-scores")
        n = scored.agg(F.count("hot_score")).first()[0] + (before.scored if before else 0)
        model, tail, sketch = self._settle(before, replace(draft, scored=n), scored)
        with new_version(self.spark, f"{self.path}/state") as folder:
            tail.select(*FEATURE_COLUMNS).write.parquet(f"{folder}/tail")
            sketch.coalesce(1).write.parquet(f"{folder}/scores")
            row = self.spark.createDataFrame([tuple(asdict(model).values())], STATE)
            row.coalesce(1).write.parquet(f"{folder}/model")
        return model

    def _write(self, cells: DataFrame, batch_id: int, before: Model | None) -> DataFrame:
        """Write the batch's cells with growth; a repetition replaces them."""
        latest = cells.select(*LATEST)
        latest = latest.limit(0) if before is None else self._latest(before, latest.schema)
        grown = with_growth_from(cells, latest)
        folder = f"{self.path}/cells/batch_id={batch_id}"
        grown.withColumn("day", F.to_date("window_start")).write.mode("overwrite").partitionBy("day").parquet(folder)
        return self.spark.read.schema(grown.schema).parquet(folder).select(*FEATURE_COLUMNS)

    def _latest(self, model: Model, schema: T.StructType) -> DataFrame:
        """The last window of each video."""
        found = self._by_batch("latest", schema, model.latest_from, model.batch_id)
        last = F.max(F.struct("window_start", "views_count")).alias("last")
        return found.groupBy("video_id").agg(last).select("video_id", "last.*")

    def _write_latest(self, grown: DataFrame, batch_id: int, before: Model | None) -> int:
        """Write the last windows of the batch's videos, or of all; returns the batch to read from."""
        rows = grown.select(*LATEST)
        merged = before is not None and batch_id - before.latest_from >= COMPACT
        if merged:
            rows = rows.unionByName(self._latest(before, rows.schema))
        last = F.max(F.struct("window_start", "views_count")).alias("last")
        latest = rows.groupBy("video_id").agg(last).select("video_id", "last.*")
        latest.write.mode("overwrite").parquet(f"{self.path}/latest/batch_id={batch_id}")
        return batch_id if merged or before is None else before.latest_from

    def _settle(self, before: Model | None, draft: Model, scored: DataFrame):
        """``(model with floor and cut, tail, sketch)``: from the tail before, or from a scan of all cells."""
        sketch = _sketch(scored)
        if before is not None:
            sketch = stage(_merged(self._table("scores").unionByName(sketch)), "sketch")
            risen, guess = self._risen(before, draft), self._guess(sketch)
            if risen is not None and guess is not None:
                old = scored_by(self._table("tail"), draft, self.weights)
                found = self._cut(draft, max(risen, guess), old.unionByName(scored))
                if found:
                    return *found, sketch
            # Too many scores changed: one scan of all cells.
            scored = stage(scored_by(self._cells(draft.batch_id, scored.select(*FEATURE_COLUMNS).schema), draft, self.weights), "all-scores")
            draft, sketch = replace(draft, rebuilt=True), _sketch(scored)
        sketch = stage(sketch, "sketch")
        guess = self._guess(sketch)
        found = self._cut(draft, guess, scored) if guess is not None else None
        return *(found or self._cut(draft, -math.inf, scored)), sketch

    def _guess(self, sketch: DataFrame) -> float | None:
        """A score near the quantile at which the tail should begin."""
        q = max(0.0, 1 - (1 - self.quantile) * self.tail_share)
        known = sketch.filter(F.col("sketch").isNotNull()).filter(F.kll_sketch_get_n_double("sketch") > 0)
        found = known.select(F.kll_sketch_get_quantile_double("sketch", F.lit(q))).first()
        return found[0] if found else None

    def _risen(self, before: Model, draft: Model) -> float | None:
        """What no cell outside the tail can reach under the new maxima; None where that is not known."""
        old, new = before.divisors(), draft.divisors()
        if before.floor is None or not all(b >= a > 0 for a, b in zip(old, new)):
            return None
        below = max(0.0, -(before.min_growth or 0.0))
        return before.floor + self.weights.growth * below * (1 / old[1] - 1 / new[1]) + MARGIN

    def _cut(self, draft: Model, floor: float, candidates: DataFrame) -> tuple[Model, DataFrame] | None:
        """The model and the tail if the wanted ranks lie among the candidates that reach ``floor``.

        All cells that are no candidates score less than ``floor``.
        """
        if not draft.scored:
            return draft, candidates.limit(0)
        tail = stage(candidates.filter(F.col("hot_score") >= F.lit(floor)), "tail")
        below = draft.scored - tail.count()
        place = self.quantile * (draft.scored - 1)
        low, high = math.floor(place), math.ceil(place)
        if low < below:
            return None
        a, b = kth_values(tail.select("hot_score"), [("hot_score", low - below), ("hot_score", high - below)])
        cut = a if a == b else (1 - (place - low)) * a + (place - low) * b
        return replace(draft, floor=floor, cut=cut), tail


def _sketch(scored: DataFrame) -> DataFrame:
    return scored.agg(F.kll_sketch_agg_double("hot_score").alias("sketch"))


def _merged(sketches: DataFrame) -> DataFrame:
    return sketches.filter(F.col("sketch").isNotNull()).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def _largest(a, b):
    return b if a is None else a if b is None else max(a, b)


def remove_unfinished(store: HotStore) -> None:
    """Remove cells of a batch that was written but never added."""
    model = store.model()
    fs, folder = hadoop_path(store.spark, f"{store.path}/cells")
    if not fs.exists(folder):
        return
    for found in fs.listStatus(folder):
        name = found.getPath().getName()
        if name.startswith("batch_id=") and (model is None or int(name.partition("=")[2]) > model.batch_id):
            fs.delete(found.getPath(), True)
