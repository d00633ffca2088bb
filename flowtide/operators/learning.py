"""Training, scoring and evaluation of the three-class flow classifier with Spark ML.

A zero and a missing feature mean the same to the classifier, so missing features are filled with
zero before assembly, and no row is ever skipped.
"""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowtide.functions.flow import null_if_nan
from flowtide.operators.aggregates import accuracy
from flowtide.schema import CATEGORY_NAMES, ENCODED_COLUMNS, FEATURES, LABELLED_COLUMNS

# Model size and early stopping, and the bins of a boosted feature.
MAX_DEPTH, TREES = 5, 100
MISSING = 0.0
BINS = 32

_CLASS = "class_label"
_INPUT = "x_"
_VALUES = "x_values"
_BIN = "bin_"
_PIECE = 1000
# Spark draws max(10,000, maxBins squared) rows for its split candidates. Rows of bins have BINS values a feature at most, and this
# lets it see all bins: up to about a million such rows it draws none.
_SEEN_BINS = 1024


def fill_features(df: DataFrame) -> DataFrame:
    """Numeric copies of the features, with missing values filled; the inputs stay as they are."""
    return df.withColumns(
        {
            _INPUT + c: F.coalesce(null_if_nan(F.col(c).cast("double")), F.lit(MISSING))
            for c in FEATURES
        }
    )


def _filled_apart(df: DataFrame) -> DataFrame:
    """``fill_features`` by one function over an array, which Spark evaluates in a step of its own.

    In one step with what made the rows, the model's code can pass the 8,000 bytes of a method that the JVM compiles; each row then
    takes three times as long.
    """
    values = F.transform(F.array(*[F.col(c).cast("double") for c in FEATURES]), lambda x: F.coalesce(null_if_nan(x), F.lit(MISSING)))
    filled = df.withColumn(_VALUES, values)
    return filled.withColumns({_INPUT + c: F.col(_VALUES)[i] for i, c in enumerate(FEATURES)}).drop(_VALUES)


def feature_assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=[_INPUT + c for c in FEATURES], outputCol="features")


def assemble_features(df: DataFrame) -> DataFrame:
    """Add ``features``, the ten features as a vector in their fixed order."""
    filled = feature_assembler().transform(fill_features(df))
    return filled.drop(*[_INPUT + c for c in FEATURES])


def _labelled(df: DataFrame) -> DataFrame:
    label = F.col("Label").try_cast("int")
    known = df.where(label.isin(*CATEGORY_NAMES))
    return fill_features(known.withColumn(_CLASS, label.cast("double")))


def _forest(trees: int, depth: int, seed: int) -> list:
    return [
        RandomForestClassifier(
            featuresCol="features", labelCol=_CLASS, weightCol="weight",
            numTrees=trees, maxDepth=depth, seed=seed,
        )
    ]


def _boosted(rounds: int, depth: int, seed: int) -> list:
    # One booster per class against the rest; scoring takes the most probable class.
    return [
        GBTClassifier(
            featuresCol="features", labelCol=f"is_{c}", weightCol="weight",
            validationIndicatorCol="isVal", maxIter=rounds, maxDepth=depth, seed=seed,
            maxBins=_SEEN_BINS, predictionCol=f"prediction_{c}",
        )
        .setRawPredictionCol(f"raw_{c}")
        .setProbabilityCol(f"probability_{c}")
        for c in CATEGORY_NAMES
    ]


def partitions_for(rows: int) -> int:
    """Partitions of training rows: 10,000 rows each up to 100 partitions. These grow to 250,000 rows each (or ten times the root) before there are more.

    Every level of every tree is a task a partition, and each task sends its own statistics of all the level's nodes.
    """
    most = max(250_000, 10 * math.isqrt(rows))
    return max(1, math.ceil(rows / max(10_000, min(math.ceil(rows / 100), most))))


def binned_partitions_for(rows: int) -> int:
    """Partitions of rows of bins: 50,000 rows each, more from 5 million on, so that there are 100 until 25 million rows."""
    return max(1, math.ceil(rows / max(50_000, min(math.ceil(rows / 100), 250_000))))


def _placed(df: DataFrame, partitions: int | None) -> DataFrame:
    """Rows dealt by their values and in order, so that a fit doesn't depend on the input's partitions.

    Equal rows are counted first and dealt in pieces of ``_PIECE``, so that rows that many share don't meet in one task.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count("*").alias("n"))
    if partitions is None:
        partitions = partitions_for(df.count())
    pieces = counted.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _PIECE))))
    dealt = pieces.repartition(partitions, *columns, "piece").sortWithinPartitions(*columns, "piece")
    copies = F.least(F.lit(_PIECE), F.col("n") - F.col("piece") * _PIECE).cast("int")
    return dealt.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).select(*columns)


def cut_points(df: DataFrame, columns: list[str], bins: int = BINS) -> dict[str, list[float]]:
    """Cuts between up to ``bins`` bins of about the same ``weight``, for each column of more than ``bins`` values, from all rows.

    The k-th cut lies at the first place not cut yet where the weight below, with half of the next value's, exceeds k parts of
    ``bins``: the rule of Spark's trees, which draw 10,000 rows for it.
    Values are counted, laid in ranges and summed up range by range, so no column meets in one task; places that may be cut are collected.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in columns]))
    counted = df.select(cells.alias("cell"), "weight").groupBy("cell.feature", "cell.value").agg(F.sum("weight").alias("w"))
    # Stored, as sums and places have to see the same ranges.
    placed = counted.repartitionByRange("feature", "value").withColumn("part", F.spark_partition_id()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parts = placed.groupBy("feature", "part").agg(F.sum("w").alias("w"), F.max("value").alias("last"), F.count("*").alias("n"))
        whole = Window.partitionBy("feature")
        earlier = whole.orderBy("part")
        ahead = parts.select(
            "feature", "part", F.sum("w").over(whole).alias("total"), F.sum("n").over(whole).alias("values"),
            F.coalesce(F.sum("w").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("below"),
            F.lag("last").over(earlier).alias("before"),
        )
        in_part = Window.partitionBy("feature", "part").orderBy("value")
        running = F.col("below") + F.sum("w").over(in_part.rowsBetween(Window.unboundedPreceding, 0))
        places = placed.join(F.broadcast(ahead), ["feature", "part"]).select(
            "feature", "part", "value", "total", "values", (running - F.col("w") / 2).alias("middle"),
            F.coalesce(F.lag("value").over(in_part), "before").alias("previous"),
        )
        places = places.where((F.col("values") > bins) & F.col("previous").isNotNull()).withColumn("passed", F.ceil(F.col("middle") * bins / F.col("total")))
        # Of places past the same parts, only the first can be cut: at most one for each cut.
        for group in (["feature", "part", "passed"], ["feature", "passed"]):
            nth = F.row_number().over(Window.partitionBy(*group).orderBy("value"))
            places = places.withColumn("nth", nth).where(F.col("nth") < bins)
        found = {}
        for row in places.orderBy("feature", "value").collect():
            cuts = found.setdefault(row.feature, [])
            if row.middle > (len(cuts) + 1) * row.total / bins:
                cuts.append((row.previous + row.value) / 2)
        return found
    finally:
        placed.unpersist()


def _binning(columns: list[str], cuts: dict[str, list[float]]) -> PipelineModel:
    """Features, those with cuts as the numbers of their bins. A value at a cut belongs below it, as in Spark's trees."""
    cut = [c for c in columns if c in cuts]
    bounds = [[-math.inf, *sorted({math.nextafter(x, math.inf) for x in cuts[c] if x < math.inf} or {0.0}), math.inf] for c in cut]
    numbers = VectorAssembler(inputCols=[_BIN + c if c in cuts else c for c in columns], outputCol="features")
    bucketizers = [Bucketizer(splitsArray=bounds, inputCols=cut, outputCols=[_BIN + c for c in cut])] if cut else []
    return PipelineModel([*bucketizers, numbers])


def _binned(rows: DataFrame, binning: PipelineModel, partitions: int | None) -> DataFrame:
    """Rows of equal bins and class as one row with their summed weight, dealt by their values and in order.

    Trees that look at bins only can't tell them apart, so the fit is that on all rows.
    """
    *bucketizers, assembler = binning.stages
    key = [*assembler.getInputCols(), _CLASS, "isVal"]
    # Weights are multiplied and not added up, so that Spark still meets one that is missing or negative.
    counted = PipelineModel(bucketizers).transform(rows).groupBy(*key, "weight").agg(F.count("*").alias("n"))
    counted = counted.withColumn("weight", F.col("weight") * F.col("n")).drop("n").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if partitions is None:
            partitions = binned_partitions_for(counted.count())
        dealt = counted.repartition(partitions, *key).sortWithinPartitions(*key, "weight")
        targets = {f"is_{c}": F.when(F.col(_CLASS) == c, 1.0).otherwise(0.0) for c in CATEGORY_NAMES}
        # Bins are numbers in order: as the categories that the bucketizer marks, trees would put them in any order.
        narrow = assembler.transform(dealt).withMetadata("features", {}).withColumns(targets).drop(*assembler.getInputCols())
        narrow.persist(StorageLevel.MEMORY_AND_DISK).count()
        return narrow
    finally:
        counted.unpersist()


def _fit_side_by_side(estimators: list, rows: DataFrame) -> list:
    """Fit on one stored table at once; each fit's jobs take the cores that the others leave free."""
    with ThreadPool(len(estimators)) as pool:
        return pool.map(inheritable_thread_target(rows.sparkSession)(lambda e: e.fit(rows)), estimators)


def train_flow_classifier(
    train: DataFrame,
    method: str = "forest",
    trees: int = TREES,
    depth: int = MAX_DEPTH,
    seed: int = 42,
    partitions: int | None = None,
) -> PipelineModel:
    """Fit on encoded flows that carry ``isVal`` and ``weight`` (see ``union_train_val``).

    ``forest`` fits one three-class random forest on the rows not marked ``isVal``. ``boosted`` fits
    a gradient-boosted classifier per class, side by side, and stops each early on the rows marked; it learns from rows of
    bins (``cut_points``) with their weights, so that a round takes as long as there are such rows. Rows without one of
    the three labels are left out. The model follows from the rows and the seed: ``partitions`` follow from the number of
    rows unless given (``partitions_for``, ``binned_partitions_for``).
    """
    estimators = {"forest": _forest, "boosted": _boosted}[method](trees, depth, seed)
    inputs = [_INPUT + c for c in FEATURES]
    rows = _labelled(train).select(*inputs, _CLASS, "isVal", "weight")
    if method == "boosted":
        features = _binning(inputs, cut_points(rows.where(~F.col("isVal")), inputs))
        narrow = _binned(rows, features, partitions)
    else:
        features = feature_assembler()
        # Every tree level is a pass over these rows. They may spill to disk and are rebuilt if lost.
        narrow = features.transform(_placed(rows, partitions)).drop(*inputs)
        narrow.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # Filtered above the stored rows, where the flag is a plain column.
        fitted = narrow if method == "boosted" else narrow.filter(~F.col("isVal"))
        return PipelineModel([features, *_fit_side_by_side(estimators, fitted)])
    finally:
        narrow.unpersist()


def score_flows(df: DataFrame, model: Transformer) -> DataFrame:
    """Add an integer ``prediction``; all input columns stay, nothing is joined or collected.

    A prediction that the rows already carry is no input of the model: it gives way to the model's own.
    """
    scored = model.transform(_filled_apart(df.drop("prediction")))
    if "prediction" in scored.columns:
        chosen = F.col("prediction").cast("int")
    else:
        odds = {c: vector_to_array(f"probability_{c}")[1] for c in CATEGORY_NAMES}
        best = F.greatest(*odds.values())
        chosen = F
        for c, value in odds.items():
            chosen = chosen.when(value == best, c)
    keep = [c for c in df.columns if c not in LABELLED_COLUMNS]
    layout = [c for c in LABELLED_COLUMNS if c in df.columns or c == "prediction"]
    return scored.select(*keep, *[chosen.alias(c) if c == "prediction" else c for c in layout])


def evaluate_flows(df: DataFrame, model: Transformer) -> DataFrame:
    """Accuracy of a model on labelled rows."""
    return accuracy(score_flows(df, model))
