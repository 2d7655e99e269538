"""Anomaly model on the feature table, with ``pyspark.ml``.

The label follows ``anomaly_rate``. The columns that state it outright are left
out, but sensor extremes, z-scores and quality still reveal it, so a high score
shows that the features carry the rule, not that anomalies are foreseen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telestrata.functions import ratio
from telestrata.operators.distributions import numeric_features
from telestrata.sources.storage import workspace

LABEL = "is_anomalous_window"
LEAKING = (
    "anomaly_count",
    "anomaly_rate",
    "temp_anomaly_count",
    "hum_anomaly_count",
    "pres_anomaly_count",
)
CLASS_NAMES = {0: "Clean", 1: "Anomalous"}
# Substring and category, first match wins.
CATEGORIES = (
    ("zscore", "Z-Score Features"),
    ("quality", "Quality Features"),
    ("battery", "Battery Features"),
    ("temp", "Temperature Sensor"),
    ("hum", "Humidity Sensor"),
    ("pres", "Pressure Sensor"),
)
_GRID = 4096


def add_label(features: DataFrame) -> DataFrame:
    return features.withColumn(LABEL, (F.col("anomaly_rate") > 0).cast("int"))


def class_balance(labelled: DataFrame) -> DataFrame:
    """Windows per class and their share; the window runs over two rows."""
    counts = labelled.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn(
        "share", ratio(F.col("n"), F.sum("n").over(Window.partitionBy()))
    )


def model_features(features: DataFrame) -> list[str]:
    return [c for c in numeric_features(features) if c not in (*LEAKING, LABEL)]


def split(labelled: DataFrame, train_share: float = 0.7, seed: int = 42) -> DataFrame:
    """Mark each window ``train`` or ``test`` by a hash of its key.

    The same window always lands on the same side, whatever the partitioning. The
    shares hold within each class up to sampling noise; they are not exact.
    """
    grain = 1_000_000
    key = F.concat_ws(
        "|", "device_id", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"), F.lit(str(seed))
    )
    # The leading digits of a hash that every engine has.
    draw = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % F.lit(grain)
    side = F.when(draw < int(train_share * grain), "train").otherwise("test")
    return labelled.withColumn("side", side)


def add_class_weights(labelled: DataFrame) -> DataFrame:
    """Weight ``n / (2 * n_class)``, so both classes carry equal weight."""
    counts = labelled.groupBy(LABEL).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy())
    weights = counts.select(LABEL, (total / (2.0 * F.col("_n"))).alias("weight"))
    return labelled.join(F.broadcast(weights), LABEL)  # one row per class


def train(
    labelled: DataFrame,
    columns: Sequence[str] | None = None,
    trees: int = 100,
    depth: int = 10,
    min_leaf: int = 2,
    seed: int = 42,
) -> PipelineModel:
    """Random forest with balanced classes; missing features count as 0."""
    names = list(columns or model_features(labelled))
    rows = _filled(add_class_weights(labelled), names)
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol=LABEL,
        weightCol="weight",
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        seed=seed,
    )
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    fitted = Pipeline(stages=[assembler, forest]).fit(rows)
    # A fresh model drags its training summary, and with it the session, into
    # every scoring task; the stored copy has none.
    path = workspace(labelled.sparkSession, "forest")
    fitted.write().save(path)
    return PipelineModel.load(path)


def _filled(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(names))


def score(model: PipelineModel, features: DataFrame, cut: float = 0.5) -> DataFrame:
    """Add the probability of an anomalous window and the class at ``cut``."""
    names = model.stages[0].getInputCols()
    scored = model.transform(_filled(features, names))
    probability = vector_to_array("probability")[1]
    return scored.withColumn("predicted_prob", probability).select(
        *features.columns,
        "predicted_prob",
        (F.col("predicted_prob") > cut).cast("int").alias("predicted_anomalous"),
    )


def what_if(
    model: PipelineModel, features: DataFrame, overrides: Mapping[str, float]
) -> DataFrame:
    """Score the given windows with some features replaced."""
    edited = features.withColumns({c: F.lit(float(v)) for c, v in overrides.items()})
    return score(model, edited)


def classification_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, from one pass."""
    actual, predicted = F.col(LABEL), F.col("predicted_anomalous")
    counts = scored.groupBy().agg(
        *[
            F.count_if((actual == a) & (predicted == p)).alias(f"n{a}{p}")
            for a in (0, 1)
            for p in (0, 1)
        ]
    )

    def line(c: int) -> Column:
        hit = F.col(f"n{c}{c}")
        precision = ratio(hit, hit + F.col(f"n{1 - c}{c}"))
        support = hit + F.col(f"n{c}{1 - c}")
        recall = ratio(hit, support)
        f1 = F.try_divide(2.0 * precision * recall, precision + recall)
        zero = F.lit(0.0)
        return F.struct(
            F.lit(CLASS_NAMES[c]).alias("class"),
            F.coalesce(precision, zero).alias("precision"),
            F.coalesce(recall, zero).alias("recall"),
            F.coalesce(f1, zero).alias("f1"),
            support.alias("support"),
        )

    return counts.select(F.inline(F.array(line(0), line(1))))


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Rows by actual class, columns by predicted class."""
    counts = scored.groupBy(F.col(LABEL).alias("actual")).agg(
        F.count_if(F.col("predicted_anomalous") == 0).alias("predicted_clean"),
        F.count_if(F.col("predicted_anomalous") == 1).alias("predicted_anomalous"),
    )
    return counts.orderBy("actual")


def roc_points(scored: DataFrame) -> DataFrame:
    """False and true positive rate at every distinct probability.

    Rows with equal probability are merged first. Running totals come from three
    levels: ranges of 1/4096, the 4096 ranges inside each of those, and the
    probabilities inside such a small range. A task thus adds up at most 4,097
    range totals or the distinct probabilities of one range of width 6e-8. No rows
    come out when only one class is present.
    """
    merged = (
        scored.groupBy("predicted_prob")
        .agg(
            F.count_if(F.col(LABEL) == 1).alias("pos"),
            F.count_if(F.col(LABEL) == 0).alias("neg"),
        )
        .withColumn("cell", F.floor(F.col("predicted_prob") * _GRID))
        .withColumn("part", F.floor(F.col("predicted_prob") * _GRID * _GRID))
    )
    parts = merged.groupBy("cell", "part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    cells = parts.groupBy("cell").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    above, whole = Window.orderBy(F.desc("cell")), Window.partitionBy()
    cell_offsets = cells.select(
        "cell",
        (F.sum("p").over(above) - F.col("p")).alias("pos_above"),
        (F.sum("n").over(above) - F.col("n")).alias("neg_above"),
        F.sum("p").over(whole).alias("all_pos"),
        F.sum("n").over(whole).alias("all_neg"),
    ).where((F.col("all_pos") > 0) & (F.col("all_neg") > 0))
    in_cell = Window.partitionBy("cell").orderBy(F.desc("part"))
    # The broadcast side has at most one row per cell of the grid.
    offsets = parts.join(F.broadcast(cell_offsets), "cell").select(
        "cell",
        "part",
        (F.col("pos_above") + F.sum("p").over(in_cell) - F.col("p")).alias("pos_above"),
        (F.col("neg_above") + F.sum("n").over(in_cell) - F.col("n")).alias("neg_above"),
        "all_pos",
        "all_neg",
    )
    in_part = Window.partitionBy("cell", "part").orderBy(F.desc("predicted_prob"))
    tp = F.col("pos_above") + F.sum("pos").over(in_part)
    fp = F.col("neg_above") + F.sum("neg").over(in_part)
    return merged.join(offsets, ["cell", "part"]).select(
        F.col("predicted_prob").alias("threshold"),
        ratio(fp, F.col("all_neg")).alias("fpr"),
        ratio(tp, F.col("all_pos")).alias("tpr"),
        ratio(F.col("neg"), F.col("all_neg")).alias("fpr_step"),
        ratio(F.col("pos"), F.col("all_pos")).alias("tpr_step"),
    )


def auc(points: DataFrame) -> DataFrame:
    """Area under the points of ``roc_points`` by trapezoids; null without any."""
    strip = F.col("fpr_step") * (F.col("tpr") - F.col("tpr_step") / 2.0)
    return points.agg(F.sum(strip).alias("auc"))


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Importance of every feature with its category (one row per feature)."""
    names = model.stages[0].getInputCols()
    values = model.stages[-1].featureImportances.toArray().tolist()
    pairs = spark.createDataFrame(list(zip(names, values)), "feature string, importance double")
    return pairs.withColumn("category", category(F.col("feature")))


def category(feature: Column) -> Column:
    chosen = F.when(F.lit(False), F.lit(None).cast("string"))
    for part, name in CATEGORIES:
        chosen = chosen.when(feature.contains(part), name)
    return chosen.otherwise("Other")


def top_importance(importance: DataFrame, k: int = 15) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(k)


def importance_by_category(importance: DataFrame) -> DataFrame:
    return importance.groupBy("category").agg(F.sum("importance").alias("importance"))


def alerts(scored: DataFrame, threshold: float = 0.8) -> DataFrame:
    return scored.where(F.col("predicted_prob") > threshold).select(
        "device_id", "window_start", "window_end", "predicted_prob", "predicted_anomalous"
    )


def drift(scored: DataFrame, window: str = "1 day") -> DataFrame:
    """Predicted against actual share of anomalous windows over time."""
    return (
        scored.withColumn("period", F.window("window_start", window)["start"])
        .groupBy("period")
        .agg(
            F.count(F.lit(1)).alias("windows"),
            F.avg("predicted_anomalous").alias("predicted_rate"),
            F.avg(LABEL).alias("actual_rate"),
        )
        .withColumn("gap", F.col("predicted_rate") - F.col("actual_rate"))
    )
