import random

import pytest
from pyspark.sql import functions as F

from telestrata.operators import model


@pytest.fixture(scope="module")
def features(spark):
    """Hot windows are anomalous; a quarter of them, and some gaps."""
    draw = random.Random(1)
    rows = []
    for i in range(600):
        hot = i % 4 == 0
        temp = draw.uniform(150, 200) if hot else draw.uniform(10, 40)
        rows.append((f"d{i % 20}", i, temp, None if i % 9 == 0 else draw.random(), float(hot) / 2, int(hot)))
    df = spark.createDataFrame(
        rows,
        "device_id string, w int, temp_mean double, battery_mean double, anomaly_rate double, anomaly_count int",
    )
    start = F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, w, 0, 0)")
    return df.withColumn("window_start", start).withColumn("window_end", start).drop("w")


@pytest.fixture(scope="module")
def fitted(features):
    return model.train(model.add_label(features), trees=8, depth=4)


@pytest.fixture(scope="module")
def scored(fitted, features):
    return model.score(fitted, model.add_label(features)).cache()


def test_label_and_balance(features):
    rows = {r[model.LABEL]: (r.n, r.share) for r in model.class_balance(model.add_label(features)).collect()}
    assert rows == {0: (450, 0.75), 1: (150, 0.25)}


def test_leaking_columns_are_left_out(features):
    assert model.model_features(model.add_label(features)) == ["temp_mean", "battery_mean"]


def test_split_is_stable_and_near_its_shares(features):
    labelled = model.add_label(features)
    once = model.split(labelled)
    again = model.split(labelled.repartition(7))
    assert once.exceptAll(again).count() == 0
    for label in (0, 1):
        share = once.where(F.col(model.LABEL) == label).agg(F.avg((F.col("side") == "train").cast("int"))).first()[0]
        assert 0.6 < share < 0.8


def test_balanced_weights(features):
    weighted = model.add_class_weights(model.add_label(features))
    sums = {r[0]: r[1] for r in weighted.groupBy(model.LABEL).agg(F.sum("weight")).collect()}
    assert sums == {0: pytest.approx(300), 1: pytest.approx(300)}


def test_scores_separate_the_classes(scored, features):
    assert scored.count() == features.count()
    report = {r["class"]: r for r in model.classification_report(scored).collect()}
    assert report["Anomalous"].support == 150 and report["Clean"].support == 450
    assert report["Anomalous"].recall > 0.95 and report["Clean"].f1 > 0.95
    matrix = {r.actual: (r.predicted_clean, r.predicted_anomalous) for r in model.confusion_matrix(scored).collect()}
    assert sum(matrix[0]) == 450 and sum(matrix[1]) == 150


def test_scoring_works_after_an_observation(spark, fitted, features):
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 3
    assert len(model.score(fitted, features).toPandas()) == 600


def brute_force_auc(pairs):
    pos = [p for p, y in pairs if y]
    neg = [p for p, y in pairs if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_roc_and_auc_against_brute_force(spark):
    draw = random.Random(5)
    pairs = []
    for _ in range(800):
        y = draw.random() < 0.3
        p = 0.5 if draw.random() < 0.33 else min(1.0, max(0.0, draw.gauss(0.6 if y else 0.4, 0.2)))
        pairs.append((p, int(y)))
    df = spark.createDataFrame(pairs, f"predicted_prob double, {model.LABEL} int")
    points = model.roc_points(df)
    assert model.auc(points).first().auc == pytest.approx(brute_force_auc(pairs))
    rows = points.orderBy(F.desc("threshold")).collect()
    assert len(rows) == len({p for p, _ in pairs})
    assert (rows[-1].fpr, rows[-1].tpr) == (1.0, 1.0)
    assert all(a.tpr <= b.tpr and a.fpr <= b.fpr for a, b in zip(rows, rows[1:]))


def test_roc_where_most_probabilities_share_a_range(spark):
    """Two thirds of the probabilities differ only far behind the point."""
    draw = random.Random(6)
    pairs = [
        (draw.random() * (1e-9 if i % 3 else 1.0), int(draw.random() < 0.4)) for i in range(600)
    ] + [(0.0, 1), (1.0, 0), (1.0, 1)]
    df = spark.createDataFrame(pairs, f"predicted_prob double, {model.LABEL} int").repartition(5)
    points = model.roc_points(df)
    assert points.count() == len({p for p, _ in pairs})
    assert model.auc(points).first().auc == pytest.approx(brute_force_auc(pairs))


def test_roc_of_one_class_is_empty(spark):
    df = spark.createDataFrame([(0.2, 0), (0.7, 0)], f"predicted_prob double, {model.LABEL} int")
    assert model.roc_points(df).count() == 0
    assert model.auc(model.roc_points(df)).first().auc is None


def test_importance(spark, fitted):
    table = model.feature_importance(spark, fitted)
    rows = {r.feature: r for r in table.collect()}
    assert rows["temp_mean"].importance > rows["battery_mean"].importance
    assert model.top_importance(table, 1).first().feature == "temp_mean"
    by_category = {r.category: r.importance for r in model.importance_by_category(table).collect()}
    assert sum(by_category.values()) == pytest.approx(1.0)


@pytest.mark.parametrize(
    "feature, expected",
    [
        ("temp_zscore_abs_max", "Z-Score Features"),
        ("quality_min", "Quality Features"),
        ("battery_mean", "Battery Features"),
        ("temp_range", "Temperature Sensor"),
        ("hum_mean", "Humidity Sensor"),
        ("pres_max", "Pressure Sensor"),
        ("event_count", "Other"),
    ],
)
def test_categories(spark, feature, expected):
    df = spark.createDataFrame([(feature,)], "f string")
    assert df.select(model.category(F.col("f"))).first()[0] == expected


def test_what_if(fitted, features):
    cold = features.where("anomaly_rate = 0").limit(1)
    row = model.what_if(fitted, cold, {"temp_mean": 190.0}).first()
    assert row.predicted_anomalous == 1


def test_alerts_and_drift(scored):
    assert model.alerts(scored, 0.5).count() == scored.where("predicted_prob > 0.5").count()
    days = model.drift(scored).collect()
    assert sum(d.windows for d in days) == 600
    assert all(abs(d.gap) < 0.2 for d in days)


def test_the_curve_reads_written_scores(scored, monkeypatch):
    from verification import queries

    read = []
    points = model.roc_points
    monkeypatch.setattr(queries, "scored_test", lambda spark, sf: scored)
    monkeypatch.setattr(model, "roc_points", lambda rows: read.extend(rows.inputFiles()) or points(rows))
    found = {r.figure: r.value for r in queries.ml_roc(scored.sparkSession, "").collect()}
    assert found["auc"] == pytest.approx(model.auc(points(scored)).first().auc)
    assert found["points"] == points(scored).count()
    assert read and all("scored-test" in file for file in read)
