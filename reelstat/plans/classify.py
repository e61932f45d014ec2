"""Random-forest classifier with a held-out accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.session import materialise


def split_by_key(df: DataFrame, keys: Sequence[str], test_share: float = 0.2) -> DataFrame:
    """``df`` with ``held_out``, chosen by a digest of the key columns as text: a row lies on the same side in every run and
    after every lost task."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return df.withColumn("held_out", F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 1000 < round(1000 * test_share))


def held_out_counts(model: PipelineModel, data: DataFrame) -> DataFrame:
    """Held-out rows by label and prediction."""
    return model.transform(data.where("held_out")).groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("rows"))


def train_classifier(
    df: DataFrame,
    target: str,
    keys: Sequence[str],
    features: Sequence[str] | None = None,
    test_share: float = 0.2,
    trees: int = 20,
    seed: int = 42,
) -> tuple[PipelineModel, float, DataFrame]:
    """Fit on the rows that ``split_by_key`` does not hold out; returns the model, its accuracy on the rest, and the stored
    features with their side. ``features`` default to all other columns; ``target`` holds class numbers from 0."""
    features = list(features or [c for c in df.columns if c != target and c not in keys])
    split = split_by_key(df, keys, test_share)
    label = F.col(target).cast("double").alias("label")
    data = split.select(label, "held_out", *[F.col(c).cast("double").alias(c) for c in features]).dropna()
    data = materialise(data, "features")  # the fit passes over it many times
    stages = [VectorAssembler(inputCols=features, outputCol="features"), RandomForestClassifier(numTrees=trees, seed=seed)]
    model = Pipeline(stages=stages).fit(data.where("not held_out"))
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(model.transform(data.where("held_out")))
    return model, accuracy, data
