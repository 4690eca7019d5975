"""Five-class star classifier for texts, trained with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaudit.functions.sentiment import sentiment_label
from plaudit.operators.sample import fixed_sample
from plaudit.operators.topics import HELPER_COLUMNS, MAX_TERMS, fit_tfidf
from plaudit.storage import balanced

TRAIN_ROWS = 10_000
TEST_ROWS = 2_000


@dataclass(frozen=True)
class StarClassifier:
    """A fitted text pipeline; predictions are 1..5 stars."""

    model: PipelineModel
    accuracy: float
    text: str = "text"

    def transform(self, df: DataFrame, text: str = "review_text") -> DataFrame:
        """Adds the three sentiment columns of ``scoring.score_sentiment``."""
        staged = df if text == self.text else df.withColumn(self.text, F.col(text))
        scored = self.model.transform(staged).withColumn("sentiment_stars", (F.col("prediction") + 1).cast("int"))
        scored = scored.withColumns({
            "sentiment_label": sentiment_label(F.col("sentiment_stars")),
            "sentiment_model": F.lit("classifier"),
        })
        extra = () if text == self.text else (self.text,)
        return scored.drop("features", "rawPrediction", "probability", "prediction", *extra, *HELPER_COLUMNS)

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)


def shift_labels(df: DataFrame) -> DataFrame:
    """Stars 1..5 to classes 0..4."""
    return df.withColumn("label", (F.col("label") - 1).cast("double"))


def train_classifier(
    train: DataFrame,
    test: DataFrame,
    key: str,
    text: str = "text",
    train_rows: int = TRAIN_ROWS,
    test_rows: int = TEST_ROWS,
    strengths: tuple[float, ...] = (0.01, 0.1),
    size: int = MAX_TERMS,
    seed: int = 42,
) -> StarClassifier:
    """Multinomial regression on TF-IDF; the regularisation with the best test accuracy wins.

    ``train`` and ``test`` hold ``key``, a text and a ``label`` of 1..5; fixed-size samples of both
    are used.
    """

    def sampled(df: DataFrame, rows: int) -> DataFrame:
        # a limit ends in one partition; training should not
        return shift_labels(balanced(fixed_sample(df.select(key, text, "label"), rows, key, seed))).persist()

    sampled_train, sampled_test = sampled(train, train_rows), sampled(test, test_rows)
    try:
        pipeline, _ = fit_tfidf(sampled_train, text, size)
        train_vectors, test_vectors = pipeline.transform(sampled_train), pipeline.transform(sampled_test)
        evaluator = MulticlassClassificationEvaluator(metricName="accuracy")
        best = None
        for strength in strengths:
            model = LogisticRegression(family="multinomial", regParam=strength, maxIter=50).fit(train_vectors)
            accuracy = evaluator.evaluate(model.transform(test_vectors))
            if best is None or accuracy > best[0]:
                best = (accuracy, model)
    finally:
        sampled_train.unpersist()
        sampled_test.unpersist()
    return StarClassifier(PipelineModel(stages=[*pipeline.stages, best[1]]), best[0], text)


def load_classifier(path: str, text: str = "text") -> StarClassifier:
    return StarClassifier(PipelineModel.load(path), float("nan"), text)
