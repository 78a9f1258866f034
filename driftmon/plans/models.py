"""Boosted-tree pipelines: build, score, save, load."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmon.schemas import BOOSTING_ROUNDS, FEATURES

SEED = 42  # the library default differs between processes


def pipeline(kind: str = "classifier", invalid: str = "error", seed: int = SEED, **params):
    """Assembler and boosted trees; `params` go to the tree estimator."""
    estimator = {"classifier": GBTClassifier, "regressor": GBTRegressor}[kind]
    gbt = estimator(
        featuresCol="features",
        labelCol="label",
        seed=seed,
        **{"maxIter": BOOSTING_ROUNDS, **params},
    )
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid=invalid)
    return Pipeline(stages=[assembler, gbt])


Spread = str | int | tuple[str, int] | None


def spread(df: DataFrame, by: Spread = None) -> DataFrame:
    """Optional repartition before training: a column name, a partition count, or both.

    A column alone spreads rows by its values, so `label` fills two partitions. With a count as
    well, every value is dealt over all partitions, so that each holds each class in its share,
    but for chance; equal rows part as others do.
    """
    if not isinstance(by, tuple):
        return df if by is None else df.repartition(by)
    column, parts = by
    salted = F.xxhash64(column, F.monotonically_increasing_id())
    place = F.pmod(salted, F.lit(parts)).cast("int")
    return df.withColumn("_place", place).repartitionById(parts, F.col("_place")).drop("_place")


def fit(train: DataFrame, kind: str = "classifier", by: Spread = None, **params):
    needed = train.select(*FEATURES, F.col("label").cast("double").alias("label"))
    return pipeline(kind, **params).fit(spread(needed, by))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add `prediction`; for a classifier also `score`, the raw margin of class 1, and its
    `probability`."""
    out = model.transform(df)
    if "rawPrediction" in out.columns:
        out = out.withColumns(
            {
                "score": vector_to_array("rawPrediction")[1],
                "probability": vector_to_array("probability")[1],
            }
        )
    return out.drop("features", "rawPrediction")


def complete() -> Column:
    """True for rows with all features; the assembler fails on others."""
    cond = F.lit(True)
    for c in FEATURES:
        cond = cond & F.col(c).isNotNull() & ~F.isnan(c)
    return cond


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
