"""Training and scoring: no model is fitted on fewer rows than given, and none on the driver.

A forest is fitted in groups of trees (`operators.forest`), boosted trees in rounds
(`operators.boosting`). Both are stages of Spark ML pipeline models.
"""

import math

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import PipelineSharedReadWrite
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from levyscan.constants import (
    BOOSTED_NAME,
    BOOSTED_THRESHOLD,
    FEATURES,
    FOREST_NAME,
    LOWEST_BAND,
    SCORE_TIER_BANDS,
)
from levyscan.functions.scalars import band, flag, hash_fraction, hash_number
from levyscan.operators import forest as forests
from levyscan.operators.boosting import fit_boosted
from levyscan.operators.keyed import lookup_join, one_per_key
from levyscan.operators.ordering import number_rows
from levyscan.operators.projection import fill_features
from levyscan.sources.staging import Jobs, stage


def feature_matrix(silver: DataFrame) -> DataFrame:
    return fill_features(silver.select("po_id", "is_anomalous", *FEATURES))


def with_split(df: DataFrame, test_share: float = 0.2, salt: str = "split") -> DataFrame:
    """is_test by a hash of the order id: row-local, each class gets close to its share."""
    return df.withColumn("is_test", hash_fraction(salt, F.col("po_id")) < test_share)


def with_exact_split(
    df: DataFrame, test_share: float = 0.2, label: str = "is_anomalous", salt: str = "split"
) -> DataFrame:
    """is_test with the exact share of each class: the first rows of the class in hash order."""
    hashed = df.withColumn("_hash", hash_number(salt, F.col("po_id")))
    numbered = number_rows(hashed, [label, "_hash", "po_id"], "_nth")
    sizes = numbered.groupBy(label).agg(F.min("_nth").alias("_first"), F.count("*").alias("_size"))
    place = F.col("_nth") - F.col("_first")
    return (
        lookup_join(numbered, sizes, [label], ["po_id"])
        .withColumn("is_test", place < F.round(F.col("_size") * test_share))
        .drop("_hash", "_nth", "_first", "_size")
    )


def with_class_weight(df: DataFrame, label: str = "is_anomalous") -> DataFrame:
    """Balanced weight n / (classes * n_class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("rows"), F.count("*").alias("classes")).first()
    weights = counts.select(label, (F.lit(total["rows"]) / (total["classes"] * F.col("_n"))).alias("weight"))
    return lookup_join(df, weights, [label], ["po_id"])


def train_forest(
    train: DataFrame,
    features: list[str] = FEATURES,
    trees: int = 500,
    depth: int = 30,
    seed: int = 42,
    trees_per_group: int = 25,
) -> PipelineModel:
    """Balanced random forest. The depth is the deepest Spark grows, the nearest to no limit."""
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    rows = stage(assembler.transform(train).select("features", "is_anomalous"), "train")
    per_node = math.ceil(math.sqrt(len(features)))
    return PipelineModel(stages=[assembler, *forests.fit_forest(rows, trees, depth, per_node, seed, trees_per_group)])


def train_boosted(
    train: DataFrame,
    features: list[str] = FEATURES,
    rounds: int = 500,
    depth: int = 4,
    step: float = 0.05,
    seed: int = 42,
) -> PipelineModel:
    """Boosted trees on 80 % of the rows and features, a job for each level (`operators.boosting`)."""
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    rows = stage(assembler.transform(train).select("features", "is_anomalous"), "train")
    return PipelineModel(stages=[assembler, fit_boosted(rows, rounds, depth, step, 0.8, 0.8, seed)])


def positive_probability(probability: Column) -> Column:
    return vector_to_array(probability)[1]


def decide(probability: Column, threshold: float) -> Column:
    return flag(probability >= threshold)


def probability_tier(probability: Column) -> Column:
    return band(probability, SCORE_TIER_BANDS, LOWEST_BAND)


def score(model: PipelineModel, df: DataFrame, model_name: str, threshold: float | None = None) -> DataFrame:
    """Long score table. Without a threshold the more probable class is taken."""
    first, *stages = model.stages
    if isinstance(stages[0], forests.ForestModel):
        scored, probability = forests.with_share(first.transform(df), stages, "_share"), F.col("_share")
    else:
        scored, probability = model.transform(df), positive_probability(F.col("probability"))
    out = scored.select("po_id", "is_anomalous", probability.alias("probability"))
    decision = flag(F.col("probability") > 0.5) if threshold is None else decide(F.col("probability"), threshold)
    return out.select(
        "po_id",
        F.col("is_anomalous").alias("label"),
        decision.alias("prediction"),
        "probability",
        F.lit(model_name).alias("model_name"),
    )


def score_forest(model: PipelineModel, df: DataFrame) -> DataFrame:
    return score(model, df, FOREST_NAME)


def score_boosted(model: PipelineModel, df: DataFrame) -> DataFrame:
    return score(model, df, BOOSTED_NAME, BOOSTED_THRESHOLD)


def prediction_table(scored: DataFrame, short: str, with_tier: bool = False) -> DataFrame:
    """One row per order in the published shape, such as rf_prediction, rf_probability."""
    columns = [
        "po_id",
        F.col("label").alias("actual"),
        F.col("prediction").alias(f"{short}_prediction"),
        F.col("probability").alias(f"{short}_probability"),
        "model_name",
    ]
    if with_tier:
        columns.append(probability_tier(F.col("probability")).alias("risk_tier"))
    return one_per_key(scored.select(*columns), ["po_id"])


def feature_importance(model: PipelineModel, model_name: str, features: list[str] = FEATURES) -> DataFrame:
    """One row per feature: a table as long as the feature list. Trees of a forest count alike."""
    parts = [s.featureImportances.toArray() * len(s.treeWeights) for s in model.stages[1:]]
    weights = sum(parts) / tree_count(model)
    rows = [(model_name, name, float(w)) for name, w in zip(features, weights)]
    schema = "model_name string, feature_name string, importance_score double"
    return SparkSession.active().createDataFrame(rows, schema)


def tree_count(model: PipelineModel) -> int:
    return sum(len(s.treeWeights) for s in model.stages[1:])


class _StagesWriter(MLWriter):
    """Writes a pipeline model as Spark does, but its stages side by side: a forest has many."""

    def __init__(self, model: PipelineModel):
        super().__init__()
        self._stages, self._model = model.stages, model

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        about = {"stageUids": [s.uid for s in self._stages], "language": "Python"}
        DefaultParamsWriter.saveMetadata(self._model, path, spark, paramMap=about)
        places = _stage_paths(path, about["stageUids"])
        with Jobs(spark) as jobs:
            written = [jobs.start(lambda s=s, place=place: s.write().save(place)) for s, place in zip(self._stages, places)]
            for each in written:
                each.result()


def _stage_paths(path: str, uids: list[str]) -> list[str]:
    return [PipelineSharedReadWrite.getStagePath(uid, i, len(uids), f"{path}/stages") for i, uid in enumerate(uids)]


def save_model(model: PipelineModel, path: str) -> str:
    _StagesWriter(model).overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    spark = SparkSession.active()
    places = _stage_paths(path, DefaultParamsReader.loadMetadata(path, spark)["paramMap"]["stageUids"])
    with Jobs(spark) as jobs:
        read = [jobs.start(lambda place=place: DefaultParamsReader.loadParamsInstance(place, spark)) for place in places]
        return PipelineModel(stages=[each.result() for each in read])
