"""The layer jobs: raw files to bronze, bronze to silver, silver to scores, both to gold.

Each job reads published layers and publishes one (`sources.published`), so it can be run
again after a failure, and readers keep the older version meanwhile.

| Layer | Tables |
|---|---|
| bronze | the seven inputs typed, and `quarantine` with the rows that could not be read |
| silver | `orders`, the wide table |
| scores | `rf_predictions`, `xgb_predictions`, `feature_importance`, and both models |
| gold | `anomaly_flags`, `vendor_risk` |
"""

from dataclasses import fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from levyscan.constants import BOOSTED_NAME, FOREST_NAME
from levyscan.operators import models
from levyscan.operators.ordering import sample_rows
from levyscan.plans import gold
from levyscan.plans.bronze import Layer, build_bronze
from levyscan.plans.silver import build_silver
from levyscan.schemas import INPUT_FIELDS
from levyscan.sources import published
from levyscan.sources.files import read_checked
from levyscan.sources.staging import Jobs, stage

MAX_TRAINING_ROWS = 20_000  # labelled rows of a fit, those with the least hashes


def read_raw(spark: SparkSession, raw_base: str) -> tuple[Layer, DataFrame]:
    """The seven inputs from CSV folders named after them, and the rows that cannot be read."""
    good, bad = {}, []
    for name, specs in INPUT_FIELDS.items():
        good[name], rejected = read_checked(spark, f"{raw_base.rstrip('/')}/{name}", specs, name)
        bad.append(rejected)
    return Layer(**good), reduce(DataFrame.unionByName, bad)


def bronze_job(spark: SparkSession, raw_base: str, base: str, as_of: str | None = None) -> str:
    raw, quarantine = read_raw(spark, raw_base)
    layer = build_bronze(raw, as_of)
    return published.write_layer(spark, base, "bronze", {**vars(layer), "quarantine": quarantine})


def bronze_layer(spark: SparkSession, base: str) -> Layer:
    return Layer(**{f.name: published.read_layer(spark, base, "bronze", f.name) for f in fields(Layer)})


def silver_job(spark: SparkSession, base: str, as_of: str | None = None, **options) -> str:
    silver = build_silver(bronze_layer(spark, base), as_of, **options)
    return published.write_layer(spark, base, "silver", {"orders": silver})


def score_job(spark: SparkSession, base: str, max_rows: int = MAX_TRAINING_ROWS, trees: int = 500, depth: int = 30, rounds: int = 500) -> str:
    """Fit both models on at most `max_rows` training orders and score every order."""
    silver = published.read_layer(spark, base, "silver", "orders")
    rows = stage(models.with_split(models.feature_matrix(silver)), "features")
    train = stage(sample_rows(rows.filter("not is_test"), max_rows, "fit", "po_id"), "sample")
    with Jobs(spark) as jobs:
        fitted = jobs.start(lambda: models.train_boosted(train, rounds=rounds))
        forest, boosted = models.train_forest(train, trees=trees, depth=depth), fitted.result()
    weights = models.feature_importance(forest, FOREST_NAME).union(models.feature_importance(boosted, BOOSTED_NAME))
    tables = {
        "rf_predictions": models.prediction_table(models.score_forest(forest, rows), "rf"),
        "xgb_predictions": models.prediction_table(models.score_boosted(boosted, rows), "xgb", with_tier=True),
        "feature_importance": weights,
    }

    def save(folder: str) -> None:
        models.save_model(forest, f"{folder}/forest")
        models.save_model(boosted, f"{folder}/boosted")

    return published.write_layer(spark, base, "scores", tables, save)


def gold_job(spark: SparkSession, base: str, as_of: str | None = None) -> str:
    silver = published.read_layer(spark, base, "silver", "orders")
    forest, boosted = (published.read_layer(spark, base, "scores", f"{m}_predictions") for m in ("rf", "xgb"))
    tables = {"anomaly_flags": gold.gold_anomaly_flags(silver, forest, boosted, as_of), "vendor_risk": gold.gold_vendor_risk(silver)}
    return published.write_layer(spark, base, "gold", tables)
