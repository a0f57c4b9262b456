"""Model quality from a long table (model_name, label, prediction, probability).

Counts are exact integers until the last division, so results do not hang on row order.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyscan.operators.keyed import lookup_join
from levyscan.operators.ordering import running_totals
from levyscan.operators.setops import append_by_name


def confusion_matrix(scored: DataFrame) -> DataFrame:
    def n(label: int, prediction: int):
        return F.count(F.when((F.col("label") == label) & (F.col("prediction") == prediction), 1))

    return scored.groupBy("model_name").agg(
        n(1, 1).alias("tp"), n(0, 1).alias("fp"), n(1, 0).alias("fn"), n(0, 0).alias("tn")
    )


def _share(part, whole):
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def quality_metrics(scored: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1; a ratio without cases is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion_matrix(scored).select(
        "model_name",
        _share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def class_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support seen from each of the two classes."""
    flipped = scored.select("model_name", (1 - F.col("label")).alias("label"), (1 - F.col("prediction")).alias("prediction"))
    sides = []
    for value, frame in ((1, scored), (0, flipped)):
        tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
        sides.append(
            confusion_matrix(frame).select(
                "model_name",
                F.lit(value).alias("class"),
                _share(tp, tp + fp).alias("precision"),
                _share(tp, tp + fn).alias("recall"),
                _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
                (tp + fn).alias("support"),
            )
        )
    return append_by_name(*sides)


def _cumulative(scored: DataFrame) -> DataFrame:
    """Per model and distinct score, from the highest down: true and false positives so far,
    and the class totals of the model."""
    groups = scored.groupBy("model_name", "probability").agg(
        F.count(F.when(F.col("label") == 1, 1)).alias("pos"),
        F.count(F.when(F.col("label") == 0, 1)).alias("neg"),
    )
    running = running_totals(
        groups, ["model_name", F.desc("probability")], {"run_pos": "pos", "run_neg": "neg"}
    )
    # The running sums go over all models; what earlier models added is taken off again.
    per_model = running.groupBy("model_name").agg(
        F.sum("pos").alias("all_pos"),
        F.sum("neg").alias("all_neg"),
        F.min(F.col("run_pos") - F.col("pos")).alias("skip_pos"),
        F.min(F.col("run_neg") - F.col("neg")).alias("skip_neg"),
    )
    return lookup_join(running, per_model, ["model_name"], ["probability"]).select(
        "model_name",
        "probability",
        "pos",
        "neg",
        (F.col("run_pos") - F.col("skip_pos")).alias("tp"),
        (F.col("run_neg") - F.col("skip_neg")).alias("fp"),
        "all_pos",
        "all_neg",
    )


def roc_auc(scored: DataFrame) -> DataFrame:
    """Area under the ROC curve as a tie-aware rank sum; 0 when a class is missing.

    Each positive beats the negatives below it and half of those it ties with. Twice that
    is a whole number, summed exactly.
    """
    below = F.col("all_neg") - F.col("fp")
    twice = F.col("pos").cast("decimal(18,0)") * (2 * below + F.col("neg")).cast("decimal(19,0)")
    sums = (
        _cumulative(scored)
        .groupBy("model_name")
        .agg(
            F.sum(twice).cast("double").alias("twice"),
            F.max("all_pos").cast("double").alias("p"),
            F.max("all_neg").cast("double").alias("n"),
        )
    )
    pairs = F.lit(2.0) * F.col("p") * F.col("n")
    return sums.select("model_name", _share(F.col("twice"), pairs).alias("roc_auc"))


def roc_points(scored: DataFrame, with_baseline: bool = True) -> DataFrame:
    """Curve points at every distinct score, the origin of each curve, and the diagonal."""
    points = _cumulative(scored).select(
        F.col("model_name").alias("Model"),
        _share(F.col("fp"), F.col("all_neg")).alias("FPR"),
        _share(F.col("tp"), F.col("all_pos")).alias("TPR"),
    )
    origin = scored.select(F.col("model_name").alias("Model")).distinct()
    origin = origin.select("Model", F.lit(0.0).alias("FPR"), F.lit(0.0).alias("TPR"))
    if not with_baseline:
        return append_by_name(origin, points)
    ends = scored.sparkSession.range(2).select(
        F.lit("Random Baseline").alias("Model"),
        F.col("id").cast("double").alias("FPR"),
        F.col("id").cast("double").alias("TPR"),
    )
    return append_by_name(origin, points, ends)


def comparison_table(scored: DataFrame) -> DataFrame:
    """One row per model, under the published column names."""
    return quality_metrics(scored).join(roc_auc(scored), "model_name").select(
        F.col("model_name").alias("Model"),
        F.col("accuracy").alias("Accuracy"),
        F.col("precision").alias("Precision"),
        F.col("recall").alias("Recall"),
        F.col("f1").alias("F1"),
        F.col("roc_auc").alias("ROC_AUC"),
    )


def false_positives(scored: DataFrame) -> DataFrame:
    return scored.filter((F.col("label") == 0) & (F.col("prediction") == 1))


def false_negatives(scored: DataFrame) -> DataFrame:
    return scored.filter((F.col("label") == 1) & (F.col("prediction") == 0))
