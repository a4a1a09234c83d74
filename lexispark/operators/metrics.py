"""Evaluation tables from scored rows.

Every label metric is derived from the confusion counts, so the predictions are aggregated
once. ``by`` names columns that tell models (or folds) apart; all of them share that pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from .ordered import running_sums


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient that is 0 where the denominator is 0."""
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def confusion_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per true and predicted label; pairs that do not occur have no row."""
    return scored.groupBy(*by, "label", "prediction").agg(F.count("*").alias("n"))


def class_metrics(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 per label that is true or predicted somewhere."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.col("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"), hit.alias("tp")),
        F.struct(
            F.col("prediction").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
            F.lit(0).cast("bigint").alias("tp"),
        ),
    )
    sums = (
        cells.select(*by, F.explode(sides).alias("x"))
        .select(*by, "x.*")
        .groupBy(*by, "label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    )
    return sums.select(
        *by,
        "label",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1_score"),
        "support",
        "tp",
    )


def summary(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    return summary_of(confusion_counts(scored, by), by)


def summary_of(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    total = F.sum("support")
    weighted = [
        (F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in ("precision", "recall", "f1_score")
    ]
    rows = class_metrics(cells, by).groupBy(*by) if by else class_metrics(cells)
    return rows.agg((F.sum("tp") / total).alias("accuracy"), *weighted)


def class_report(scored: DataFrame) -> DataFrame:
    """One row per class, then accuracy, macro average and weighted average."""
    # a row per pair of labels; classes and averages are both read from it
    rows = class_metrics(materialise(confusion_counts(scored)))
    names = ("precision", "recall", "f1_score")
    per_class = rows.select(F.col("label").cast("string").alias("label"), *names, "support")
    total = F.sum("support")
    nothing = F.lit(None).cast("double")
    averages = rows.agg(
        F.array(
            F.struct(
                F.lit("accuracy").alias("label"), nothing.alias("precision"), nothing.alias("recall"),
                (F.sum("tp") / total).alias("f1_score"), total.alias("support"),
            ),
            F.struct(F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in names], total.alias("support")),
            F.struct(
                F.lit("weighted avg").alias("label"),
                *[(F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in names], total.alias("support"),
            ),
        ).alias("rows")
    )
    return per_class.unionByName(averages.select(F.explode("rows").alias("r")).select("r.*"))


def confusion_matrix(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count and share of the true label for every pair of known labels, zeros included."""
    cells = materialise(confusion_counts(scored, by))
    labels = class_metrics(cells, by).select(*by, "label")
    known = (labels.groupBy(*by) if by else labels).agg(F.collect_set("label").alias("labels"))
    grid = known.select(*by, "labels", F.explode("labels").alias("label")).select(
        *by, "label", F.explode("labels").alias("prediction")
    )
    of_label = F.sum("n").over(W.partitionBy(*by, "label"))
    return (
        grid.join(cells, [*by, "label", "prediction"], "left")
        .select(*by, "label", "prediction", F.coalesce("n", F.lit(0)).alias("n"))
        .select("*", F.when(of_label > 0, F.col("n") / of_label).alias("share"))
    )


def wide_confusion(matrix: DataFrame, labels: list, value: str = "n") -> DataFrame:
    """One row per true label and one column per predicted label."""
    return matrix.groupBy("label").pivot("prediction", labels).agg(F.first(value))


# Threshold curves --------------------------------------------------------------------------------

# Sums in another order differ in the last bits; scores equal to this many digits are ties.
TIE_DIGITS = 12


def class_scores(scored: DataFrame, classes: list, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, class, score, pos, neg)`` summed per distinct score.

    With two classes the second one's probability is the score; otherwise every class is
    scored against the rest.
    """
    probability = F.col("probability")
    if len(classes) == 2:
        entries = F.array(F.struct(F.lit(classes[1]).alias("class"), F.round(probability[1], TIE_DIGITS).alias("score")))
    else:
        entries = F.array(
            *[
                F.struct(F.lit(c).alias("class"), F.round(probability[i], TIE_DIGITS).alias("score"))
                for i, c in enumerate(classes)
            ]
        )
    positive = F.col("label") == F.col("e.class")
    sums = (
        scored.select(*by, "label", F.explode(entries).alias("e"))
        .groupBy(*by, F.col("e.class").alias("class"), F.col("e.score").alias("score"))
        .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    )
    # cut points, totals and the running sums all read this table
    return materialise(sums)


def _cumulative(scores: DataFrame, by: Sequence[str], following: dict | None = None) -> DataFrame:
    """True and false positives at every threshold from the highest score down."""
    ranked = scores.withColumn("_down", -F.col("score"))
    sums = {"tp": F.col("pos"), "fp": F.col("neg")}
    return running_sums(ranked, [*by, "class"], "_down", sums, totals=True, following=following)


def roc_points(scores: DataFrame, by: Sequence[str] = (), drop_intermediate: bool = True) -> DataFrame:
    """False and true positive rates, from (0, 0); points on a straight run are left out.

    A rate is null where the class has no negatives or no positives.
    """
    rows = _cumulative(scores, by, {"_pos": "pos", "_neg": "neg"})
    if drop_intermediate:
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        last = F.col("_pos").isNull()
        bend = (F.col("_pos") != F.col("pos")) | (F.col("_neg") != F.col("neg"))
        rows = rows.where(first | last | bend)
    points = rows.select(
        *by,
        "class",
        F.col("score").alias("threshold"),
        F.try_divide("fp", "fp_total").alias("fpr"),
        F.try_divide("tp", "tp_total").alias("tpr"),
    )
    zero, nothing = F.lit(0.0), F.lit(None).cast("double")
    origin = scores.select(*by, "class").distinct()
    return points.unionByName(
        origin.select(*by, "class", nothing.alias("threshold"), zero.alias("fpr"), zero.alias("tpr"))
    )


def roc_auc(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve by trapezoids; null where a class has no positives or no negatives."""
    area = (F.col("neg") / F.col("fp_total")) * ((2 * F.col("tp") - F.col("pos")) / (2 * F.col("tp_total")))
    defined = (F.col("fp_total") > 0) & (F.col("tp_total") > 0)
    return (
        _cumulative(scores, by)
        .groupBy(*by, "class")
        .agg(F.sum(F.when(defined, area)).alias("roc_auc"))
    )


def model_auc(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean area over the classes (one class when there are two labels); null if any is undefined."""
    per_class = roc_auc(scores, by)
    mean = F.when(F.count("roc_auc") == F.count("*"), F.avg("roc_auc")).alias("roc_auc")
    return (per_class.groupBy(*by) if by else per_class).agg(mean)


def pr_points(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at every threshold, and the closing point (recall 0, precision 1)."""
    points = _cumulative(scores, by).select(
        *by,
        "class",
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.when(F.col("tp_total") > 0, F.col("tp") / F.col("tp_total")).otherwise(1.0).alias("recall"),
    )
    end = scores.select(*by, "class").distinct()
    return points.unionByName(
        end.select(
            *by, "class", F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
            F.lit(0.0).alias("recall"),
        )
    )


def average_precision(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision summed over the steps in recall."""
    step = F.when(F.col("tp_total") > 0, F.col("pos") / F.col("tp_total")).otherwise(0.0)
    return (
        _cumulative(scores, by)
        .groupBy(*by, "class")
        .agg(F.sum(step * (F.col("tp") / (F.col("tp") + F.col("fp")))).alias("average_precision"))
    )


# Comparison of models ----------------------------------------------------------------------------

# Column names of the comparison table.
COMPARISON_COLUMNS = {
    "model": "Model",
    "accuracy": "Accuracy",
    "precision": "Precision",
    "recall": "Recall",
    "f1_score": "F1 Score",
    "roc_auc": "ROC AUC",
    "training_time": "Training Time (s)",
    "prediction_time": "Prediction Time (s)",
}


def compare_models(scored: DataFrame, classes: list, timings: DataFrame | None = None) -> DataFrame:
    """One row per value of ``model``: label metrics, area under the curve and times.

    Rows without ``probability`` (or models that give none) get a null area.
    """
    out = summary(scored, ["model"])
    if "probability" in scored.columns:
        with_probability = scored.where(F.col("probability").isNotNull())
        out = out.join(model_auc(class_scores(with_probability, classes, ["model"]), ["model"]), "model", "left")
    else:
        out = out.withColumn("roc_auc", F.lit(None).cast("double"))
    if timings is not None:
        out = out.join(timings, "model", "left")
    else:
        nothing = F.lit(None).cast("double")
        out = out.withColumns({"training_time": nothing, "prediction_time": nothing})
    return out.select(*[F.col(a).alias(b) for a, b in COMPARISON_COLUMNS.items()])


def best_model(comparison: DataFrame) -> DataFrame:
    """The model with the highest weighted F1; the first by name among equals."""
    return comparison.orderBy(F.desc("F1 Score"), "Model").limit(1)


METRICS = ("Accuracy", "Precision", "Recall", "F1 Score", "ROC AUC")


def long_metrics(comparison: DataFrame) -> DataFrame:
    """One row per model and metric; the area is left out when no model has one."""
    has_area = comparison.agg((F.count("ROC AUC") > 0).alias("any")).scalar()
    rows = comparison.unpivot("Model", list(METRICS), "Metric", "Score")
    return rows.where((F.col("Metric") != "ROC AUC") | has_area)


def long_timings(comparison: DataFrame) -> DataFrame:
    """One row per model and time; a missing training time counts as 0."""
    train, predict = "Training Time (s)", "Prediction Time (s)"
    filled = comparison.select("Model", F.coalesce(train, F.lit(0.0)).alias(train), predict)
    return filled.unpivot("Model", [train, predict], "Metric", "Time (s)")


def metric_matrix(comparison: DataFrame) -> DataFrame:
    """Model by metric, the input of a radar chart."""
    return long_metrics(comparison).groupBy("Model").pivot("Metric", list(METRICS)).agg(F.first("Score"))


def top_importances(importances: DataFrame, n: int = 20, by: Sequence[str] = ("model", "class")) -> DataFrame:
    """The ``n`` terms of largest absolute importance per model and class."""
    order = W.partitionBy(*by).orderBy(F.desc(F.abs("importance")), "term")
    return importances.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def learning_curve_summary(curve: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean and population deviation over the folds per training size."""
    stats = [
        f(c).alias(f"{c}_{name}")
        for c in ("train_f1", "test_f1")
        for f, name in ((F.avg, "mean"), (F.stddev_pop, "std"))
    ]
    return curve.groupBy(*by, "train_size").agg(*stats)


def run_summary(docs: DataFrame, n_features: int, label: str = "label") -> DataFrame:
    """Training rows, test rows, features and training classes of a run, in one row."""
    train = F.col("split") == "train"
    return docs.agg(
        F.count_if(train).alias("train_size"),
        F.count_if(F.col("split") == "test").alias("test_size"),
        F.count_distinct(F.when(train, F.col(label))).alias("n_classes"),
    ).select("train_size", "test_size", F.lit(n_features).cast("bigint").alias("n_features"), "n_classes")
