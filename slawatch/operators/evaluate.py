"""Metrics of a binary classifier from a table of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stats import roc_auc


def classification_metrics(preds: DataFrame, label: str = "sla_breached",
                           prediction: str = "predicted_label", prob: str = "risk_score") -> DataFrame:
    """One row: rows scored, accuracy, precision, recall, F1 and exact ROC
    AUC, all as aggregates (no collect). Rows without a label or prediction
    are left out."""
    y = F.col(label).cast("boolean")
    p = F.col(prediction).cast("boolean")
    df = preds.filter(y.isNotNull() & p.isNotNull())
    tp, fp, fn = F.count_if(y & p), F.count_if(~y & p), F.count_if(y & ~p)
    base = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.when(y == p, F.lit(1)).otherwise(F.lit(0))).alias("accuracy"),
        F.when(tp + fp > 0, tp / (tp + fp)).alias("precision"),
        F.when(tp + fn > 0, tp / (tp + fn)).alias("recall"),
        F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).alias("f1"),
    )
    return base.withColumn("auc", roc_auc(df, label, prob))
