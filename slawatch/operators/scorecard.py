"""A fitted model as rows of weights, and the rows as a column expression.

A model that is a sum of weights per feature value needs no model object to
score: its weights are a small table (``feature``, ``value``, ``weight``)
that can be stored, joined, read by any engine, and compiled into one Spark
expression that runs inside whole-stage code generation.

``fit_scorecard`` fits such a model in closed form, by aggregates alone: the
log odds of a breach per feature value, smoothed towards the overall odds
(naive Bayes). ``logistic_weights`` writes a fitted MLlib logistic
regression over the same encoded features as rows. ``score_column`` compiles
either.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .risk_model import BLANK, CATEGORICAL, LABEL, feature_columns

#: Feature name of the constant term, and value of unseen or missing values.
INTERCEPT, OTHER = "(intercept)", "(other)"
SMOOTHING = 1.0
#: Compiled into an expression up to so many rows (values of the categories).
MAX_WEIGHTS = 100_000


def category(name: str) -> Column:
    """A model input as text; missing and blank ones are ``OTHER``."""
    c = feature_columns()[name].cast("string")
    return F.when(c.isNull() | (c == ""), F.lit(OTHER)).otherwise(c)


def encoded(name: str) -> Column:
    """A model input as the MLlib indexer sees it; null for missing ones."""
    c = feature_columns()[name].cast("string")
    return F.when(c == "", F.lit(BLANK)).otherwise(c)


def fit_scorecard(df: DataFrame, label: str = LABEL, features: list[str] | None = None, smoothing: float = SMOOTHING) -> DataFrame:
    """(``feature``, ``value``, ``weight``) from labelled rows: per value the
    log odds of the label among its rows, each class smoothed by
    ``smoothing`` rows at the overall rate, less the overall log odds; the
    intercept is the overall log odds. Values that no labelled row has weigh
    nothing. One aggregate over (feature, value) rows, combined map-side."""
    features = features or CATEGORICAL
    rows = df.filter(F.col(label).isNotNull()).select(
        F.col(label).cast("boolean").alias("y"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), category(f).alias("value")) for f in [*features]],
                          F.struct(F.lit(INTERCEPT).alias("feature"), F.lit("").alias("value")))).alias("f"))
    counted = rows.groupBy("f.feature", "f.value").agg(F.count_if("y").alias("pos"), F.count_if(~F.col("y")).alias("neg"))
    total = counted.filter(F.col("feature") == INTERCEPT).select(
        F.struct((F.col("pos") + 0.5).alias("pos"), (F.col("neg") + 0.5).alias("neg"))).scalar()
    counted = counted.withColumn("_t", total)
    p, n = F.col("_t.pos"), F.col("_t.neg")
    share = p / (p + n)
    odds = F.log(p / n)
    own = F.log((F.col("pos") + smoothing * share) / (F.col("neg") + smoothing * (1.0 - share)))
    return counted.select("feature", "value", F.when(F.col("feature") == INTERCEPT, odds).otherwise(own - odds).alias("weight"))


def logistic_weights(model: PipelineModel) -> list[tuple[str, str, float]]:
    """The weights of a fitted pipeline (indexer, one-hot encoder, assembler,
    logistic regression) over ``CATEGORICAL``, as rows. Values that the
    indexer has not seen have their own weight (``OTHER``)."""
    indexer = next(s for s in model.stages if hasattr(s, "labelsArray"))
    encoder = next(s for s in model.stages if hasattr(s, "categorySizes"))
    regression = model.stages[-1]
    weights, at = regression.coefficients.toArray().tolist(), 0
    rows = [(INTERCEPT, "", float(regression.intercept))]
    for name, labels, size in zip(CATEGORICAL, indexer.labelsArray, encoder.categorySizes):
        # One column per label and one for unseen values; the encoder may
        # keep a further one that no value reaches.
        width = size - (1 if encoder.getDropLast() else 0) + (1 if encoder.getHandleInvalid() == "keep" else 0)
        columns = weights[at:at + width]
        rows += [(name, value, w) for value, w in zip(labels, columns)]
        if len(columns) > len(labels):
            rows.append((name, OTHER, columns[len(labels)]))
        at += width
    return rows


def score_column(weights: list[tuple[str, str, float]], value=category) -> Column:
    """The probability as one expression: the logistic function of the sum
    of the weights of a row's values (``OTHER``, or nothing, for a value that
    has none)."""
    if len(weights) > MAX_WEIGHTS:
        raise ValueError(f"{len(weights)} weights: join the table instead of compiling it")
    total = F.lit(sum((w for f, _, w in weights if f == INTERCEPT), 0.0))
    for name in sorted({f for f, _, _ in weights if f != INTERCEPT}):
        own = {v: w for f, v, w in weights if f == name}
        pairs = [F.lit(x) for v, w in sorted(own.items()) for x in (v, float(w))]
        total = total + F.coalesce(F.element_at(F.create_map(*pairs), value(name)), F.lit(own.get(OTHER, 0.0)))
    return 1.0 / (1.0 + F.exp(-total))


def score_with_weights(issues: DataFrame, weights: DataFrame | list[tuple[str, str, float]], threshold: float = 0.5,
                       value=category) -> DataFrame:
    """``issues`` with ``predicted_label`` and ``risk_score`` from a table of
    weights (it reaches the driver: one row per feature value). ``value``:
    how an input is spelt in the table, ``category`` for a scorecard and
    ``encoded`` for a logistic regression."""
    if isinstance(weights, DataFrame):
        weights = [tuple(r) for r in weights.select("feature", "value", "weight").limit(MAX_WEIGHTS + 1).collect()]
    p = score_column(weights, value)
    keep = [c for c in issues.columns if c not in ("predicted_label", "risk_score")]
    return issues.filter(F.col("issue_id").isNotNull()).select(
        *keep, (p >= threshold).alias("predicted_label"), F.struct(F.lit(True).alias("label"), p.alias("prob")).alias("risk_score"))


