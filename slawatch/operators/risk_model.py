"""Breach-risk classifiers: features, training, evaluation, scoring.

Features are the scoring query's inputs and the text features of the enriched
rows (no resolution time, status or close date: they leak the label). Training and scoring are MLlib
pipelines: distributed fits, map-only ``transform``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, OneHotEncoder, RegexTokenizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import dow_sunday1
from ..functions.text import text_len, word_count
from ..schemas import SEED
from ..session import cut_lineage
from .evaluate import classification_metrics
from .sparse_fit import BoostedTrees, NeuralNet

CATEGORICAL = ["region", "channel", "raw_category", "topic_id", "hour", "dow"]
COUNTS = ["text_len", "word_count"]
TEXT_FEATURES, KEYWORD_FEATURES = 1024, 256
LABEL = "sla_breached"
#: The columns that ``feature_columns`` reads.
SOURCES = ["issue_text", "region", "channel", "raw_category", "topic_id", "created_at", "issue_keyword"]
TRAIN_SHARE = 0.8
#: Classifiers that MLlib trains on dense copies of their rows, and the bytes
#: that the rows of one task take as such a copy, at most.
DENSE = ("boosted_trees", "neural_net")
DENSE_TASK_BYTES = 256 << 20


def feature_columns(keyword: bool = True) -> dict:
    """The model inputs: text, region, channel, category, topic, hour and day
    of week (Sunday = 1) of creation, the text's keyword (if the rows have
    the column), its length and its number of words."""
    return {
        "issue_text": F.col("issue_text"), "region": F.col("region"), "channel": F.col("channel"),
        "raw_category": F.col("raw_category"), "topic_id": F.col("topic_id").cast("int"),
        "hour": F.hour("created_at").cast("int"), "dow": dow_sunday1("created_at"),
        "issue_keyword": F.col("issue_keyword") if keyword else F.lit(None).cast("string"),
        "text_len": text_len("issue_text"), "word_count": word_count("issue_text"),
    }


def scoring_features(df: DataFrame) -> DataFrame:
    """The id and the model inputs."""
    return df.select("issue_id", *[c.alias(k) for k, c in feature_columns("issue_keyword" in df.columns).items()])


#: The indexer's name for a blank category (it takes no empty names).
BLANK = "(blank)"


def _with_inputs(df: DataFrame) -> DataFrame:
    """All original columns plus the model inputs under ``_f_`` names
    (categoricals as text for the indexer)."""
    cols = feature_columns("issue_keyword" in df.columns)
    text = F.coalesce(cols.pop("issue_text"), F.lit("")).alias("_f_issue_text")
    # The keyword as a list of at most one word, the counts on a log scale.
    word = F.array_compact(F.array(cols.pop("issue_keyword"))).alias("_f_keyword")
    counts = [F.log1p(F.coalesce(cols.pop(c), F.lit(0)).cast("double")).alias(f"_f_{c}") for c in COUNTS]

    def named(c):
        c = c.cast("string")
        return F.when(c == "", F.lit(BLANK)).otherwise(c)

    return df.select("*", text, word, *counts, *[named(c).alias(f"_f_{k}") for k, c in cols.items()])


def feature_stages(text: bool = True) -> list:
    """Encoders of the inputs; without ``text``, of the categories only."""
    idx = StringIndexer(inputCols=[f"_f_{c}" for c in CATEGORICAL],
                        outputCols=[f"_i_{c}" for c in CATEGORICAL], handleInvalid="keep")
    ohe = OneHotEncoder(inputCols=[f"_i_{c}" for c in CATEGORICAL],
                        outputCols=[f"_o_{c}" for c in CATEGORICAL], handleInvalid="keep")
    if not text:
        return [idx, ohe, VectorAssembler(inputCols=[f"_o_{c}" for c in CATEGORICAL], outputCol="_features", handleInvalid="keep")]
    tok = RegexTokenizer(inputCol="_f_issue_text", outputCol="_f_tokens", pattern=r"(?U)\b\w\w+\b",
                         gaps=False)
    tf = HashingTF(inputCol="_f_tokens", outputCol="_f_tf", numFeatures=TEXT_FEATURES)
    key = HashingTF(inputCol="_f_keyword", outputCol="_f_key", numFeatures=KEYWORD_FEATURES)
    asm = VectorAssembler(inputCols=[f"_o_{c}" for c in CATEGORICAL] + ["_f_tf", "_f_key"] + [f"_f_{c}" for c in COUNTS],
                          outputCol="_features", handleInvalid="keep")
    return [idx, ohe, tok, tf, key, asm]


def _label(df: DataFrame) -> DataFrame:
    return df.withColumn("_label", F.col(LABEL).cast("double"))


def _labelled(df: DataFrame) -> DataFrame:
    """The labelled rows, id, label and what the inputs are made of, written
    once: encoders, fits and the holdout's scores all read them."""
    cols = [c for c in ("issue_id", *SOURCES, LABEL) if c in df.columns]
    return cut_lineage(df.filter(F.col(LABEL).isNotNull()).select(cols), "labelled")


def split(df: DataFrame, seed: int = SEED, share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """Train / holdout by a seeded hash of the id: the same split under any
    partitioning or rerun, no shuffle."""
    bucket = F.pmod(F.xxhash64("issue_id", F.lit(seed)), F.lit(1000))
    cut = int(share * 1000)
    return df.filter(bucket < cut), df.filter(bucket >= cut)


def _dealt(rows: DataFrame, width: int) -> DataFrame:
    """The rows dealt over as many tasks as their dense copies need. A row is
    a few hundred bytes when stored and ``8 * width`` as a dense copy, so
    tasks cut by stored bytes would hold copies as large as an executor, in
    too few tasks for the cluster."""
    tasks = -(-rows.count() * 8 * width // DENSE_TASK_BYTES)
    return rows.repartition(max(tasks, rows.sparkSession.sparkContext.defaultParallelism))


def _classifiers(width: int, seed: int) -> dict:
    models = {
        "logistic_regression": LogisticRegression(maxIter=50, regParam=0.01),
        "boosted_trees": BoostedTrees(maxIter=20, maxDepth=5, seed=seed),
        "neural_net": NeuralNet(layers=[width, 16, 2], maxIter=100, seed=seed),
    }
    for m in models.values():
        m.setFeaturesCol("_features").setLabelCol("_label").setPredictionCol("_prediction")
        m.setProbabilityCol("_probability").setRawPredictionCol("_raw")
    return models


@dataclass
class TrainedModels:
    models: dict[str, PipelineModel] = field(default_factory=dict)
    metrics: DataFrame | None = None
    best: str | None = None


def train_models(df: DataFrame, seed: int = SEED, names: list[str] | None = None,
                 holdout: DataFrame | None = None, text: bool = True) -> TrainedModels:
    """Fit logistic regression, boosted trees and a small neural net on the
    labelled rows; evaluate each on the holdout (hash split unless given).
    ``text=False`` leaves the issue text out of the features."""
    src = _labelled(df)
    if holdout is None:
        train_raw, test = split(src, seed)
    else:
        train_raw, test = src, _labelled(holdout)
    train = _label(_with_inputs(train_raw))
    feats = Pipeline(stages=feature_stages(text)).fit(train)
    width = _feature_width(feats, train)
    out = TrainedModels()
    rows = None
    if any(n in DENSE for n in names or DENSE):
        train = _label(_with_inputs(_dealt(train_raw, width)))
    # Featurised once, kept (memory and disk) for the iterative fits.
    train_feats = feats.transform(train).select("_features", "_label").persist(StorageLevel.MEMORY_AND_DISK)
    for name, clf in _classifiers(width, seed).items():
        if names and name not in names:
            continue
        model = _stored(PipelineModel(stages=feats.stages + [clf.fit(train_feats)]),
                        name, df.sparkSession)
        out.models[name] = model
        # Scored once: the metrics and the ranks read the three columns.
        scored = cut_lineage(score_issues(model, test).select(LABEL, "predicted_label", F.col("risk_score.prob").alias("_p")), f"scored-{name}")
        m = classification_metrics(scored, LABEL, "predicted_label", "_p").withColumn("model", F.lit(name))
        rows = m if rows is None else rows.unionByName(m)
    train_feats.unpersist()
    out.metrics = rows
    return out


def _stored(model: PipelineModel, name: str, spark: SparkSession) -> PipelineModel:
    """Save the fitted pipeline under the shared checkpoint folder and load
    it back: the model is then what a later daily run would load, and it
    carries no training summary (a summary holds the session, which
    scoring closures must not capture)."""
    from ..session import scratch_path

    path = scratch_path(spark, f"model-{name}")
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def evaluate_models(trained: TrainedModels, by: str = "auc") -> TrainedModels:
    """Pick the best model by a metric (a few rows reach the driver)."""
    best = trained.metrics.orderBy(F.desc_nulls_last(by), "model").select("model").first()
    trained.best = best["model"] if best else None
    return trained


def _feature_width(feats: PipelineModel, sample: DataFrame) -> int:
    attrs = feats.transform(sample.limit(0)).schema["_features"].metadata.get("ml_attr", {})
    if "num_attrs" in attrs:
        return int(attrs["num_attrs"])
    row = feats.transform(sample).select("_features").first()
    return int(row[0].size)


def score_issues(model: PipelineModel, issues: DataFrame) -> DataFrame:
    """Score rows: ``predicted_label`` and ``risk_score`` = struct of the
    positive label and its probability. Input columns are kept (no
    self-join); rows without an id are not scored."""
    base = _with_inputs(issues.filter(F.col("issue_id").isNotNull()))
    scored = model.transform(base)
    p1 = vector_to_array("_probability").getItem(1)
    out = scored.withColumns({
        "predicted_label": F.col("_prediction") == F.lit(1.0),
        "risk_score": F.struct(F.lit(True).alias("label"), p1.alias("prob")),
    })
    keep = [c for c in issues.columns if c not in ("predicted_label", "risk_score")]
    return out.select(*keep, "predicted_label", "risk_score")
