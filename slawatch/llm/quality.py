"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Statistics of each whole text (lengths, shares of letters, capitals,
   digits and symbols, distinct words and lines) as built-in expressions, in
   one map-only pass, written to the shared folder.
2. A small random forest is fitted to labelled rows; every path from a root
   is a conjunction of thresholds, a rule.
3. A lasso logistic regression weighs the rules. Rows with the same rules
   true are one weighted row, so it sees a small table.
4. The rules that keep a weight are compiled into one Spark column
   expression, which scores every row without Python.

Training uses at most about ``MAX_TRAIN`` labelled rows, chosen by a hash of
the id (documented bound; scoring and statistics cover everything). Labels
never enter a score.

Defined cases: a null text counts as empty and is scored; null labels are
not used; without labels every score is 0.5, with one class only 0 or 1; a
null ``doc_id`` counts as the empty string for the split; repeated rows are
scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import WORD, by_shuffle

MAX_TRAIN = 50_000
TREES, DEPTH = 12, 4
LASSO = 0.001
THRESHOLD = 0.3


def _left(c: Column, pattern: str) -> Column:
    """Characters that stay when all matches are removed."""
    return F.length(F.regexp_replace(c, pattern, "")).cast("double")


def statistics(text: Column) -> dict[str, Column]:
    """Name -> statistic of a text; all are defined for empty texts."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.split(text, "\n")
    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")
    letters = _left(text, r"[^\p{L}]+")
    return {
        "words": F.size(words).cast("double"),
        "word_length": (n - _left(text, WORD)) / n_words,
        "letters": letters / n,
        "capitals": _left(text, r"[^\p{Lu}]+") / F.greatest(letters, F.lit(1.0)),
        "digits": _left(text, r"[^0-9]+") / n,
        "symbols": _left(text, r"[\p{L}\p{N}\s.,;:'\"()-]+") / n,
        "stops": _left(text, r"[^.,]+") / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines).cast("double"),
        "line_words": n_words / F.size(lines),
    }


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", *[c.alias(k) for k, c in statistics(text).items()])


@dataclass(frozen=True)
class Rules:
    """Conjunctions of (statistic, above, threshold) with weights."""

    intercept: float
    rules: tuple[tuple[tuple[tuple[str, bool, float], ...], float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def holds(rule: tuple[tuple[str, bool, float], ...]) -> Column:
    out = F.lit(True)
    for name, above, t in rule:
        out = out & (F.col(name) > t if above else F.col(name) <= t)
    return out


def tree_rules(forest, names: list[str]) -> list[tuple[tuple[str, bool, float], ...]]:
    """Every path from a root of a fitted forest, with the tightest bound of
    each statistic and direction; each rule once."""
    found: dict[tuple, None] = {}

    def walk(node, path: dict):
        if path:
            found.setdefault(tuple((n, a, t) for (n, a), t in sorted(path.items())))
        if node.subtreeDepth() == 0:
            return
        name, t = names[node.split().featureIndex()], node.split().threshold()
        walk(node.leftChild(), path | {(name, False): min(t, path.get((name, False), t))})
        walk(node.rightChild(), path | {(name, True): max(t, path.get((name, True), t))})

    for tree in forest.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(found)


def fit_rules(train: DataFrame, names: list[str], trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, seed: int = 42) -> Rules:
    """Fit to rows with the statistics ``names`` and a 0/1 ``label``."""
    classes = {int(r["label"]): r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(classes) < 2:
        return Rules({(): 0.0, (0,): -50.0, (1,): 50.0}[tuple(classes)], ())
    rows = train.select(F.col("label").cast("double").alias("label"), array_to_vector(F.array(*names)).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=5, subsamplingRate=0.7).fit(rows)
    rules = tree_rules(forest, names)
    if not rules:
        return Rules(0.0, ())
    true = F.array(*[holds(r).cast("double") for r in rules])
    patterns = cut_lineage(train.groupBy(true.alias("true"), F.col("label").cast("double").alias("label"))
                                .agg(F.count(F.lit(1)).cast("double").alias("n")).coalesce(1), "quality-patterns")
    weighted = patterns.select(array_to_vector("true").alias("features"), "label", "n")
    model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, weightCol="n", maxIter=60).fit(weighted)
    weights = model.coefficients.toArray().tolist()
    return Rules(float(model.intercept), tuple((r, w) for r, w in zip(rules, weights) if w))


def labelled(stats: DataFrame, labels: DataFrame, label: str, held_out: Column, max_train: int = MAX_TRAIN) -> DataFrame:
    """Training rows: labelled, not held out, at most about ``max_train``."""
    marks = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("label IN (0, 1)").distinct()
    rows = cut_lineage(stats.filter(~held_out).join(by_shuffle(marks), "doc_id"), "labelled")
    n = rows.count()
    if n <= max_train:
        return rows
    kept = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) < (1 << 20) * max_train // n
    return rows.filter(kept)


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality", threshold: float = THRESHOLD, **options) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the statistics, ``held_out``,
    ``score`` and ``predicted`` (1 if the score reaches ``threshold``)."""
    stats = cut_lineage(with_statistics(docs), "quality-statistics")
    rules = fit_rules(labelled(stats, labels, label, held_out), [c for c in stats.columns if c != "doc_id"], **options)
    scored = stats.withColumn("held_out", held_out).withColumn("score", rules.score())
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality", threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns kept."""
    cols = docs.columns
    text = F.coalesce(F.col("text"), F.lit(""))
    stats = cut_lineage(with_statistics(docs), "quality-statistics")
    names = [c for c in stats.columns if c != "doc_id"]
    rules = fit_rules(labelled(stats, labels, label, held_out), names, **options)
    # Scored beside the whole row; the documents may have columns of these
    # names. The statistics pass a generator, which keeps the optimizer from
    # writing each of them out again for every rule that names it.
    told = statistics(text)
    wide = docs.select(F.struct(*cols).alias("_row"), *[c.alias(f"_{k}") for k, c in told.items()])
    one = F.array(F.struct(*[F.col(f"_{k}").alias(k) for k in told]))
    return wide.select("_row", F.inline(one)).filter(rules.score() >= threshold).select("_row.*")
