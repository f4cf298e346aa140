"""Exact, distributed order statistics.

Spark's exact ``percentile`` aggregate merges every distinct value into one
buffer in one task; ``percentile_approx`` is bounded but approximate. The
summary report needs exact, interpolated quartiles (as pandas' ``describe``)
and model evaluation needs an exact ROC AUC; both reduce to a prefix sum
over sorted distinct values, computed here without a single-task step:

1. value histogram by a hash aggregate (map-side combine: a value repeated
   a billion times becomes one row before the shuffle);
2. range-partition the distinct values; running sum within each range
   partition, plus the sum of all earlier partitions (one row per
   partition, so that offset table is tiny and broadcast);
3. the requested ranks / sums are read off a handful of rows.

The range-partitioned histogram is written once to the shared checkpoint
folder (``cut_lineage``) so that both of its uses see the same partition
ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def prefix_sums(hist: DataFrame, value: str, counts: list[str],
                partitions: int | None = None) -> DataFrame:
    """For each distinct ``value`` row of ``hist``, add ``before_<c>``: the
    sum of ``c`` over all rows with a smaller value (exclusive prefix sum).

    Without ``partitions`` the range partition count is left to AQE, which
    coalesces adjacent ranges to its advisory size (merged ranges stay
    contiguous and in order, so partition ids remain a range order)."""
    by_range = (hist.repartitionByRange(partitions, value) if partitions
                else hist.repartitionByRange(value))
    ranged = cut_lineage(by_range.withColumn("_pid", F.spark_partition_id()), "ranged-histogram")
    within = Window.partitionBy("_pid").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in counts])
    # One row per range partition: a bounded table, safe to broadcast.
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}")
                                      for c in counts])
    inside = ranged.withColumns({f"_i_{c}": F.coalesce(F.sum(c).over(within), F.lit(0)) for c in counts})
    out = inside.join(F.broadcast(offsets), "_pid")
    return out.select(*hist.columns,
                      *[(F.col(f"_o_{c}") + F.col(f"_i_{c}")).alias(f"before_{c}") for c in counts])


def value_histogram(df: DataFrame, col: str) -> DataFrame:
    v = F.col(col).cast("double")
    return (df.select(v.alias("v"))
              .filter(F.col("v").isNotNull() & ~F.isnan("v"))
              .groupBy("v").agg(F.count(F.lit(1)).alias("c")))


def ranked_histogram(df: DataFrame, col: str, partitions: int | None = None) -> DataFrame:
    """(v, c, lo, hi): the 1-based ranks ``lo..hi`` held by value ``v``."""
    ranked = prefix_sums(value_histogram(df, col), "v", ["c"], partitions)
    lo = F.col("before_c") + 1
    return ranked.select("v", "c", lo.alias("lo"), (lo + F.col("c") - 1).alias("hi"))


def exact_quantiles(df: DataFrame, col: str, probs: list[float],
                    names: list[str] | None = None) -> DataFrame:
    """One row: the interpolated quantile (pandas / ``quantile_cont``
    definition) of ``col`` for each probability in ``probs``."""
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    ranked = ranked_histogram(df, col)
    # The row count as a column of the few histogram rows: one subquery.
    ranked = ranked.withColumn("_n", ranked.agg(F.sum("c")).scalar())
    aggs: list[Column] = []
    for p, name in zip(probs, names):
        at = (F.col("_n") - 1) * F.lit(p)

        def value(rank):
            return F.max(F.when((F.col("lo") <= rank) & (rank <= F.col("hi")), F.col("v")))

        lo, hi = value(F.floor(at) + 1), value(F.ceil(at) + 1)
        part = F.max(at - F.floor(at))
        aggs.append((lo + part * (hi - lo)).alias(name))
    return ranked.agg(*aggs)


def roc_auc(df: DataFrame, label: str, score: str) -> Column:
    """Exact ROC AUC (ties count one half) as a scalar column.

    AUC = sum over distinct scores s of pos(s) * (neg(< s) + neg(= s) / 2),
    divided by P * N; rows with a null label or score are left out.
    """
    hist = (df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
              .groupBy(F.col(score).cast("double").alias("s"))
              .agg(F.count_if(F.col(label).cast("boolean")).alias("pos"),
                   F.count_if(~F.col(label).cast("boolean")).alias("neg")))
    ranked = prefix_sums(hist, "s", ["neg"])
    num = F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2.0))
    den = F.sum("pos") * F.sum("neg")
    return ranked.agg(F.when(den > 0, num / den)).scalar()
