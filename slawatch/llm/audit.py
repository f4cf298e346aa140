"""How text filters interact: every order of the filters, in one fold.

Each document's failures are a bit mask. Documents are first counted by
(part, mask, good, toxic): a few cells per part, whatever the input. Every
cell then folds across the array of all filter orders with ``transform`` and
``aggregate``: along an order the fold carries the filters applied so far and
tells at each step what the cell's documents do there, as a struct weighted
by their number. That makes an array of (orders x steps) structs per cell,
600 for five filters; the arrays of a part are added element by element. So
no order is run over the documents, and everything is an SQL expression.

One filter looks at other rows: a document fails it if a smaller ``doc_id``
anywhere in the table has the same text. Documents of one text have one mask
otherwise, so it needs only the number of rows at the smallest id of each
text, found by aggregates over (text digest, part, good, toxic); a text held
by a third of all rows is reduced inside the map tasks.

Defined cases: a null text is empty (and equal to other empty ones); a null
part is the empty string; a row without ``doc_id`` fails no copy filter, nor
does it make others fail, and has no labels; rows equal in id and text are
not copies of each other; of repeated labels of an id a 1 counts; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import whole

#: Measures of a step, in the order of the result.
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Join keys over which rows without an id are spread.
NULL_SALTS = 1024


def word_filters(text: Column) -> dict[str, Column]:
    """The filters on a text alone: the condition to fail each."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, kinds = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {"A": n < 100, "B": 100 * kinds < 80 * n, "C": 100 * capitals > 10 * F.length(text), "D": text.rlike("[#$%&*|]")}


def labelled(rows: DataFrame, labels: DataFrame, good: str, toxic: str) -> DataFrame:
    """``rows`` with ``good`` and ``toxic`` (false without a label). Rows
    without an id match nothing and are spread over many tasks."""
    told = labels.select("doc_id", (F.col(good) == 1).alias("_good"), (F.col(toxic) == 1).alias("_toxic")).filter("doc_id IS NOT NULL")
    told = told.groupBy("doc_id").agg(F.max("_good").alias("_good"), F.max("_toxic").alias("_toxic"))
    told = told.select(F.col("doc_id").cast("string").alias("_key"), F.lit(False).alias("_none"), "_good", "_toxic")
    salt = F.pmod(F.xxhash64("digest", "part"), F.lit(NULL_SALTS)).cast("string")
    keyed = rows.withColumns({"_key": F.coalesce(F.col("doc_id").cast("string"), salt), "_none": F.col("doc_id").isNull()})
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    return keyed.join(told, ["_key", "_none"], "left").select(*rows.columns, yes("_good").alias("good"), yes("_toxic").alias("toxic"))


def cells(rows: DataFrame, copy_bit: int) -> DataFrame:
    """(``part``, ``mask``, ``good``, ``toxic``, ``n``) of rows (``doc_id``,
    ``digest``, ``part``, ``mask``, ``good``, ``toxic``); rows with a smaller
    id of the same digest get ``copy_bit`` as well."""
    kind = ["part", "mask", "good", "toxic"]
    each = rows.groupBy("doc_id", "digest", *kind).agg(F.count(F.lit(1)).alias("n"))
    texts = each.groupBy("digest", *kind).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_none"))
    # A text has one row here per part and label: a small window.
    first = F.min("first").over(Window.partitionBy("digest"))
    own = F.col("n_none") + F.when(F.col("first") == first, F.col("n_first")).otherwise(0)
    split = texts.withColumn("own", own).groupBy(*kind).agg(F.sum("own").alias("own"), F.sum(F.col("n") - F.col("own")).alias("copies"))
    two = F.array(F.struct(F.col("mask"), F.col("own").alias("n")), F.struct(F.col("mask").bitwiseOR(copy_bit).alias("mask"), F.col("copies").alias("n")))
    return split.select("part", "good", "toxic", F.inline(two)).filter("n > 0")


def fold_orders(counted: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of ``letters`` and step, from cells whose mask
    has bit i set if letter i's filter fails."""
    orders = F.lit(["".join(p) for p in permutations(letters)])
    steps = F.sequence(F.lit(1), F.lit(len(letters)))
    n, mask = F.col("n"), F.col("mask")
    zero = F.lit(0).cast("long")

    def weighted(condition: Column) -> Column:
        return F.when(condition, n).otherwise(zero)

    def walk(order: Column) -> Column:
        def step(state: Column, at: Column) -> Column:
            letter = F.substr(order, at, F.lit(1))
            bit = F.call_function("shiftleft", F.lit(1), F.call_function("locate", letter, F.lit(letters)) - 1)
            alive, fails = mask.bitwiseAND(state["seen"]) == 0, mask.bitwiseAND(bit) != 0
            told = F.struct(
                order.alias("filter_order"), at.alias("step"),
                weighted(alive & ~fails).alias("kept"), weighted(alive & fails).alias("removed"), weighted(~alive & fails).alias("redundant"),
                weighted(mask == bit).alias("unique_fails"),
                weighted(alive & fails & F.col("good")).alias("good_lost"), weighted(alive & fails & F.col("toxic")).alias("toxic_lost"))
            return F.struct(state["seen"].bitwiseOR(bit).alias("seen"), F.concat(state["told"], F.array(told)).alias("told"))

        kind = "array<struct<filter_order:string,step:int," + ",".join(f"{m}:bigint" for m in MEASURES) + ">>"
        start = F.struct(F.lit(0).alias("seen"), F.array().cast(kind).alias("told"))
        return F.aggregate(steps, start, step, lambda state: state["told"])

    folded = counted.select("part", F.flatten(F.transform(orders, walk)).alias("told"))

    def added(a: Column, b: Column) -> Column:
        return F.struct(a["filter_order"].alias("filter_order"), a["step"].alias("step"), *[(a[m] + b[m]).alias(m) for m in MEASURES])

    # At most 4 * 2^filters arrays per part.
    parts = folded.groupBy("part").agg(F.collect_list("told").alias("all"))
    merged = parts.select("part", F.aggregate(
        F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(0))), F.element_at("all", 1),
        lambda total, more: F.zip_with(total, more, added)).alias("told"))

    def applied(t: Column) -> Column:
        return F.substr(t["filter_order"], t["step"], F.lit(1))

    removed_by = F.transform(F.lit(list(letters)), lambda letter: F.aggregate(
        F.filter("told", lambda t: applied(t) == letter), zero, lambda s, t: s + t["removed"]))
    rows = merged.withColumn("by_letter", removed_by).select("part", "by_letter", F.inline("told"))
    letter = F.substr(F.col("filter_order"), F.col("step"), F.lit(1))
    at = F.call_function("locate", letter, F.lit(letters))
    return rows.select("part", "filter_order", "step", *MEASURES, F.element_at("by_letter", at).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column] | None = None, copies: str = "E",
          part: str = "lang", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """Per part, order of the filters and step: ``kept``, ``removed``,
    ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost`` and
    ``shapley``. ``filters``: letter -> failure condition over the column
    ``text`` (default: ``word_filters``); ``copies``: the letter of the copy
    filter."""
    text = F.col("text")
    filters = dict(filters or word_filters(text))
    letters = "".join(filters) + copies
    bits = [F.when(fails, F.lit(1 << i)).otherwise(0) for i, fails in enumerate(filters.values())]
    mask = sum(bits[1:], bits[0])
    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), whole().alias("text"))
    rows = rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))
    return fold_orders(cells(labelled(rows, labels, good, toxic), 1 << len(filters)), letters)
