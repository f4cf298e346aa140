"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is as long as the corpus. Each source has a weight; its target is
its share of all words, stopped at ``max_epochs`` times its own size, the
excess shared again by weight (water filling, one pass over the sources).

Blocks of ``block`` words are seats. Sources get seats by the highest
quotients ``target / (2 k - 1)``; each source is split into shards of about
``shard_words`` words by a seeded hash of the document (its id and text), so
a source with a third of all rows, or an id, is many shards, and its seats go to the shards by the same
rule with the shard's words as weight. Within a shard the documents lie on a
ring in seeded order, and the shard's quota of blocks is laid on the ring
from a seeded block on: whole turns repeat every document, the rest is an
arc. So every block has exactly ``block`` words, a shard gives exactly its
quota, and no document is taken more than ``max_epochs`` times.

Sources are aggregated with map-side combine; the seat tables have one row
per source or per shard; only windows within one shard sort documents.

Defined cases: a null text has no words; null sources are one source, last
in order; documents without words take nothing; repeated rows are separate
rows (equal in all columns they are interchangeable, and lie in one shard;
equal in id and text only, a hash of the carried columns orders them); an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import WORD, bucket, seeded, whole

WEIGHTS = (5, 2, 1)
SHARD_WORDS = 1 << 20
#: The mix has about this many blocks; a block has one word at least.
BLOCKS = 1 << 20


def count_words(text: str = "text") -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def sainte_lague(df: DataFrame, weight: str, seats: str, group: list[str], key: list[str]) -> DataFrame:
    """Add ``quota``: the seats of each row within its group.

    The seats that every divisor near the group's mean certainly gives are
    counted in closed form; only the last ones (at most two per row and the
    group's rounding) are ranked by quotient. Ties go to the smaller key.
    """
    g = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    w, q = F.col(weight).cast("double"), F.col(seats)
    mean = w / F.sum(w).over(g)
    n = F.count(F.lit(1)).over(g) / 2.0
    sure = F.greatest(F.lit(0), F.floor(mean * (q - n) + 0.5)).cast("long")
    most = F.greatest(F.lit(0), F.floor(mean * (q + n) + 0.5) + 1).cast("long")
    rows = (df.withColumns({"_sure": F.coalesce(sure, F.lit(0).cast("long")), "_most": F.coalesce(most, F.lit(0).cast("long"))})
              .withColumn("_left", q - F.sum("_sure").over(g)))
    last = rows.filter("_most > _sure").withColumn("_k", F.explode(F.sequence(F.col("_sure") + 1, F.col("_most"))))
    by_quotient = g.orderBy((F.col(weight) / (2 * F.col("_k") - 1)).desc(), *key)
    won = (last.withColumn("_rank", F.row_number().over(by_quotient)).filter("_rank <= _left")
               .groupBy(*group, *key).agg(F.count(F.lit(1)).alias("_won")))
    return (rows.join(won, [*group, *key], "left")
                .withColumn("quota", F.col("_sure") + F.coalesce("_won", F.lit(0)))
                .drop("_sure", "_most", "_left", "_won"))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """One row per source: ``rank`` (by code point, null last), ``weight``,
    ``source_size``, ``total`` and ``target``."""
    every = Window.partitionBy(F.lit(0))
    by_name = every.orderBy(F.col("source").asc_nulls_last())
    turn = F.lit([int(w) for w in weights])
    rows = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
                 .withColumn("rank", F.row_number().over(by_name) - 1)
                 .withColumn("weight", F.element_at(turn, (F.col("rank") % len(weights) + 1).cast("int")))
                 .withColumn("total", F.sum("source_size").over(every))
                 .withColumn("_cap", F.col("source_size") * max_epochs))
    # Sources in the order in which they reach their cap as the level rises.
    rising = every.orderBy((F.col("_cap") / F.col("weight")).asc(), "rank")
    full = F.coalesce(F.sum("_cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumns({"_free": F.col("total") - full, "_rest": rest, "_turn": F.row_number().over(rising)})
    holds = F.col("_free") * F.col("weight").cast("double") <= F.col("_cap") * F.col("_rest").cast("double")
    level = F.min(F.when(holds, F.struct("_turn", "_free", "_rest"))).over(every)
    rows = rows.withColumn("_level", level)
    share = F.col("_level._free") * F.col("weight").cast("double") / F.col("_level._rest")
    target = F.when(F.col("_turn") < F.col("_level._turn"), F.col("_cap").cast("double")).otherwise(share)
    return rows.select("source", "rank", "weight", "source_size", "total", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, seed: int = 42,
        shard_words: int = SHARD_WORDS, blocks: int = BLOCKS, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``, ``source``) with
    ``size``, ``source_size``, ``target``, ``taken`` and where the words come
    from: ``copies`` whole copies, then words ``[head_from, head_to)`` and
    ``[tail_from, tail_to)`` of the document. ``keep`` names columns to carry.
    """
    digest = seeded(seed, F.col("doc_id"), F.md5(whole().cast("binary")))
    columns = ["doc_id", "source", count_words().alias("size"), digest.alias("_digest")]
    sized = cut_lineage(docs.select(*columns), "mix-sizes")
    # Carried columns may be wide: they are read again instead of staged.
    rows = docs.select(*columns, *keep) if keep else sized
    block = F.greatest(F.lit(1), F.floor(F.col("total") / blocks)).cast("long")
    sources = source_targets(sized, weights, max_epochs).withColumn("block", block)
    sources = sources.withColumn("seats", F.floor(F.col("total") / F.col("block")).cast("long"))
    sources = sainte_lague(sources, "target", "seats", [], ["rank"])
    fits = F.least("quota", F.floor(F.col("source_size") * max_epochs / F.col("block")).cast("long"))
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(shard_words))).cast("long")
    sources = cut_lineage(sources.select("source", "rank", "source_size", "target", "block", fits.alias("seats"), shards.alias("shards")), "mix-sources")

    def placed(df: DataFrame) -> DataFrame:
        return (df.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
                  .withColumn("shard", bucket(F.col("_digest"), F.col("shards"))))

    quotas = placed(sized).groupBy("rank", "shard", "seats", "block").agg(F.sum("size").alias("shard_size"))
    quotas = sainte_lague(quotas, "shard_size", "seats", ["rank"], ["shard"])
    words = F.least("quota", F.floor(F.col("shard_size") * max_epochs / F.col("block")).cast("long")) * F.col("block")
    first = bucket(seeded(seed, F.col("rank"), F.col("shard")), F.greatest(F.lit(1), F.floor(F.col("shard_size") / F.col("block")).cast("long")))
    size = F.greatest(F.col("shard_size"), F.lit(1))
    quotas = quotas.select("rank", "shard", size.alias("_ring"), words.alias("_words"), (first * F.col("block")).alias("_first"))

    ties = [F.xxhash64(*keep)] if keep else []
    ring = Window.partitionBy("rank", "shard").orderBy("_digest", *ties).rowsBetween(Window.unboundedPreceding, -1)
    laid = placed(rows).withColumn("_a", F.coalesce(F.sum("size").over(ring), F.lit(0).cast("long"))).join(quotas, ["rank", "shard"])
    laid = laid.withColumns({"_end": F.col("_first") + F.col("_words") % F.col("_ring"),
                             "copies": F.floor(F.col("_words") / F.col("_ring")).cast("long")})

    def within(x: Column) -> Column:
        return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), x - F.col("_a")))

    laid = laid.withColumns({"head_from": within(F.col("_first")), "head_to": within(F.col("_end")),
                             "tail_from": F.lit(0).cast("long"), "tail_to": within(F.col("_end") - F.col("_ring"))})
    taken = F.col("copies") * F.col("size") + F.col("head_to") - F.col("head_from") + F.col("tail_to")
    return laid.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "copies",
                       "head_from", "head_to", "tail_from", "tail_to", *keep)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, each document as often as it
    is taken; a part of a document keeps the white space between its words,
    and its ``n_chars`` (if there is such a column) is its own."""
    cols = docs.columns
    # Carried under names of their own, so no column of ``docs`` clashes.
    names = {c: f"_in{i}" for i, c in enumerate(cols)}
    row = docs.select("doc_id", "text", "source", *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    parts = mix(row, keep=tuple(names.values()), **options)
    text = names["text"]
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))

    def piece(a: str, b: str) -> Column:
        cut = F.array_join(F.slice(words, (F.col(a) + 1).cast("int"), (F.col(b) - F.col(a)).cast("int")), "")
        return F.when(F.col(b) > F.col(a), F.regexp_replace(cut, r"^[\x20\x09-\x0D]+", ""))

    pieces = F.array_compact(F.array(piece("head_from", "head_to"), piece("tail_from", "tail_to")))
    whole_copies = F.array_repeat(F.col(text), F.col("copies").cast("int"))
    texts = parts.withColumn("_text", F.explode(F.concat(F.when(F.col("size") > 0, whole_copies).otherwise(F.array().cast("array<string>")), pieces)))
    out = [F.col("_text").alias(c) if c == "text" else F.length("_text").cast("long").alias(c) if c == "n_chars" else F.col(n).alias(c) for c, n in names.items()]
    return texts.select(*out)
