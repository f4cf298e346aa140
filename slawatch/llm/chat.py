"""Chat formatting over reply trees.

Messages form trees (``msg_id``, ``parent_id`` within ``conv_id``). Every
root-to-leaf path is a candidate conversation; paths are ranked by the mean
``score`` of their messages and the best ``top`` of each conversation are
written as one formatted text each.

Paths come from iterative self-joins with doubling: ``jump[k]`` maps a
message to its ancestor 2^k steps up (``jump[k+1] = jump[k]`` joined to
itself), so a tree of depth d takes log2(d) rounds, and each leaf's path is
expanded with the same tables, so that the rows never exceed the paths'
total length. Only ids take part; texts are joined once, to the chosen
paths. Every join is on a message's key, which spreads a huge conversation
over all tasks; only the turns of one formatted text meet in one task.

Template: ``<s>`` at the start, then per turn ``[ROLE]`` role ``[/ROLE]``
text ``</s>``. Inside roles and texts the escape character and the first
character of every control string are replaced (``\\`` -> ``\\\\``,
``<`` -> ``\\l``, ``[`` -> ``\\b``), so no control string can occur there and the
original comes back exactly. The loss mask is a list of spans (code points of
the formatted text) over assistant texts.

Defined cases: null text or role is empty; a message whose parent is missing
is a root; messages on a cycle have no root and are in no path; a null score
counts as 0; equal scores go to the smaller leaf id; repeated ``msg_id``
rows of a conversation are one message, the smallest (role, text) of them;
rows without a ``conv_id`` are of no conversation and left out (``as_tree``
drops them before it orders turns); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path

START, END = "<s>", "</s>"
ROLE, ROLE_END = "[ROLE]", "[/ROLE]"
LEARNED = ("assistant",)


def escape(c: Column) -> Column:
    for plain, safe in (("\\", "\\\\"), ("<", "\\l"), ("[", "\\b")):
        c = F.replace(c, F.lit(plain), F.lit(safe))
    return c


def unescape(s: str) -> str:
    """Inverse of ``escape``; escape pairs are read from the left."""
    return "\\".join(part.replace("\\l", "<").replace("\\b", "[") for part in s.split("\\\\"))


def _jumps(links: DataFrame) -> list[DataFrame]:
    """Tables of (message, ``up``): its ancestor 2^k steps up, for messages
    that have one; the last holds only messages that hang on a cycle."""
    jumps = [cut_lineage(links.filter("parent_id IS NOT NULL").select("conv_id", "msg_id", F.col("parent_id").alias("up")), "chat-jump")]
    left = jumps[0].count()
    while left:
        last = jumps[-1]
        upper = last.select("conv_id", F.col("msg_id").alias("up"), F.col("up").alias("_up"))
        jumps.append(cut_lineage(last.join(upper, ["conv_id", "up"]).select("conv_id", "msg_id", F.col("_up").alias("up")), "chat-jump"))
        before, left = left, jumps[-1].count()
        # Depths have no gaps: if as many messages have the longer jump, none
        # of them ever reaches a root.
        if left == before:
            break
    return jumps


def paths(messages: DataFrame) -> DataFrame:
    """Every root-to-leaf path: rows (``conv_id``, ``leaf``, ``msg_id``,
    ``back``), ``back`` counting messages from the leaf upwards."""
    there = messages.select("conv_id", F.col("msg_id").alias("parent_id"), F.lit(True).alias("_there"))
    links = messages.select("conv_id", "msg_id", "parent_id").join(there, ["conv_id", "parent_id"], "left")
    links = cut_lineage(links.select("conv_id", "msg_id", F.when(F.col("_there"), F.col("parent_id")).alias("parent_id")), "chat-links")
    *jumps, cyclic = _jumps(links)
    parents = links.filter("parent_id IS NOT NULL").select("conv_id", F.col("parent_id").alias("msg_id"))
    leaves = links.join(parents.unionByName(cyclic.select("conv_id", "msg_id")), ["conv_id", "msg_id"], "left_anti")
    rows = cut_lineage(leaves.select("conv_id", F.col("msg_id").alias("leaf"), "msg_id", F.lit(0).cast("long").alias("back")), "chat-steps")
    for k, jump in enumerate(jumps):
        up = rows.join(jump, ["conv_id", "msg_id"]).select(
            "conv_id", "leaf", F.col("up").alias("msg_id"), (F.col("back") + (1 << k)).alias("back"))
        rows = rows.unionByName(cut_lineage(up, "chat-steps"))
    return rows


def best_paths(rows: DataFrame, scores: DataFrame, top: int = 1) -> DataFrame:
    """The ``top`` leaves of each conversation by mean score (``path_rank``).
    The best of each salt come first, so that a conversation with a great
    many leaves is not sorted in one task."""
    ranked = (rows.join(scores, ["conv_id", "msg_id"])
                  .groupBy("conv_id", "leaf").agg(F.avg(F.coalesce("score", F.lit(0.0))).alias("path_score"))
                  .withColumn("_salt", F.xxhash64("leaf") % 64))
    order = [F.desc("path_score"), F.asc("leaf")]
    ranked = ranked.withColumn("_r", F.row_number().over(Window.partitionBy("conv_id", "_salt").orderBy(*order))).filter(F.col("_r") <= top)
    ranked = ranked.withColumn("path_rank", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)))
    return ranked.filter(F.col("path_rank") <= top).drop("_r", "_salt")


def format_conversations(messages: DataFrame, top: int = 1, learned: tuple[str, ...] = LEARNED) -> DataFrame:
    """(``conv_id``, ``leaf``, ``path_rank``, ``path_score``, ``formatted``,
    ``loss_spans``) for the chosen paths of ``messages`` (``conv_id``,
    ``msg_id``, ``parent_id``, ``role``, ``text``, ``score``)."""
    said = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    told = (messages.filter(F.col("conv_id").isNotNull() & F.col("msg_id").isNotNull())
                    .groupBy("conv_id", "msg_id")
                    .agg(F.min("parent_id").alias("parent_id"), F.max("score").alias("score"), F.min(said).alias("said")))
    told = cut_lineage(told, "chat-messages")
    steps = paths(told)
    best = best_paths(steps, told.select("conv_id", "msg_id", "score"), top)
    chosen = steps.join(best, ["conv_id", "leaf"]).join(told.select("conv_id", "msg_id", "said"), ["conv_id", "msg_id"])
    turn = F.struct((-F.col("back")).alias("at"), "said.role", "said.text")
    turns = chosen.groupBy("conv_id", "leaf", "path_rank", "path_score").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    shown = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(ROLE), escape(t["role"]), F.lit(ROLE_END)).alias("head"), escape(t["text"]).alias("body"),
        t["role"].isin(*learned).alias("learn")))
    ends = F.aggregate(
        "shown", F.struct(F.lit(len(START)).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda a, t: F.struct(
            (a["at"] + F.length(t["head"]) + F.length(t["body"]) + len(END)).alias("at"),
            F.when(t["learn"], F.array_append(a["spans"], F.struct(
                (a["at"] + F.length(t["head"])).alias("start"),
                (a["at"] + F.length(t["head"]) + F.length(t["body"])).alias("end")))).otherwise(a["spans"]).alias("spans")),
        lambda a: a["spans"])
    text = F.concat(F.lit(START), F.array_join(F.transform("shown", lambda t: F.concat(t["head"], t["body"], F.lit(END))), ""))
    return (turns.withColumn("shown", shown)
                 .select("conv_id", "leaf", "path_rank", "path_score", text.alias("formatted"), ends.alias("loss_spans")))


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    if not formatted.startswith(START):
        raise ValueError("not a formatted conversation")
    out = []
    for turn in formatted[len(START):].split(END)[:-1]:
        role, _, text = turn.removeprefix(ROLE).partition(ROLE_END)
        out.append((unescape(role), unescape(text)))
    return out


def digests(formatted: DataFrame) -> DataFrame:
    """Per formatted conversation, from its text and mask alone: ``n_turns``,
    ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars``."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def read(batches):
        for b in batches:
            out = []
            for conv, text, spans in zip(*(b.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans"))):
                turns = parse(text)
                said = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode())
                learned = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
                out.append((conv, len(turns), said.hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(text)))
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(read, schema)


def as_tree(conversations: DataFrame) -> DataFrame:
    """Rows (``conv_id``, ``turn``, ``role``, ``text``) as messages: each
    replies to the one before it by turn, then role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return (conversations.filter("conv_id IS NOT NULL").withColumn("msg_id", F.row_number().over(order).cast("long"))
                         .select("conv_id", "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"),
                                 "role", "text", F.lit(None).cast("double").alias("score")))


def write_formatted(spark: SparkSession, formatted: DataFrame, path: str | None = None) -> DataFrame:
    """Write the conversations as Parquet and read them back."""
    path = path or scratch_path(spark, "chat-formatted")
    formatted.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
