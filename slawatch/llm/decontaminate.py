"""Benchmark decontamination with an Aho-Corasick automaton.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of any
character beyond ASCII. A benchmark item gives one window per 13 consecutive
words (an item of fewer words: one window of all). The windows, as word
strings with a blank on both sides, go into one automaton; each document,
normalised the same way, is scanned once, and every hit is mapped back to
words and to offsets of the original text.

The windows reach the tasks by broadcast, in chunks of at most
``chunk_mb`` megabytes of pattern text: a larger benchmark is scanned chunk
after chunk, one automaton at a time, with the rows staged in between, so
neither the driver nor a worker ever holds more than a chunk. Scanning is
map-only.

Defined cases: null texts have no words; an item without words has no
window; items without an id count as one item, null in ``items``, last;
windows that several items share count for each; repeated documents
are separate rows; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut_lineage
from .base import PLAIN, plain_words

WINDOW = 13
#: A document is contaminated if at least one in this many words is hit.
SHARE = 20
CHUNK_MB = 64

_WORD = re.compile(rb"[^ ]+")
def normal(text: str | None) -> list[str]:
    """The words of a text."""
    return [w.decode("utf-8", "surrogatepass") for w in plain_words(text)]


def windows(words: list[str], size: int = WINDOW) -> set[str]:
    if not words:
        return set()
    return {f" {' '.join(words[i:i + size])} " for i in range(max(1, len(words) - size + 1))}


def _automaton(pairs: list[tuple[str, list[str]]]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for text, items in pairs:
        a.add_word(text, (text.count(" ") - 1, items))
    if pairs:
        a.make_automaton()
    return a


def scan(automaton, text: str | None) -> tuple[int, list[tuple[int, int, list[str]]]]:
    """(words in the text, hits as (first word, last word + 1, items))."""
    words = plain_words(text)
    hits = []
    if words and len(automaton):
        line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
        found = list(automaton.iter(line))
        if found:
            # A hit ends on the blank after a word: count blanks up to it.
            blanks = np.cumsum(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) == 32)
            hits = [(int(blanks[end]) - 1 - n, int(blanks[end]) - 1, items) for end, (n, items) in found]
    return len(words), hits


def original_offsets(text: str) -> list[tuple[int, int]]:
    """(start, end) of every word in code points of the original text."""
    raw = text.encode("utf-8", "surrogatepass")
    at = np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)
    starts = np.concatenate([[0], at])
    return [(int(starts[m.start()]), int(starts[m.end()])) for m in _WORD.finditer(raw.translate(PLAIN))]


def pattern_chunks(benchmark: DataFrame, size: int, chunk_mb: int):
    """Chunks of (window, item ids), each window whole in one chunk."""
    def cut(batches):
        for b in batches:
            rows = [(w, i) for i, t in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist()) for w in sorted(windows(normal(t), size))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], names=["window", "item"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    # As structs, since a set of plain values would leave the null id out.
    pairs = (items.mapInArrow(cut, "window string, item string").groupBy("window")
                  .agg(F.array_sort(F.transform(F.collect_set(F.struct("item")), lambda s: s["item"])).alias("items")))
    chunk, held, first = [], 0, True
    for r in pairs.toLocalIterator():
        chunk.append((r["window"], r["items"]))
        held += len(r["window"]) + sum(len(i or "") for i in r["items"])
        if held >= chunk_mb << 20:
            yield chunk
            chunk, held, first = [], 0, False
    if chunk or first:
        yield chunk


#: What a scan adds to each row; ``hit_words`` are runs of word numbers.
FOUND = (("n_words", "bigint"), ("n_hit", "bigint"), ("items", "array<string>"),
         ("hit_words", "array<struct<first:int,last:int>>"),
         ("spans", "array<struct<start:int,end:int>>"), ("contaminated", "boolean"))
_RUN = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_ARROW = [pa.int64(), pa.int64(), pa.list_(pa.string()), _RUN, _SPAN, pa.bool_()]


def _row(automaton, text: str | None, runs: list, items: list) -> tuple:
    n, found = scan(automaton, text)
    runs = [*[(r["first"], r["last"], ()) for r in runs], *found]
    if not runs:
        return n, 0, [], [], [], False
    change = np.zeros(n + 1, dtype=np.int64)
    names = set(items)
    for first, last, ids in runs:
        change[first] += 1
        change[last] -= 1
        names.update(ids)
    hit = np.cumsum(change[:-1]) > 0
    n_hit = int(hit.sum())
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))).reshape(-1, 2).tolist()
    at = original_offsets(text)
    return (n, n_hit, sorted(names, key=lambda i: (i is None, i or "")), [{"first": a, "last": b} for a, b in edges],
            [{"start": at[a][0], "end": at[b - 1][1]} for a, b in edges], SHARE * n_hit >= n)


def _pass(rows: DataFrame, chunk: list, again: bool) -> DataFrame:
    """One scan of every text with the automaton of one chunk."""
    old = [f for f in rows.schema.fields if f.name not in dict(FOUND)]
    schema = StructType([*old, *StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in FOUND)).fields])
    names = [f.name for f in old]
    shared = rows.sparkSession.sparkContext.broadcast(chunk)

    def run(batches):
        automaton = None
        for b in batches:
            automaton = automaton or _automaton(shared.value)
            before = [b.column(c).to_pylist() for c in ("hit_words", "items")] if again else [[[]] * len(b)] * 2
            # Texts one by one: a batch may hold very long ones.
            out = [_row(automaton, text.as_py(), *prior) for text, *prior in zip(b.column("text"), *before)]
            cols = list(zip(*out)) if out else [()] * len(FOUND)
            found = [pa.array(list(c), t) for c, t in zip(cols, _ARROW)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], *found], names=[*names, *dict(FOUND)])

    return rows.mapInArrow(run, schema)


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, chunk_mb: int = CHUNK_MB, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text`` and the columns named in
    ``keep``) with ``n_words``, ``n_hit``, ``items`` (sorted ids as strings),
    ``hit_words``, ``spans`` (hit runs in code points of the original text)
    and ``contaminated``."""
    rows, again = docs.select("doc_id", "text", *keep), False
    for chunk in pattern_chunks(benchmark, size, chunk_mb):
        rows = _pass(cut_lineage(rows, "decontaminate") if again else rows, chunk, again)
        again = True
    return rows


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns kept."""
    cols = docs.columns
    others = F.struct(F.lit(0).alias("_"), *[c for c in cols if c not in ("doc_id", "text")]).alias("_row")
    clean = hits(docs.select("doc_id", "text", others), benchmark, keep=("_row",), **options).filter("NOT contaminated")
    return clean.select(*[c if c in ("doc_id", "text") else F.col(f"_row.{c}") for c in cols])
