"""Removal of repeated byte strings with run-length compressed indexes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
earlier in the corpus (smaller id, or same document, earlier start).

1. Each window of 100 bytes has an anchor: of its 69 grams of 32 bytes the
   one with the smallest hash. Anchor and place of the anchor depend on the
   window's bytes alone, so equal windows have equal anchors. Consecutive
   windows with one anchor form a slice; a slice is kept as a row of numbers
   (anchor, digest of its bytes, document, place).
2. Anchors that occur once in the corpus cannot match (counted by Spark,
   combined before the shuffle). Slices with equal digests are equal: the
   first stays, the others go whole. So copies, and passages that thousands
   of documents share, are settled as numbers, one row per distinct slice.
3. Only where different slices share an anchor (the borders of passages, the
   places around edits) bytes are compared: the first of each of those
   slices is cut from the text. The slices of one anchor are put into a
   run-compressed Burrows-Wheeler index with sampled run ends
   (``runindex``), streamed through it, and windows that match earlier text
   are marked.
4. An anchor with more than ``LIMIT`` different slices is not indexed in one
   task: its windows are compared by 128-bit digests in a grouped minimum
   (combined before the shuffle), which has no limit.
5. The marked windows of a document are joined to its text and cut out.

The documents are staged once in the shared folder, bucketed by document, so
that steps 3 and 5 read them without shuffling text. Rows equal in id and
text are counted first and staged as one row with their number, so a document
is sliced, compared and cut once, however often it is repeated; step 5 gives
all its rows back, those of a much repeated one from many tasks.

Defined cases: a null text is empty; null ids come first; documents that
repeat an id are ordered by a hash of their text, and rows equal in id and
text are one document (all are returned); texts under 100 bytes lose
nothing; removed parts may cut a character, the digest is over bytes; an
empty table gives an empty result.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from .base import small
from .runindex import LENGTH, RunLengthIndex

GRAM = 32
#: Key of the rows without an id: they come first.
NO_ID = -(1 << 63)
#: Grams per window.
SPAN = LENGTH - GRAM + 1
#: Different slices of one anchor that are indexed together.
LIMIT = 4096
#: Bytes of slices per index (its arrays stay in the processor's cache), and
#: of texts hashed at a time.
INDEX_BYTES, HASH_BYTES = 1 << 17, 1 << 21
#: Buckets of the staged documents for each GB of text, and at least.
BUCKETS_PER_GB, BUCKETS = 64, 32
#: Rows of one repeated document that a task gives back together.
COPIES = 256

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xBF58476D1CE4E5B9)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h *= _ODD[6]
    return h ^ (h >> np.uint64(32))


_BYTE = _mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD[0])


def _hashes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the grams and of the windows that start at each byte."""
    n, h, kept = len(text), _BYTE[text], {}
    size, i = 1, 0
    kept[1] = h
    while size < 64:
        h = h[: max(0, n - 2 * size + 1)] * _ODD[i] + h[size:]
        size, i = size * 2, i + 1
        kept[size] = h
    m = max(0, n - LENGTH + 1)
    # 100 = 64 + 32 + 4
    window = (kept[64][:m] * _ODD[5] + kept[32][64:64 + m]) * _ODD[4] + kept[4][96:96 + m]
    return _mix(kept[GRAM]), _mix(window)


def slices_of(text: np.ndarray, begin: np.ndarray) -> dict[str, np.ndarray]:
    """The slices of concatenated documents (``begin``: their first bytes and
    the end): document number, first window ``lo`` (in the document), number
    of windows ``n``, ``anchor`` and ``digest``."""
    grams, windows = _hashes(text)
    m = len(windows)
    ends = np.repeat(begin[1:], np.diff(begin))[:m]
    valid = np.arange(m) + LENGTH <= ends
    # The place in the low bits: a minimum is the leftmost smallest.
    low = np.uint64((1 << 24) - 1)
    best = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    size = 1
    while size * 2 <= SPAN:
        best = np.minimum(best[:-size], best[size:]) if len(best) > size else best[:0]
        size *= 2
    place = (np.minimum(best[:m], best[SPAN - size:SPAN - size + m]) & low).astype(np.int64)
    new = valid.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
    # Windows of different documents never share a slice.
    starts = begin[:-1][begin[:-1] < m]
    new[starts] |= valid[starts]
    first = np.flatnonzero(new)
    n = np.add.reduceat(valid.astype(np.int64), first) if len(first) else first
    doc = np.searchsorted(begin, first, side="right") - 1
    digest = _mix(windows[first] * _ODD[1] + windows[first + n - 1] * _ODD[2] + n.astype(np.uint64)) if len(first) else windows[:0]
    return {"doc": doc, "lo": first - begin[doc], "n": n, "anchor": grams[place[first]].view(np.int64), "digest": digest.view(np.int64)}


def _batches_of(texts: list[bytes]):
    """(first row, texts) of about ``HASH_BYTES``; a longer text is alone."""
    at, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > HASH_BYTES:
            yield at, texts[at:i]
            at, held = i, 0
        held += len(t)
    if at < len(texts):
        yield at, texts[at:]


#: A text longer than this is hashed in overlapping parts (places have 24 bits).
PART = 1 << 23


def _parts(texts: list[bytes]):
    """(row, offset, bytes): long texts in parts that share no window."""
    for row, t in enumerate(texts):
        for at in range(0, max(1, len(t) - LENGTH + 1), PART):
            yield row, at, t[at:at + PART + LENGTH - 1]


def slice_table(texts: list[bytes]) -> dict[str, np.ndarray]:
    """``slices_of`` for a list of texts of any length; ``doc`` is the row."""
    out = []
    parts = [p for p in _parts(texts) if len(p[2]) >= LENGTH]
    for at, some in _batches_of([p[2] for p in parts]):
        begin = np.cumsum([0, *map(len, some)])
        got = slices_of(np.frombuffer(b"".join(some), dtype=np.uint8), begin)
        got["lo"] = got["lo"] + np.array([p[1] for p in parts[at:at + len(some)]], dtype=np.int64)[got["doc"]]
        got["doc"] = np.array([p[0] for p in parts[at:at + len(some)]], dtype=np.int64)[got["doc"]]
        out.append(got)
    kinds = {"doc": np.int64, "lo": np.int64, "n": np.int64, "anchor": np.int64, "digest": np.int64}
    return {k: np.concatenate([o[k] for o in out]) if out else np.zeros(0, dtype=t) for k, t in kinds.items()}


def _bytes(column) -> list[bytes]:
    return [t.as_py() for t in column.cast(pa.binary())]


def _slices(docs: DataFrame) -> DataFrame:
    """(``key``, ``hash``, ``lo``, ``n``, ``anchor``, ``digest``); a slice
    that repeats an earlier one of the same batch of documents has a null
    anchor: it goes. So a slice that very many documents share leaves a batch
    once, before any exchange."""
    def run(batches):
        for whole in batches:
            for i in range(0, len(whole), 512):
                b = whole.slice(i, 512)
                got = slice_table(_bytes(b.column("text")))
                key, row = (b.column(c).to_numpy()[got["doc"]] for c in ("key", "hash"))
                order = np.lexsort((got["lo"], row, key, got["digest"], got["anchor"]))
                again = np.zeros(len(order), dtype=bool)
                same = [got[k][order[1:]] == got[k][order[:-1]] for k in ("anchor", "digest")]
                again[order[1:]] = np.logical_and.reduce(same)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(row), pa.array(got["lo"]), pa.array(got["n"].astype(np.int32)),
                     pa.array(got["anchor"], mask=again), pa.array(got["digest"], mask=again)],
                    names=["key", "hash", "lo", "n", "anchor", "digest"])

    return docs.select("key", "hash", "text").mapInArrow(run, "key long, hash long, lo long, n int, anchor long, digest long")


def _cut(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of wanted slices (``key``, ``hash``, ``anchor``, ``lo``,
    ``n``), from the bucketed documents."""
    lists = wanted.groupBy("key", "hash").agg(F.collect_list(F.struct("anchor", "lo", "n")).alias("wanted"))
    # Hashing the short lists spares sorting the texts of a bucket.
    both = docs.select("key", "hash", "text").join(lists.hint("shuffle_hash"), ["key", "hash"])

    def run(batches):
        names = ["key", "hash", "anchor", "lo", "bytes"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for b in batches:
            cols = [[] for _ in names]
            for key, row, text, some in zip(b.column("key").to_pylist(), b.column("hash").to_pylist(), b.column("text").cast(pa.binary()), b.column("wanted")):
                text = text.as_py()
                for w in some.as_py():
                    for c, v in zip(cols, (key, row, w["anchor"], w["lo"], text[w["lo"]:w["lo"] + w["n"] + LENGTH - 1])):
                        c.append(v)
                if len(cols[0]) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)
                    cols = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return both.mapInArrow(run, "key long, hash long, anchor long, lo long, bytes binary")


def _runs(flags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, first, length) of the runs of set flags of each string."""
    size = np.array([len(f) for f in flags], dtype=np.int64)
    # An unset flag before and after each string keeps runs apart.
    begin = np.cumsum(size + 1) - size
    flat = np.zeros(int(size.sum()) + len(flags) + 1, dtype=np.int8)
    flat[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())] = np.concatenate([*flags, np.zeros(0, dtype=bool)])
    first, end = np.flatnonzero(np.diff(flat)).reshape(-1, 2).T + 1
    string = np.searchsorted(begin, first, side="right") - 1
    return string, first - begin[string], end - first


def _indexed(cut: DataFrame) -> DataFrame:
    """Marked windows (``key``, ``hash``, ``lo``, ``n``) among slices that
    share anchors, by run-length indexes."""
    def run(batches):
        names = ["key", "hash", "lo", "n"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32()]

        def out(rows):
            string, first, n = _runs(RunLengthIndex([r[3] for r in rows]).earlier_matches())
            key, row, lo = (np.array([r[i] for r in rows], dtype=np.int64)[string] for i in range(3))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((key, row, lo + first, n), types)], names=names)

        rows, held, last = [], 0, (None,)
        for b in batches:
            for a, key, row, lo, text in zip(*(b.column(c).to_pylist() for c in ("anchor", "key", "hash", "lo", "bytes"))):
                if (a, key, row, lo) == last:  # rows of a repeated document
                    continue
                # An index holds whole anchors.
                if held > INDEX_BYTES and a != last[0]:
                    yield out(rows)
                    rows, held = [], 0
                rows.append((key, row, lo, text))
                held, last = held + len(text), (a, key, row, lo)
        if rows:
            yield out(rows)

    ordered = cut.repartition("anchor").sortWithinPartitions("anchor", "key", "hash", "lo")
    return ordered.mapInArrow(run, "key long, hash long, lo long, n int")


def _by_digest(cut: DataFrame) -> DataFrame:
    """The same by digests of single windows, for crowded anchors."""
    def run(batches):
        import xxhash

        for b in batches:
            for key, row, lo, text in zip(*(b.column(c).to_pylist() for c in ("key", "hash", "lo", "bytes"))):
                n = len(text) - LENGTH + 1
                same = lambda v: pa.array(np.full(n, v, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [same(key), same(row), pa.array(lo + np.arange(n)), pa.array([xxhash.xxh3_128_digest(text[i:i + LENGTH]) for i in range(n)], pa.binary())],
                    names=["key", "hash", "lo", "window"])

    windows = cut_lineage(cut.mapInArrow(run, "key long, hash long, lo long, window binary"), "dedup-windows")
    place = F.struct("key", "hash", "lo")
    first = windows.groupBy("window").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("many")).filter("many > 1")
    return windows.join(first, "window").filter(place != F.col("first")).select("key", "hash", "lo", F.lit(1).alias("n"))


def marked_windows(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(``key``, ``hash``, ``lo``, ``n``): runs of windows that also start
    earlier. ``docs``: ``key`` (order), ``hash``, ``text`` (bytes)."""
    slices = _slices(docs)
    slices = cut_lineage(slices, "dedup-slices")
    own = slices.filter("anchor IS NULL").select("key", "hash", "lo", "n")
    keyed = slices.filter("anchor IS NOT NULL")
    often = keyed.groupBy("anchor").agg(F.count(F.lit(1)).alias("many")).filter("many > 1").select("anchor")
    shared = cut_lineage(keyed.join(often, "anchor", "left_semi"), "dedup-shared")
    place = F.struct("key", "hash", "lo")
    kinds = cut_lineage(shared.groupBy("anchor", "digest").agg(F.min(place).alias("first"), F.first("n").alias("n"), F.count(F.lit(1)).alias("many")), "dedup-kinds")
    # Later copies of a slice go whole.
    repeated = kinds.filter("many > 1").select("anchor", "digest", "first")
    copies = shared.join(repeated, ["anchor", "digest"]).filter(place != F.col("first")).select("key", "hash", "lo", "n")
    # First copies of different slices with one anchor are compared.
    varied = cut_lineage(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1"), "dedup-varied")

    def wanted(anchors: DataFrame) -> DataFrame:
        return kinds.join(anchors, "anchor").select("first.key", "first.hash", "anchor", "first.lo", "n")

    crowded = varied.filter(F.col("kinds") > limit)
    found = [own, copies, _indexed(_cut(docs, wanted(varied.filter(F.col("kinds") <= limit))))]
    if not crowded.isEmpty():
        found.append(_by_digest(_cut(docs, wanted(crowded))))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def staged_documents(docs: DataFrame) -> DataFrame:
    """Distinct documents as bytes with the number of their rows (``copies``),
    bucketed by ``key`` (the id; null first) and ``hash`` (of the text, where
    an id has several texts or is null, else 0), so that later joins with
    their places move no text."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), F.xxhash64(text).alias("hash"), text.cast("binary").alias("text"))
    seen = rows.groupBy("key", "hash").agg(F.count(F.lit(1)).alias("many"), F.sum(F.octet_length("text")).alias("size"))
    seen = cut_lineage(seen, "dedup-rows")
    size = seen.agg(F.sum("size")).first()[0] or 0
    repeated = seen.filter("many > 1").select("key", "hash")
    # Only ids with several texts need the hash; 0 elsewhere takes no room in the exchanges.
    several = seen.filter(F.col("key") != NO_ID).groupBy("key").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    tied = seen.join(several, "key", "left_semi").select("key", "hash", F.lit(True).alias("tied"))
    if several.isEmpty():
        rows = rows.withColumn("tied", F.lit(False))
    else:
        rows = rows.join(small(tied), ["key", "hash"], "left")
    short = F.when((F.col("key") == NO_ID) | F.coalesce("tied", F.lit(False)), F.col("hash")).otherwise(0).alias("hash")
    if repeated.isEmpty():
        rows = rows.select("doc_id", "key", short, "text", F.lit(1).cast("long").alias("copies"))
    else:
        repeated = small(repeated)
        once = rows.join(repeated, ["key", "hash"], "left_anti").select("doc_id", "key", short, "text", F.lit(1).cast("long").alias("copies"))
        # By the text itself: equal hashes alone do not make one document.
        again = rows.join(repeated, ["key", "hash"], "left_semi").select("doc_id", "key", short, "text")
        rows = once.unionByName(again.groupBy("doc_id", "key", "hash", "text").agg(F.count(F.lit(1)).alias("copies")))
    buckets = max(BUCKETS, round(size / 1e9 * BUCKETS_PER_GB))
    name = f"dedup_{uuid.uuid4().hex[:12]}"
    (rows.write.bucketBy(buckets, "key", "hash").option("path", scratch_path(spark, "dedup-documents"))
         .option("compression", "zstd").saveAsTable(name))
    return spark.table(name)


def _kept(staged: DataFrame, marks: DataFrame) -> DataFrame:
    """The result of each staged document, with ``hash`` and ``copies``."""
    both = staged.join(marks.hint("shuffle_hash"), ["key", "hash"], "left").select("doc_id", "hash", "copies", "text", "marks")

    def run(batches):
        names = ["doc_id", "hash", "copies", "n_bytes", "removed", "kept"]
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for whole in batches:
            for i in range(0, len(whole), 256):
                b = whole.slice(i, 256)
                sizes, removed, kept = [], [], []
                for text, some in zip(b.column("text"), b.column("marks")):
                    text = text.as_py()
                    spans = merged([(m["lo"], m["lo"] + m["n"] - 1 + LENGTH) for m in some.as_py() or ()])
                    sizes.append(len(text))
                    removed.append([{"start": x, "end": y} for x, y in spans])
                    at = [0, *[e for s in spans for e in s], len(text)]
                    kept.append(b"".join(text[x:y] for x, y in zip(at[::2], at[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c) for c in names[:3]], pa.array(sizes, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary())], names=names)

    kind = staged.schema["doc_id"].dataType.simpleString()
    return both.mapInArrow(run, f"doc_id {kind}, hash long, copies long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary")


def remove_repeats(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_bytes``, ``removed`` (runs of
    removed bytes) and ``kept`` (the remaining bytes)."""
    staged = staged_documents(docs)
    marks = cut_lineage(marked_windows(staged, limit).groupBy("key", "hash").agg(F.collect_list(F.struct("lo", "n")).alias("marks")), "dedup-marks")
    names, most = ["doc_id", "n_bytes", "removed", "kept"], staged.agg(F.max("copies")).first()[0] or 0
    if most <= 1:
        return _kept(staged, marks).select(*names)
    each = lambda n: F.explode(F.sequence(F.lit(1).cast("long"), n))
    out = _kept(staged.filter(F.col("copies") <= COPIES), marks).select(*names, each(F.col("copies"))).select(*names)
    if most > COPIES:
        parts = _kept(staged.filter(F.col("copies") > COPIES), marks).select("*", each(F.ceil(F.col("copies") / COPIES)).alias("part"))
        rest = F.least(F.lit(COPIES).cast("long"), F.col("copies") - (F.col("part") - 1) * COPIES)
        out = out.unionByName(parts.repartition("doc_id", "hash", "part").select(*names, each(rest)).select(*names))
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
